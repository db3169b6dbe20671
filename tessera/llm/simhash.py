"""SimHash near-duplicates: fingerprints of word shingles, linked within a few bits through a Gray-order hierarchical index.

Fingerprints are first made distinct, so copies cost nothing further. Two fingerprints within k bits agree on at
least 2 of k + 2 blocks of bits, so every distinct fingerprint goes to the upper nodes (15 for 4 bits) that are named by
the masked pattern of a pair of blocks. Inside a node fingerprints are sorted by Gray rank; runs of neighbours share masked bit
patterns, which become the nodes above them, and two whole runs are dropped together once the differences that
their shared bits accumulate exceed the limit. A node of more than ``node_rows`` fingerprints is dealt into parts, and
each pair of parts is a task's work of its own. Only a spanning star of each linked group leaves a task, and
components come from alternating large and small stars over those few links.

Empty and null texts have fingerprint zero and link like any other. Rows with a null doc_id keep their fingerprint
and have a null component_id. Repeated rows each get a row. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, raw_texts, row_id, ship, unused
from tessera.operators.graph import connected_components

def fingerprint(words: list[bytes], size: int) -> int:
    """Majority vote of the bits of XXH64 (seed 42) over all shingles, repeats included."""
    if not words:
        return 0
    if len(words) < size:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    h = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        bits = np.unpackbits(h[at : at + 65536].view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of each row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.lower().split(), shingle) for t in raw_texts(batch.column("text"))]
            yield pa.record_batch([batch.column("doc_id"), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each fingerprint in the binary-reflected Gray order."""
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index that each node reaches over the links (i, j) and what label holds already."""
    while len(i):
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            break
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        low = np.minimum(a, b)
        np.minimum.at(label, np.maximum(a, b), low)
        while True:
            nearer = label[label]
            if (nearer == label).all():
                break
            label = nearer
    return label


class GrayIndex:
    """One tree for each group of fingerprints, over rows sorted by (group, Gray rank).

    A node holds a run of up to ``fan`` neighbours, and keeps the bits that all fingerprints under it share, and their mask. Level 0
    are the fingerprints themselves; a group's root is the level at which it has one node.
    """

    def __init__(self, group: np.ndarray, fp: np.ndarray, fan: int = 8) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = [(fp, np.full(len(fp), ~np.uint64(0)))]
        self.children: list[np.ndarray] = []  # by level: first child of each node, and the end of the last one's
        self.roots: list[np.ndarray] = []
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.diff(np.r_[first, len(fp)])
        both = any_ = fp
        alone = size == 1
        self.roots.append(first[alone])
        while not alone.all():
            parents = -(-size // fan)
            head = np.cumsum(parents) - parents
            at = np.repeat(first - fan * head, parents) + fan * np.arange(int(parents.sum()))
            self.children.append(np.r_[at, len(both)])
            both, any_ = np.bitwise_and.reduceat(both, at), np.bitwise_or.reduceat(any_, at)
            self.levels.append((both, ~(both ^ any_)))
            self.roots.append(head[(parents == 1) & ~alone])
            first, size, alone = head, parents, parents == 1
        self.fan = fan

    def pairs(self, limit: int, block: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of all pairs i < j of one group whose fingerprints differ in at most limit bits, and in how many."""
        stack = [(level, r, r, np.zeros(len(r), np.uint64), np.zeros(len(r), np.int64)) for level, r in enumerate(self.roots) if level and len(r)]
        step = np.arange(self.fan)
        while stack:
            level, i, j, seen, differ = stack.pop()
            if len(i) > block:
                half = len(i) // 2
                stack += [(level, i[:half], j[:half], seen[:half], differ[:half]), (level, i[half:], j[half:], seen[half:], differ[half:])]
                continue
            shared, mask = self.levels[level]
            fresh = mask[i] & mask[j] & ~seen  # bits that become fixed at this node and count from here on
            differ = differ + np.bitwise_count((shared[i] ^ shared[j]) & fresh)
            near = differ <= limit
            if level == 0:
                near &= i < j
                yield i[near], j[near], differ[near]
                continue
            i, j, seen, differ = i[near], j[near], (seen | fresh)[near], differ[near]
            child = self.children[level - 1]
            wide = self.fan**2
            a = np.repeat(child[i], wide) + np.tile(np.repeat(step, self.fan), len(i))
            b = np.repeat(child[j], wide) + np.tile(step, self.fan * len(j))
            held = (a <= b) & (a < np.repeat(child[i + 1], wide)) & (b < np.repeat(child[j + 1], wide))
            stack.append((level - 1, a[held], b[held], np.repeat(seen, wide)[held], np.repeat(differ, wide)[held]))


def star(index: GrayIndex, node: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of each linked group's smallest node to its others."""
    label = np.arange(len(node))
    for i, j, _ in index.pairs(limit):
        label = _labels(label, i, j)
    least = np.full(len(node), np.iinfo(np.int64).max)
    np.minimum.at(least, label, node)
    a = least[label]
    return a[a != node], node[a != node]


def nearest(index: GrayIndex, node: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the nearest row before it in Gray order, the first of equally near ones: real links, one a row at most."""
    best = np.full(len(node), np.iinfo(np.int64).max)
    for i, j, differ in index.pairs(limit):
        np.minimum.at(best, j, differ.astype(np.int64) << 48 | i)
    j = np.flatnonzero(best < np.iinfo(np.int64).max)
    return node[best[j] & ((1 << 48) - 1)], node[j]


def links(nodes: DataFrame, limit: int = 4, node_rows: int = 2048, of_group: Callable = star) -> DataFrame:
    """Links (a, b), a < b, whose components are those of all pairs of fingerprints that differ in at most limit bits.

    nodes: fp, node (distinct). Of limit + 2 blocks, two agree; the wider the limit, the fewer bits an upper node names. With
    ``nearest`` as of_group, links are pairs that are this near themselves, a few for each node.
    """
    if not 0 <= limit <= 12:
        raise ValueError("limit must be 0 to 12")
    blocks = limit + 2
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    block = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    masks = [block[a] | block[b] for a, b in combinations(range(blocks), 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    upper = nodes.select("fp", "node", F.posexplode(F.split(F.lit(",".join(map(str, signed))), ",").cast("array<bigint>")).alias("mask", "bits"))
    upper = upper.select("fp", "node", "mask", F.col("fp").bitwiseAND(F.col("bits")).alias("pattern"))
    large = upper.groupBy("mask", "pattern").count().filter(F.col("count") > node_rows)
    large = large.select("mask", "pattern", F.ceil(F.col("count") / node_rows).cast("int").alias("parts"))
    upper = upper.join(cut(large), ["mask", "pattern"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    upper = upper.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    key = ["mask", "pattern", "low", "high"]
    dealt = upper.select("mask", "pattern", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "fp", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        col = {c: table.column(c).to_numpy() for c in table.column_names}
        fp = col["fp"].view(np.uint64)
        order = np.lexsort([gray_rank(fp), *(col[k] for k in reversed(key))])
        fp, node = fp[order], col["node"][order]
        change = np.zeros(len(fp), bool)
        for k in key:
            v = col[k][order]
            change[1:] |= v[1:] != v[:-1]
        a, b = of_group(GrayIndex(np.cumsum(change), fp), node, limit)
        yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    ship(nodes.sparkSession)
    return dealt.repartition(*key).mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, limit: int = 4) -> DataFrame:
    """doc_id, fp, component_id of each row of docs; component_id is the smallest doc_id reachable over links."""
    fps = cut(fingerprints(docs, shingle))
    nodes = cut(fps.filter(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("node")))
    found = connected_components(links(nodes, limit))
    label = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    known = fps.filter(F.col("doc_id").isNotNull()).join(label, "fp", "left").select("doc_id", "fp", "component_id")
    return known.union(fps.filter(F.col("doc_id").isNull()).select("doc_id", "fp", F.lit(None).cast("long")))


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def deduplicate(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs with one document of each group: the smallest doc_id; a row with a null doc_id stays.

    Groups hang together by pairs whose distinct shingles have a Jaccard index of the similarity or more. The Gray index names
    pairs that differ in a few bits; each is verified on its shingles. Pairs of 0.8 lie up to some 14 bits apart, where fingerprints of 64
    bits name about all pairs of unrelated texts too, so the pairs that the index can't see come from shingles themselves (jaccard.py).
    """
    from tessera.llm import jaccard  # it takes the index from here

    key = unused(docs, "row_id")
    groups = jaccard.near_copies(docs, shingle, similarity)
    gone = groups.filter("component_id <> doc_id").select(F.col("row_id").alias(key)).distinct()
    return docs.withColumn(key, row_id(F.col("doc_id").cast("long"), F.col("text"))).join(gone, key, "left_anti").select(docs.columns)
