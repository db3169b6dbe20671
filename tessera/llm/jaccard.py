"""Near copies by the exact Jaccard index of their distinct word shingles: candidates from two sides, each verified on the shingles.

Documents with the same shingles are one class (by a 64-bit hash of the set). The Gray index of simhash.py names classes whose
fingerprints differ in a few bits. It can't see all pairs of an index of 0.8, so prefix filtering names the rest: under any order of
all shingles, two sets of an index of s or more share one of the first n - ceil(s * n) + 1 shingles of each, so classes that meet in such a
prefix, and whose sizes and places there leave enough in common, are all the candidates there are. The order begins with the shingles
that a count-min sketch of all of them estimates in one class alone: they meet none, so a text of which a fifth or more is its own has no
candidates. The shingles that a sample of documents often holds come last. The order decides how many candidates there are, never
which links are found; a fuller sketch leaves more of them.

Each meeting shingle first tries its member of the earliest place against the others; after that only members of different
components are tried, all of them, dealt into pairs of parts. A candidate goes first if the parities of the two sets differ in too
many cells, then by the sets themselves.

Texts without words are one class. Rows with a null doc_id belong to no class. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, mix, row_id, ship, slices, span_hashes, texts, word_bounds
from tessera.llm.simhash import links, nearest
from tessera.llm.substring import cells, estimated_twice, merged_cells, sketch_bits, sketch_rows
from tessera.operators.graph import connected_components

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Documents of the sample that orders shingles, how many of them make a shingle common, and the most that are common.
SAMPLE, COMMON, MOST = 4096, 4, 1 << 17
#: Bits of the table that names the rows whose sets are wanted, and the fewest cells of a set's parities.
TABLE_BITS, LEAST_CELLS = 1 << 23, 256


def shingles(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For slices of a batch: the rows first to last, and the row (from first) and hash of each distinct shingle, in that order.

    Words are lower-cased (A-Z) and split at white space; a text of fewer words than size is one shingle.
    """
    data, offsets = texts(column)
    for part in slices(data, offsets):
        b = part.bytes.copy()
        b[(b >= 65) & (b <= 90)] += 32
        starts, ends = word_bounds(b)
        row = np.searchsorted(part.starts, starts, "right") - 1
        word = span_hashes(b, starts, ends)
        held = np.bincount(row, minlength=part.last - part.first)
        n = max(0, len(word) - size + 1)
        whole = np.flatnonzero(row[:n] == row[size - 1 :]) if n else np.zeros(0, np.int64)
        hashed = np.zeros(len(whole), np.uint64)
        for k in range(size):
            hashed = mix(hashed * _ODD + word[whole + k])
        at = np.cumsum(held) - held
        short = np.flatnonzero((held > 0) & (held < size))
        few = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            more = held[short] > k
            few[more] = mix(few[more] * _ODD + word[at[short[more]] + k])
        row, hashed = np.concatenate([row[whole], short]), np.concatenate([hashed, few])
        order = np.lexsort([hashed, row])
        row, hashed = row[order], hashed[order]
        fresh = np.ones(len(row), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (hashed[1:] != hashed[:-1])
        yield part.first, part.last, row[fresh], hashed[fresh]


def classes_of(rows: int, row: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each row (a hash of its set of shingles) and the size of that set."""
    n = np.bincount(row, minlength=rows)
    total = np.zeros(len(hashed) + 1, np.uint64)
    np.cumsum(mix(hashed), out=total[1:])
    ends = np.cumsum(n)
    return mix((total[ends] - total[ends - n]) * _ODD + n.astype(np.uint64)).view(np.int64), n


def _enough(common: Column, n: Column, m: Column, share: int) -> Column:
    """Whether sets of n and m that have so many in common reach an index of share / 1000."""
    return common * (1000 + share) >= share * (n + m)


def fingerprints_of(rows: int, row: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """The majority of each bit over each row's distinct shingles; zero for a row that has none."""
    n = np.bincount(row, minlength=rows)
    there = np.flatnonzero(n)
    out = np.zeros(rows, np.uint64)
    if len(there):
        bits = np.unpackbits(hashed.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones = np.add.reduceat(bits, (np.cumsum(n) - n)[there], axis=0, dtype=np.int64)
        out[there] = np.packbits(2 * ones > n[there][:, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)
    return out


def _classes(rows: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, row, hashed in shingles(batch.column("text"), size):
                cls, _ = classes_of(last - first, row, hashed)
                fp = fingerprints_of(last - first, row, hashed)
                yield pa.record_batch([*(batch.column(c).slice(first, last - first) for c in ("row_id", "doc_id")), pa.array(cls), pa.array(fp.view(np.int64))], ["row_id", "doc_id", "class", "fp"])

    return rows.mapInArrow(run, "row_id struct<a: bigint, b: bigint>, doc_id long, class long, fp long")


def _common(rows: DataFrame, size: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a sample of the rows often holds, ascending, and how many of its rows do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, hashed in shingles(batch.column("text"), size):
                yield pa.record_batch([pa.array(hashed.view(np.int64))], ["h"])

    some = rows.filter(F.pmod("row_id.b", F.lit(1 << 20)) < int(share * (1 << 20))).select("text")
    often = some.mapInArrow(run, "h long").groupBy("h").count().filter(F.col("count") >= COMMON).orderBy(F.desc("count"), "h").limit(MOST).collect()
    found = np.array([r["h"] for r in often], np.int64).view(np.uint64)
    order = np.argsort(found)
    return found[order], np.array([r["count"] for r in often], np.int64)[order]


def _flags(ids: DataFrame) -> np.ndarray:
    """A bit table of fixed size that holds each row_id, and others."""
    longs = ids.groupBy(F.shiftright(_bit(), 6).alias("i")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(row_id.a, {TABLE_BITS}) & 63 as int))")).alias("bits")).collect()
    table = np.zeros(TABLE_BITS >> 6, np.int64)
    table[[r["i"] for r in longs]] = [r["bits"] for r in longs]
    return table.view(np.uint64)


def _bit() -> Column:
    return F.pmod("row_id.a", F.lit(TABLE_BITS))


def _held(batch: pa.RecordBatch, table: np.ndarray) -> pa.RecordBatch:
    """The rows whose bit (column at) is set."""
    at = batch.column("at").to_numpy()
    return batch.filter(pa.array((table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0))


def _prefixes(rows: DataFrame, first: DataFrame, size: int, share: int, common: tuple[np.ndarray, np.ndarray], bits: int) -> DataFrame:
    """class, n, h, place: the shingles of each class's prefix that two classes hold, and some others. first: a row_id of each class."""
    context = rows.sparkSession.sparkContext
    spread, wanted = context.broadcast(common), context.broadcast(_flags(first))
    rows = rows.select(_bit().alias("at"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for *_, h in shingles(_held(batch, wanted.value).column("text"), size):
                held.append(cells(h, bits).reshape(-1))
                n += len(h)
                if n >= 1 << 21:
                    yield sketch_rows(np.concatenate(held), bits)
                    held, n = [], 0
        if n:
            yield sketch_rows(np.concatenate(held), bits)

    flags = context.broadcast(merged_cells(rows.mapInArrow(count, "range int, once binary, more binary"), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (known, counts), table = spread.value, flags.value
        for batch in batches:
            for start, last, row, hashed in shingles(_held(batch, wanted.value).column("text"), size):
                cls, n = classes_of(last - start, row, hashed)
                often = estimated_twice(table, hashed, bits).astype(np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, hashed), len(known) - 1)
                    often += np.where(known[at] == hashed, counts[at], 0)
                order = np.lexsort([hashed, often, row])
                row, hashed, often = row[order], hashed[order], often[order]
                place = np.arange(len(row)) - (np.cumsum(n) - n)[row]
                held = (often > 0) & (place <= (n - (n * share + 999) // 1000)[row])
                row = row[held]
                yield pa.record_batch([pa.array(cls[row]), pa.array(n[row].astype(np.int32)), pa.array(hashed[held].view(np.int64)), pa.array(place[held].astype(np.int32))], ["class", "n", "h", "place"])

    return rows.mapInArrow(run, "class long, n int, h long, place int")


def _lists(ends: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(values.view(np.int64)))


def _sets(rows: DataFrame, wanted: DataFrame, size: int, parities: bool) -> DataFrame:
    """class, n and s of each row whose row_id is wanted, and of a few others: a bit table of fixed size lets rows through, so no texts are dealt.

    s are the shingles, or with parities about a cell for each shingle: how many shingles fall into it, modulo 2.
    """
    spread = rows.sparkSession.sparkContext.broadcast(_flags(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _held(batch, spread.value)
            for first, last, row, hashed in shingles(batch.column("text"), size):
                cls, n = classes_of(last - first, row, hashed)
                ends, held = np.cumsum(n), hashed
                if parities:
                    cells = np.maximum(LEAST_CELLS, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
                    ends = np.cumsum(cells)
                    odd = np.bincount((ends - cells)[row] + (hashed.view(np.int64) & (cells - 1)[row]), minlength=int(cells.sum())) & 1
                    ends, held = ends // 64, np.packbits(odd.astype(bool), bitorder="little")
                yield pa.record_batch([pa.array(cls), pa.array(n.astype(np.int32)), _lists(ends, held)], ["class", "n", "s"])

    return rows.select(_bit().alias("at"), "text").mapInArrow(run, "class long, n int, s array<long>")


def _folded(s: Column, size: Column) -> Column:
    """Parities over half as many cells, where s has more than size longs."""
    return F.when(F.size(s) > size, F.zip_with(F.slice(s, F.lit(1), size), F.slice(s, size + 1, size), lambda x, y: x.bitwiseXOR(y))).otherwise(s)


def near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, limit: int = 4, part_rows: int = 512) -> DataFrame:
    """row_id (of doc_id and text), doc_id, component_id of each row with a doc_id: the smallest doc_id reachable over pairs of the similarity or more."""
    share = round(1000 * similarity)
    ship(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    texts_ = docs.select(row_id(doc_id, F.col("text")).alias("row_id"), doc_id.alias("doc_id"), "text").filter("doc_id is not null")
    rows = cut(_classes(texts_, shingle))
    total = rows.count()
    first = rows.groupBy("class").agg(F.min(F.struct("doc_id", "row_id", "fp")).alias("f"))
    first = cut(first.select("class", F.struct("f.doc_id", "class").alias("node"), "f.row_id", "f.fp"))
    close = links(first.select("fp", F.col("class").alias("node")), limit, of_group=nearest)

    common = _common(texts_, shingle, min(1.0, SAMPLE / max(1, total)))
    w = Window.partitionBy("h")
    met = _prefixes(texts_, first, shingle, share, common, sketch_bits(total)).select(
        "*", F.min("class").over(w).alias("low"), F.max("class").over(w).alias("high"), F.min(F.struct("place", "class", "n")).over(w).alias("pivot"),
    )
    met = cut(met.filter("low <> high").drop("low", "high").dropDuplicates(["class", "h"]))

    def sets(wanted: DataFrame, parities: bool) -> DataFrame:
        return cut(_sets(texts_, wanted.select("class").distinct().join(first, "class").select("row_id"), shingle, parities))

    def may(n: Column, at: Column, m: Column, at_m: Column) -> Column:
        return _enough(F.least(n - at, m - at_m), n, m, share)

    def verified(pairs: DataFrame) -> DataFrame:
        """Sets differ in no fewer shingles than their parities differ in cells, so most pairs go before their sets are joined."""
        pairs = cut(pairs.distinct())
        parities = sets(pairs.select(F.col("a").alias("class")).union(pairs.select("b")), True)
        left, right = (parities.select(F.col("class").alias(c), F.col("n").alias(f"n_{c}"), F.col("s").alias(f"s_{c}")) for c in "ab")
        both = pairs.join(left, "a").filter("n_a is not null").join(right, "b").filter(_enough(F.least("n_a", "n_b"), F.col("n_a"), F.col("n_b"), share))
        cells = F.least(F.size("s_a"), F.size("s_b"))
        differ = F.aggregate(F.zip_with(_folded(F.col("s_a"), cells), _folded(F.col("s_b"), cells), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
        pairs = cut(both.filter(_enough((F.col("n_a") + F.col("n_b") - differ) / 2, F.col("n_a"), F.col("n_b"), share)).select("a", "b").distinct())
        held = sets(pairs.select(F.col("a").alias("class")).union(pairs.select("b")), False)
        left, right = (held.select(F.col("class").alias(c), F.col("s").alias(f"s_{c}")) for c in "ab")
        both = pairs.join(left, "a").join(right, "b")
        shared = F.size(F.array_intersect("s_a", "s_b"))
        return cut(both.filter(_enough(shared, F.size("s_a"), F.size("s_b"), share)).select("a", "b").distinct())

    def labelled(edges: DataFrame) -> DataFrame:
        """class, component of the classes that edges link; a component is its smallest (doc_id, class), so no group meets in one place to find it."""
        a, b = (first.select(F.col("class").alias(c), F.col("node").alias(f"node_{c}")) for c in "ab")
        edges = edges.join(a, "a").join(b, "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        return connected_components(edges).select("node.class", "component")

    tried = met.filter("class <> pivot.class").filter(may(F.col("n"), F.col("place"), F.col("pivot.n"), F.col("pivot.place")))
    tried = cut(tried.select(F.least("class", "pivot.class").alias("a"), F.greatest("class", "pivot.class").alias("b")).union(close).distinct())
    found = verified(tried)
    left = met.drop("pivot").join(labelled(found), "class", "left").withColumn("component", F.coalesce("component.class", "class"))
    open_ = left.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(F.count("*") / part_rows).cast("int").alias("parts")).filter("low <> high")
    left = cut(left.join(open_.select("h", "parts"), "h").withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")))
    other = left.select("h", *(F.col(c).alias(f"{c}_b") for c in ("class", "n", "place", "component")), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    rest = left.join(other, ["h", "part"]).filter("class < class_b and component <> component_b").filter(may(F.col("n"), F.col("place"), F.col("n_b"), F.col("place_b")))
    rest = rest.select(F.col("class").alias("a"), F.col("class_b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    label = first.join(labelled(found.union(verified(rest))), "class", "left").select("class", F.coalesce("component.doc_id", "node.doc_id").alias("component_id"))
    return rows.join(label, "class").select("row_id", "doc_id", "component_id")
