"""Benchmark decontamination by spaced seeds.

A mask keeps some of the words after a position and ignores the others. Every position of every test item and of every
document is hashed under each mask; documents meet items where hashes are equal, and only there are whole
overlaps compared word by word along the diagonal. With the two masks below, any 12 aligned words of which at most
2 differ share a seed, so no such overlap is lost. An item of fewer words than the window is cut into one run more than words
of it may differ, so that one run is always whole; documents are hashed under runs of these lengths too, if there are such items.
Positions whose hashes fall on no bit of the test items' table (a constant of bounded size, probed twice) leave before they become rows.

Words are runs of letters, digits and non-ASCII characters with A-Z lower-cased. A document overlaps an item if
some ``window`` aligned words (the whole item, if shorter) agree in a share of ``similarity`` or more. Null and empty texts on
either side overlap nothing. Rows and items with a null id are searched like others. Repeated rows and items are found once. Empty
tables on either side give an empty result.
"""

from __future__ import annotations

import functools
import itertools
import math
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, let, row_id, unused
from tessera.llm.native import bit_table, bucket, in_table, letter_words

#: Places that a mask keeps; the others up to its last are ignored.
MASKS = ((0, 1, 2, 3, 5), (0, 1, 2, 4, 7))
#: Bits of the test items' table: about 16 for each seed, within these bounds.
LEAST_BITS, MOST_BITS = 1 << 19, 1 << 22


def runs(words: int, similarity: float) -> list[tuple[int, int]]:
    """Start and length of the runs that an item of so few words is cut into: one more than words of it may differ."""
    parts = words - math.ceil(round(words * similarity, 9)) + 1
    edges = [words * k // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(edges)]


def positions(df: DataFrame, key: str, masks: tuple[tuple[int, ...], ...] = MASKS) -> DataFrame:
    """key, at and h0, h1, ...: each position of the word array ``w`` with its hash under each mask, null where the mask doesn't fit.

    The places that masks keep are zipped as shifted copies of the word hashes, so that a position is a row of plain
    columns, and hashing and probing it is generated code.
    """
    places = sorted({k for mask in masks for k in mask})
    df = df.select(key, F.transform("w", lambda x: F.xxhash64(x)).alias("w")).filter(F.size("w") > 0)
    shifted = [F.slice("w", F.lit(k + 1), F.size("w")).alias(f"w{k}") for k in places]
    rows = df.select(key, F.inline(F.arrays_zip(F.sequence(F.lit(0), F.size("w") - 1).alias("at"), *shifted)).alias("at", *(f"w{k}" for k in places)))
    hashes = [F.when(F.col(f"w{mask[-1]}").isNotNull(), F.xxhash64(F.lit(",".join(map(str, mask))), *(F.col(f"w{k}") for k in mask))).alias(f"h{m}") for m, mask in enumerate(masks)]
    return rows.select(key, "at", *hashes)


def seeds(rows: DataFrame, key: str) -> DataFrame:
    """key, at, seed: a row for each mask that fits."""
    return rows.select(key, "at", F.explode(F.array(*(F.col(c) for c in rows.columns if c not in (key, "at")))).alias("seed")).filter("seed is not null")


def _probe(h: Column) -> Column:
    return F.shiftright(h, 21)


def item_table(benchmark: DataFrame, window: int, similarity: float) -> tuple[DataFrame, DataFrame, tuple[tuple[int, ...], ...], Column, int]:
    """Items with their words, their seeds, the masks that documents need, and the table of bits that the seeds fall on with its size."""
    item_id = F.col("item_id").cast("long")
    items = benchmark.select(row_id(item_id, F.col("text")).alias("item_key"), item_id.alias("item_id"), letter_words(F.col("text")).alias("item"))
    items = cut(items.filter(F.size("item") > 0).dropDuplicates(["item_key"]))
    sizes = {r["n"] for r in items.select(F.least(F.size("item"), F.lit(window)).alias("n")).distinct().collect()}  # at most window rows
    own, masks = [], list(MASKS) if window in sizes else []
    if window in sizes:
        own.append(seeds(positions(items.filter(F.size("item") >= window).withColumnRenamed("item", "w"), "item_key"), "item_key"))
    for n in sorted(sizes - {window}):
        for at, length in runs(n, similarity):
            mask = tuple(range(length))
            masks += [mask] if mask not in masks else []
            first = positions(items.filter(F.size("item") == n).select("item_key", F.slice("item", at + 1, length).alias("w")), "item_key", (mask,))
            own.append(seeds(first.filter("at = 0").withColumn("at", F.lit(at)), "item_key"))
    if not own:
        return items, items.select("item_key", F.lit(0).alias("item_at"), F.lit(0).cast("long").alias("seed")), MASKS, bit_table({}, 64), 64
    seeds_ = cut(functools.reduce(DataFrame.union, own).withColumnRenamed("at", "item_at"))
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * seeds_.count()).bit_length()))
    both = seeds_.select(bucket(F.col("seed"), size).alias("b")).union(seeds_.select(bucket(_probe(F.col("seed")), size)))
    longs = both.groupBy(F.shiftright("b", 6).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, b & 63)")).alias("bits"))
    return items, seeds_, tuple(masks), bit_table({r["i"]: r["bits"] for r in longs.collect()}, size), size  # at most size / 64 rows


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 12, similarity: float = 0.8) -> DataFrame:
    """row_key, doc_id, item_id, first_word, last_word, n_equal, similarity of each verified overlap's longest reach."""
    if (window, similarity) != (12, 0.8) and (window < 12 or math.floor(window * (1 - similarity) + 1e-9) > 2):
        raise ValueError("the masks find all overlaps of windows of 12 words or more in which at most 2 differ")
    items, item_seeds, masks, table, size = item_table(benchmark, window, similarity)

    def near(h: Column) -> Column:
        return in_table(table, h, size) & in_table(table, _probe(h), size)

    docs = docs.select(F.col("doc_id").cast("long"), "text", row_id(F.col("doc_id").cast("long"), F.col("text")).alias("row_key"))
    rows = positions(docs.select("row_key", letter_words(F.col("text")).alias("w")), "row_key", masks)
    some = rows.filter(functools.reduce(operator.or_, (F.coalesce(near(F.col(f"h{m}")), F.lit(False)) for m in range(len(masks)))))
    hits = seeds(some, "row_key").filter(near(F.col("seed")))
    hits = hits.join(item_seeds, "seed").select("row_key", "item_key", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()
    hits = cut(hits.join(items, "item_key").groupBy("row_key").agg(F.collect_list(F.struct("item_key", "item_id", "diagonal", "item")).alias("tries")))

    def compare(w: Column) -> Column:
        def line(t: Column) -> Column:
            equal = F.transform(t["item"], lambda x, i: F.coalesce((F.get(w, i + t["diagonal"]) == x).cast("int"), F.lit(0)))
            n = F.least(F.lit(window), F.size(t["item"]))

            def reach(e: Column) -> Column:
                starts = F.filter(F.sequence(F.lit(0), F.size(e) - n), lambda i: F.aggregate(F.slice(e, i + 1, n), F.lit(0), lambda s, x: s + x) >= F.ceil(F.round(n * F.lit(similarity), 9)))
                return F.struct(F.array_min(starts).alias("first"), (F.array_max(starts) + n - 1).alias("last"), e.alias("equal"))

            return F.struct(t["item_key"].alias("item_key"), t["item_id"].alias("item_id"), t["diagonal"].alias("diagonal"), let(equal, reach).alias("r"))

        return F.filter(F.transform(F.col("tries"), line), lambda x: x["r"]["first"].isNotNull())

    met = docs.join(hits.hint("shuffle_hash"), "row_key").select("row_key", "doc_id", F.inline(let(letter_words(F.col("text")), compare)))
    equal = F.aggregate(F.slice("r.equal", F.col("r.first") + 1, F.col("r.last") - F.col("r.first") + 1), F.lit(0), lambda s, x: s + x)
    found = met.select(
        "row_key", "doc_id", "item_key", "item_id", (F.col("r.first") + F.col("diagonal")).cast("long").alias("first_word"), (F.col("r.last") + F.col("diagonal")).cast("long").alias("last_word"), equal.cast("long").alias("n_equal"),
    )
    found = found.withColumn("similarity", F.col("n_equal") / (F.col("last_word") - F.col("first_word") + 1))
    best = F.max_by(F.struct("first_word", "last_word", "n_equal", "similarity"), F.struct("n_equal", -F.col("first_word"), -F.col("last_word")))
    return found.groupBy("row_key", "doc_id", "item_key", "item_id").agg(best.alias("b")).select("row_key", "doc_id", "item_id", "b.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that overlap a test item."""
    key = unused(docs, "row_id")
    gone = overlaps(docs, benchmark).select(F.col("row_key").alias(key)).distinct()
    return docs.withColumn(key, row_id(F.col("doc_id").cast("long"), F.col("text"))).join(gone, key, "left_anti").select(docs.columns)
