"""Quality by importance resampling: hashed n-gram models of target and raw text, and a Gumbel top-k of their ratio.

Words and word pairs fall into ``buckets``; counts over all documents (raw) and over the target rows are summed in Spark to one
row a bucket. A text's log weight is the sum of its n-grams' log ratios. Adding a Gumbel draw keyed by the doc_id and
keeping the k largest samples without replacement in proportion to the weights. The k-th largest is found by counting
ever finer bins, and rows that tie there by their doc_id in the same way, so nothing is sorted in one place. k is a share of the
rows: by default that of target rows among labelled ones.

Null and empty texts have log weight 0. Rows with a null doc_id share one draw. Without target rows all ratios are 0; then no row is
kept if rows are labelled, and every row if none is.
Repeated rows each get a row. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Slice, cut, keyed, mix, ship, slices, span_hashes, texts, word_bounds

BUCKETS = 10_000
#: Rows of ids that may be broadcast (16 bytes each).
SMALL_ROWS = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def ngrams(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every word and word pair of a slice, and the document that it stands in."""
    b = _LOWER[s.bytes]
    starts, ends = word_bounds(b)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = span_hashes(b, starts, ends)
    doc = np.searchsorted(s.starts, starts, "right") - 1
    pair = mix(h[:-1] * np.uint64(3) + h[1:])
    same = doc[:-1] == doc[1:]
    return (np.concatenate([h, pair[same]]) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([doc, doc[:-1][same]])


def log_ratios(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """The log ratio of each bucket's share in target and in raw text, one added to every count."""
    target = target.select("doc_id").distinct().withColumn("is_target", F.lit(1))
    target = F.broadcast(target) if target.count() <= SMALL_ROWS else target.hint("shuffle_hash")
    marked = docs.join(target, "doc_id", "left").select("text", F.coalesce("is_target", F.lit(0)).alias("is_target"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, own = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            is_target = batch.column("is_target").to_numpy()
            for s in slices(*texts(batch.column("text"))):
                bucket, doc = ngrams(s)
                raw += np.bincount(bucket, minlength=BUCKETS)
                own += np.bincount(bucket[is_target[s.first + doc] == 1], minlength=BUCKETS)
        used = np.flatnonzero(raw)
        yield pa.record_batch([pa.array(used), pa.array(raw[used]), pa.array(own[used])], ["bucket", "raw", "own"])

    sums = marked.mapInArrow(count, "bucket long, raw long, own long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("own").alias("own"))
    raw, own = np.ones(BUCKETS), np.ones(BUCKETS)
    for r in sums.collect():  # at most BUCKETS rows
        raw[r["bucket"]] += r["raw"]
        own[r["bucket"]] += r["own"]
    return np.log(own / own.sum()) - np.log(raw / raw.sum()) if own.sum() > BUCKETS else np.zeros(BUCKETS)


def top_k(rows: DataFrame, key: str, k: int, tie: tuple[str, ...] = (), bins: int = 4096, last: int = 10_000) -> DataFrame:
    """rows with ``kept``: whether a row is among the k with the greatest key, then with the least of each column of tie, nulls last.

    Rows that are alike in all of these are alike to it. rows is read more than once: it must be a table or a checkpoint.
    """
    low, high, n = rows.agg(F.min(key), F.max(key), F.count("*")).first()
    if k <= 0 or not n:
        return rows.withColumn("kept", F.lit(False))
    need, inside = min(k, n), n
    while inside > last and low < high:
        width = (high - low) / bins
        at = F.least(F.floor((F.col(key) - low) / width), F.lit(bins - 1)) if width else F.when(F.col(key) < high, 0).otherwise(1)
        counts = {r["at"]: (r["count"], r["low"], r["high"]) for r in rows.filter(F.col(key).between(low, high)).groupBy(at.alias("at")).agg(F.count("*").alias("count"), F.min(key).alias("low"), F.max(key).alias("high")).collect()}
        for b in sorted(counts, reverse=True):
            if need <= counts[b][0]:
                inside, low, high = counts[b]
                break
            need -= counts[b][0]
    near = F.col(key).between(low, high)
    others = rows.filter(~near).withColumn("kept", F.col(key) > high)
    some = rows.filter(near)
    if inside <= last:
        order = Window.partitionBy("_near").orderBy(F.desc(key), *(F.asc_nulls_last(c) for c in tie))
        return some.withColumn("_near", F.lit(0)).withColumn("kept", F.row_number().over(order) <= need).drop("_near").union(others)
    if tie:  # all of one key
        turned = some.withColumn("_tie", F.coalesce(-F.col(tie[0]).cast("double"), F.lit(float("-inf"))))
        found = top_k(turned, "_tie", need, tie[1:], bins, last).drop("_tie")
        return found.union(others)
    some = some.withColumn("_part", F.spark_partition_id())
    quota, left = [], need
    for part, count in sorted(some.groupBy("_part").count().collect()):  # a row for each partition
        quota.append(f"when {part} then {min(count, left)}")
        left -= min(count, left)
    inside_part = F.row_number().over(Window.partitionBy("_part").orderBy(F.lit(0)))
    return some.withColumn("kept", inside_part <= F.expr(f"case _part {' '.join(quota)} end")).drop("_part").union(others)


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 7) -> DataFrame:
    """doc_id, log_weight, gumbel_key and kept of each row."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    labelled = labels.filter("doc_id is not null and quality is not null")
    if share is None:
        share = labelled.agg(F.avg("quality")).first()[0]
        share = 1.0 if share is None else share
    ratios = spark.sparkContext.broadcast(log_ratios(docs, labelled.filter("quality = 1").select(F.col("doc_id").cast("long"))))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = np.zeros(batch.num_rows)
            for s in slices(*texts(batch.column("text"))):
                bucket, doc = ngrams(s)
                weight[s.first : s.last] = np.bincount(doc, ratios.value[bucket], s.last - s.first)
            yield pa.record_batch([batch.column("doc_id"), pa.array(weight)], ["doc_id", "log_weight"])

    rows = docs.mapInArrow(weigh, "doc_id long, log_weight double")
    draw = -F.log(-F.log(keyed(seed, F.col("doc_id")) + F.lit(1e-17)))
    rows = cut(rows.withColumn("gumbel_key", F.col("log_weight") + draw))
    return top_k(rows, "gumbel_key", round(rows.count() * share), ("doc_id", "log_weight"))
