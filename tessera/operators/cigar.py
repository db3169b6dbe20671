"""Alignments read base by base: what their CIGAR text says, where on the target it says so, and what no alignment covers."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.intervals import islands, overlap_join
from tessera.operators.lineage import ship

#: One operation of a CIGAR: how long and which.
STEP = r"(\d+)([MIDNSHP=X])"
#: Operations that move along the target, and along the query.
ON_TARGET, ON_QUERY = "MDN=X", "MIS=X"


def length_of(text: Column, ops: str) -> Column:
    """The summed length of the operations in ops; null for null text."""
    sizes = F.regexp_extract_all(text, F.lit(rf"(\d+)[{ops}]"), F.lit(1))
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))


def decoded(aln: DataFrame, text: str = "cg", edits: str = "nm") -> DataFrame:
    """aln with aligned, inserted, deleted and mismatches: X operations where the text tells matches apart, else the edit distance less insertions and deletions, else null."""
    own = F.when(F.col(text) != "", F.col(text))
    rows = aln.withColumns({"aligned": length_of(own, "M=X"), "inserted": length_of(own, "I"), "deleted": length_of(own, "D")})
    told = F.when(own.rlike("[=X]"), length_of(own, "X")).when(own.isNotNull() & F.col(edits).isNotNull(), F.greatest(F.lit(0), F.col(edits) - F.col("inserted") - F.col("deleted")))
    return rows.withColumn("mismatches", told)


def accuracy(aln: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: blocks, those that can't be decoded (never guessed), columns and the rates over them; rates are null where nothing was decoded."""
    known = F.col("mismatches").isNotNull()
    total = lambda c: F.coalesce(F.sum(F.when(known, F.col(c))), F.lit(0))
    sums = decoded(aln).groupBy(*keys).agg(F.count("*").alias("n_blocks"), F.count_if(~known).alias("n_blocks_without_cigar"), total("aligned").alias("aligned"), total("mismatches").alias("mismatch_bp"), total("inserted").alias("inserted_bp"), total("deleted").alias("deleted_bp"))
    sums = sums.withColumn("aligned_columns", F.col("aligned") + F.col("inserted_bp") + F.col("deleted_bp"))
    rate = lambda c: F.try_divide(c.cast("double"), F.col("aligned_columns").cast("double"))
    rates = {"identity": rate(F.col("aligned") - F.col("mismatch_bp"))} | {f"{a}_rate": rate(F.col(b)) for a, b in (("mismatch", "mismatch_bp"), ("insertion", "inserted_bp"), ("deletion", "deleted_bp"))}
    return sums.withColumns(rates).drop("aligned")


def walk(aln: DataFrame, keys: list[str], text: str = "cg", start: str = "tstart") -> DataFrame:
    """keys, op, n, s, e: every operation of every alignment as an interval of the target; what isn't on the target (an insertion) is the empty one before the next base."""
    ship(aln.sparkSession)
    schema = aln.select(*keys).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = re.compile(STEP)
        for batch in batches:
            rows, sizes, ops, at = [], [], [], []
            for i, (cigar, first) in enumerate(zip(batch.column(text).to_pylist(), batch.column(start).to_pylist(), strict=True)):
                found = step.findall(cigar or "")
                own = np.array([int(n) for n, _ in found], np.int64)
                moved = np.where([op in ON_TARGET for _, op in found], own, 0) if found else own
                rows += [i] * len(found)
                sizes.append(own)
                ops += [op for _, op in found]
                at.append(first + np.cumsum(moved) - moved)
            n, s = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (sizes, at))
            e = s + np.where(np.isin(ops, list(ON_TARGET)), n, 0) if len(n) else n
            place = pa.array(rows, pa.int64())
            yield pa.record_batch([*(batch.column(k).take(place) for k in keys), pa.array(ops, pa.string()), *(pa.array(x, pa.int64()) for x in (n, s, e))], [*keys, "op", "n", "s", "e"])

    named = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return aln.select(*keys, text, F.col(start).cast("long").alias(start)).mapInArrow(run, f"{named}, op string, n long, s long, e long")


def edits_in_regions(aln: DataFrame, regions: DataFrame, keys: list[str], region: list[str]) -> DataFrame:
    """Per key and region (rs, re on the target): mismatched and deleted bases inside it, insertions and their bases.

    An edit is a row of its own and meets regions by an interval join; an insertion counts where the base before which it stands is.
    """
    edits = walk(aln, keys).filter("op in ('X', 'I', 'D')").withColumnRenamed("s", "ls").withColumn("le", F.greatest("e", F.col("ls") + 1))
    shared = [k for k in keys if k in regions.columns]
    both = overlap_join(edits.drop("e"), regions, shared)
    bp = lambda op: F.sum(F.when(F.col("op") == op, F.col("overlap")).otherwise(0))
    return both.groupBy(*keys, *region).agg(bp("X").alias("mismatch_bp"), bp("D").alias("deleted_bp"), F.count_if(F.col("op") == "I").alias("insertions"), F.sum(F.when(F.col("op") == "I", F.col("n")).otherwise(0)).alias("inserted_bp"))


def missing_regions(aln: DataFrame, targets: DataFrame, keys: list[str], length: str = "length") -> DataFrame:
    """Per key of targets (a linear sequence each): covered bases, and number, bases and longest of the stretches that no alignment covers."""
    merged = islands(aln, keys)
    gap = F.greatest(F.col("s") - F.coalesce(F.lag("e").over(Window.partitionBy(*keys).orderBy("s")), F.lit(0)), F.lit(0))
    per = merged.withColumn("gap", gap).groupBy(*keys).agg(F.sum(F.col("e") - F.col("s")).alias("covered"), F.count_if(F.col("gap") > 0).alias("n"), F.sum("gap").alias("bp"), F.max("gap").alias("longest"), F.max("e").alias("last"))
    rows = targets.join(per, keys, "left").fillna(0, ["covered", "n", "bp", "longest", "last"])
    tail = F.greatest(F.col(length) - F.col("last"), F.lit(0))
    return rows.select(*keys, length, F.col("covered").alias("covered_bp"), (F.col("n") + (tail > 0).cast("int")).alias("missing_regions"), (F.col("bp") + tail).alias("missing_bp"), F.greatest("longest", tail).alias("longest_missing_bp"))
