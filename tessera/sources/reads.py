"""Sequencing reads: record files of four lines, read in parallel and numbered in file order, their pairs and what is wrong with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The adapter sequences that sequencing kits leave at read ends.
ADAPTERS = ("AGATCGGAAGAGC", "CTGTCTCTTATACACATCT")


def numbered_lines(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """keys, line, value: the lines of the files under path, numbered from 0 in each folder ``key=value/...`` in the order of file names.

    A file may be split among tasks: each block's lines keep their order there, and the few counts of blocks are summed up beforehand.
    """
    rows = spark.read.text(path).select(*keys, "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    blocks = rows.groupBy(*keys, "file", "block").agg(F.min("id").alias("first"), F.count("*").alias("lines"))
    before = F.coalesce(F.sum("lines").over(Window.partitionBy(*keys, F.lit(0)).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("file", "block", (before - F.col("first")).alias("shift"))
    return rows.join(blocks, ["file", "block"]).select(*keys, (F.col("id") + F.col("shift")).alias("line"), "value")


def read_fastq(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """keys, record, name, seq, qual and problem of each record; gzip by file name.

    problem is ``truncated`` if the file ends inside the record, ``malformed_fastq`` if a marker is missing or sequence and
    qualities differ in length. Names lose their mate suffix. A file that can't be unpacked fails the job.
    """
    part = F.col("line") % 4
    field = lambda k: F.max(F.when(part == k, F.rtrim("value", F.lit("\r")))).alias(f"f{k}")
    rows = numbered_lines(spark, path, keys).groupBy(*keys, F.floor(F.col("line") / 4).alias("record")).agg(*map(field, range(4)))
    problem = F.when(F.col("f3").isNull() | (F.col("f3") == ""), "truncated").when(~F.startswith("f0", F.lit("@")) | ~F.startswith("f2", F.lit("+")) | (F.length("f1") != F.length("f3")), "malformed_fastq")
    token = F.split(F.substring("f0", 2, 1 << 30), r"\s+")[0]
    return rows.select(*keys, "record", F.regexp_replace(token, "/[12]$", "").alias("name"), F.col("f1").alias("seq"), F.col("f3").alias("qual"), problem.alias("problem"))


def pairs(reads: DataFrame, keys: list[str], mate: str = "mate") -> DataFrame:
    """keys, record, and name, seq, qual, problem of both mates (1, 2), matched by their place in the file; a missing mate is null."""
    side = lambda k: reads.filter(F.col(mate) == k).select(*keys, "record", *(F.col(c).alias(f"{c}{k}") for c in ("name", "seq", "qual", "problem")), F.lit(True).alias(f"has{k}"))
    return side(1).join(side(2), [*keys, "record"], "full")


def integrity(both: DataFrame, keys: list[str]) -> DataFrame:
    """keys, reads1, reads2, integrity: ok, empty, unequal_read_counts, or the first broken record's problem."""
    broken = F.coalesce("problem1", "problem2")
    rows = both.groupBy(*keys).agg(F.count("has1").alias("reads1"), F.count("has2").alias("reads2"), F.min(F.when(broken.isNotNull(), F.struct("record", broken.alias("kind")))).alias("broken"))
    least = F.least("reads1", "reads2")
    # a broken record counts only up to where the shorter file ends
    verdict = F.when(F.col("broken.record") <= least, F.col("broken.kind")).when(F.col("reads1") != F.col("reads2"), "unequal_read_counts").when(least == 0, "empty").otherwise("ok")
    return rows.select(*keys, "reads1", "reads2", verdict.alias("integrity"))


def qualities(qual: Column) -> Column:
    """Phred scores (offset 33) of a quality line."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def total(scores: Column) -> Column:
    return F.aggregate(scores, F.lit(0).cast("long"), lambda s, x: s + x)


def mean_quality(qual: Column) -> Column:
    """The mean Phred score of a read; null if it has none."""
    return F.when(F.length(qual) > 0, total(qualities(qual)) / F.length(qual))


def _held(seq: Column, letters: str) -> Column:
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def pair_metrics(both: DataFrame, keys: list[str], genome_mb: float = 5.0, adapters: tuple[str, ...] = ADAPTERS, prefix: int = 50) -> DataFrame:
    """Quality, composition, adapters, duplicates, mismatched names, lengths and depth of the pairs that have both mates."""
    whole = both.filter("has1 and has2")
    joined = lambda c: F.concat(F.coalesce(f"{c}1", F.lit("")), F.coalesce(f"{c}2", F.lit("")))
    rows = whole.select(*keys, "name1", "name2", "seq1", "seq2", joined("seq").alias("seq"), qualities(joined("qual")).alias("scores"))
    held = lambda text: F.coalesce(F.contains(F.col(text), F.lit(adapters[0])) | F.contains(F.col(text), F.lit(adapters[1])), F.lit(False))
    share = lambda least: F.sum(F.size(F.filter("scores", lambda x: x >= least))) / F.sum(F.length("seq"))
    head = lambda c: F.substring(c, 1, prefix)
    out = rows.groupBy(*keys).agg(
        F.count("*").alias("pairs"), F.sum(F.length("seq")).alias("bases"), (F.sum(total(F.col("scores"))) / F.sum(F.length("seq"))).alias("mean_quality"), share(20).alias("q20"), share(30).alias("q30"),
        (100 * F.sum(_held(F.col("seq"), "GC")) / F.nullif(F.sum(_held(F.col("seq"), "ACGT")), F.lit(0))).alias("gc_percent"), (F.sum(_held(F.col("seq"), "N")) / F.sum(F.length("seq"))).alias("n_share"),
        (F.count_if(held("seq1") | held("seq2")) / F.count("*")).alias("adapter_share"), ((F.count("*") - F.count_distinct(head("seq1"), head("seq2"))) / F.count("*")).alias("duplicate_share"),
        (F.count_if(F.col("name1") != F.col("name2")) / F.count("*")).alias("mismatch_share"),
        F.percentile(F.length("seq1"), F.lit(0.5)).alias("median1"), F.percentile(F.length("seq2"), F.lit(0.5)).alias("median2"),
    )
    return out.withColumn("median_length", F.least("median1", "median2")).withColumn("depth", F.col("bases") / (genome_mb * 1e6))


def parse_rungs(text: str) -> list[tuple[int, float]]:
    """MIN_LENGTH:MIN_MEAN_Q entries; each positive, none twice."""
    rungs = [(int(a), float(b)) for a, b in (chunk.split(":") for chunk in text.split(",") if chunk.strip())]
    if not rungs or len(set(rungs)) != len(rungs) or any(n <= 0 or q < 0 for n, q in rungs):
        raise ValueError(f"rungs must be different pairs of a positive length and a quality: {text!r}")
    return rungs


def quality_ladder(reads: DataFrame, keys: list[str], rungs: list[tuple[int, float]], least: int) -> DataFrame:
    """keys, min_length, min_quality, reads, bases, enough of each rung: its reads are the long and good ones."""
    table = F.explode(F.array(*(F.struct(F.lit(n).alias("min_length"), F.lit(q).alias("min_quality")) for n, q in rungs))).alias("rung")
    rows = reads.select(*keys, F.length("seq").alias("n"), mean_quality(F.col("qual")).alias("q"), table)
    kept = (F.col("n") >= F.col("rung.min_length")) & (F.col("q") >= F.col("rung.min_quality"))
    out = rows.groupBy(*keys, "rung.min_length", "rung.min_quality").agg(F.count_if(kept).alias("reads"), F.coalesce(F.sum(F.when(kept, F.col("n"))), F.lit(0)).alias("bases"))
    return out.withColumn("enough", F.col("reads") >= least)
