"""Paired reads: written as record files by Spark, read back, checked and measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.coverage import r6
from tessera.plans.more import scratch
from tessera.plans.registry import query
from tessera.plans.views import Views
from tessera.sources import reads

#: Turns of a conversation are mates of a pair in turn; letters stand for bases and qualities.
NUMBERED = "nr AS (SELECT *, row_number() OVER (PARTITION BY sample, mate ORDER BY pair) - 1 AS record FROM v_reads)"
SCORES = "[ascii(c) - 33 FOR c IN string_split(qual, '')]"
BOTH = NUMBERED + """,
pr AS (SELECT a.sample, a.pair AS p1, b.pair AS p2, a.seq AS s1, b.seq AS s2, a.qual AS q1, b.qual AS q2, list_concat([ascii(c) - 33 FOR c IN string_split(a.qual, '')], [ascii(c) - 33 FOR c IN string_split(b.qual, '')]) AS scores
FROM nr a JOIN nr b ON a.sample = b.sample AND a.record = b.record AND a.mate = 1 AND b.mate = 2)"""


def files(v: Views) -> str:
    """The path of v_reads as record files, a folder for each sample and mate."""
    path = scratch(v.spark)
    lines = F.concat(F.lit("@r"), "pair", F.lit("/"), "mate", F.lit(" x\n"), "seq", F.lit("\n+\n"), "qual")
    v.v_reads.select("sample", "mate", "pair", lines.alias("value")).orderBy("pair").drop("pair").write.partitionBy("sample", "mate").text(path)
    return path


def stored(v: Views) -> DataFrame:
    return reads.read_fastq(v.spark, files(v), ["sample", "mate"]).withColumn("sample", F.col("sample").cast("long"))


@query("a04_paired_reads", "SELECT sample, count(*) FILTER (mate = 1) AS reads1, count(*) FILTER (mate = 2) AS reads2, CASE WHEN count(*) FILTER (mate = 1) <> count(*) FILTER (mate = 2) THEN 'unequal_read_counts' ELSE 'ok' END AS integrity FROM v_reads GROUP BY sample")
def a04(v: Views) -> DataFrame:
    return reads.integrity(reads.pairs(stored(v), ["sample"]), ["sample"])


@query("l07_read_pair_metrics", """
SELECT sample, count(*) AS pairs, CAST(sum(length(s1 || s2)) AS BIGINT) AS bases, round(sum(list_sum(scores)) / sum(length(s1 || s2)), 6) AS mean_quality, round(sum(len([x FOR x IN scores IF x >= 20])) / sum(length(s1 || s2)), 6) AS q20, round(sum(len([x FOR x IN scores IF x >= 30])) / sum(length(s1 || s2)), 6) AS q30,
round(100.0 * sum(length(regexp_replace(s1 || s2, '[^GC]', '', 'g'))) / sum(length(regexp_replace(s1 || s2, '[^ACGT]', '', 'g'))), 6) AS gc_percent, round(sum(length(regexp_replace(s1 || s2, '[^N]', '', 'g'))) / sum(length(s1 || s2)), 6) AS n_share,
round(count(*) FILTER (s1 LIKE '%AGATCGGAAGAGC%' OR s1 LIKE '%CTGTCTCTTATACACATCT%' OR s2 LIKE '%AGATCGGAAGAGC%' OR s2 LIKE '%CTGTCTCTTATACACATCT%') / count(*), 6) AS adapter_share, round((count(*) - count(DISTINCT (substr(s1, 1, 50), substr(s2, 1, 50)))) / count(*), 6) AS duplicate_share,
round(count(*) FILTER (p1 <> p2) / count(*), 6) AS mismatch_share, quantile_cont(length(s1), 0.5) AS median1, quantile_cont(length(s2), 0.5) AS median2, least(quantile_cont(length(s1), 0.5), quantile_cont(length(s2), 0.5)) AS median_length, round(sum(length(s1 || s2)) / 5e6, 6) AS depth FROM pr GROUP BY sample""", BOTH)
def l07(v: Views) -> DataFrame:
    return r6(reads.pair_metrics(reads.pairs(stored(v), ["sample"]), ["sample"]), "mean_quality", "q20", "q30", "gc_percent", "n_share", "adapter_share", "duplicate_share", "mismatch_share", "depth")


@query("l08_depth_and_quality", f"""
SELECT sample, CAST(sum(length(seq)) AS BIGINT) AS bases, round(sum(length(seq)) / max(bp), 6) AS depth, round(sum(list_sum({SCORES})) / sum(length(seq)), 6) AS mean_quality FROM v_reads JOIN (SELECT sample, sum(length) AS bp FROM v_truth GROUP BY sample) USING (sample) GROUP BY sample""")
def l08(v: Views) -> DataFrame:
    bp = v.v_truth.groupBy("sample").agg(F.sum("length").alias("bp"))
    rows = stored(v).groupBy("sample").agg(F.sum(F.length("seq")).alias("bases"), F.sum(reads.total(reads.qualities(F.col("qual")))).alias("score"))
    return r6(rows.join(bp, "sample").select("sample", "bases", (F.col("bases") / F.col("bp")).alias("depth"), (F.col("score") / F.col("bases")).alias("mean_quality")), "depth", "mean_quality")


@query("l12_quality_ladder", f"""
SELECT sample, min_length, min_quality, count(*) FILTER (kept) AS reads, CAST(coalesce(sum(n) FILTER (kept), 0) AS BIGINT) AS bases, count(*) FILTER (kept) >= 5 AS enough FROM (SELECT *, n >= min_length AND q >= min_quality AS kept
FROM (SELECT sample, length(seq) AS n, list_sum({SCORES}) / length(seq) AS q FROM v_reads), (VALUES (40, CAST(20 AS DOUBLE)), (120, 27.5), (300, 28)) AS t(min_length, min_quality)) GROUP BY ALL""")
def l12(v: Views) -> DataFrame:
    return reads.quality_ladder(stored(v), ["sample"], reads.parse_rungs("40:20,120:27.5,300:28"), 5)
