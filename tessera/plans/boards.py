"""Leaderboards, strata, ranks and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import rates
from tessera.operators import ranking
from tessera.plans.coverage import r6
from tessera.plans.registry import query
from tessera.plans.views import Views

RUN = ["sample", "tool"]
VALS = """
vals AS (SELECT sample, tool, f1 AS value FROM v_scores WHERE f1 IS NOT NULL UNION ALL SELECT s.sample, s.tool, 0.0 FROM v_status s WHERE status = 'failed' AND NOT EXISTS (SELECT 1 FROM v_scores x WHERE x.sample = s.sample AND x.tool = s.tool AND x.f1 IS NOT NULL))"""
PAIRS = VALS + ", prs AS (SELECT x.sample, x.tool AS a, y.tool AS b, x.value - y.value AS d FROM vals x JOIN vals y ON x.sample = y.sample AND x.tool < y.tool)"


def values(v: Views) -> DataFrame:
    return ranking.with_failures(v.v_scores, v.v_status)


@query("e01_outcome_counts", """
SELECT tool, count(*) AS runs, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed' AND exit_code = 137) AS failed_resource, count(*) FILTER (status = 'failed' AND exit_code = 1) AS failed_tool FROM v_status GROUP BY tool""")
def e01(v: Views) -> DataFrame:
    failed = F.col("status") == "failed"
    return v.v_status.groupBy("tool").agg(F.count("*").alias("runs"), F.count_if(F.col("status") == "completed").alias("completed"), F.count_if(F.col("status") == "skipped").alias("skipped"), F.count_if(failed & (F.col("exit_code") == 137)).alias("failed_resource"), F.count_if(failed & (F.col("exit_code") == 1)).alias("failed_tool"))


@query("e02_failure_as_zero", "SELECT sample, tool, round(value, 6) AS value FROM vals", VALS)
def e02(v: Views) -> DataFrame:
    return r6(values(v), "value")


@query("c09_shared_samples", "SELECT sample FROM v_scores WHERE f1 > 0.2 GROUP BY sample HAVING count(DISTINCT tool) >= (SELECT count(DISTINCT tool) FROM v_scores WHERE f1 > 0.2 AND tool < 'R') AND count(DISTINCT CASE WHEN tool < 'R' THEN tool END) = (SELECT count(DISTINCT tool) FROM v_scores WHERE f1 > 0.2 AND tool < 'R')")
def c09(v: Views) -> DataFrame:
    return ranking.shared_samples(v.v_scores.filter("f1 > 0.2 and tool < 'R'"))


@query("e03_leaderboard", """
SELECT o.tool, round(own_mean, 6) AS own_mean, round(own_median, 6) AS own_median, own_n, round(shared_mean, 6) AS shared_mean, shared_n, CAST(row_number() OVER (ORDER BY round(shared_mean, 9) DESC, o.tool) AS INT) AS place
FROM (SELECT tool, avg(value) AS own_mean, quantile_cont(value, 0.5) AS own_median, count(*) AS own_n FROM vals GROUP BY tool) o
LEFT JOIN (SELECT tool, avg(value) AS shared_mean, count(*) AS shared_n FROM vals WHERE sample IN (SELECT sample FROM vals GROUP BY sample HAVING count(DISTINCT tool) = (SELECT count(DISTINCT tool) FROM vals)) GROUP BY tool) s ON o.tool = s.tool""", VALS)
def e03(v: Views) -> DataFrame:
    return r6(ranking.leaderboard(values(v)), "own_mean", "own_median", "shared_mean")


@query("e04_ranking_score", """
SELECT p.tool, round(coalesce(macro, pooled), 6) AS score, CASE WHEN macro IS NOT NULL THEN 'macro' ELSE 'pooled' END AS basis, coalesce(g, 0) AS groups
FROM (SELECT tool, avg(value) AS pooled FROM vals JOIN v_sheet USING (sample) GROUP BY tool) p LEFT JOIN (SELECT tool, avg(m) AS macro, count(*) AS g FROM (SELECT tool, species, avg(value) AS m FROM vals JOIN v_sheet USING (sample) GROUP BY ALL HAVING count(DISTINCT study) >= 6) GROUP BY tool) q ON p.tool = q.tool""", VALS)
def e04(v: Views) -> DataFrame:
    return r6(ranking.macro_average(values(v), v.v_sheet, least=6), "score")


@query("e05_pooled_shares", """
SELECT tool, round(sum(correct) / CAST(sum(plasmids) AS DOUBLE), 6) AS pooled, round(avg(correct / CAST(plasmids AS DOUBLE)), 6) AS mean_of_ratios, CASE WHEN count(*) = count(f1) THEN round(sum(f1), 6) END AS f1_if_complete FROM v_scores GROUP BY tool""")
def e05_e07(v: Views) -> DataFrame:
    out = v.v_scores.groupBy("tool").agg((F.sum("correct") / F.sum("plasmids")).alias("pooled"), F.avg(F.col("correct") / F.col("plasmids")).alias("mean_of_ratios"), F.when(F.count("*") == F.count("f1"), F.sum("f1")).alias("f1_if_complete"))
    return r6(out, "pooled", "mean_of_ratios", "f1_if_complete")


@query("e07_pooled_and_isolate_cprr", "SELECT tool, round(sum(correct) / CAST(sum(plasmids) AS DOUBLE), 6) AS pooled_cprr, round(avg(correct / CAST(plasmids AS DOUBLE)), 6) AS isolate_cprr, count(*) AS isolates FROM v_scores WHERE bin_f1 >= 0.1 GROUP BY tool")
def e07(v: Views) -> DataFrame:
    out = v.v_scores.filter("bin_f1 >= 0.1").groupBy("tool").agg((F.sum("correct") / F.sum("plasmids")).alias("pooled_cprr"), F.avg(F.col("correct") / F.col("plasmids")).alias("isolate_cprr"), F.count("*").alias("isolates"))
    return r6(out, "pooled_cprr", "isolate_cprr")


@query("e06_length_weighted_median", """
SELECT sample, min(depth) AS quantile FROM (SELECT sample, depth, sum(w) OVER (PARTITION BY sample ORDER BY depth ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY sample) AS total FROM (SELECT sample, depth, sum(length) AS w FROM v_contig GROUP BY ALL)) WHERE run >= 0.5 * total GROUP BY sample""")
def e06(v: Views) -> DataFrame:
    return ranking.weighted_quantile(v.v_contig, ["sample"], "depth", "length", 0.5)


@query("e08_species_table", """
SELECT species, tool, n, studies, round(mean, 6) AS mean, round(mean - pooled, 6) AS against_pooled, CAST(rank() OVER (PARTITION BY species ORDER BY round(mean, 9) DESC) AS INT) AS place
FROM (SELECT species, tool, count(*) AS n, count(DISTINCT study) AS studies, avg(value) AS mean FROM vals JOIN v_sheet USING (sample) GROUP BY ALL) JOIN (SELECT tool, avg(value) AS pooled FROM vals GROUP BY tool) USING (tool)""", VALS)
def e08(v: Views) -> DataFrame:
    per = values(v).join(v.v_sheet, "sample").groupBy("species", "tool").agg(F.count("*").alias("n"), F.count_distinct("study").alias("studies"), F.avg("value").alias("mean"))
    pooled = values(v).groupBy("tool").agg(F.avg("value").alias("pooled"))
    out = ranking.ranked(per.join(pooled, "tool").withColumn("against_pooled", F.col("mean") - F.col("pooled")), ["species"], "mean").drop("pooled")
    return r6(out, "mean", "against_pooled")


@query("e09_three_populations", """
SELECT population, tool, count(*) AS n, round(avg(value), 6) AS mean, count(DISTINCT study) >= 10 AS available FROM (
SELECT 'all' AS population, * FROM vals JOIN v_sheet USING (sample) UNION ALL SELECT 'sensitivity', * FROM vals JOIN v_sheet USING (sample) WHERE region < 4 UNION ALL SELECT 'primary', * FROM vals JOIN v_sheet USING (sample) WHERE region < 2) GROUP BY ALL""", VALS)
def e09(v: Views) -> DataFrame:
    rows = values(v).join(v.v_sheet, "sample")
    in_ = F.array_compact(F.array(F.lit("all"), F.when(F.col("region") < 4, "sensitivity"), F.when(F.col("region") < 2, "primary")))
    out = rows.withColumn("population", F.explode(in_)).groupBy("population", "tool").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), (F.count_distinct("study") >= 10).alias("available"))
    return r6(out, "mean")


@query("e10_baseline_comparison", """
SELECT sample, tool, CASE WHEN base IS NULL THEN 'no baseline' WHEN value > base THEN 'yes' ELSE 'no' END AS beats FROM (SELECT *, max(CASE WHEN tool LIKE 'N%' THEN value END) OVER (PARTITION BY sample) AS base FROM vals) WHERE tool NOT LIKE 'N%'""", VALS)
def e10(v: Views) -> DataFrame:
    base = F.max(F.when(F.col("tool").startswith("N"), F.col("value"))).over(Window.partitionBy("sample"))
    out = values(v).withColumn("base", base).filter(~F.col("tool").startswith("N"))
    return out.select(*RUN, F.when(F.col("base").isNull(), "no baseline").when(F.col("value") > F.col("base"), "yes").otherwise("no").alias("beats"))


@query("e13_scenario_performance", "SELECT region, tool, count(f1) AS n, round(avg(f1), 6) AS mean_f1, round(avg(bin_f1), 6) AS mean_bin_f1, count(*) >= 5 AS powered FROM v_scores JOIN v_sheet USING (sample) GROUP BY ALL")
def e13(v: Views) -> DataFrame:
    out = v.v_scores.join(v.v_sheet, "sample").groupBy("region", "tool").agg(F.count("f1").alias("n"), F.avg("f1").alias("mean_f1"), F.avg("bin_f1").alias("mean_bin_f1"), (F.count("*") >= 5).alias("powered"))
    return r6(out, "mean_f1", "mean_bin_f1")


@query("e14_performance_summary", """
SELECT tool, round(count(*) FILTER (status = 'completed') / CAST(count(*) FILTER (status <> 'skipped') AS DOUBLE), 6) AS success, round(quantile_cont(runtime_seconds, 0.5) FILTER (status = 'completed'), 6) AS median_s, round(quantile_cont(runtime_seconds, 0.9) FILTER (status = 'completed'), 6) AS p90_s FROM v_status GROUP BY tool""")
def e14(v: Views) -> DataFrame:
    done = F.when(F.col("status") == "completed", F.col("runtime_seconds"))
    out = v.v_status.groupBy("tool").agg((F.count_if(F.col("status") == "completed") / F.count_if(F.col("status") != "skipped")).alias("success"), F.percentile(done, F.lit(0.5)).alias("median_s"), F.percentile(done, F.lit(0.9)).alias("p90_s"))
    return r6(out, "success", "median_s", "p90_s")


@query("e15_scaling_exponent", """
SELECT tool, round(regr_slope(ln(runtime_seconds), ln(size)), 6) AS exponent, count(*) AS points FROM v_status WHERE runtime_seconds > 0 GROUP BY tool HAVING count(DISTINCT size) >= 3 AND max(size) >= 1.5 * min(size)""")
def e15(v: Views) -> DataFrame:
    out = v.v_status.filter("runtime_seconds > 0").groupBy("tool").agg(F.regr_slope(F.ln("runtime_seconds"), F.ln("size")).alias("exponent"), F.count("*").alias("points"), F.count_distinct("size").alias("sizes"), F.max("size").alias("most"), F.min("size").alias("least"))
    return r6(out.filter("sizes >= 3 and most >= 1.5 * least").select("tool", "exponent", "points"), "exponent")


DIMS = """
dim AS (SELECT tool, 100 * avg(f1) AS accuracy, 100 * avg(bin_f1) AS binning, 100 * sum(correct) / CAST(sum(plasmids) AS DOUBLE) AS recovery FROM v_scores GROUP BY tool),
spd AS (SELECT tool, 100 * greatest(0, 1 - log10(m / min(m) OVER ()) / 2) AS speed FROM (SELECT tool, avg(runtime_seconds) AS m FROM v_status WHERE status = 'completed' GROUP BY tool)),
cmp AS (SELECT tool, accuracy, binning, recovery, speed, 0.4 * accuracy + 0.2 * binning + 0.3 * recovery + 0.1 * speed AS composite, accuracy >= 40 AND recovery >= 30 AS passes FROM dim JOIN spd USING (tool))"""


def dimensions(v: Views) -> DataFrame:
    dims = v.v_scores.groupBy("tool").agg((100 * F.avg("f1")).alias("accuracy"), (100 * F.avg("bin_f1")).alias("binning"), (100 * F.sum("correct") / F.sum("plasmids")).alias("recovery"))
    time = v.v_status.filter("status = 'completed'").groupBy("tool").agg(F.avg("runtime_seconds").alias("m"))
    speed = time.select("tool", (100 * F.greatest(F.lit(0.0), 1 - F.log10(F.col("m") / F.min("m").over(Window.partitionBy(F.lit(1)))) / 2)).alias("speed"))
    return dims.join(speed, "tool")


WEIGHTS = {"accuracy": 0.4, "binning": 0.2, "recovery": 0.3, "speed": 0.1}


@query("e16_composite_score", "SELECT tool, round(accuracy, 6) AS accuracy, round(binning, 6) AS binning, round(recovery, 6) AS recovery, round(speed, 6) AS speed, round(composite, 6) AS composite, passes, CAST(rank() OVER (ORDER BY round(composite, 6) DESC) AS INT) AS place FROM cmp", DIMS)
def e16(v: Views) -> DataFrame:
    out = dimensions(v).withColumn("composite", sum(w * F.col(k) for k, w in WEIGHTS.items())).withColumn("passes", (F.col("accuracy") >= 40) & (F.col("recovery") >= 30))
    out = out.withColumn("place", F.rank().over(Window.partitionBy(F.lit(1)).orderBy(F.desc(F.round("composite", 6)))))
    return r6(out, *WEIGHTS, "composite")


@query("e16_drop_one_dimension", """
SELECT dropped, tool, CAST(rank() OVER (PARTITION BY dropped ORDER BY round(score, 6) DESC) AS INT) AS place FROM (
SELECT 'accuracy' AS dropped, tool, (0.2 * binning + 0.3 * recovery + 0.1 * speed) / 0.6 AS score FROM cmp UNION ALL SELECT 'binning', tool, (0.4 * accuracy + 0.3 * recovery + 0.1 * speed) / 0.8 FROM cmp
UNION ALL SELECT 'recovery', tool, (0.4 * accuracy + 0.2 * binning + 0.1 * speed) / 0.7 FROM cmp UNION ALL SELECT 'speed', tool, (0.4 * accuracy + 0.2 * binning + 0.3 * recovery) / 0.9 FROM cmp)""", DIMS)
def e16_drop(v: Views) -> DataFrame:
    parts = [F.struct(F.lit(d).alias("dropped"), (sum(w * F.col(k) for k, w in WEIGHTS.items() if k != d) / (1 - w_d)).alias("score")) for d, w_d in WEIGHTS.items()]
    out = dimensions(v).select("tool", F.inline(F.array(*parts)))
    return out.select("dropped", "tool", F.rank().over(Window.partitionBy("dropped").orderBy(F.desc(F.round("score", 6)))).alias("place"))


@query("e17_random_weight_ranks")
def e17(v: Views) -> DataFrame:
    """Ranks under 200 keyed draws of the weights, each times 0.5 to 1.5."""
    draws = v.spark.range(200).withColumnRenamed("id", "draw")
    u = {k: 0.5 + F.pmod(F.xxhash64(F.lit(k), "draw"), F.lit(1 << 20)) / float(1 << 20) for k in WEIGHTS}
    rows = dimensions(v).withColumn("one", F.lit(1)).join(draws.withColumn("one", F.lit(1)), "one")
    rows = rows.withColumn("score", sum(w * u[k] * F.col(k) for k, w in WEIGHTS.items()) / sum(w * u[k] for k, w in WEIGHTS.items()))
    rows = rows.withColumn("place", F.rank().over(Window.partitionBy("draw").orderBy(F.desc("score"))))
    return rows.groupBy("tool").agg(F.avg("place").alias("mean_place"), F.min("place").alias("best"), F.max("place").alias("worst"), F.avg((F.col("place") == 1).cast("double")).alias("first_share"))


@query("e19_run_reproducibility", """
SELECT tool, count(*) AS keys, round(avg(CASE WHEN hi - lo <= 0.05 THEN 1.0 ELSE 0.0 END), 6) AS within, round(max(hi - lo), 6) AS worst FROM (SELECT sample, tool, min(x) AS lo, max(x) AS hi FROM (SELECT sample, tool, f1 AS x FROM v_scores UNION ALL SELECT sample, tool, bin_f1 FROM v_scores) GROUP BY ALL HAVING count(x) = 2) GROUP BY tool""")
def e19(v: Views) -> DataFrame:
    runs = v.v_scores.select(*RUN, F.explode(F.array("f1", "bin_f1")).alias("x")).groupBy(*RUN).agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n")).filter("n = 2")
    return r6(runs.groupBy("tool").agg(F.count("*").alias("keys"), F.avg((F.col("hi") - F.col("lo") <= 0.05).cast("double")).alias("within"), F.max(F.col("hi") - F.col("lo")).alias("worst")), "within", "worst")


@query("e20_published_agreement", """
SELECT coalesce(CAST(region AS VARCHAR), 'all') AS stratum, count(*) AS n, round(avg(f1 - bin_f1), 6) AS mean_difference, round(avg(abs(f1 - bin_f1)), 6) AS mean_absolute, round(corr(f1, bin_f1), 6) AS correlation, round(avg(CASE WHEN abs(f1 - bin_f1) <= 0.1 THEN 1.0 ELSE 0.0 END), 6) AS within
FROM v_scores JOIN v_sheet USING (sample) WHERE f1 IS NOT NULL GROUP BY GROUPING SETS ((region), ())""")
def e20(v: Views) -> DataFrame:
    rows = v.v_scores.filter("f1 is not null").join(v.v_sheet, "sample").withColumn("d", F.col("f1") - F.col("bin_f1"))
    out = rows.rollup("region").agg(F.count("*").alias("n"), F.avg("d").alias("mean_difference"), F.avg(F.abs("d")).alias("mean_absolute"), F.corr("f1", "bin_f1").alias("correlation"), F.avg((F.abs("d") <= 0.1).cast("double")).alias("within"))
    out = out.withColumn("stratum", F.coalesce(F.col("region").cast("string"), F.lit("all"))).drop("region")
    return r6(out, "mean_difference", "mean_absolute", "correlation", "within")


@query("e22_long_format_unpivot", "SELECT sample, tool, metric, round(value, 6) AS value FROM (SELECT sample, tool, 'f1' AS metric, f1 AS value FROM v_scores UNION ALL SELECT sample, tool, 'bin_f1', bin_f1 FROM v_scores UNION ALL SELECT sample, tool, 'correct', CAST(correct AS DOUBLE) FROM v_scores) WHERE value IS NOT NULL")
def e22(v: Views) -> DataFrame:
    wide = v.v_scores.select(*RUN, "f1", "bin_f1", F.col("correct").cast("double").alias("correct"))
    return r6(wide.unpivot(RUN, ["f1", "bin_f1", "correct"], "metric", "value").filter("value is not null"), "value")


@query("e23_metric_comparison", """
SELECT metric, tool, round(mean, 6) AS mean, rank() OVER (PARTITION BY metric ORDER BY round(mean, 9) DESC) + (count(*) OVER (PARTITION BY metric, round(mean, 9)) - 1) / 2.0 AS place, round(q1, 6) AS q1, round(q3, 6) AS q3 FROM (
SELECT metric, tool, avg(value) AS mean, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM (SELECT tool, 'f1' AS metric, f1 AS value FROM v_scores UNION ALL SELECT tool, 'bin_f1', bin_f1 FROM v_scores) WHERE value IS NOT NULL GROUP BY ALL)""")
def e23(v: Views) -> DataFrame:
    long = v.v_scores.unpivot(RUN, ["f1", "bin_f1"], "metric", "value").filter("value is not null")
    out = long.groupBy("metric", "tool").agg(F.avg("value").alias("mean"), F.percentile("value", F.lit(0.25)).alias("q1"), F.percentile("value", F.lit(0.75)).alias("q3"))
    out = ranking.average_rank(out.withColumn("key", -F.round("mean", 9)), ["metric"], "key", "place").drop("key")
    return r6(out, "mean", "q1", "q3")


@query("e24_facet_cells", """
SELECT s.species, r.region, t.tool, count(f1) AS n, round(avg(f1), 6) AS mean, count(f1) < 3 AS few FROM (SELECT DISTINCT species FROM v_sheet) s CROSS JOIN (SELECT DISTINCT region FROM v_sheet) r CROSS JOIN (SELECT DISTINCT tool FROM v_scores) t
LEFT JOIN (SELECT species, region, tool, f1 FROM v_scores JOIN v_sheet USING (sample)) x ON x.species = s.species AND x.region = r.region AND x.tool = t.tool GROUP BY ALL""")
def e24(v: Views) -> DataFrame:
    one = F.lit(1).alias("one")
    cells = v.v_sheet.select("species", one).distinct().join(v.v_sheet.select("region", one).distinct(), "one").join(v.v_scores.select("tool", one).distinct(), "one").drop("one")
    got = v.v_scores.join(v.v_sheet, "sample").select("species", "region", "tool", "f1")
    return r6(cells.join(got, ["species", "region", "tool"], "left").groupBy("species", "region", "tool").agg(F.count("f1").alias("n"), F.avg("f1").alias("mean"), (F.count("f1") < 3).alias("few")), "mean")


@query("e25_distribution_summary", """
SELECT tool, round(q1, 6) AS q1, round(q2, 6) AS q2, round(q3, 6) AS q3, round(min(CASE WHEN f1 >= q1 - 1.5 * (q3 - q1) THEN f1 END), 6) AS low, round(max(CASE WHEN f1 <= q3 + 1.5 * (q3 - q1) THEN f1 END), 6) AS high
FROM v_scores JOIN (SELECT tool, quantile_cont(f1, 0.25) AS q1, quantile_cont(f1, 0.5) AS q2, quantile_cont(f1, 0.75) AS q3 FROM v_scores GROUP BY tool) USING (tool) WHERE f1 IS NOT NULL GROUP BY tool, q1, q2, q3""")
def e25(v: Views) -> DataFrame:
    q = v.v_scores.groupBy("tool").agg(*(F.percentile("f1", F.lit(k / 4)).alias(f"q{k}") for k in (1, 2, 3)))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    out = v.v_scores.filter("f1 is not null").join(q, "tool").groupBy("tool", "q1", "q2", "q3").agg(F.min(F.when(F.col("f1") >= F.col("q1") - reach, F.col("f1"))).alias("low"), F.max(F.when(F.col("f1") <= F.col("q3") + reach, F.col("f1"))).alias("high"))
    return r6(out, "q1", "q2", "q3", "low", "high")


@query("e28_cohort_composition", "SELECT species, count(*) AS isolates, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) > 0.25 AS dominant FROM v_sheet GROUP BY species")
def e28(v: Views) -> DataFrame:
    out = v.v_sheet.groupBy("species").agg(F.count("*").alias("isolates"))
    out = out.withColumn("share", F.col("isolates") / F.sum("isolates").over(Window.partitionBy(F.lit(1)))).withColumn("dominant", F.col("share") > 0.25)
    return r6(out, "share")


@query("e29_metadata_completeness", "SELECT sample, 'clonal_group' AS field FROM v_sheet WHERE clonal_group IS NULL")
def e29(v: Views) -> DataFrame:
    fields = ["species", "study", "region", "clonal_group"]
    return v.v_sheet.unpivot("sample", fields, "field", "value").filter("value is null").select("sample", "field")


@query("e30_robust_outliers", """
SELECT sample, tool, round(0.6745 * (runtime_seconds - med) / mad, 6) AS z, abs(0.6745 * (runtime_seconds - med) / mad) > 3.5 AS outlier FROM v_status JOIN (SELECT tool, quantile_cont(runtime_seconds, 0.5) AS med FROM v_status GROUP BY tool) USING (tool)
JOIN (SELECT tool, quantile_cont(abs(runtime_seconds - m), 0.5) AS mad FROM v_status JOIN (SELECT tool, quantile_cont(runtime_seconds, 0.5) AS m FROM v_status GROUP BY tool) USING (tool) GROUP BY tool HAVING count(*) >= 8) USING (tool) WHERE mad > 0""")
def e30(v: Views) -> DataFrame:
    med = v.v_status.groupBy("tool").agg(F.percentile("runtime_seconds", F.lit(0.5)).alias("med"))
    rows = v.v_status.join(med, "tool").withColumn("gap", F.col("runtime_seconds") - F.col("med"))
    mad = rows.groupBy("tool").agg(F.percentile(F.abs("gap"), F.lit(0.5)).alias("mad"), F.count("*").alias("n")).filter("n >= 8 and mad > 0")
    out = rows.join(mad, "tool").withColumn("z", 0.6745 * F.col("gap") / F.col("mad"))
    return r6(out.select(*RUN, "z", (F.abs("z") > 3.5).alias("outlier")), "z")


@query("e31_warning_validity", "SELECT count(*) FILTER (w AND f) AS hits, count(*) FILTER (w AND NOT f) AS false_alarms, round(count(*) FILTER (w AND f) / CAST(count(*) FILTER (w) AS DOUBLE), 6) AS ppv, round(count(*) FILTER (w AND f) / CAST(count(*) FILTER (f) AS DOUBLE), 6) AS sensitivity FROM (SELECT runtime_seconds > 3500 AS w, status = 'failed' AS f FROM v_status)")
def e31(v: Views) -> DataFrame:
    w, f = F.col("runtime_seconds") > 3500, F.col("status") == "failed"
    out = v.v_status.agg(F.count_if(w & f).alias("hits"), F.count_if(w & ~f).alias("false_alarms"), (F.count_if(w & f) / F.count_if(w)).alias("ppv"), (F.count_if(w & f) / F.count_if(f)).alias("sensitivity"))
    return r6(out, "ppv", "sensitivity")


@query("e33_correlated_samples", "SELECT study AS parent, count(DISTINCT sample) AS children FROM v_sheet GROUP BY study HAVING count(DISTINCT sample) > 1")
def e33(v: Views) -> DataFrame:
    return v.v_sheet.groupBy(F.col("study").alias("parent")).agg(F.count_distinct("sample").alias("children")).filter("children > 1")


W = "1.959963984540054"
WILSON = "greatest((p + {z}*{z}/(2*n))/(1+{z}*{z}/n) - {z}*sqrt(p*(1-p)/n + {z}*{z}/(4*n*n))/(1+{z}*{z}/n), 0) AS {a}, least((p + {z}*{z}/(2*n))/(1+{z}*{z}/n) + {z}*sqrt(p*(1-p)/n + {z}*{z}/(4*n*n))/(1+{z}*{z}/n), 1) AS {b}"


@query("i05_wilson_interval", "SELECT tool, c, CAST(n AS BIGINT) AS n, round(low, 6) AS low, round(high, 6) AS high FROM (SELECT *, " + WILSON.format(z=W, a="low", b="high") + " FROM (SELECT tool, CAST(sum(correct) AS BIGINT) AS c, CAST(sum(plasmids) AS DOUBLE) AS n, sum(correct) / CAST(sum(plasmids) AS DOUBLE) AS p FROM v_scores GROUP BY tool))")
def i05(v: Views) -> DataFrame:
    sums = v.v_scores.groupBy("tool").agg(F.sum("correct").alias("c"), F.sum("plasmids").alias("n"))
    low, high = rates.wilson(F.col("c"), F.col("n"))
    return r6(sums.withColumn("low", low).withColumn("high", high), "low", "high")


@query("e34_forest_rows", """
SELECT stratum, CAST(c AS BIGINT) AS c, CAST(n AS BIGINT) AS n, round(p, 6) AS share, round(low, 6) AS low, round(high, 6) AS high, round(p - (SELECT sum(correct) / CAST(sum(plasmids) AS DOUBLE) FROM v_scores), 6) AS against_all FROM (SELECT *, """ + WILSON.format(z=W, a="low", b="high") + """
FROM (SELECT coalesce(CAST(species AS VARCHAR), 'all') AS stratum, sum(correct) AS c, CAST(sum(plasmids) AS DOUBLE) AS n, sum(correct) / CAST(sum(plasmids) AS DOUBLE) AS p FROM v_scores JOIN v_sheet USING (sample) GROUP BY GROUPING SETS ((species), ())))""")
def e34(v: Views) -> DataFrame:
    sums = v.v_scores.join(v.v_sheet, "sample").rollup("species").agg(F.sum("correct").alias("c"), F.sum("plasmids").alias("n"))
    low, high = rates.wilson(F.col("c"), F.col("n"))
    out = sums.withColumn("share", F.col("c") / F.col("n")).withColumn("low", low).withColumn("high", high)
    all_ = F.max(F.when(F.col("species").isNull(), F.col("share"))).over(Window.partitionBy(F.lit(1)))
    return r6(out.withColumn("against_all", F.col("share") - all_).withColumn("stratum", F.coalesce(F.col("species").cast("string"), F.lit("all"))).drop("species"), "share", "low", "high", "against_all")


@query("e35_best_and_tied_cells", "SELECT metric, tool, round(mean, 6) AS mean, mean >= top - 1e-9 AS best, mean >= top - 0.05 AS near FROM (SELECT *, max(mean) OVER (PARTITION BY metric) AS top FROM (SELECT 'f1' AS metric, tool, avg(f1) AS mean FROM v_scores GROUP BY tool UNION ALL SELECT 'bin_f1', tool, avg(bin_f1) FROM v_scores GROUP BY tool))")
def e35(v: Views) -> DataFrame:
    out = v.v_scores.unpivot(RUN, ["f1", "bin_f1"], "metric", "value").groupBy("metric", "tool").agg(F.avg("value").alias("mean"))
    top = F.max("mean").over(Window.partitionBy("metric"))
    return r6(out.withColumn("best", F.col("mean") >= top - 1e-9).withColumn("near", F.col("mean") >= top - 0.05), "mean")


@query("f01_competition_rank", "SELECT sample, tool, CAST(row_number() OVER (PARTITION BY sample ORDER BY value DESC, tool) AS INT) AS by_name, CAST(rank() OVER (PARTITION BY sample ORDER BY value DESC) AS INT) AS competition, CAST(dense_rank() OVER (PARTITION BY sample ORDER BY value DESC) AS INT) AS dense FROM vals", VALS)
def f01(v: Views) -> DataFrame:
    w = Window.partitionBy("sample").orderBy(F.desc("value"))
    return values(v).select(*RUN, F.row_number().over(Window.partitionBy("sample").orderBy(F.desc("value"), "tool")).alias("by_name"), F.rank().over(w).alias("competition"), F.dense_rank().over(w).alias("dense"))


@query("c10_tool_pair_self_join", "SELECT sample, a, b, round(d, 6) AS difference FROM prs", PAIRS)
def c10(v: Views) -> DataFrame:
    return r6(ranking.pairs(values(v)).select("sample", "a", "b", "difference"), "difference")


@query("j01_paired_differences", "SELECT a, b, count(*) AS n, count(DISTINCT study) AS clusters, round(avg(d), 6) AS mean, count(*) FILTER (d > 0) AS wins, count(*) FILTER (d = 0) AS ties, count(*) FILTER (d < 0) AS losses FROM prs JOIN v_sheet USING (sample) GROUP BY ALL", PAIRS)
def j01(v: Views) -> DataFrame:
    d = F.col("difference")
    out = ranking.pairs(values(v)).join(v.v_sheet, "sample").groupBy("a", "b").agg(F.count("*").alias("n"), F.count_distinct("study").alias("clusters"), F.avg(d).alias("mean"), F.count_if(d > 0).alias("wins"), F.count_if(d == 0).alias("ties"), F.count_if(d < 0).alias("losses"))
    return r6(out, "mean")


MEANS = "mns AS (SELECT tool, avg(f1) AS x, avg(bin_f1) AS y FROM v_scores GROUP BY tool), rks AS (SELECT tool, rank() OVER (ORDER BY x DESC) AS rx, rank() OVER (ORDER BY y DESC) AS ry FROM mns)"


@query("j12_kendall_tau", "SELECT round(sum(sign(a.rx - b.rx) * sign(a.ry - b.ry)) / CAST(count(*) AS DOUBLE), 6) AS tau FROM rks a JOIN rks b ON a.tool < b.tool", MEANS)
def j12(v: Views) -> DataFrame:
    means = v.v_scores.groupBy("tool").agg(F.avg("f1").alias("x"), F.avg("bin_f1").alias("y"))
    everyone = Window.partitionBy(F.lit(1))
    ranks = means.select("tool", F.rank().over(everyone.orderBy(F.desc("x"))).alias("rx"), F.rank().over(everyone.orderBy(F.desc("y"))).alias("ry"))
    return r6(ranking.kendall(ranks, "rx", "ry"), "tau")


@query("j13_pearson_spearman", """
SELECT tool, count(*) AS n, round(corr(f1, bin_f1), 6) AS pearson, round(corr(rx, ry), 6) AS spearman FROM (SELECT tool, f1, bin_f1, rank() OVER (PARTITION BY tool ORDER BY f1) + (count(*) OVER (PARTITION BY tool, f1) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY tool ORDER BY bin_f1) + (count(*) OVER (PARTITION BY tool, bin_f1) - 1) / 2.0 AS ry FROM v_scores WHERE f1 IS NOT NULL) GROUP BY tool""")
def j13(v: Views) -> DataFrame:
    rows = ranking.average_rank(ranking.average_rank(v.v_scores.filter("f1 is not null"), ["tool"], "f1", "rx"), ["tool"], "bin_f1", "ry")
    return r6(rows.groupBy("tool").agg(F.count("*").alias("n"), F.corr("f1", "bin_f1").alias("pearson"), F.corr("rx", "ry").alias("spearman")), "pearson", "spearman")


@query("j17_leave_one_group_out", """
SELECT left_out, tool, round(mean, 6) AS mean, n, CAST(rank() OVER (PARTITION BY left_out ORDER BY round(mean, 9) DESC) AS INT) AS place FROM (SELECT g.study AS left_out, x.tool, avg(x.value) AS mean, count(*) AS n FROM (SELECT DISTINCT study FROM vals JOIN v_sheet USING (sample)) g JOIN (SELECT * FROM vals JOIN v_sheet USING (sample)) x ON x.study <> g.study GROUP BY ALL)""", VALS)
def j17(v: Views) -> DataFrame:
    return r6(ranking.leave_one_out(values(v), v.v_sheet, "study"), "mean")


@query("g01_top_k_blocks", "SELECT tool, tname, s, qname, e - s AS bp FROM (SELECT *, row_number() OVER (PARTITION BY tool ORDER BY e - s DESC, tname, s, qname, qstart, strand, mapq) AS n FROM v_retained) WHERE n <= 50")
def g01(v: Views) -> DataFrame:
    order = Window.partitionBy("tool").orderBy(F.desc(F.col("e") - F.col("s")), "tname", "s", "qname", "qstart", "strand", "mapq")
    return v.retained.withColumn("n", F.row_number().over(order)).filter("n <= 50").select("tool", "tname", "s", "qname", (F.col("e") - F.col("s")).alias("bp"))


@query("g03_candidate_choice", "SELECT sample, contig FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY length DESC, depth, contig) AS n FROM v_contig WHERE called) WHERE n = 1")
def g03(v: Views) -> DataFrame:
    return v.v_contig.filter("called").groupBy("sample").agg(F.max_by("contig", F.struct("length", -F.col("depth"), -F.col("contig"))).alias("contig"))


@query("h02_set_intersection", "SELECT tool FROM v_scores WHERE f1 > 0.9 INTERSECT SELECT tool FROM v_scores WHERE bin_f1 > 0.9")
def h02(v: Views) -> DataFrame:
    return v.v_scores.filter("f1 > 0.9").select("tool").intersect(v.v_scores.filter("bin_f1 > 0.9").select("tool"))


@query("h03_difference_sets", "SELECT 'first' AS side, sample, tool FROM (SELECT sample, tool FROM v_status WHERE status = 'completed' EXCEPT SELECT sample, tool FROM v_scores WHERE correct >= 3) UNION ALL SELECT 'second', sample, tool FROM (SELECT sample, tool FROM v_scores WHERE correct >= 3 EXCEPT SELECT sample, tool FROM v_status WHERE status = 'completed')")
def h03(v: Views) -> DataFrame:
    """Runs that completed without three correct plasmids, and runs that have them without having completed."""
    done, good = v.v_status.filter("status = 'completed'").select(*RUN), v.v_scores.filter("correct >= 3").select(*RUN)
    side = lambda name, a, b: a.join(b, RUN, "left_anti").distinct().select(F.lit(name).alias("side"), *RUN)
    return side("first", done, good).union(side("second", good, done))


@query("h01_union_with_missing_columns", "SELECT sample, tool, f1 AS value, NULL AS status FROM v_scores UNION ALL SELECT sample, tool, NULL, status FROM v_status")
def h01(v: Views) -> DataFrame:
    low = v.v_scores.select(*RUN, F.col("f1").alias("value"))
    return low.unionByName(v.v_status.select(*RUN, "status"), allowMissingColumns=True)


@query("m02_decision_score", "SELECT s.sample, s.tool, round(0.5 * coalesce(f1, 0) + 0.3 * bin_f1 + 0.2 * correct / plasmids - 0.1 * CASE WHEN status = 'failed' THEN 1 ELSE 0 END, 6) AS score FROM v_scores s JOIN v_status t ON s.sample = t.sample AND s.tool = t.tool")
def m02(v: Views) -> DataFrame:
    score = 0.5 * F.coalesce("f1", F.lit(0.0)) + 0.3 * F.col("bin_f1") + 0.2 * F.col("correct") / F.col("plasmids") - 0.1 * (F.col("status") == "failed").cast("int")
    return r6(v.v_scores.join(v.v_status.select(*RUN, "status"), RUN).select(*RUN, score.alias("score")), "score")


@query("m01_multi_scope_recommendation", """
SELECT scope, grp, tool AS winner, round(mean, 6) AS mean, n FROM (SELECT *, row_number() OVER (PARTITION BY scope, grp ORDER BY round(mean, 9) DESC, tool) AS k FROM (
SELECT scope, grp, tool, avg(value) AS mean, count(*) AS n FROM (SELECT 'overall' AS scope, 'all' AS grp, * FROM vals JOIN v_sheet USING (sample) UNION ALL SELECT 'species', CAST(species AS VARCHAR), * FROM vals JOIN v_sheet USING (sample) UNION ALL SELECT 'region', CAST(region AS VARCHAR), * FROM vals JOIN v_sheet USING (sample)) GROUP BY ALL HAVING count(*) >= 3)) WHERE k = 1""", VALS)
def m01(v: Views) -> DataFrame:
    scopes = F.array(*(F.struct(F.lit(s).alias("scope"), g.alias("grp")) for s, g in (("overall", F.lit("all")), ("species", F.col("species").cast("string")), ("region", F.col("region").cast("string")))))
    rows = values(v).join(v.v_sheet, "sample").select("tool", "value", F.inline(scopes)).groupBy("scope", "grp", "tool").agg(F.avg("value").alias("mean"), F.count("*").alias("n")).filter("n >= 3")
    best = Window.partitionBy("scope", "grp").orderBy(F.desc(F.round("mean", 9)), "tool")
    return r6(rows.withColumn("k", F.row_number().over(best)).filter("k = 1").select("scope", "grp", F.col("tool").alias("winner"), "mean", "n"), "mean")


@query("m03_leave_one_study_out", """
SELECT left_out, tool AS pick, round(train, 6) AS train_mean, round(held, 6) AS held_mean, round(best_held - held, 6) AS regret FROM (SELECT *, row_number() OVER (PARTITION BY left_out ORDER BY round(train, 9) DESC, tool) AS k, max(held) OVER (PARTITION BY left_out) AS best_held FROM (
SELECT g.study AS left_out, x.tool, avg(x.value) FILTER (x.study <> g.study) AS train, avg(x.value) FILTER (x.study = g.study) AS held FROM (SELECT DISTINCT study FROM vals JOIN v_sheet USING (sample)) g CROSS JOIN (SELECT * FROM vals JOIN v_sheet USING (sample)) x GROUP BY ALL)) WHERE k = 1""", VALS)
def m03(v: Views) -> DataFrame:
    joined = values(v).join(v.v_sheet.select("sample", "study"), "sample")
    held = joined.groupBy(F.col("study").alias("left_out"), "tool").agg(F.avg("value").alias("held"))
    out = ranking.leave_one_out(values(v), v.v_sheet, "study").withColumnRenamed("mean", "train").join(held, ["left_out", "tool"], "left")
    w = Window.partitionBy("left_out")
    out = out.withColumn("k", F.row_number().over(w.orderBy(F.desc(F.round("train", 9)), "tool"))).withColumn("regret", F.max("held").over(w) - F.col("held")).filter("k = 1")
    return r6(out.select("left_out", F.col("tool").alias("pick"), F.col("train").alias("train_mean"), F.col("held").alias("held_mean"), "regret"), "train_mean", "held_mean", "regret")
