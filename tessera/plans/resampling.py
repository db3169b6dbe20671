"""Statistics over paired differences and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import ranking, stats
from tessera.plans.boards import PAIRS, VALS, values
from tessera.plans.coverage import r6
from tessera.plans.registry import query
from tessera.plans.views import Views, islands_text


def differences(v: Views) -> DataFrame:
    return ranking.pairs(values(v)).join(v.v_sheet, "sample")


@query("j02_cluster_bootstrap")
def j02(v: Views) -> DataFrame:
    return stats.bootstrap(values(v).join(v.v_sheet, "sample"), ["tool"], "study", "value")


CLS = PAIRS + ", cl AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY study) - 1 AS i FROM (SELECT a, b, study, CAST(sum(CAST(round(d * 1000000) AS BIGINT)) AS BIGINT) AS s FROM prs JOIN v_sheet USING (sample) GROUP BY ALL)), gg AS (SELECT a, b, count(*) AS g, abs(sum(s)) AS observed FROM cl GROUP BY ALL HAVING count(*) BETWEEN 6 AND 13)"


@query("j03_exact_sign_flip", """
SELECT a, b, clusters, round(avg(CASE WHEN abs(t) >= observed THEN 1.0 ELSE 0.0 END), 6) AS p FROM (SELECT cl.a, cl.b, m.mask, any_value(gg.g) AS clusters, any_value(observed) AS observed, sum(CASE WHEN (m.mask >> i) & 1 = 1 THEN -s ELSE s END) AS t FROM cl JOIN gg ON cl.a = gg.a AND cl.b = gg.b JOIN (SELECT unnest(range(0, 8192)) AS mask) m ON m.mask < (1 << gg.g) GROUP BY ALL) GROUP BY ALL""", CLS)
def j03(v: Views) -> DataFrame:
    return r6(stats.exact_sign_flip(differences(v), ["a", "b"], "study", "difference", most=13), "p")


@query("j04_sampled_sign_flip")
def j04(v: Views) -> DataFrame:
    return stats.sampled_sign_flip(differences(v), ["a", "b"], "study", "difference")


@query("j05_cluster_t_interval", """
SELECT tool, round(mean, 6) AS mean, g AS clusters, round(sqrt(g / CAST(g - 1 AS DOUBLE) * r2) / n, 6) AS se FROM (SELECT tool, any_value(mean) AS mean, sum(k) AS n, count(*) AS g, sum((s - k * mean) * (s - k * mean)) AS r2 FROM (
SELECT *, sum(s) OVER (PARTITION BY tool) / sum(k) OVER (PARTITION BY tool) AS mean FROM (SELECT tool, study, sum(value) AS s, count(*) AS k FROM vals JOIN v_sheet USING (sample) GROUP BY ALL)) GROUP BY tool)""", VALS)
def j05(v: Views) -> DataFrame:
    out = stats.cluster_t(values(v).join(v.v_sheet, "sample"), ["tool"], "study", "value")
    return r6(out.select("tool", "mean", "clusters", "se"), "mean", "se")


@query("j07_interval_method_rule", "SELECT tool, round(max(n) / CAST(sum(n) AS DOUBLE), 6) AS dominant, CASE WHEN max(n) / CAST(sum(n) AS DOUBLE) > 0.30 THEN 'percentile' ELSE 'cluster_t' END AS method FROM (SELECT tool, study, count(*) AS n FROM vals JOIN v_sheet USING (sample) GROUP BY ALL) GROUP BY tool", VALS)
def j07(v: Views) -> DataFrame:
    per = values(v).join(v.v_sheet, "sample").groupBy("tool", "study").agg(F.count("*").alias("n"))
    share = F.max("n") / F.sum("n")
    return r6(per.groupBy("tool").agg(share.alias("dominant"), F.when(share > 0.30, "percentile").otherwise("cluster_t").alias("method")), "dominant")


HOLM = CLS + ", pv AS (SELECT a, b, a || b AS k, avg(CASE WHEN abs(t) >= observed THEN 1.0 ELSE 0.0 END) AS p FROM (SELECT cl.a, cl.b, m.mask, any_value(observed) AS observed, sum(CASE WHEN (m.mask >> i) & 1 = 1 THEN -s ELSE s END) AS t FROM cl JOIN gg ON cl.a = gg.a AND cl.b = gg.b JOIN (SELECT unnest(range(0, 8192)) AS mask) m ON m.mask < (1 << gg.g) GROUP BY ALL) GROUP BY ALL)"


@query("j08_holm_adjustment", "SELECT a, b, round(p, 6) AS p, round(max(raw) OVER (PARTITION BY a ORDER BY p, k ROWS UNBOUNDED PRECEDING), 6) AS adjusted FROM (SELECT *, least(1.0, p * (count(*) OVER (PARTITION BY a) - row_number() OVER (PARTITION BY a ORDER BY p, k) + 1)) AS raw FROM pv)", HOLM)
def j08(v: Views) -> DataFrame:
    """Each tool's comparisons are a family; p-values are those of the exact sign flips."""
    rows = stats.exact_sign_flip(differences(v), ["a", "b"], "study", "difference", most=13).select("a", "b", "p").withColumn("k", F.concat("a", "b"))
    return r6(stats.holm(rows, ["a"], "p", "k").drop("k"), "p", "adjusted")


@query("j09_wilcoxon_signed_rank", """
SELECT a, b, count(*) AS n, round(sum(CASE WHEN d > 0 THEN r ELSE 0 END), 6) AS w_plus FROM (SELECT a, b, d, rank() OVER (PARTITION BY a, b ORDER BY round(abs(d), 12)) + (count(*) OVER (PARTITION BY a, b, round(abs(d), 12)) - 1) / 2.0 AS r FROM prs WHERE d <> 0) GROUP BY ALL""", PAIRS)
def j09(v: Views) -> DataFrame:
    return r6(stats.wilcoxon(ranking.pairs(values(v)), ["a", "b"], "difference").select("a", "b", "n", "w_plus"), "w_plus")


@query("j09_wilcoxon_p_values")
def j09_p(v: Views) -> DataFrame:
    return stats.wilcoxon(ranking.pairs(values(v)), ["a", "b"], "difference")


@query("j10_effect_status", f"""
SELECT a, b, CASE WHEN g < 6 THEN 'too few' WHEN mean - t * se > 0.05 THEN 'better' WHEN mean + t * se < -0.05 THEN 'worse' WHEN mean - t * se > -0.05 AND mean + t * se < 0.05 THEN 'equivalent' ELSE 'unclear' END AS effect, mean - t * se > 0 OR mean + t * se < 0 AS significant
FROM (SELECT a, b, mean, g, sqrt(g / CAST(g - 1 AS DOUBLE) * r2) / n AS se, [{", ".join(f"{stats.t_quantile(0.975, d):.9f}" for d in range(1, 25))}][g - 1] AS t FROM (SELECT a, b, any_value(mean) AS mean, sum(k) AS n, count(*) AS g, sum((s - k * mean) * (s - k * mean)) AS r2
FROM (SELECT *, sum(s) OVER (PARTITION BY a, b) / sum(k) OVER (PARTITION BY a, b) AS mean FROM (SELECT a, b, study, sum(d) AS s, count(*) AS k FROM prs JOIN v_sheet USING (sample) GROUP BY ALL)) GROUP BY a, b) WHERE g > 1)""", PAIRS)
def j10(v: Views) -> DataFrame:
    """What a clustered interval of the mean difference says of an effect of 0.05."""
    rows = stats.cluster_t(differences(v), ["a", "b"], "study", "difference")
    effect = F.when(F.col("clusters") < 6, "too few").when(F.col("low") > 0.05, "better").when(F.col("high") < -0.05, "worse").when((F.col("low") > -0.05) & (F.col("high") < 0.05), "equivalent").otherwise("unclear")
    return rows.select("a", "b", effect.alias("effect"), ((F.col("low") > 0) | (F.col("high") < 0)).alias("significant"))


@query("j11_minimum_detectable_difference", "SELECT a, b, count(*) AS clusters, round(2.8016 * stddev_samp(m) / sqrt(count(*)), 6) AS detectable, CAST(ceil(round(pow(2.8016 * stddev_samp(m) / 0.05, 2), 9)) AS BIGINT) AS clusters_needed FROM (SELECT a, b, study, avg(d) AS m FROM prs JOIN v_sheet USING (sample) GROUP BY ALL) GROUP BY ALL HAVING count(*) > 2", PAIRS)
def j11(v: Views) -> DataFrame:
    means = differences(v).groupBy("a", "b", "study").agg(F.avg("difference").alias("m"))
    sd = F.stddev_samp("m")
    out = means.groupBy("a", "b").agg(F.count("*").alias("clusters"), (2.8016 * sd / F.sqrt(F.count("*"))).alias("detectable"), F.ceil(F.round(F.pow(2.8016 * sd / 0.05, 2.0), 9)).alias("clusters_needed"))
    return r6(out.filter("clusters > 2"), "detectable")


VAR = "vr AS (SELECT * FROM (VALUES ('default', 20, 0.9), ('loose', 0, 0.0), ('strict', 40, 0.98)) t(variant, q, ident)), kept AS (SELECT variant, a.tool, tname, greatest(0, least(tstart, tend)) AS s, least(tlen, greatest(tstart, tend)) AS e FROM v_aln a JOIN vr ON is_primary AND block_length >= 200 AND mapq >= q AND CAST(matches AS DOUBLE) / block_length >= ident)"


@query("j16_rank_sensitivity_over_variants", """
SELECT variant, tool, covered, CAST(rank() OVER (PARTITION BY variant ORDER BY covered DESC) AS INT) AS place FROM (SELECT variant, tool, CAST(sum(e - s) AS BIGINT) AS covered FROM iv GROUP BY ALL)""", VAR + "," + islands_text("iv", "kept", "variant, tool, tname"))
def j16(v: Views) -> DataFrame:
    """Alignments meet the variants' table once; everything after is grouped by variant."""
    from tessera.operators import scoring
    from tessera.operators.intervals import union_bp

    variants = F.array(*(F.struct(F.lit(n).alias("variant"), F.lit(q).alias("q"), F.lit(i).alias("ident")) for n, q, i in (("default", 20, 0.9), ("loose", 0, 0.0), ("strict", 40, 0.98))))
    rows = v.v_aln.filter("is_primary and block_length >= 200").select("*", F.inline(variants)).filter((F.col("mapq") >= F.col("q")) & (scoring.identity() >= F.col("ident")))
    s, e = scoring.clip("tstart", "tend", "tlen")
    cov = union_bp(rows.withColumn("s", s).withColumn("e", e), ["variant", "tool", "tname"]).groupBy("variant", "tool").agg(F.sum("bp").alias("covered"))
    return cov.withColumn("place", F.rank().over(Window.partitionBy("variant").orderBy(F.desc("covered"))))


@query("j21_pooled_reliability", """
SELECT bin, round(sum(w * p) / sum(w), 6) AS mean_p, round(sum(w * y) / sum(w), 6) AS mean_y FROM (SELECT least(CAST(floor(probability * 10) AS BIGINT), 9) AS bin, probability AS p, CAST(record_id % 3 + 1 AS DOUBLE) AS w, CAST(record_id % 2 AS DOUBLE) AS y FROM v_prob) GROUP BY bin""")
def j21(v: Views) -> DataFrame:
    rows = v.v_prob.select(F.least(F.floor(F.col("probability") * 10), F.lit(9)).alias("bin"), F.col("probability").alias("p"), (F.col("record_id") % 3 + 1).cast("double").alias("w"), (F.col("record_id") % 2).cast("double").alias("y"))
    return r6(rows.groupBy("bin").agg((F.sum(F.col("w") * F.col("p")) / F.sum("w")).alias("mean_p"), (F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("mean_y")), "mean_p", "mean_y")


@query("j20_regression_by_sums", """
SELECT tool, count(*) AS n, round(regr_slope(f1, bin_f1), 6) AS slope, round(regr_intercept(f1, bin_f1), 6) AS intercept, round(regr_r2(f1, bin_f1), 6) AS r2 FROM v_scores WHERE f1 IS NOT NULL GROUP BY tool""")
def j20(v: Views) -> DataFrame:
    rows = v.v_scores.filter("f1 is not null")
    return r6(rows.groupBy("tool").agg(F.count("*").alias("n"), F.regr_slope("f1", "bin_f1").alias("slope"), F.regr_intercept("f1", "bin_f1").alias("intercept"), F.regr_r2("f1", "bin_f1").alias("r2")), "slope", "intercept", "r2")
