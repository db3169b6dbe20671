"""Which tool to use where: one pass over all scopes by grouping sets, eligibility, tiers, a floor, and the choice for a sample without truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The weights of the decision score in each profile, as published.
WEIGHTS = {
    "accuracy_first": {"f1": 0.45, "precision": 0.13, "recall": 0.13, "plasmid": 0.18, "bin": 0.06, "failure": -0.03, "structure": 1.0, "resources": 1.0},
    "amr_surveillance": {"f1": 0.30, "precision": 0.10, "recall": 0.10, "plasmid": 0.35, "bin": 0.10, "failure": -0.08, "structure": 1.0, "resources": 1.0},
    "rapid_screening": {"f1": 0.35, "precision": 0.10, "recall": 0.10, "plasmid": 0.15, "bin": 0.05, "failure": -0.03, "structure": 1.0, "resources": 5.0},
    "amr_context": {"f1": 0.20, "precision": 0.08, "recall": 0.07, "plasmid": 0.25, "bin": 0.12, "failure": -0.08, "structure": 1.5, "resources": 1.0, "genes": 0.20},
}
#: Scopes besides the overall one.
FIELDS = ("organism", "gram_group", "truth_technology", "sample_origin", "collection_country", "plasmid_size_band", "plasmid_count_band", "read_depth_band", "amr_status", "analysis_track", "read_quality_band")
#: Averaged where they exist, and averaged with a blank as zero.
DEFINED = ("f1", "precision", "recall", "plasmid_recall", "bin_f1", "amr_gene_recall")
COUNTED = ("split_events", "merge_events", "contamination_fraction", "ambiguous_bp", "true_bp", "excess_records", "true_count")


def decision_score(profile: str = "accuracy_first") -> Column:
    """The weighted sum over the columns that quality() makes. Without gene recovery anywhere in a scope, amr_context is amr_surveillance."""

    def weighted(w: dict[str, float]) -> Column:
        one = lambda mean, over: F.least(F.lit(1.0), F.col(mean) / F.greatest(F.lit(1.0), F.col(over)))
        structure = F.least(F.lit(1.0), F.col("split_events") + F.col("merge_events")) * 0.03 + F.least(F.lit(1.0), F.col("contamination_fraction")) * 0.05 + one("ambiguous_bp", "true_bp") * 0.02 + one("excess_records", "true_count") * 0.02
        used = lambda c, share: F.when(F.col(c).isNotNull(), F.least(F.lit(1.0), share)).otherwise(0.0)
        resources = used("median_runtime_seconds", F.log1p("median_runtime_seconds") / F.log1p(F.lit(3600.0))) * 0.02 + used("median_peak_rss_kb", F.col("median_peak_rss_kb") / (16 * 1024 * 1024)) * 0.01
        good = w["f1"] * F.col("f1") + w["precision"] * F.col("precision") + w["recall"] * F.col("recall") + w["plasmid"] * F.col("plasmid_recall") + w["bin"] * F.coalesce("bin_f1", 1 - F.col("failure_rate"))
        return good + w["failure"] * F.col("failure_rate") - w["structure"] * structure - w["resources"] * resources + w.get("genes", 0.0) * F.coalesce("amr_gene_recall", F.lit(0.0))

    own = weighted(WEIGHTS[profile])
    return F.when(F.col("amr_gene_recall").isNull(), weighted(WEIGHTS["amr_surveillance"])).otherwise(own) if profile == "amr_context" else own


def _scope(fields: tuple[str, ...]) -> list[Column]:
    """The scope of a row of the grouping sets, and its group."""
    return [F.coalesce(*(F.when(F.grouping(f) == 0, F.lit(f)) for f in fields), F.lit("overall")).alias("scope"), F.coalesce(*(F.when(F.grouping(f) == 0, F.col(f)) for f in fields), F.lit("all")).alias("grp")]


def quality(scores: DataFrame, isolates: DataFrame, runs: DataFrame, fields: tuple[str, ...] = FIELDS, profile: str = "accuracy_first") -> DataFrame:
    """A row a scope, group and tool: what it was scored on, coverage, means, failures and the decision score.

    scores: a row a sample and tool; isolates: a row a sample with the fields; runs: tool, status, runtime_seconds, peak_rss_kb. A
    skipped run lowers coverage alone; only failed ones count as failures.
    """
    known = isolates.select("sample", *(F.coalesce(F.col(f).cast("string"), F.lit("not_recorded")).alias(f) for f in fields))
    rows = scores.join(known, "sample")
    sums = rows.groupingSets([["tool"], *(["tool", f] for f in fields)], "tool", *fields).agg(
        *_scope(fields), F.count("*").alias("n_scored"), *(F.avg(c).alias(f"{c}_") for c in DEFINED), *(F.avg(F.coalesce(F.col(c), F.lit(0))).alias(f"{c}_") for c in COUNTED)
    )
    sums = sums.select("scope", "grp", "tool", "n_scored", *(F.col(f"{c}_").alias(c) for c in (*DEFINED, *COUNTED)))
    seen = rows.select("sample", *fields).distinct().groupingSets([[], *([f] for f in fields)], *fields).agg(*_scope(fields), F.count("*").alias("n_samples")).select("scope", "grp", "n_samples")
    every = isolates.agg(F.count("*").alias("n")).select(F.lit("overall").alias("scope"), F.lit("all").alias("grp"), F.col("n").alias("n_all"))
    seen = seen.join(every, ["scope", "grp"], "left").select("scope", "grp", F.coalesce("n_all", "n_samples").alias("n_samples"))
    done, failed = F.count_if(F.col("status").isin("completed", "reused")), F.count_if(F.col("status") == "failed")
    own = runs.groupBy("tool").agg(F.coalesce(F.try_divide(failed, done + failed), F.lit(0.0)).alias("failure_rate"), F.median("runtime_seconds").alias("median_runtime_seconds"), F.median("peak_rss_kb").alias("median_peak_rss_kb"))
    out = sums.join(seen, ["scope", "grp"]).join(own, "tool").withColumn("coverage", F.col("n_scored") / F.col("n_samples"))
    zero = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("f1", "precision", "recall")}
    out = out.withColumns(zero).withColumn("plasmid_recall", F.coalesce("plasmid_recall", "f1"))
    return out.withColumn("decision_score", decision_score(profile))


def recommended(found: DataFrame, least_samples: int = 5, least_coverage: float = 0.8, floor: float = 0.4) -> DataFrame:
    """quality()'s rows with eligible, tier and recommendation: the eligible tool of the highest score is primary, unless its mean F1 is below the floor: then there is none."""
    able = (F.col("n_scored") >= least_samples) & (F.col("coverage") >= least_coverage)
    ratio, margin = F.col("n_scored") / least_samples, F.round(F.col("coverage") - least_coverage, 12)
    tier = F.when(~able, "unsupported").when((ratio >= 2.0) & (margin >= 0.15), "high").when((ratio >= 1.4) | (margin >= 0.08), "moderate").otherwise("low")
    best = Window.partitionBy("scope", "grp").orderBy(F.desc("eligible"), F.desc(F.round("decision_score", 9)), F.desc(F.round("f1", 9)), F.desc("tool"))
    rows = found.withColumn("eligible", able).withColumn("tier", tier).withColumn("place", F.row_number().over(best))
    first = F.col("eligible") & (F.col("place") == 1)
    kind = F.when(first & (F.round("f1", 12) >= floor), "primary").when(first, "below_floor").otherwise("none")
    return rows.withColumn("recommendation", kind).drop("place")


def chosen(isolates: DataFrame, found: DataFrame) -> DataFrame:
    """sample, tool, scope: the primary tool of the most specific scope that has one, of organism, Gram group and all. Samples that no scope serves have none."""
    tried = [("organism", F.col("organism").cast("string")), ("gram_group", F.col("gram_group").cast("string")), ("overall", F.lit("all"))]
    asked = isolates.select("sample", F.inline(F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(s).alias("scope"), g.alias("grp")) for i, (s, g) in enumerate(tried)))))
    primary = found.filter("recommendation = 'primary'").select("scope", "grp", "tool")
    best = asked.join(primary, ["scope", "grp"]).groupBy("sample").agg(F.min(F.struct("rank", "scope", "tool")).alias("b"))
    return isolates.select("sample").join(best, "sample", "left").select("sample", F.col("b.tool").alias("tool"), F.col("b.scope").alias("scope"))
