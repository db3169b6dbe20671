"""The tool that a sample's nearest samples of other studies did best with, by taxonomy first, abstaining outside what they cover."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.neighbours import nearest, quantiles, scales

#: Levels in the order in which they are tried; the last takes any sample.
LEVELS = ("species", "genus", "gram_group", "any")


def feature_arm(scores: DataFrame, samples: DataFrame, features: list[str], k: int = 5, least: int = 2, least_train: int = 1, penalty: float = 1.0, q: float = 0.95) -> DataFrame:
    """For each scored sample, its study left out: tool, basis (neighbours:level, single_best or abstain_out_of_range), predicted, score, best, spread, neighbour studies, nearest distance and in_range.

    scores: sample, tool, value; samples: sample, study, species, genus, gram_group and the features. Features are scaled by the fold's training samples alone.
    A level gives a tool that least of the k nearest there have scores of, the best by mean; the first level with one decides. A sample whose nearest
    training sample lies beyond the q-quantile of their own nearest distances (of five at least) gets the fold's single best. Folds times samples is what leaving one study
    out at a time costs; within a fold neighbours come from an index.
    """
    scored = scores.select("sample").distinct()
    rows = samples.join(scored, "sample")
    studies = [r[0] for r in rows.select("study").distinct().orderBy("study").collect()]  # a fold each
    folds = rows.withColumn("fold", F.explode(F.array(*map(F.lit, studies))))
    train = folds.filter("study != fold")
    spread = scales(train, features, ["fold"]).groupBy("fold").agg(F.map_from_entries(F.collect_list(F.struct("feature", "spread"))).alias("spread"))
    scaled = F.array(*(F.col(f).cast("double") / F.col("spread")[f] for f in features))  # centres cancel out
    keep = ["sample", "study", "species", "genus", "gram_group", "fold"]
    ready = lambda df: df.join(spread, "fold").select(*keep, F.col("sample").alias("id"), scaled.alias("z"))
    held, train = ready(rows.withColumn("fold", F.col("study"))), ready(train)

    def level(name: str, place: int) -> DataFrame:
        key = F.concat_ws("|", "fold", F.lit(place)) if name == "any" else F.when(F.col(name).isNotNull(), F.concat_ws("|", "fold", name))
        own, pool = (x.withColumn("pool", key).filter("pool is not null") for x in (held, train))
        return nearest(own, pool, k, penalty, "pool").select(F.col("query").alias("sample"), F.lit(place).alias("level"), "id", "place", "distance")

    found = level(LEVELS[0], 0)
    for n, name in enumerate(LEVELS[1:], 1):
        found = found.unionByName(level(name, n))
    closest = found.filter(f"level = {len(LEVELS) - 1} and place = 1").select("sample", F.col("distance").alias("nearest_distance"))
    inner = nearest(train, train, 1, penalty, "fold")
    enough = inner.groupBy("fold").agg(F.count("*").alias("n")).filter("n >= 5").select("fold")
    limit = quantiles(inner.join(enough, "fold"), ["fold"], "distance", q).select(F.col("fold").alias("study"), F.col("at").alias("limit"))
    other = scores.select(F.col("sample").alias("id"), "tool", F.col("value").cast("double").alias("v")).join(rows.select(F.col("sample").alias("id"), F.col("study").alias("its")), "id")
    means = found.join(other, "id").groupBy("sample", "level", "tool").agg(F.avg("v").alias("predicted"), F.count("*").alias("n"), F.stddev_pop("v").alias("sd"), F.count_distinct("its").alias("n_studies")).filter(F.col("n") >= least)
    pick = means.groupBy("sample").agg(F.min(F.struct("level", (-F.round("predicted", 12)).alias("less"), "tool", "predicted", "n", "sd", "n_studies")).alias("near"))
    by_study = scores.join(rows.select("sample", "study"), "sample").groupBy("study", "tool").agg(F.sum(F.col("value").cast("double")).alias("s"), F.count("*").alias("n"))
    whole = by_study.groupBy("tool").agg(F.sum("s").alias("all_s"), F.sum("n").alias("all_n"))
    rest = rows.select("study").distinct().withColumn("tool", F.explode(F.array(*(F.lit(r["tool"]) for r in whole.select("tool").collect()))))  # a row a study and tool
    rest = rest.join(whole, "tool").join(by_study, ["study", "tool"], "left").fillna(0, ["s", "n"]).withColumn("m", (F.col("all_n") - F.col("n"))).filter(F.col("m") >= max(1, least_train))
    single = rest.withColumn("mean", (F.col("all_s") - F.col("s")) / F.col("m")).groupBy("study").agg(F.min(F.struct((-F.round("mean", 12)).alias("less"), "tool", "mean")).alias("single"))
    out = rows.select("sample", "study").join(single, "study").join(pick, "sample", "left").join(closest, "sample", "left").join(limit, "study", "left")
    inside = F.when(F.col("nearest_distance").isNull() | F.col("limit").isNull(), "unknown").when(F.col("nearest_distance") <= F.col("limit") + 1e-12, "yes").otherwise("no")
    out = out.withColumn("in_range", inside).withColumn("by_near", (F.col("in_range") != "no") & F.col("near").isNotNull())
    chosen = lambda near, alone: F.when(F.col("by_near"), F.col(f"near.{near}")).otherwise(alone)
    names = F.array(*map(F.lit, LEVELS))
    basis = F.when(F.col("by_near"), F.concat(F.lit("neighbours:"), F.get(names, F.col("near.level")))).when(F.col("in_range") == "no", "abstain_out_of_range").otherwise("single_best")
    out = out.select("sample", "study", chosen("tool", F.col("single.tool")).alias("tool"), basis.alias("basis"), chosen("predicted", F.col("single.mean")).alias("predicted"),
        F.when(F.col("by_near") & (F.col("near.n") > 1), F.col("near.sd")).alias("spread"), chosen("n_studies", F.lit(0)).alias("n_neighbour_studies"), "nearest_distance", "in_range")
    best = scores.groupBy("sample").agg(F.max("value").alias("best"))
    return out.join(best, "sample").join(scores.select("sample", "tool", F.col("value").alias("score")), ["sample", "tool"], "left").fillna(0.0, ["score"])
