"""Leaderboards, comparisons and strata over score rows (sample, tool, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RUN = ["sample", "tool"]


def with_failures(scores: DataFrame, status: DataFrame, metric: str = "f1") -> DataFrame:
    """Score rows with value 0 for failed runs that have no value; other missing values stay out."""
    failed = status.filter("status = 'failed'").select(*RUN)
    scored = scores.filter(F.col(metric).isNotNull()).select(*RUN, F.col(metric).alias("value"))
    return scored.unionByName(failed.join(scored, RUN, "left_anti").withColumn("value", F.lit(0.0)))


def shared_samples(values: DataFrame) -> DataFrame:
    """Samples that every tool has: division by counting."""
    tools = values.select("tool").distinct().groupBy().count().withColumnRenamed("count", "tools")
    per = values.groupBy("sample").agg(F.count_distinct("tool").alias("has")).withColumn("one", F.lit(1))
    return per.join(tools.withColumn("one", F.lit(1)), "one").filter("has = tools").select("sample")


def leaderboard(values: DataFrame) -> DataFrame:
    """Per tool: the mean over shared samples, which ranks, and mean, median and count over its own."""
    shared = values.join(shared_samples(values), "sample", "left_semi").groupBy("tool").agg(F.avg("value").alias("shared_mean"), F.count("*").alias("shared_n"))
    own = values.groupBy("tool").agg(F.avg("value").alias("own_mean"), F.expr("percentile(value, 0.5)").alias("own_median"), F.count("*").alias("own_n"))
    out = own.join(shared, "tool", "left")
    return out.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc(F.round("shared_mean", 9)), "tool")))


def ranked(df: DataFrame, by: list[str], value: str, name: str = "place") -> DataFrame:
    """Competition rank of tools by falling value, rounded so that equal means tie."""
    return df.withColumn(name, F.rank().over(Window.partitionBy(*by).orderBy(F.desc(F.round(value, 9)))))


def pairs(values: DataFrame) -> DataFrame:
    """Differences of every pair of tools a < b on the samples that both have."""
    a = values.select("sample", F.col("tool").alias("a"), F.col("value").alias("va"))
    b = values.select("sample", F.col("tool").alias("b"), F.col("value").alias("vb"))
    return a.join(b, "sample").filter("a < b").withColumn("difference", F.col("va") - F.col("vb"))


def macro_average(values: DataFrame, sheet: DataFrame, group: str = "species", cluster: str = "study", least: int = 2) -> DataFrame:
    """Per tool: the mean of species means where species with enough clusters exist, else the pooled mean, and which it is."""
    joined = values.join(sheet.select("sample", group, cluster), "sample")
    per = joined.groupBy("tool", group).agg(F.avg("value").alias("mean"), F.count_distinct(cluster).alias("clusters")).filter(F.col("clusters") >= least)
    macro = per.groupBy("tool").agg(F.avg("mean").alias("macro"), F.count("*").alias("groups"))
    pooled = joined.groupBy("tool").agg(F.avg("value").alias("pooled"))
    out = pooled.join(macro, "tool", "left")
    return out.select("tool", F.coalesce("macro", "pooled").alias("score"), F.when(F.col("macro").isNotNull(), "macro").otherwise("pooled").alias("basis"), F.coalesce("groups", F.lit(0)).alias("groups"))


def weighted_quantile(df: DataFrame, keys: list[str], value: str, weight: str, q: float) -> DataFrame:
    """The smallest value at which the running weight reaches q of the key's total. Equal values are summed first, so each key's window has a row a value."""
    rows = df.filter(F.col(value).isNotNull() & (F.col(weight) > 0)).groupBy(*keys, value).agg(F.sum(weight).alias("w"))
    total = F.sum("w").over(Window.partitionBy(*keys))
    run = F.sum("w").over(Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("reached", run >= q * total).filter("reached").groupBy(*keys).agg(F.min(value).alias("quantile"))


def average_rank(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """Ranks from the smallest value on, ties averaged."""
    low = F.rank().over(Window.partitionBy(*by).orderBy(value))
    return df.withColumn(name, low + (F.count("*").over(Window.partitionBy(*by, value)) - 1) / 2)


def kendall(ranks: DataFrame, a: str, b: str) -> DataFrame:
    """Kendall's tau of two rankings of the same tools."""
    x, y = ranks.select(F.col("tool").alias("t1"), F.col(a).alias("a1"), F.col(b).alias("b1")), ranks.select(F.col("tool").alias("t2"), F.col(a).alias("a2"), F.col(b).alias("b2"))
    one = F.lit(1)
    both = x.withColumn("k", one).join(y.withColumn("k", one), "k").filter("t1 < t2")
    return both.agg((F.sum(F.signum(F.col("a1") - F.col("a2")) * F.signum(F.col("b1") - F.col("b2"))) / F.count("*")).alias("tau"))


def leave_one_out(values: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    """Each tool's mean and rank with each group left out. Sums per (tool, group) come first, so the pairing is of groups with groups."""
    joined = values.join(groups.select("sample", group), "sample")
    sums = joined.groupBy("tool", group).agg(F.sum("value").alias("s"), F.count("*").alias("n"))
    total = sums.groupBy("tool").agg(F.sum("s").alias("all_s"), F.sum("n").alias("all_n"))
    left = sums.select(group).distinct().withColumn("one", F.lit(1)).join(total.withColumn("one", F.lit(1)), "one").drop("one")
    left = left.join(sums, ["tool", group], "left")
    out = left.withColumn("n", F.col("all_n") - F.coalesce("n", F.lit(0))).withColumn("mean", F.try_divide(F.col("all_s") - F.coalesce("s", F.lit(0.0)), F.col("n")))
    return ranked(out.select(F.col(group).alias("left_out"), "tool", "mean", "n"), ["left_out"], "mean")
