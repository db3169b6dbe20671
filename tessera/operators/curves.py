"""Threshold sweeps, their areas and operating points, and calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.running import running_sums


def best_cover(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Elementary segments (s, e) of each key's intervals with the greatest value among those that cover them.

    The intervals are cut at every boundary inside them, so a segment's maximum is a plain group aggregate.
    """
    points = df.select(*keys, F.explode(F.array("s", "e")).alias("p")).distinct()
    cuts = points.groupBy(*keys, F.floor(F.col("p") / 2000).alias("cell")).agg(F.array_sort(F.collect_list("p")).alias("points"))
    # a boundary cuts only intervals that reach its cell
    parts = df.withColumn("cell", F.explode(F.sequence(F.floor(F.col("s") / 2000), F.floor((F.col("e") - 1) / 2000))))
    parts = parts.join(cuts, [*keys, "cell"], "left")
    low, high = F.greatest(F.col("s"), F.col("cell") * 2000), F.least(F.col("e"), (F.col("cell") + 1) * 2000)
    inside = F.filter(F.coalesce("points", F.array().cast("array<bigint>")), lambda p: (p > low) & (p < high))
    parts = parts.withColumn("at", F.concat(F.array(low), inside, F.array(high)))
    parts = parts.select(*keys, value, F.inline(F.transform(F.slice("at", F.lit(1), F.size("at") - 1), lambda p, i: F.struct(p.alias("s"), F.get("at", i + 1).alias("e")))))
    return parts.filter("e > s").groupBy(*keys, "s", "e").agg(F.max(value).alias(value))


def threshold_sweep(kept: DataFrame, truth: DataFrame, keys: list[str]) -> DataFrame:
    """TP, FP, FN, precision and recall of each key as records enter by falling probability; a base counts from its most probable record on."""
    segments = best_cover(kept.select(*keys, "tname", "molecule_type", "s", "e", "probability"), [*keys, "tname", "molecule_type"], "probability")
    bp, plasmid = F.col("e") - F.col("s"), F.col("molecule_type") == "PLASMID"
    steps = segments.groupBy(*keys, "probability").agg(F.sum(F.when(plasmid, bp).otherwise(0)).alias("tp"), F.sum(F.when(~plasmid, bp).otherwise(0)).alias("fp"))
    order = Window.partitionBy(*keys).orderBy(F.desc("probability")).rowsBetween(Window.unboundedPreceding, 0)
    total = truth.filter("molecule_type = 'PLASMID'").agg(F.sum("length").alias("total")).withColumn("one", F.lit(1))
    out = steps.withColumn("tp", F.sum("tp").over(order)).withColumn("fp", F.sum("fp").over(order)).withColumn("one", F.lit(1)).join(total, "one")
    return out.select(*keys, "probability", "tp", "fp", (F.col("total") - F.col("tp")).alias("fn"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), (F.col("tp") / F.col("total")).alias("recall"))


def areas(curve: DataFrame, keys: list[str]) -> DataFrame:
    """Trapezoid area and average precision, from the point (recall 0, precision 1) on."""
    order = Window.partitionBy(*keys).orderBy(F.desc("probability"))
    step = F.col("recall") - F.coalesce(F.lag("recall").over(order), F.lit(0.0))
    before = F.coalesce(F.lag("precision").over(order), F.lit(1.0))
    parts = curve.select(*keys, (step * (F.col("precision") + before) / 2).alias("auc"), (step * F.col("precision")).alias("average_precision"))
    return parts.groupBy(*keys).agg(F.sum("auc").alias("auc"), F.sum("average_precision").alias("average_precision"))


def f_optimal(curve: DataFrame, keys: list[str]) -> DataFrame:
    p, r = F.col("precision"), F.col("recall")
    best = curve.filter(p + r > 0).withColumn("f1", 2 * p * r / (p + r))
    return best.groupBy(*keys).agg(F.max(F.struct("f1", "probability")).alias("b")).select(*keys, "b.probability", "b.f1")


def summed_states(curve: DataFrame, thresholds: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """t and, for each column, the sum over all keys of the value that each key's step curve has at threshold t.

    A curve's steps are differences, and differences of all curves add up along t, so no curve meets every threshold.
    """
    along = Window.partitionBy(*keys).orderBy(F.desc("probability"))
    steps = curve.select(F.col("probability").alias("t"), *((F.col(c) - F.coalesce(F.lag(c).over(along), F.lit(0))).alias(c) for c in columns))
    marks = thresholds.select("t", *(F.lit(0).alias(c) for c in columns), F.lit(True).alias("asked"))
    sums = steps.withColumn("asked", F.lit(False)).union(marks).groupBy("t").agg(*(F.sum(c).alias(c) for c in columns), F.bool_or("asked").alias("asked"))
    return running_sums(sums, "t", columns, descending=True).filter("asked").drop("asked")


def states(curve: DataFrame, thresholds: DataFrame, keys: list[str]) -> DataFrame:
    """tp and fp of each key's step curve at each of a few thresholds t: those of the lowest probability that is t or more."""
    marks = curve.select(*keys).distinct().withColumn("one", F.lit(1)).join(thresholds.withColumn("one", F.lit(1)), "one")
    rows = curve.select(*keys, F.col("probability").alias("t"), "tp", "fp", F.lit(0).alias("mark")).unionByName(marks.select(*keys, "t", F.lit(None).cast("long").alias("tp"), F.lit(None).cast("long").alias("fp"), F.lit(1).alias("mark")))
    order = Window.partitionBy(*keys).orderBy(F.desc("t"), "mark").rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.withColumn("tp", F.last("tp", True).over(order)).withColumn("fp", F.last("fp", True).over(order)).filter("mark = 1")
    return filled.select(*keys, "t", F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("fp", F.lit(0)).alias("fp"))


def calibration(kept: DataFrame, probabilities: DataFrame, truth: DataFrame, bins: int = 10) -> DataFrame:
    """Reliability bins weighted by aligned bp; a record's label is its plasmid share."""
    bp = F.col("e") - F.col("s")
    aligned = kept.join(truth.select("sequence_id", "molecule_type"), F.col("tname") == F.col("sequence_id"))
    label = aligned.groupBy("qname").agg(F.sum(bp).alias("w"), (F.sum(F.when(F.col("molecule_type") == "PLASMID", bp).otherwise(0)) / F.sum(bp)).alias("y"))
    rows = probabilities.join(label, F.col("record_id") == F.col("qname")).withColumn("bin", F.least(F.floor(F.col("probability") * bins), F.lit(bins - 1)))
    w, p, y = F.col("w"), F.col("probability"), F.col("y")
    return rows.groupBy("bin").agg(F.sum(w).alias("bp"), (F.sum(w * p) / F.sum(w)).alias("mean_p"), (F.sum(w * y) / F.sum(w)).alias("mean_y"), (F.sum(w * (p - y) * (p - y)) / F.sum(w)).alias("brier"))


def expected_error(bins: DataFrame) -> DataFrame:
    """Expected and largest calibration error and the Brier score of reliability bins, weighted by their bp."""
    gap, w = F.abs(F.col("mean_p") - F.col("mean_y")), F.col("bp")
    return bins.agg((F.sum(w * gap) / F.sum(w)).alias("expected_error"), F.max(gap).alias("largest_error"), (F.sum(w * F.col("brier")) / F.sum(w)).alias("brier"), F.sum(w).alias("bp"))
