"""Tests and intervals over clusters. Draws come from hashes of (seed, draw, cluster), so they don't depend on partitions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cluster_sums(df: DataFrame, keys: list[str], cluster: str, value: str) -> DataFrame:
    """Sum and count of each cluster, and its place among its key's clusters."""
    sums = df.filter(F.col(value).isNotNull()).groupBy(*keys, cluster).agg(F.sum(value).alias("s"), F.count("*").alias("n"))
    w = Window.partitionBy(*keys)
    return sums.withColumn("i", F.row_number().over(w.orderBy(cluster)) - 1).withColumn("g", F.count("*").over(w))


def hash_index(seed: int, draw: Column, slot: Column, size: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), draw, slot), size)


def bootstrap(df: DataFrame, keys: list[str], cluster: str, value: str, draws: int = 1000, seed: int = 1, least: int = 5) -> DataFrame:
    """Percentile interval of the mean under resampling of whole clusters; null under least clusters."""
    sums = cluster_sums(df, keys, cluster, value).filter(F.col("g") >= least)
    slots = sums.select(*keys, "i", "g").withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    picked = slots.withColumn("pick", hash_index(seed, F.col("draw"), F.col("i"), F.col("g"))).select(*keys, "draw", "pick")
    means = picked.join(sums.select(*keys, F.col("i").alias("pick"), "s", "n").withColumn("pick", F.col("pick").cast("long")), [*keys, "pick"]).groupBy(*keys, "draw").agg((F.sum("s") / F.sum("n")).alias("m"))
    order = F.array_sort(F.collect_list("m"))
    return means.groupBy(*keys).agg(order.alias("m")).select(*keys, F.get("m", F.lit(int(0.025 * draws))).alias("low"), F.get("m", F.lit(int(0.975 * draws) - 1)).alias("high"))


def bootstrap_gap(df: DataFrame, keys: list[str], cluster: str, value: str, known: str, draws: int = 1000, seed: int = 6, least: int = 5) -> DataFrame:
    """Mean of value where known is true less the mean where it is false, with a percentile interval over resampled clusters.

    status: too few studies (no interval under least clusters, or under 3 that hold the false kind), gap supported, or no clear gap.
    """
    part = lambda ok, name: (F.sum(F.when(ok, F.col(value))).alias(f"s_{name}"), F.count(F.when(ok, F.col(value))).alias(f"n_{name}"))
    yes, no = F.col(known), ~F.col(known)
    sums = df.filter(F.col(value).isNotNull() & yes.isNotNull()).groupBy(*keys, cluster).agg(*part(yes, "a"), *part(no, "b")).fillna(0.0, ["s_a", "s_b"])
    w = Window.partitionBy(*keys)
    sums = sums.withColumn("i", (F.row_number().over(w.orderBy(cluster)) - 1).cast("long")).withColumn("g", F.count("*").over(w)).withColumn("held", F.count_if(F.col("n_b") > 0).over(w))
    mean = lambda name: F.try_divide(F.sum(f"s_{name}"), F.sum(f"n_{name}"))
    seen = sums.groupBy(*keys).agg((mean("a") - mean("b")).alias("gap"), F.max("g").alias("clusters"), F.max("held").alias("held"))
    slots = sums.select(*keys, "i", "g").withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws)))).withColumn("pick", hash_index(seed, F.col("draw"), F.col("i"), F.col("g")))
    drawn = slots.select(*keys, "draw", F.col("pick").alias("i")).join(sums.drop("g", "held"), [*keys, "i"]).groupBy(*keys, "draw").agg((mean("a") - mean("b")).alias("d"))
    limits = drawn.filter("d is not null").groupBy(*keys).agg(F.percentile("d", F.lit(0.025)).alias("low"), F.percentile("d", F.lit(0.975)).alias("high"), F.count("*").alias("used"))
    out = seen.join(limits, keys, "left")
    enough = (F.col("clusters") >= least) & (F.col("held") >= 3) & (F.col("used") >= draws // 2)
    status = F.when(~F.coalesce(enough, F.lit(False)), "too few studies").when((F.col("low") > 0) | (F.col("high") < 0), "gap supported").otherwise("no clear gap")
    return out.select(*keys, "gap", F.when(enough, F.col("low")).alias("low"), F.when(enough, F.col("high")).alias("high"), "clusters", status.alias("status"))


def exact_sign_flip(df: DataFrame, keys: list[str], cluster: str, value: str, scale: int = 1_000_000, least: int = 6, most: int = 12) -> DataFrame:
    """Share of all sign patterns over clusters whose sum is at least as far from zero as the observed one; sums are scaled to whole numbers, so ties are exact."""
    whole = df.withColumn("_v", F.round(F.col(value) * scale).cast("long"))
    sums = cluster_sums(whole, keys, cluster, "_v").filter(F.col("g").between(least, most))
    seen = sums.groupBy(*keys).agg(F.abs(F.sum("s")).alias("observed"), F.max("g").alias("g"))
    masks = sums.withColumn("mask", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("shiftleft(1L, cast(g as int)) - 1"))))
    flipped = masks.groupBy(*keys, "mask").agg(F.sum(F.when(F.expr("shiftright(mask, cast(i as int)) & 1") == 1, -F.col("s")).otherwise(F.col("s"))).alias("t"))
    return flipped.join(seen, keys).groupBy(*keys).agg(F.max("g").alias("clusters"), F.avg((F.abs("t") >= F.col("observed")).cast("double")).alias("p"))


def sampled_sign_flip(df: DataFrame, keys: list[str], cluster: str, value: str, draws: int = 2000, seed: int = 2) -> DataFrame:
    sums = cluster_sums(df, keys, cluster, value)
    seen = sums.groupBy(*keys).agg(F.abs(F.sum("s")).alias("observed"))
    signs = sums.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    flipped = signs.groupBy(*keys, "draw").agg(F.sum(F.when(hash_index(seed, F.col("draw"), F.col("i"), F.lit(2)) == 1, -F.col("s")).otherwise(F.col("s"))).alias("t"))
    return flipped.join(seen, keys).groupBy(*keys).agg(((F.count_if(F.abs("t") >= F.col("observed") - 1e-12) + 1) / (draws + 1)).alias("p"))


def t_quantile(p: float, df: int) -> float:
    """Quantile of Student's t: with t = sqrt(df) tan(u), its density becomes cos(u) ** (df - 1), which Simpson's rule sums up."""
    u = np.linspace(0.0, math.pi / 2, 20_001)
    y = np.cos(u) ** (df - 1)
    area = np.concatenate([[0.0], np.cumsum((y[0:-2:2] + 4 * y[1:-1:2] + y[2::2]) * (u[1] / 3))])
    return math.sqrt(df) * math.tan(float(np.interp(2 * p - 1, area / area[-1], u[::2])))


def cluster_t(df: DataFrame, keys: list[str], cluster: str, value: str, level: float = 0.95) -> DataFrame:
    """Mean with a cluster-robust interval: CR1 standard error and g - 1 degrees of freedom."""
    sums = cluster_sums(df, keys, cluster, value)
    whole = sums.groupBy(*keys).agg(F.sum("s").alias("S"), F.sum("n").alias("N"), F.count("*").alias("g")).withColumn("mean", F.col("S") / F.col("N"))
    resid = sums.join(whole.select(*keys, "mean"), keys).groupBy(*keys).agg(F.sum(F.pow(F.col("s") - F.col("n") * F.col("mean"), 2)).alias("r2"))
    table = F.create_map(*(F.lit(x) for d in range(1, 201) for x in (d, t_quantile(0.5 + level / 2, d))))
    g = F.col("g")
    se = F.sqrt(g / (g - 1) * F.col("r2")) / F.col("N")
    t = F.coalesce(F.element_at(table, F.least(g - 1, F.lit(200)).cast("int")), F.lit(1.96))
    out = whole.join(resid, keys).filter("g > 1").withColumn("se", se)
    return out.select(*keys, "mean", g.alias("clusters"), "se", (F.col("mean") - t * F.col("se")).alias("low"), (F.col("mean") + t * F.col("se")).alias("high"))


def holm(df: DataFrame, family: list[str], p: str, tie: str) -> DataFrame:
    """Step-down adjusted p-values inside each family of non-null ones."""
    rows = df.filter(F.col(p).isNotNull())
    w = Window.partitionBy(*family).orderBy(p, tie)
    m = F.count("*").over(Window.partitionBy(*family))
    raw = F.least(F.lit(1.0), F.col(p) * (m - F.row_number().over(w) + 1))
    rows = rows.withColumn("_raw", raw)
    adjusted = rows.withColumn("adjusted", F.max("_raw").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_raw")
    return adjusted.unionByName(df.filter(F.col(p).isNull()).withColumn("adjusted", F.lit(None).cast("double")))


def wilcoxon(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Signed ranks with zeros dropped and ties averaged: W+, and a two-sided p, exact up to 25 differences."""
    rows = df.filter(F.col(value) != 0).withColumn("_a", F.round(F.abs(value), 12))
    rank = F.rank().over(Window.partitionBy(*keys).orderBy("_a")) + (F.count("*").over(Window.partitionBy(*keys, "_a")) - 1) / 2
    rows = rows.withColumn("_r", rank)
    sums = rows.groupBy(*keys).agg(F.sum(F.when(F.col(value) > 0, F.col("_r")).otherwise(0.0)).alias("w_plus"), F.count("*").alias("n"), F.collect_list(F.when(F.lit(True), F.col("_r"))).alias("ranks"))
    # only groups of at most 25 differences carry their ranks to the exact null
    sums = sums.withColumn("ranks", F.when(F.col("n") <= 25, F.col("ranks")))
    ties = rows.groupBy(*keys, "_a").agg(F.count("*").alias("t")).groupBy(*keys).agg(F.sum(F.pow(F.col("t"), 3) - F.col("t")).alias("tie"))

    @F.pandas_udf("double")
    def exact(ranks: pd.Series, w: pd.Series) -> pd.Series:
        out = []
        for r, x in zip(ranks, w, strict=True):
            if r is None or not len(r):
                out.append(None)
                continue
            doubled = np.rint(2 * np.asarray(r)).astype(int)
            ways = np.zeros(doubled.sum() + 1)
            ways[0] = 1
            for d in doubled:
                ways[d:] = ways[d:] + ways[:-d].copy() if d else 2 * ways
            ways /= ways.sum()
            k = int(round(2 * x))
            out.append(min(1.0, 2 * min(ways[: k + 1].sum(), ways[k:].sum())))
        return pd.Series(out, dtype="float64")

    n = F.col("n")
    mid, sd = n * (n + 1) / 4, F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - F.col("tie") / 48)
    out = sums.join(ties, keys).withColumn("z", F.try_divide(F.abs(F.col("w_plus") - mid) - 0.5, sd))
    return out.select(*keys, "n", "w_plus", "z", exact("ranks", "w_plus").alias("exact_p"))
