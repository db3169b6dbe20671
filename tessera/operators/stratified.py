"""Resampling of macro means, the mean of the strata's means: whole clusters flip or are drawn, and intervals follow a rule that is run.

A cluster may lie in several strata. A flip turns all that it has at once: in the macro mean its part is one number, the sum of its strata's sums
over their counts. Bootstraps draw clusters within each stratum. Draws are hashes of (seed, draw, slot), so no partition changes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.stats import cluster_t, hash_index

#: Equal but for the order of additions.
ALIKE = 1e-9


def cluster_parts(df: DataFrame, keys: list[str], cluster: str, stratum: str | None, value: str) -> DataFrame:
    """keys, i and c: each cluster's part of the macro mean, numbered; and g, how many there are."""
    rows = df.filter(F.col(value).isNotNull()).withColumns({"_k": F.col(stratum) if stratum else F.lit(0), "_v": F.col(value).cast("double")})
    sums = rows.groupBy(*keys, "_k", cluster).agg(F.sum("_v").alias("s"), F.count("*").alias("n"))
    count = sums.groupBy(*keys, "_k").agg(F.sum("n").alias("n_k"))
    strata = count.groupBy(*keys).agg(F.count("*").alias("strata"))
    parts = sums.join(count, [*keys, "_k"]).join(strata, keys).groupBy(*keys, cluster).agg(F.sum(F.col("s") / F.col("n_k") / F.col("strata")).alias("c"))
    own = Window.partitionBy(*keys)
    return parts.select(*keys, (F.row_number().over(own.orderBy(cluster)) - 1).alias("i"), "c", F.count("*").over(own).alias("g"))


def sign_flip(df: DataFrame, keys: list[str], cluster: str, stratum: str | None, value: str, draws: int = 10_000, seed: int = 5, least: int = 6, exact: int = 12) -> DataFrame:
    """keys, clusters, observed, p and exact: the share of sign patterns whose macro mean is as far from 0. Up to ``exact`` clusters all patterns count;
    beyond, draws of them, the observed one added. Fewer than least clusters give no row."""
    parts = cluster_parts(df, keys, cluster, stratum, value).filter(F.col("g") >= least)
    seen = parts.groupBy(*keys).agg(F.sum("c").alias("observed"))
    all_of = parts.filter(F.col("g") <= exact).withColumn("draw", F.explode(F.sequence(F.lit(0), F.expr("(1 << g) - 1").cast("int"))))
    some = parts.filter(F.col("g") > exact).withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    bit = F.when(F.col("g") <= exact, F.expr("shiftright(draw, i) & 1")).otherwise(F.xxhash64(F.lit(seed), "draw", "i").bitwiseAND(F.lit(1)).cast("int"))
    totals = all_of.unionByName(some).groupBy(*keys, "draw").agg(F.first("g").alias("g"), F.sum(F.when(bit == 1, F.col("c")).otherwise(-F.col("c"))).alias("t"))
    far = totals.join(seen, keys).groupBy(*keys).agg(F.first("g").alias("clusters"), F.first("observed").alias("observed"), F.count("*").alias("n"), F.count_if(F.abs("t") >= F.abs("observed") - ALIKE).alias("extreme"))
    whole = F.col("clusters") <= exact
    p = F.when(whole, F.col("extreme") / F.col("n")).otherwise((F.col("extreme") + 1) / (F.col("n") + 1))
    return far.select(*keys, "clusters", "observed", p.alias("p"), whole.alias("exact"))


def _moments(rows: DataFrame, by: list[str], s: Column, n: Column) -> DataFrame:
    """Per stratum: its mean and the variance of that, robust to clusters, from sums over its clusters."""
    sums = rows.groupBy(*by).agg(F.count("*").alias("g"), F.sum(s).alias("S"), F.sum(n).alias("N"), F.sum(s * s).alias("ss"), F.sum(s * n).alias("sn"), F.sum(n * n).alias("nn"))
    m = F.col("S") / F.col("N")
    square = F.greatest(F.col("ss") - 2 * m * F.col("sn") + m * m * F.col("nn"), F.lit(0.0)) * F.col("g") / (F.col("g") - 1) / (F.col("N") * F.col("N"))
    return sums.select(*by, m.alias("m"), square.alias("var"))


def bootstrap(df: DataFrame, keys: list[str], cluster: str, stratum: str | None, value: str, studentised: bool, draws: int = 1000, seed: int = 7, level: float = 0.95, least: int = 5) -> DataFrame:
    """keys, mean, low, high of the macro mean, from draws of each stratum's clusters: the draws' own quantiles, or those of their t values.

    Studentised, a stratum of one cluster or fewer than least clusters in all give no row, and no spread gives the mean itself.
    """
    rows = df.filter(F.col(value).isNotNull()).withColumns({"_k": F.col(stratum) if stratum else F.lit(0), "_v": F.col(value).cast("double")})
    sums = rows.groupBy(*keys, "_k", cluster).agg(F.sum("_v").alias("s"), F.count("*").alias("n"))
    own = Window.partitionBy(*keys, "_k")
    sums = sums.withColumns({"i": (F.row_number().over(own.orderBy(cluster)) - 1).cast("long"), "g": F.count("*").over(own)})
    fit = sums.groupBy(*keys).agg(F.count("*").alias("all"), F.min("g").alias("fewest")).filter((F.col("all") >= least) & ((F.col("fewest") >= 2) | F.lit(not studentised)))
    sums = sums.join(fit.select(*keys), keys)
    pooled = lambda x, by: x.groupBy(*by).agg(F.avg("m").alias("mean"), (F.sqrt(F.sum("var")) / F.count("*")).alias("se"))
    base = pooled(_moments(sums, [*keys, "_k"], F.col("s"), F.col("n")), keys)
    slots = sums.select(*keys, "_k", "i", "g").withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    slots = slots.withColumn("pick", hash_index(seed, F.col("draw"), F.xxhash64("_k", "i"), F.col("g")).cast("long")).drop("i")
    drawn = slots.join(sums.select(*keys, "_k", F.col("i").alias("pick"), "s", "n"), [*keys, "_k", "pick"])
    each = pooled(_moments(drawn, [*keys, "_k", "draw"], F.col("s"), F.col("n")), [*keys, "draw"])
    each = each.withColumnsRenamed({"mean": "m", "se": "e"}).join(base, keys)
    each = each.withColumn("t", F.when(F.col("e") > 0, (F.col("m") - F.col("mean")) / F.col("e")) if studentised else F.col("m"))
    out = each.groupBy(*keys).agg(F.first("mean").alias("mean"), F.first("se").alias("se"), F.array_sort(F.collect_list("t")).alias("t"))  # as many as there are draws
    alpha = (1 - level) / 2
    low, high = F.get("t", (F.lit(alpha) * F.size("t")).cast("int")), F.get("t", (F.lit(1 - alpha) * F.size("t")).cast("int") - 1)
    if not studentised:
        return out.select(*keys, "mean", low.alias("low"), high.alias("high"))
    still, enough = F.col("se") == 0, F.size("t") >= draws // 2
    limit = lambda q: F.when(still, F.col("mean")).when(enough, F.col("mean") - q * F.col("se"))
    return out.select(*keys, "mean", limit(high).alias("low"), limit(low).alias("high"))


def interval(df: DataFrame, keys: list[str], cluster: str, value: str, stratum: str | None = None, bounds: tuple[float, float] | None = None, dominant: float = 0.30, draws: int = 1000) -> DataFrame:
    """keys, dominant, method, low, high: the interval by the rule. Cluster t (studentised bootstrap where there are strata), unless one cluster holds more
    than the dominant share of the values: then the percentile bootstrap. Limits are clipped to the bounds of the statistic."""
    per = df.filter(F.col(value).isNotNull()).groupBy(*keys, cluster).agg(F.count("*").alias("n"))
    usual = "bootstrap_t" if stratum else "cluster_t"
    rule = per.groupBy(*keys).agg((F.max("n") / F.sum("n")).alias("dominant")).withColumn("method", F.when(F.col("dominant") > dominant, "percentile").otherwise(usual))
    of = lambda method: df.join(rule.filter(F.col("method") == method).select(*keys), keys)
    steady = bootstrap(of(usual), keys, cluster, stratum, value, True, draws) if stratum else cluster_t(of(usual), keys, cluster, value)
    found = steady.select(*keys, "low", "high").unionByName(bootstrap(of("percentile"), keys, cluster, stratum, value, False, draws).select(*keys, "low", "high"))
    out = rule.join(found, keys, "left")
    if bounds is not None:
        clip = lambda c: F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.lit(float(bounds[0]))), F.lit(float(bounds[1]))))
        out = out.withColumns({"low": clip("low"), "high": clip("high")})
    return out
