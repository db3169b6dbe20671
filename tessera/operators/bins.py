"""Agreement of predicted bins with truth, from a weighted contingency table (keys, bin, ref, bp)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def entropy_scores(table: DataFrame, keys: list[str]) -> DataFrame:
    """NMI, variation of information, adjusted Rand index, homogeneity, completeness and V-measure of each key's table."""
    whole = table.groupBy(*keys).agg(F.sum("bp").alias("n"))
    rows = table.groupBy(*keys, "bin").agg(F.sum("bp").alias("bin_bp"))
    cols = table.groupBy(*keys, "ref").agg(F.sum("bp").alias("ref_bp"))

    def pairs(c: str):
        x = F.col(c).cast("double")
        return F.sum(x * (x - 1) / 2)

    def entropy(df: DataFrame, c: str, name: str) -> DataFrame:
        p = F.col(c) / F.col("n")
        return df.join(whole, keys).groupBy(*keys).agg((-F.sum(p * F.ln(p))).alias(name), pairs(c).alias(f"{name}_pairs"))

    cells = table.join(whole, keys).withColumn("p", F.col("bp") / F.col("n")).groupBy(*keys, "n").agg((-F.sum(F.col("p") * F.ln("p"))).alias("h_both"), pairs("bp").alias("both_pairs"))
    out = cells.join(entropy(rows, "bin_bp", "h_bin"), keys).join(entropy(cols, "ref_bp", "h_ref"), keys)
    mi = F.col("h_bin") + F.col("h_ref") - F.col("h_both")
    n = F.col("n").cast("double")
    chance = F.col("h_bin_pairs") * F.col("h_ref_pairs") / (n * (n - 1) / 2)
    h = F.when(F.col("h_ref") == 0, 1.0).otherwise(mi / F.col("h_ref"))
    c = F.when(F.col("h_bin") == 0, 1.0).otherwise(mi / F.col("h_bin"))
    return out.select(
        *keys, F.when(F.col("h_bin") + F.col("h_ref") == 0, 1.0).otherwise(2 * mi / (F.col("h_bin") + F.col("h_ref"))).alias("nmi"), (F.col("h_both") - mi).alias("vi"),
        F.try_divide(F.col("both_pairs") - chance, (F.col("h_bin_pairs") + F.col("h_ref_pairs")) / 2 - chance).alias("ari"), h.alias("homogeneity"), c.alias("completeness"), F.when(h + c == 0, 0.0).otherwise(2 * h * c / (h + c)).alias("v_measure"),
    )


def best_match(table: DataFrame, keys: list[str]) -> DataFrame:
    """Share of bp in each bin's largest reference and each reference's largest bin, and their harmonic mean."""
    best = [table.groupBy(*keys, side).agg(F.max("bp").alias("best"), F.sum("bp").alias("all")).groupBy(*keys).agg((F.sum("best") / F.sum("all")).alias(name)) for side, name in (("bin", "precision"), ("ref", "recall"))]
    p, r = F.col("precision"), F.col("recall")
    return best[0].join(best[1], keys).withColumn("f1", F.when(p + r == 0, 0.0).otherwise(2 * p * r / (p + r)))


def top_reference(table: DataFrame, keys: list[str]) -> DataFrame:
    """Each bin's reference of most bp, ties to the smallest, with its purity."""
    return table.groupBy(*keys, "bin").agg(F.max_by("ref", F.struct("bp", -F.col("ref"))).alias("ref"), F.max("bp").alias("bp"), F.sum("bp").alias("bin_bp")).withColumn("purity", F.col("bp") / F.col("bin_bp"))


def splits_and_merges(table: DataFrame, keys: list[str], share: float = 0.2) -> DataFrame:
    """Extra bins that hold a share of a reference (splits), extra references that a bin holds a share of (merges)."""
    t = table.withColumn("in_bin", F.sum("bp").over(Window.partitionBy(*keys, "bin"))).withColumn("in_ref", F.sum("bp").over(Window.partitionBy(*keys, "ref")))
    split = t.filter(F.col("bp") >= share * F.col("in_ref")).groupBy(*keys, "ref").count().groupBy(*keys).agg(F.sum(F.col("count") - 1).alias("splits"))
    merge = t.filter(F.col("bp") >= share * F.col("in_bin")).groupBy(*keys, "bin").count().groupBy(*keys).agg(F.sum(F.col("count") - 1).alias("merges"))
    return split.join(merge, keys, "full").select(*keys, F.coalesce("splits", F.lit(0)).alias("splits"), F.coalesce("merges", F.lit(0)).alias("merges"))


def dissimilarity(members: DataFrame, keys: list[str], alpha: float = 0.5) -> DataFrame:
    """Split, join, extra and missing costs of members (keys, item, bin, ref, length): length ** alpha outside each group's largest part, over the total."""
    m = members.withColumn("w", F.pow(F.col("length").cast("double"), alpha))
    both = m.filter("bin is not null and ref is not null")

    def cost(side: str, other: str, name: str) -> DataFrame:
        part = both.groupBy(*keys, side, other).agg(F.sum("w").alias("w")).groupBy(*keys, side).agg((F.sum("w") - F.max("w")).alias("c"))
        return part.groupBy(*keys).agg(F.sum("c").alias(name))

    alone = m.groupBy(*keys).agg(F.sum(F.when(F.col("bin").isNotNull() & F.col("ref").isNull(), F.col("w")).otherwise(0.0)).alias("extra"), F.sum(F.when(F.col("bin").isNull() & F.col("ref").isNotNull(), F.col("w")).otherwise(0.0)).alias("missing"), F.sum("w").alias("total"))
    out = alone.join(cost("ref", "bin", "split"), keys, "left").join(cost("bin", "ref", "joined"), keys, "left").fillna(0.0, ["split", "joined"])
    return out.withColumn("dissimilarity", (F.col("split") + F.col("joined") + F.col("extra") + F.col("missing")) / F.col("total"))
