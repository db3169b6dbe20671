"""Which reference a record is close to, if any: the nearest hit, unless one of another cluster is as near."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def classify(queries: DataFrame, hits: DataFrame, clusters: DataFrame, threshold: float, least_members: int = 1, most_p: float = 1.0, least_length: int = 0, margin: float = 0.0) -> DataFrame:
    """query, status, best_ref, cluster, distance, rival and distance_margin for every query, those without a hit included.

    queries: query, length; hits: query, ref, distance, p (may be null); clusters: ref, cluster, members. A query shorter than least_length isn't compared
    (insufficient_sequence); one without hits has insufficient_reference. The nearest hit (ties: smaller ref) is close if it is within the threshold,
    supported by its p and of a large enough cluster; ambiguous_between_references if a supported hit of another cluster lies within margin beyond it.
    Both come from aggregates by query over hits joined by equality; distance_margin is how deep inside the threshold it lies, or how far outside, at most 1.
    """
    known = hits.join(clusters.select("ref", "cluster", "members"), "ref", "left")
    best = known.groupBy("query").agg(F.min(F.struct("distance", "ref", "p", "cluster", "members")).alias("b"))
    supported = lambda p: p.isNull() | (p <= most_p)
    close = (F.col("b.distance") <= threshold) & (F.coalesce("b.members", F.lit(0)) >= least_members) & supported(F.col("b.p"))
    best = best.withColumn("close", close)
    others = known.join(best.filter("close"), "query") if margin > 0 else known.join(best.filter("false"), "query")
    other = (F.col("ref") != F.col("b.ref")) & F.col("cluster").isNotNull() & ~F.col("cluster").eqNullSafe(F.col("b.cluster")) & supported(F.col("p")) & (F.col("distance") - F.col("b.distance") <= margin)
    rival = others.filter(other).groupBy("query").agg(F.min(F.struct("distance", "ref")).alias("r"))
    rows = queries.select("query", "length").join(best, "query", "left").join(rival, "query", "left")
    short = F.coalesce(F.col("length") < least_length, F.lit(False)) if least_length else F.lit(False)
    status = F.when(short, "insufficient_sequence").when(F.col("b").isNull(), "insufficient_reference").when(F.col("close") & F.col("r").isNotNull(), "ambiguous_between_references").when(F.col("close"), "close_reference_match").otherwise("no_close_reference")
    told = ~short & F.col("b").isNotNull()
    inside = F.greatest(F.lit(0.0), 1 - F.col("b.distance") / threshold) if threshold > 0 else F.lit(0.0)
    outside = F.least(F.lit(1.0), (F.col("b.distance") - threshold) / threshold) if threshold > 0 else F.lit(1.0)
    depth = F.when(status == "ambiguous_between_references", 0.0).when(status == "close_reference_match", inside).otherwise(outside)
    shown = {"best_ref": F.col("b.ref"), "cluster": F.col("b.cluster"), "distance": F.col("b.distance"), "rival": F.when(F.col("close"), F.col("r.ref")), "distance_margin": depth}
    return rows.select("query", status.alias("status"), *(F.when(told, c).alias(k) for k, c in shown.items()))
