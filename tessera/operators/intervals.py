"""Interval algebra: half-open [s, e) rows per key. Overlapping or touching intervals merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], s: str = "s", e: str = "e", width: int | None = None) -> DataFrame:
    """Merged intervals per key. With width, pieces are first merged inside cells of that many positions, so that a key with
    very many intervals isn't one task's work: only merged pieces meet in the final pass."""
    if width:
        cut = df.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(s) / width), F.floor((F.greatest(F.col(e) - 1, F.col(s))) / width))))
        cut = cut.withColumn(s, F.greatest(F.col(s), F.col("_cell") * width)).withColumn(e, F.least(F.col(e), (F.col("_cell") + 1) * width))
        return islands(islands(cut, [*keys, "_cell"], s, e), keys)
    order = Window.partitionBy(*keys).orderBy(s, e)
    reach = F.max(e).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.select(*keys, F.col(s).alias("s"), F.col(e).alias("e"), F.coalesce((F.col(s) > reach).cast("int"), F.lit(1)).alias("_new"))
    order = Window.partitionBy(*keys).orderBy("s", "e").rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn("_island", F.sum("_new").over(order)).groupBy(*keys, "_island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("_island")


def union_bp(df: DataFrame, keys: list[str], s: str = "s", e: str = "e", name: str = "bp") -> DataFrame:
    """Positions that the union of a key's intervals covers: in order of start, each adds what lies beyond all before it."""
    reach = F.max(e).over(Window.partitionBy(*keys).orderBy(s, e).rowsBetween(Window.unboundedPreceding, -1))
    marked = df.select(*keys, F.col(s).alias("s"), F.col(e).alias("e"), reach.alias("_reach"))
    own = F.when(F.col("s") <= F.col("_reach"), F.greatest(F.col("e") - F.col("_reach"), F.lit(0))).otherwise(F.col("e") - F.col("s"))
    return marked.select(*keys, own.alias("_own")).groupBy(*keys).agg(F.sum("_own").alias(name))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], width: int = 2000) -> DataFrame:
    """Pairs of left (ls, le) and right (rs, re) intervals of one key that share positions, with overlap bp.

    Both sides are dealt into cells of width positions and joined on (key, cell), an equi-join; a pair counts in the cell where its overlap begins.
    """
    def dealt(df: DataFrame, s: str, e: str) -> DataFrame:
        return df.filter(F.col(e) > F.col(s)).withColumn("_cell", F.explode(F.sequence(F.floor(F.col(s) / width), F.floor((F.col(e) - 1) / width))))

    both = dealt(left, "ls", "le").join(dealt(right, "rs", "re"), [*keys, "_cell"])
    both = both.withColumn("overlap", F.least("le", "re") - F.greatest("ls", "rs")).filter("overlap > 0")
    return both.filter(F.floor(F.greatest("ls", "rs") / width) == F.col("_cell")).drop("_cell")


def sweep(df: DataFrame, keys: list[str], gains: dict[str, Column], s: str = "s", e: str = "e") -> DataFrame:
    """Elementary segments (s, e) of each key, and for each named gain the sum over the intervals that cover them."""
    ends = [df.select(*keys, F.col(at).alias("pos"), *((sign * g).alias(k) for k, g in gains.items())) for at, sign in ((s, 1), (e, -1))]
    events = ends[0].union(ends[1]).groupBy(*keys, "pos").agg(*(F.sum(k).alias(k) for k in gains))
    order = Window.partitionBy(*keys).orderBy("pos")
    running = [F.sum(k).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias(k) for k in gains]
    return events.select(*keys, F.col("pos").alias("s"), F.lead("pos").over(order).alias("e"), *running).filter("e is not null")


def first_holders(df: DataFrame, keys: list[str], order: str, s: str = "s", e: str = "e", width: int = 500) -> DataFrame:
    """For each key and value of order, the positions that its intervals cover and no interval of a lesser order does.

    Intervals are cut into cells; every stretch between two ends in a cell goes to the least order that covers it, so the work per interval is
    bounded by the width of a cell, however many intervals lie over each other.
    """
    cut = df.filter(F.col(e) > F.col(s)).select(*keys, order, s, e).withColumn("_cell", F.explode(F.sequence(F.floor(F.col(s) / width), F.floor((F.col(e) - 1) / width))))
    cut = cut.select(*keys, order, "_cell", F.greatest(F.col(s), F.col("_cell") * width).alias("_s"), F.least(F.col(e), (F.col("_cell") + 1) * width).alias("_e"))
    cut = cut.groupBy(*keys, "_cell", "_s", "_e").agg(F.min(order).alias("_by"))
    ends = cut.select(*keys, "_cell", F.explode(F.array("_s", "_e")).alias("_at")).distinct()
    nearest = Window.partitionBy(*keys, "_cell").orderBy("_at")
    pieces = ends.withColumn("_to", F.lead("_at").over(nearest)).filter("_to is not null")
    held = cut.join(pieces, [*keys, "_cell"]).filter("_s <= _at and _at < _e").groupBy(*keys, "_cell", "_at", "_to").agg(F.min("_by").alias(order))
    return held.groupBy(*keys, order).agg(F.sum(F.col("_to") - F.col("_at")).alias("fresh"))


def windows_of(length: Column, size: int, step: int) -> Column:
    """Starts of windows of a fixed size and step; the last is anchored to the end, and a short sequence has one."""
    last = F.greatest(length - size, F.lit(0)).cast("long")
    return F.array_sort(F.array_distinct(F.concat(F.sequence(F.lit(0).cast("long"), last, F.lit(step).cast("long")), F.array(last))))
