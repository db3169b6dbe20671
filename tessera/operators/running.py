"""Running sums over a whole table without a task that holds it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.lineage import cut


def running_sums(df: DataFrame, by: str, columns: list[str], descending: bool = False) -> DataFrame:
    """df with each of columns replaced by its sum over all rows up to this one in the order of by, whose values differ.

    Rows are dealt out by range; sums run inside a range, and what came before it is added from the ranges' totals, a row each.
    """
    order = F.col(by).desc() if descending else F.col(by).asc()
    rows = cut(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    totals = rows.groupBy("_part").agg(*(F.sum(c).alias(f"_{c}") for c in columns))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    totals = totals.select("_part", *(F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}") for c in columns))
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(totals, "_part")
    return out.withColumns({c: F.col(f"_{c}") + F.sum(c).over(inside) for c in columns}).select(df.columns)
