"""Orders and shortlists: rotation over groups, and rows that two caps admit."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.lineage import cut
from tessera.operators.running import running_sums


def balanced_order(df: DataFrame, group: str, arm: str, study: str, tie: str) -> DataFrame:
    """df with turn and place: groups take turns; in a group no study comes twice before each has come once, and arms alternate, least first.

    place counts all rows from 1. Rows are ranked inside their group and inside their turn; the counts of turns are summed up by range.
    """
    of_study = F.row_number().over(Window.partitionBy(group, study).orderBy(arm, tie))
    rows = df.withColumn("_s", of_study)
    rows = rows.withColumn("_a", F.row_number().over(Window.partitionBy(group, "_s", arm).orderBy(study, tie)))
    rows = rows.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy("_s", "_a", arm, study, tie)))
    turns = rows.groupBy("turn").agg(F.count("*").alias("n"))
    before = running_sums(turns.withColumn("own", F.col("n")), "turn", ["n"]).select("turn", (F.col("n") - F.col("own")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("turn").orderBy(group))
    return rows.join(before, "turn").withColumn("place", F.col("_before") + inside).drop("_s", "_a", "_before")


def dual_cap(df: DataFrame, first: str, second: str, order: list[str], first_cap: int, second_cap: int) -> DataFrame:
    """The rows that are kept if all are taken in order, each kept while both its keys have fewer kept rows than their caps.

    Rounds decide at once every row that no open one before it can change: it is dropped if kept rows fill a cap before it, and kept if
    even all open rows before it would leave room. The first open row of all is always one of these. Open rows alone go on to the next
    round, with the number of kept rows before them. order ends in a unique column.
    """
    rows = df.withColumns({"_n1": F.lit(0).cast("long"), "_n2": F.lit(0).cast("long")})
    found = []
    while True:
        sides = (("_n1", first, first_cap), ("_n2", second, second_cap))
        for n, key, _ in sides:
            rows = rows.withColumn(f"{n}_open", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)
        full = functools.reduce(operator.or_, (F.col(n) >= cap for n, _, cap in sides))
        free = functools.reduce(operator.and_, (F.col(n) + F.col(f"{n}_open") < cap for n, _, cap in sides))
        rows = rows.withColumn("_kept", F.when(full, False).when(free, True)).drop("_n1_open", "_n2_open")
        for n, key, _ in sides:
            ahead = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
            rows = rows.withColumn(n, F.col(n) + F.coalesce(F.count_if(F.coalesce("_kept", F.lit(False))).over(ahead), F.lit(0)))
        rows = cut(rows.filter("_kept is null or _kept"))
        found.append(rows.filter("_kept").select(*df.columns))
        if len(found) == 20:  # a long chain of rounds is one table again
            found = [cut(functools.reduce(DataFrame.union, found).coalesce(8))]
        rows = rows.filter("_kept is null").drop("_kept")
        if not rows.limit(1).count():
            return functools.reduce(DataFrame.union, found)
