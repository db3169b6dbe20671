"""Nearest rows by cosine against all pairs, with copies, zero vectors and missing components; and pairs that don't become rows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera import catalog
from tessera.operators import cosine


def brute(rows, k):
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: (x * y).cast("double")), F.lit(0.0), lambda s, x: s + x)
    rows = rows.withColumn("norm", F.sqrt(dot(F.col("x"), F.col("x")))).filter("norm > 0")
    q = rows.filter("id % 20 = 0").select(F.col("id").alias("query"), F.col("x").alias("q"), F.col("norm").alias("m"), F.size("x").alias("d"))
    pairs = q.join(rows, (F.col("id") != F.col("query")) & (F.size("x") == F.col("d"))).select("query", "id", (dot(F.col("x"), F.col("q")) / (F.col("norm") * F.col("m"))).alias("cosine"))
    return pairs.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("cosine"), "id"))).filter(F.col("place") <= k)


def test_nearest(spark):
    draw = random.Random(4)
    rows = [(i, [draw.gauss(0, 1) for _ in range(8)]) for i in range(300)] + [(1000 + i, [1.0] * 8) for i in range(50)] + [(2000, [0.0] * 8), (2020, [None] + [1.0] * 7), (2040, [1.0, 2.0]), (2041, [2.0, 1.0]), (2060, None), (2080, [2.0] * 8)]
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"id long, x array<{kind}>")
        got = {(r.query, r.place): (r.id, r.cosine) for r in cosine.nearest(df, "id % 20 = 0", 5).collect()}
        assert got == {(r.query, r.place): (r.id, r.cosine) for r in brute(df, 5).collect()}
        assert cosine.nearest(df.limit(0), "id % 20 = 0", 5).count() == 0


def test_no_row_is_a_pair(spark):
    plan = catalog.queries()["c14_nearest_neighbours"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "FlatMapCoGroupsInArrow" in plan
