"""Gene order on a line, a circle, a reversed and a rearranged record; dates of several precisions and releases by date."""

import datetime

from pyspark.sql import functions as F

from tessera.operators import gene_order, releases


def share(spark, blocks, circular):
    genes = spark.createDataFrame([(1, "S", k, 1000 * k, 1000 * k + 500) for k in range(5)], "sample long, sequence_id string, copy_id long, start_pos long, end_pos long")
    rows = [(1, "t", q, "S", qs, qs + e - s, s, e, way) for q, qs, s, e, way in blocks]
    aligned = spark.createDataFrame(rows, "sample long, tool string, qname string, tname string, qstart long, qend long, s long, e long, strand string")
    ring = spark.createDataFrame([("S",)] if circular else [], "sequence_id string")
    runs = spark.createDataFrame([(1, "t"), (1, "none")], "sample long, tool string")
    got = {r.tool: (r.pairs, r.conserved, r.projected) for r in gene_order.conserved(genes, ring, aligned, runs).collect()}
    assert got["none"] == (5 if circular else 4, 0, 0)
    return got["t"]


def test_order(spark):
    whole = [("r", 0, 0, 5000, "+")]
    assert share(spark, whole, False) == (4, 4, 5) and share(spark, whole, True) == (5, 5, 5)
    assert share(spark, [("r", 0, 0, 5000, "-")], True) == (5, 5, 5)
    turned = [("r", 0, 2000, 5000, "+"), ("r", 3000, 0, 2000, "+")]  # the record starts elsewhere on the circle
    assert share(spark, turned, True) == (5, 5, 5) and share(spark, turned, False) == (4, 4, 5)
    assert share(spark, [("r", 0, 0, 2000, "+"), ("q", 0, 2000, 5000, "+")], True) == (5, 3, 5)
    assert share(spark, [("r", 0, 0, 2000, "+"), ("r", 3000, 2000, 5000, "-")], True)[1] == 1 + 2
    assert share(spark, [("r", 0, 0, 1200, "+"), ("r", 5000, 3000, 5000, "+")], True) == (5, 2, 3)


def test_dates_and_releases(spark):
    texts = {"2019-03-07": (2019, 3, 7), "2019-03": (2019, 3, 1), "2019": (2019, 1, 1), " 2019-03-07T10:00 ": (2019, 3, 7), "2019-13-40": None, "March 2019": None, "": None, None: None}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", releases.tolerant_date(F.col("t")).alias("d"))
    assert {r.t: r.d for r in df.collect()} == {t: x and datetime.date(*x) for t, x in texts.items()}
    day = datetime.date
    out = spark.createDataFrame([("a", "1", day(2018, 5, 1), day(2018, 1, 1)), ("a", "2", day(2020, 5, 1), None), ("a", "3", day(2020, 7, 1), day(2020, 6, 1))], "tool string, release string, released date, db_date date")
    runs = spark.createDataFrame([(k, t, d) for k, (t, d) in enumerate([("a", day(2018, 4, 30)), ("a", day(2018, 5, 1)), ("a", day(2019, 12, 31)), ("a", day(2020, 6, 30)), ("a", day(2024, 1, 1)), ("b", day(2024, 1, 1))])], "sample long, tool string, ran date")
    assert {r.sample: r.release for r in releases.in_force(runs, out).collect()} == {0: None, 1: "1", 2: "1", 3: "2", 4: "3", 5: None}
    cases = [(day(2020, 1, 1), True, day(2020, 1, 1), "possible_overlap"), (day(2020, 1, 2), True, day(2020, 1, 1), "after_database"), (None, True, day(2020, 1, 1), "unknown"), (day(2020, 1, 1), True, None, "unknown"), (None, False, None, "no_reference_database")]
    df = spark.createDataFrame(cases, "t date, u boolean, d date, want string")
    assert all(r.got == r.want for r in df.withColumn("got", releases.overlap_class(F.col("t"), F.col("u"), F.col("d"))).collect())
