"""What keeps costs in line with the input: large inputs are read once, and what follows stands on what is left of them."""

from pyspark.sql import functions as F

from tessera.operators import graph, intervals, multiplicity
from tessera.plans import rebuilt
from tessera.plans.views import Views

DIR = "/root/testdata/sf0.001"


def test_union_of_intervals_takes_one_window(spark):
    rows = [("a", 0, 10), ("a", 5, 7), ("a", 5, 12), ("a", 12, 12), ("a", 12, 15), ("a", 40, 50), ("a", 41, 42), ("b", 3, 3), ("c", 7, 9), ("c", 7, 9)]
    df = spark.createDataFrame(rows, "k string, s long, e long")
    found = intervals.union_bp(df, ["k"])
    assert {r.k: r.bp for r in found.collect()} == {"a": 25, "b": 0, "c": 2}
    assert found._jdf.queryExecution().executedPlan().toString().count("Window [") <= 2  # once in each of the initial and the final plan


def test_tables_of_bins_stand_on_their_own(spark):
    parts = rebuilt.Parts(Views(spark, DIR))
    for df in (parts.overlaps, parts.chromosome, parts.bins):
        assert "parquet" not in df._jdf.queryExecution().optimizedPlan().toString().lower()
    v = Views(spark, DIR)
    want = v.v_record.join(v.v_bins, F.col("record_id") == F.col("sequence_id")).select("sample", "tool", F.col("bin_id").alias("bin")).distinct()
    assert {tuple(r) for r in parts.bins.collect()} == {tuple(r) for r in want.collect()}


def test_matching_ships_its_helper(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(graph, "ship", sent.append, raising=False)
    graph.best_matching(spark.createDataFrame([("k", 1, 2, 3.0)], "k string, left long, right long, weight double"), ["k"])
    assert sent == [spark]


def test_records_are_joined_once(spark):
    """Records of no alignment, most of them, meet the aligned ones once and nothing else."""
    aligned = spark.createDataFrame([(1, "t", "a", "P", 0, 900), (1, "t", "b", "P", 100, 900), (1, "t", "b", "C", 0, 300)], "sample long, tool string, qname string, tname string, s long, e long")
    truth = spark.createDataFrame([(1, "P", "PLASMID", 1000), (1, "C", "CHROMOSOME", 5000)], "sample long, sequence_id string, molecule_type string, length long")
    records = spark.createDataFrame([(1, "t", q, 1000) for q in "abxyz"] + [(2, "t", "x", 10)], "sample long, tool string, record_id string, length long")
    found = multiplicity.candidates(aligned, records, truth, least_bp=100)
    assert {(r.sample, r.candidate): r.relationship for r in found.collect()} == {(1, "a"): "primary", (1, "b"): "chimeric", (1, "x"): "unmapped", (1, "y"): "unmapped", (1, "z"): "unmapped", (2, "x"): "unmapped"}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LeftAnti") == 1
    few = multiplicity.candidates(aligned, records, truth, least_bp=100, unmapped=False)
    assert {r.candidate for r in few.collect()} == {"a", "b"} and "record_id" not in few._jdf.queryExecution().optimizedPlan().toString()
    rows = {r.plasmid: (r.tool, r.n_touching, r.sample) for r in multiplicity.plasmids(aligned, few, truth, records).collect()}
    assert rows == {"P": ("t", 2, 1)}
