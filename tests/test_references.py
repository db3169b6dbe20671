"""Close, ambiguous, no close reference, and the two ways of not being compared, by hand."""

from tessera.operators import references


def test_classes(spark):
    queries = spark.createDataFrame([(q, n) for q, n in [("near", 900), ("two", 900), ("same", 900), ("far", 900), ("weak", 900), ("small", 900), ("alone", 900), ("short", 50), ("tie", None)]], "query string, length long")
    hits = [("near", "a1", 0.01, 0.0), ("near", "b1", 0.03, 0.0), ("two", "a1", 0.01, 0.0), ("two", "b1", 0.012, None), ("same", "a1", 0.01, 0.0), ("same", "a2", 0.01, 0.0), ("same", "b1", 0.011, 0.9), ("far", "a1", 0.075, 0.0),
            ("weak", "a1", 0.01, 0.9), ("small", "c1", 0.01, 0.0), ("short", "a1", 0.0, 0.0), ("tie", "b1", 0.02, None), ("tie", "a2", 0.02, None)]
    hits = spark.createDataFrame(hits, "query string, ref string, distance double, p double")
    clusters = spark.createDataFrame([("a1", "A", 2), ("a2", "A", 2), ("b1", "B", 5), ("c1", "C", 1)], "ref string, cluster string, members long")
    got = {r.query: (r.status, r.best_ref, r.rival, None if r.distance_margin is None else round(r.distance_margin, 6)) for r in references.classify(queries, hits, clusters, 0.05, 2, 0.1, 100, 0.005).collect()}
    assert got == {
        "near": ("close_reference_match", "a1", None, 0.8), "two": ("ambiguous_between_references", "a1", "b1", 0.0), "same": ("close_reference_match", "a1", None, 0.8), "far": ("no_close_reference", "a1", None, 0.5),
        "weak": ("no_close_reference", "a1", None, -0.8), "small": ("no_close_reference", "c1", None, -0.8), "alone": ("insufficient_reference", None, None, None), "short": ("insufficient_sequence", None, None, None), "tie": ("ambiguous_between_references", "a2", "b1", 0.0),
    }
    plain = {r.query: r.status for r in references.classify(queries, hits, clusters, 0.05).collect()}
    assert plain["two"] == "close_reference_match" and plain["short"] == "close_reference_match"
