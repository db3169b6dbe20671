"""Places, moves, tau and the top tool of variants by hand."""

from tessera.operators import variants


def test_compared(spark):
    values = [("baseline", s, t, x) for s in (1, 2) for t, x in (("a", 0.9), ("b", 0.5), ("c", 0.1))] + [("baseline", 3, "c", 1.0)]
    values += [("setting:x", 1, "a", 0.1), ("setting:x", 1, "b", 0.2), ("setting:x", 1, "c", 0.3), ("cohort:y", 1, "a", 0.5), ("cohort:y", 1, "b", 0.5), ("metric:z", 1, "new", 1.0)]
    got = {(r.variant, r.tool): (r.n, r.place, r.moved, r.tau, r.top, r.same_top) for r in variants.compared(spark.createDataFrame(values, "variant string, sample long, tool string, value double")).collect()}
    assert got == {
        ("baseline", "a"): (2, 1, 0, 1.0, "a", True), ("baseline", "b"): (2, 2, 0, 1.0, "a", True), ("baseline", "c"): (2, 3, 0, 1.0, "a", True),
        ("setting:x", "c"): (1, 1, 2, -1.0, "c", False), ("setting:x", "b"): (1, 2, 0, -1.0, "c", False), ("setting:x", "a"): (1, 3, -2, -1.0, "c", False),
        ("cohort:y", "a"): (1, 1, 0, 1.0, "a", True), ("cohort:y", "b"): (1, 2, 0, 1.0, "a", True), ("metric:z", "new"): (1, 1, None, None, "new", None),
    }
