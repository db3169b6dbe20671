"""Tiers, floor, profiles and the fallback of scopes on a small table worked out by hand."""

import math

from tessera.operators import recommendation as r


def table(spark, f1):
    scores = [(s, t, x, x, x, None, None, None, *[0.0] * 7) for (s, t), x in f1.items()]
    scores = spark.createDataFrame(scores, "sample long, tool string, f1 double, precision double, recall double, plasmid_recall double, bin_f1 double, amr_gene_recall double, " + ", ".join(f"{c} double" for c in r.COUNTED))
    isolates = spark.createDataFrame([(s, "x" if s < 6 else "y", "g") for s in range(10)], "sample long, organism string, gram_group string")
    runs = spark.createDataFrame([("a", "completed", 0, None), ("a", "failed", 0, None), ("a", "skipped", 0, None), ("b", "reused", 3600, 16 * 1024 * 1024)], "tool string, status string, runtime_seconds long, peak_rss_kb long")
    return scores, isolates, runs


def test_scopes(spark):
    f1 = {(s, "a"): 0.6 for s in range(10)} | {(s, "b"): 0.9 for s in range(7)} | {(0, "b"): None}
    scores, isolates, runs = table(spark, f1)
    found = r.recommended(r.quality(scores, isolates, runs, ("organism", "gram_group")), least_samples=4, least_coverage=0.8)
    got = {(x.scope, x.grp, x.tool): x for x in found.collect()}
    assert set(got) == {(s, g, t) for s, g in (("overall", "all"), ("gram_group", "g"), ("organism", "x"), ("organism", "y")) for t in "ab"}
    assert {k: (x.n_scored, x.tier, x.recommendation) for k, x in got.items()} == {
        ("overall", "all", "a"): (10, "high", "primary"), ("overall", "all", "b"): (7, "unsupported", "none"), ("gram_group", "g", "a"): (10, "high", "primary"), ("gram_group", "g", "b"): (7, "unsupported", "none"),
        ("organism", "x", "a"): (6, "moderate", "none"), ("organism", "x", "b"): (6, "moderate", "primary"), ("organism", "y", "a"): (4, "moderate", "primary"), ("organism", "y", "b"): (1, "unsupported", "none"),
    }
    a, b = got["overall", "all", "a"], got["overall", "all", "b"]
    assert a.failure_rate == 0.5 and math.isclose(a.decision_score, 0.6 * (0.45 + 0.13 + 0.13 + 0.18) + 0.06 * 0.5 - 0.03 * 0.5)
    assert math.isclose(b.f1, 0.9) and math.isclose(b.decision_score, 0.9 * 0.89 + 0.06 - 0.02 - 0.01)
    picks = {x.sample: (x.tool, x.scope) for x in r.chosen(isolates, found).collect()}
    assert picks == {s: ("b", "organism") if s < 6 else ("a", "organism") for s in range(10)}


def test_floor_and_fallback(spark):
    scores, isolates, runs = table(spark, {(s, "a"): 0.3 if s < 6 else 0.8 for s in range(10)})
    found = r.recommended(r.quality(scores, isolates, runs, ("organism", "gram_group"), "amr_context"), least_samples=5, floor=0.4)
    kinds = {(x.scope, x.grp): x.recommendation for x in found.collect()}
    assert kinds == {("overall", "all"): "primary", ("gram_group", "g"): "primary", ("organism", "x"): "below_floor", ("organism", "y"): "none"}
    assert {(x.tool, x.scope) for x in r.chosen(isolates, found).collect()} == {("a", "gram_group")}
    none = r.recommended(r.quality(scores, isolates, runs, ("organism", "gram_group")), floor=0.95)
    assert {x.tool for x in r.chosen(isolates, none).collect()} == {None}
