"""Sign flips over strata against enumeration; bootstraps against numpy's; the rule of intervals run, with its fallback and clipping."""

import itertools
import math
import random

import numpy as np

from tessera.operators import stats, stratified


def rows(seed, clusters, strata=3):
    draw = random.Random(seed)
    return [(f"c{c}", f"s{draw.randrange(strata)}", round(draw.gauss(0.3, 1), 3)) for c in range(clusters) for _ in range(draw.randint(1, 4))]


def macro(data):
    by = {}
    for _, s, x in data:
        by.setdefault(s, []).append(x)
    return sum(sum(v) / len(v) for v in by.values()) / len(by)


def test_flips_equal_enumeration(spark):
    data = {seed: rows(seed, n) for seed, n in ((1, 6), (2, 9), (3, 8), (4, 5))} | {5: [(f"c{i}", "s0", 1.0) for i in range(6)]}
    df = spark.createDataFrame([(k, *r) for k, own in data.items() for r in own] + [(1, "c0", "s0", None)], "k int, cluster string, stratum string, x double")
    got = {r.k: r for r in stratified.sign_flip(df, ["k"], "cluster", "stratum", "x").collect()}
    assert set(got) == {1, 2, 3, 5}
    for k, r in got.items():
        names = sorted({c for c, _, _ in data[k]})
        observed = abs(macro(data[k]))
        far = [abs(macro([(c, s, x * sign[names.index(c)]) for c, s, x in data[k]])) >= observed - 1e-9 for sign in itertools.product((1, -1), repeat=len(names))]
        assert r.exact and math.isclose(r.p, sum(far) / len(far)) and math.isclose(abs(r.observed), observed)
    sampled = stratified.sign_flip(df.filter("k = 2"), ["k"], "cluster", "stratum", "x", exact=4, draws=4000).first()
    assert not sampled.exact and abs(sampled.p - got[2].p) < 0.03


def test_bootstraps_agree_with_numpy(spark):
    data = [(f"c{c}", f"s{c % 2}", x) for c, (_, _, x) in enumerate(rows(7, 30)) if c < 40]
    df = spark.createDataFrame([(1, *r) for r in data], "k int, cluster string, stratum string, x double")
    strata = [np.array([x for _, s, x in data if s == name]) for name in ("s0", "s1")]
    rng = np.random.default_rng(1)
    draws = [[rng.choice(v, len(v)) for v in strata] for _ in range(4000)]
    means = np.array([np.mean([d.mean() for d in one]) for one in draws])
    errors = np.array([np.sqrt(sum(d.var(ddof=1) / len(d) for d in one)) / 2 for one in draws])
    mean, se = np.mean([v.mean() for v in strata]), np.sqrt(sum(v.var(ddof=1) / len(v) for v in strata)) / 2
    plain = stratified.bootstrap(df, ["k"], "cluster", "stratum", "x", False, draws=4000).first()
    t = stratified.bootstrap(df, ["k"], "cluster", "stratum", "x", True, draws=4000).first()
    assert math.isclose(plain["mean"], mean) and np.allclose([plain.low, plain.high], np.quantile(means, [0.025, 0.975]), atol=0.15 * se)
    q = np.quantile((means - mean) / errors, [0.975, 0.025])
    assert np.allclose([t.low, t.high], mean - q * se, atol=0.2 * se)


def test_too_few_clusters(spark):
    df = spark.createDataFrame([(1, "a", "s", 1.0), (1, "b", "s", 2.0)] + [(2, f"c{i}", "s" if i else "lone", float(i)) for i in range(8)] + [(3, f"c{i}", "s", 4.0) for i in range(6)], "k int, cluster string, stratum string, x double")
    got = {r.k: (r.low, r.high) for r in stratified.bootstrap(df, ["k"], "cluster", "stratum", "x", True, draws=50).collect()}
    assert got == {3: (4.0, 4.0)}


def test_rule_is_run(spark):
    even = [("even", f"c{i}", "s", 0.9 + 0.1 * (i % 3 == 0)) for i in range(12)]
    ruled = [("ruled", "big", "s", 0.5 + 0.01 * i) for i in range(10)] + [("ruled", f"c{i}", "s", 1.0) for i in range(12)]
    df = spark.createDataFrame(even + ruled, "k string, cluster string, stratum string, x double")
    got = {r.k: r for r in stratified.interval(df, ["k"], "cluster", "x", bounds=(0.0, 0.95)).collect()}
    assert (got["even"].method, got["ruled"].method) == ("cluster_t", "percentile") and math.isclose(got["ruled"].dominant, 10 / 22)
    own = stats.cluster_t(df.filter("k = 'even'"), ["k"], "cluster", "x").first()
    assert math.isclose(got["even"].low, own.low) and got["even"].high == 0.95 < own.high
    want = stratified.bootstrap(df.filter("k = 'ruled'"), ["k"], "cluster", None, "x", False).first()
    assert math.isclose(got["ruled"].low, want.low) and got["ruled"].high == min(0.95, want.high)
    strata = {r.k: r.method for r in stratified.interval(df, ["k"], "cluster", "x", "stratum").collect()}
    assert strata == {"even": "bootstrap_t", "ruled": "percentile"}
