"""Neighbours with missing features against all pairs, on random tables with nulls, ties and copies."""

import math
import random

import pytest

from tessera.operators import neighbours


def brute(rows, k, penalty):
    def d(a, b):
        both = [(x - y) ** 2 for x, y in zip(a, b) if x is not None and y is not None]
        one = sum((x is None) != (y is None) for x, y in zip(a, b)) if penalty else 0
        return math.sqrt((sum(both) + one * penalty**2) / (len(both) + one)) if len(both) >= 2 else None

    out = {}
    for i, a in rows:
        near = sorted((round(x, 9), j) for j, b in rows if j != i and (x := d(a, b)) is not None)[:k]
        out |= {(i, n): (j, x) for n, (x, j) in enumerate(near, 1)}
    return out


@pytest.mark.parametrize("penalty, block", [(1.0, 2048), (1.0, 8), (0.0, 8), (2.5, 8)])
def test_nearest_is_exact(spark, monkeypatch, penalty, block):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    draw = random.Random(block)
    rows = [(i, [None if draw.random() < 0.3 else round(draw.gauss(0, 1), 1) for _ in range(4)]) for i in range(250)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(60)] + [(2000, [None] * 4), (2001, [1.0, None, None, None]), (2002, [50.0, 50.0, None, None])]
    df = spark.createDataFrame(rows, "id long, z array<double>")
    got = {(r.query, r.place): (r.id, round(r.distance, 9)) for r in neighbours.nearest(df, df, 4, penalty).collect()}
    want = brute(rows, 4, penalty)
    assert got.keys() == want.keys() and all(got[x][0] == want[x][0] and math.isclose(got[x][1], want[x][1], abs_tol=2e-9) for x in want)
    assert neighbours.nearest(df.limit(0), df.limit(0), 4).count() == 0


def test_quantiles_are_exact(spark):
    draw = random.Random(3)
    rows = [(g, draw.choice([1.0, 2.0, draw.random()])) for g in ["a", "b", None] for _ in range(draw.randint(1, 99))] + [("a", None), ("only", 4.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    for q in (0.0, 0.5, 0.95, 1.0):
        for r in neighbours.quantiles(df, ["g"], "x", q).collect():
            own = sorted(x for g, x in rows if g == r.g and x is not None)
            at = q * (len(own) - 1)
            want = own[math.floor(at)] + (own[math.ceil(at)] - own[math.floor(at)]) * (at - math.floor(at))
            assert math.isclose(r["at"], want, rel_tol=1e-12)


def test_threshold_needs_five(spark):
    df = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(4)], "id long, z array<double>")
    assert neighbours.range_threshold(df).first()["threshold"] is None
    df = spark.createDataFrame([(i, [float(i * i), 0.0]) for i in range(6)], "id long, z array<double>")
    assert math.isclose(neighbours.range_threshold(df, q=1.0).first()["threshold"], 9 / math.sqrt(2))


def test_only_near_rows_leave_a_block(spark, monkeypatch):
    """Pairs are measured in their block; before, each pair of a query and a visited row was a row of a join."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 8)
    draw = random.Random(5)
    df = spark.createDataFrame([(i, [draw.random() for _ in range(4)]) for i in range(400)], "id long, z array<double>")
    plan = neighbours.nearest(df, df, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Join" not in plan.split("FlatMapCoGroupsInArrow")[0]


@pytest.mark.parametrize("within", [None, "pool"])
def test_block_and_queries_meet_in_any_partition(spark, monkeypatch, within):
    """Both sides' keys are of the same types, so they hash alike: merged into one partition, other types would go unseen."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 8)
    draw = random.Random(11)
    rows = [(i, [None if draw.random() < 0.2 else draw.gauss(0, 1) for _ in range(4)], "one") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, z array<double>, pool string")
    merged = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.query, r.place): r.id for r in neighbours.nearest(df, df, 3, within=within).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merged)
    assert got == {x: i for x, (i, _) in brute([r[:2] for r in rows], 3, 1.0).items()}
