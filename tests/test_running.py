"""Running sums over many ranges against plain adding up."""

import random

from tessera.operators.running import running_sums


def test_running_sums(spark):
    draw = random.Random(4)
    rows = [(float(t), draw.randint(-5, 9), draw.randint(0, 3), "x") for t in draw.sample(range(5000), 400)]
    df = spark.createDataFrame(rows, "t double, a long, b long, other string")
    for down in (False, True):
        a = b = 0
        want = []
        for t, x, y, _ in sorted(rows, reverse=down):
            a, b = a + x, b + y
            want.append((t, a, b, "x"))
        got = running_sums(df, "t", ["a", "b"], down)
        assert got.columns == df.columns and sorted(map(tuple, got.collect())) == sorted(want)
    assert running_sums(df.limit(0), "t", ["a"]).count() == 0
