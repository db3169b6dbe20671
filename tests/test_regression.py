"""Models from sums against the same fitted on whole matrices."""

import numpy as np
import pytest

from tessera.operators import regression


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    study = rng.integers(0, 7, 120)
    x = rng.normal(size=(120, 3)) * [1, 10, 0.1]
    y = 0.5 + 2 * x[:, 0] - 0.1 * x[:, 1] + rng.normal(size=7)[study] * 0.3 + rng.normal(size=120) * 0.5
    return study, x, y


def frame(spark, data, key="k"):
    study, x, y = data
    return spark.createDataFrame([(key, int(s), *map(float, a), float(b)) for s, a, b in zip(study, x, y, strict=True)], "key string, study long, a double, b double, c double, y double")


def test_clustered_regression(spark, data):
    study, x, y = data
    few = frame(spark, (np.array([1, 1, 2]), x[:3], y[:3]), "few")
    out = {r.term: r for r in regression.clustered_regression(frame(spark, data).union(few), ["key"], "study", ["a", "b", "c"], "y").collect()}
    z = np.c_[np.ones(120), x]
    beta = np.linalg.lstsq(z, y, rcond=None)[0]
    res = y - z @ beta
    bread = np.linalg.inv(z.T @ z)
    meat = sum(np.outer(s, s) for s in (z[study == g].T @ res[study == g] for g in range(7)))
    se = np.sqrt(np.diag(bread @ meat @ bread) * 7 / 6 * 119 / 116)
    r2 = 1 - res @ res / ((y - y.mean()) ** 2).sum()
    for k, name in enumerate("abc", 1):
        r = out[name]
        assert r.key == "k" and r.estimate == pytest.approx(beta[k]) and (r.high - r.low) / 2 == pytest.approx(2.446912 * se[k], rel=1e-4) and r.r2 == pytest.approx(r2)
        part = np.delete(z, k, 1)
        lost = y - part @ np.linalg.lstsq(part, y, rcond=None)[0]
        assert r.delta_r2 == pytest.approx(r2 - 1 + lost @ lost / ((y - y.mean()) ** 2).sum())
    assert out["a"].supported and out["a"].sign_stability == 1 and not out["c"].supported


def ridge(x, y, penalty):
    mean, sd = x.mean(0), x.std(0)
    z = (x - mean) / sd
    b = np.linalg.solve(z.T @ z + penalty * np.eye(x.shape[1]), z.T @ (y - y.mean())) / sd
    return lambda new: y.mean() + (new - mean) @ b


def test_ridge_by_study(spark, data):
    study, x, y = data
    grid = (0.01, 0.1, 1.0, 10.0)

    def choose(rows):
        def error(p):
            return np.mean(np.concatenate([np.abs(y[rows & (study == s)] - ridge(x[rows & (study != s)], y[rows & (study != s)], p)(x[rows & (study == s)])) for s in set(study[rows])]))

        return min(grid, key=lambda p: (round(error(p), 12), p)), min(map(error, grid))

    penalty, error = choose(np.ones(120, bool))
    nested, base = [], []
    for s in range(7):
        train = study != s
        p, _ = choose(train)
        nested.append(np.abs(y[~train] - ridge(x[train], y[train], p)(x[~train])))
        base.append(np.abs(y[~train] - y[train].mean()))
    r = regression.ridge_by_study(frame(spark, data), ["key"], "study", ["a", "b", "c"], "y", grid).first()
    assert r.penalty == penalty and r.held_out_error == pytest.approx(error) and r.nested_error == pytest.approx(np.mean(np.concatenate(nested))) and r.baseline_error == pytest.approx(np.mean(np.concatenate(base)))
    whole = ridge(x, y, penalty)
    assert np.allclose(np.c_[np.ones(5), x[:5]] @ np.array(r.coefficients), whole(x[:5])) and 0.6 < r.slope < 1.4 and 0.5 < r.coverage <= 1 and r.n == 120


def test_one_hot(spark):
    df, names = regression.one_hot(spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "s string"), "s", ["x", "y", "z"])
    assert names == ["s_y", "s_z"] and [(r.s_y, r.s_z) for r in df.collect()] == [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]
