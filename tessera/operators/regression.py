"""Linear models from sums: Spark adds up products of features per cluster, and what is left to solve is as small as the clusters are few.

Rows: keys, cluster, features and a target y, all numbers; rows with a null among them stay out.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.lineage import ship
from tessera.operators.stats import t_quantile


def one_hot(df: DataFrame, column: str, levels: list) -> tuple[DataFrame, list[str]]:
    """df with a 0/1 column for each level but the first, which the intercept stands for; other values have none."""
    names = [f"{column}_{x}" for x in levels[1:]]
    return df.withColumns({name: (F.col(column).eqNullSafe(F.lit(x))).cast("double") for name, x in zip(names, levels[1:], strict=True)}), names


def product_sums(rows: DataFrame, keys: list[str], cluster: str, features: list[str], y: str) -> DataFrame:
    """keys, cluster, sums: the upper triangle of the products of (1, features, y), summed."""
    names = ["_one", *features, y]
    rows = rows.dropna(subset=[*features, y]).withColumn("_one", F.lit(1.0))
    sums = F.array(*(F.sum(F.col(a).cast("double") * F.col(b)) for k, a in enumerate(names) for b in names[k:]))
    return rows.groupBy(*keys, cluster).agg(sums.alias("sums"))


def _matrix(sums: np.ndarray, size: int) -> np.ndarray:
    m = np.zeros((size, size))
    m[np.triu_indices(size)] = sums
    return m + np.triu(m, 1).T


def clustered_fit(pdf: pd.DataFrame, features: list[str], draws: int = 200, seed: int = 4) -> list[tuple]:
    """(term, estimate, low, high, sign_stability, supported, delta_r2, r2, n, clusters) of each feature, from a key's cluster sums."""
    size = len(features) + 2
    parts = np.array([_matrix(np.asarray(x), size) for x in pdf.sort_values("cluster").sums])
    whole, g = parts.sum(0), len(parts)
    xx, xy, yy, n = whole[:-1, :-1], whole[:-1, -1], whole[-1, -1], whole[0, 0]
    p = size - 1
    if g < 3 or n <= p or np.linalg.matrix_rank(xx) < p:
        return []
    beta = np.linalg.solve(xx, xy)
    spread = yy - whole[0, -1] ** 2 / n

    def r2(keep: list[int]) -> float:
        b = np.linalg.lstsq(xx[np.ix_(keep, keep)], xy[keep], rcond=None)[0]
        return 1 - (yy - 2 * b @ xy[keep] + b @ xx[np.ix_(keep, keep)] @ b) / spread if spread > 0 else float("nan")

    score = parts[:, :-1, -1] - parts[:, :-1, :-1] @ beta  # each cluster's sum of x times residual
    inverse = np.linalg.inv(xx)
    se = np.sqrt(np.diag(inverse @ (score.T @ score) @ inverse) * g / (g - 1) * (n - 1) / (n - p))
    t95, t_all = t_quantile(0.975, g - 1), t_quantile(1 - 0.025 / len(features), g - 1)
    rng = np.random.default_rng(seed)
    same, fits = np.zeros(p), 0
    for _ in range(draws):
        m = parts[rng.integers(0, g, g)].sum(0)
        if np.linalg.matrix_rank(m[:-1, :-1]) == p:
            same += np.sign(np.linalg.solve(m[:-1, :-1], m[:-1, -1])) == np.sign(beta)
            fits += 1
    full = r2(list(range(p)))
    out = []
    for k, name in enumerate(features, 1):
        stable = same[k] / fits if fits else None
        supported = bool(abs(beta[k]) > t_all * se[k] and (stable is None or stable >= 0.9))
        out.append((name, beta[k], beta[k] - t95 * se[k], beta[k] + t95 * se[k], stable, supported, full - r2([i for i in range(p) if i != k]), full, int(n), g))
    return out


def clustered_regression(rows: DataFrame, keys: list[str], cluster: str, features: list[str], y: str) -> DataFrame:
    """Per key and feature: estimate, CR1 interval over clusters, how often resampled clusters give its sign, what R2 loses without it. Keys that can't be estimated have no rows."""
    ship(rows.sparkSession)
    sums = product_sums(rows, keys, cluster, features, y).withColumnRenamed(cluster, "cluster")
    kinds = ", ".join(f"{c} {t}" for c, t in sums.select(*keys).dtypes)
    columns = ["term", "estimate", "low", "high", "sign_stability", "supported", "delta_r2", "r2", "n", "clusters"]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(clustered_fit(pdf, features), columns=columns)
        for c in reversed(keys):
            out.insert(0, c, pdf[c].iloc[0])
        return out

    kind = "term string, estimate double, low double, high double, sign_stability double, supported boolean, delta_r2 double, r2 double, n long, clusters long"
    return sums.groupBy(*keys).applyInPandas(solve, f"{kinds}, {kind}")


def ridge_coefficients(m: np.ndarray, penalty: float) -> np.ndarray:
    """Intercept and slopes, on the features' own scale, of a ridge on standardised features; the intercept isn't penalised."""
    n, sx, sy = m[0, 0], m[0, 1:-1], m[0, -1]
    mean = sx / n
    sd = np.sqrt(np.maximum(np.diag(m)[1:-1] / n - mean**2, 0.0))
    sd = np.where(sd > 1e-12, sd, 1.0)
    zz = (m[1:-1, 1:-1] - n * np.outer(mean, mean)) / np.outer(sd, sd)
    zy = (m[1:-1, -1] - mean * sy) / sd
    b = np.linalg.solve(zz + penalty * np.eye(len(sd)), zy) / sd
    return np.r_[sy / n - b @ mean, b]


def ridge_by_study(rows: DataFrame, keys: list[str], study: str, features: list[str], y: str, penalties: tuple[float, ...] = (0.01, 0.1, 1.0, 10.0)) -> DataFrame:
    """Per key: the penalty of least absolute error on studies left out, that error, the same of a nested choice and of the mean alone, calibration and coefficients.

    In the nested error a study's penalty is chosen without it, on further studies left out. Coefficients of every fold come from sums;
    predictions and their errors are joins and averages in Spark. Keys of fewer than three studies have no nested error.
    """
    ship(rows.sparkSession)
    size = len(features) + 2
    rows = rows.dropna(subset=[*features, y]).select(*keys, F.col(study).cast("string").alias("study"), *features, F.col(y).cast("double").alias("y"))
    sums = product_sums(rows, keys, "study", features, "y")
    kinds = ", ".join(f"{c} {t}" for c, t in sums.select(*keys).dtypes)

    def folds(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = {s: _matrix(np.asarray(x), size) for s, x in zip(pdf.study, pdf.sums, strict=True)}
        whole, out = sum(parts.values()), []
        for a, b in itertools.product([None, *parts], [None, *parts]):  # a is kept out of the choice, b is predicted
            if a is not None and a == b:
                continue
            m = whole - sum(parts[s] for s in {a, b} if s is not None)
            if m[0, 0] < 2:
                continue
            for penalty in penalties:
                c = ridge_coefficients(m, penalty)
                fit = m[-1, -1] - 2 * c @ m[:-1, -1] + c @ m[:-1, :-1] @ c
                out.append((a, b, penalty, c.tolist(), m[0, -1] / m[0, 0], float(np.sqrt(max(fit, 0.0) / m[0, 0]))))
        out = pd.DataFrame(out, columns=["apart", "held", "penalty", "coefficients", "mean", "sd"])
        for c in reversed(keys):
            out.insert(0, c, pdf[c].iloc[0])
        return out

    fold = sums.groupBy(*keys).applyInPandas(folds, f"{kinds}, apart string, held string, penalty double, coefficients array<double>, mean double, sd double")
    x = F.array(F.lit(1.0), *(F.col(c).cast("double") for c in features))
    told = rows.withColumn("x", x).withColumnRenamed("study", "held").join(fold.filter("held is not null"), [*keys, "held"])
    predicted: Column = F.aggregate(F.zip_with("x", "coefficients", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    told = told.select(*keys, "apart", "held", "penalty", "y", "mean", "sd", predicted.alias("p"))
    errors = told.groupBy(*keys, "apart", "penalty").agg(F.avg(F.abs(F.col("y") - F.col("p"))).alias("error"))
    best = errors.withColumn("k", F.row_number().over(Window.partitionBy(*keys, "apart").orderBy(F.round("error", 12), "penalty"))).filter("k = 1").drop("k")
    final = best.filter("apart is null").select(*keys, "penalty", F.col("error").alias("held_out_error"))
    inner = best.filter("apart is not null").select(*keys, F.col("apart").alias("held"), "penalty")
    alone = told.filter("apart is null")
    nested = alone.join(inner, [*keys, "held", "penalty"]).groupBy(*keys).agg(F.avg(F.abs(F.col("y") - F.col("p"))).alias("nested_error"), F.avg(F.abs(F.col("y") - F.col("mean"))).alias("baseline_error"))
    chosen = alone.join(final.select(*keys, "penalty"), [*keys, "penalty"])
    calibration = chosen.groupBy(*keys).agg(F.count("*").alias("n"), F.regr_slope("y", "p").alias("slope"), F.regr_intercept("y", "p").alias("intercept"), F.avg((F.abs(F.col("y") - F.col("p")) <= 1.6449 * F.col("sd")).cast("double")).alias("coverage"))
    whole = fold.filter("apart is null and held is null").select(*keys, "penalty", "coefficients")
    return final.join(nested, keys, "left").join(calibration, keys).join(whole, [*keys, "penalty"])
