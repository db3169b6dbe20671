"""Rates with undefined cases as null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(a: Column, b: Column) -> Column:
    """a / b; null where b is zero or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def recall(tp: Column, fn: Column) -> Column:
    return share(tp, tp + fn)


def precision(tp: Column, fp: Column) -> Column:
    return share(tp, tp + fp)


def f_beta(p: Column, r: Column, beta: float = 1.0, truth: Column | None = None) -> Column:
    """Weighted harmonic mean. Null without truth; 0 where there is truth and nothing was predicted."""
    b = beta * beta
    value = F.when(p + r == 0, F.lit(0.0)).otherwise(F.try_divide((1 + b) * p * r, b * p + r))
    if truth is None:
        return value
    return F.when(truth > 0, F.coalesce(value, F.lit(0.0)))


def mcc(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """Matthews correlation; null on a zero marginal."""
    tp, fp, fn, tn = (x.cast("double") for x in (tp, fp, fn, tn))
    below = (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)
    return F.when(below > 0, (tp * tn - fp * fn) / F.sqrt(below))


def wilson(c: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """Wilson interval of a proportion c of n."""
    n = n.cast("double")
    p = F.try_divide(c.cast("double"), n)
    mid = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return F.greatest(mid - half, F.lit(0.0)), F.least(mid + half, F.lit(1.0))


def newcombe(c1: Column, n1: Column, c2: Column, n2: Column) -> tuple[Column, Column, Column]:
    """Difference of two proportions with Newcombe's interval."""
    p1, p2 = share(c1, n1), share(c2, n2)
    (l1, u1), (l2, u2) = wilson(c1, n1), wilson(c2, n2)
    return p1 - p2, p1 - p2 - F.sqrt((p1 - l1) ** 2 + (u2 - p2) ** 2), p1 - p2 + F.sqrt((u1 - p1) ** 2 + (p2 - l2) ** 2)
