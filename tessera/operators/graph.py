"""Components, one-to-one matching and clustering over edge tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.lineage import cut, ship


def connected_components(edges: DataFrame, nodes: DataFrame | None = None, rounds: int = 100) -> DataFrame:
    """node, component (the smallest reachable node) of the undirected edges (a, b), by large and small stars; nodes adds lonely ones."""
    found = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    before = None
    for _ in range(rounds):
        state = found.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if state == before or not state[0]:
            break
        before = state
        both = found.select(F.col("a").alias("u"), F.col("b").alias("v")).union(found.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).union(low.select("m", "u"))
        found = cut(small.filter("a < b").distinct())
    else:
        raise RuntimeError(f"components are not settled after {rounds} rounds")
    every = edges.select(F.col("a").alias("node")).union(edges.select("b"))
    every = (every.union(nodes.select("node")) if nodes is not None else every).distinct()
    label = found.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    return every.join(label, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def assignment(weight: np.ndarray) -> list[tuple[int, int]]:
    """Rows and columns of greatest total weight, one to one (shortest augmenting paths over potentials)."""
    flip = weight.shape[0] > weight.shape[1]
    cost = -(weight.T if flip else weight).astype(float)
    n, m = cost.shape
    u, v, owner = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        owner[0], j = i, 0
        least, back, seen = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while owner[j]:
            seen[j] = True
            row = owner[j]
            reduced = cost[row - 1] - u[row] - v[1:]
            better = ~seen[1:] & (reduced < least[1:])
            least[1:][better], back[1:][better] = reduced[better], j
            free = np.where(seen[1:], np.inf, least[1:])
            nxt = int(free.argmin()) + 1
            step = free[nxt - 1]
            u[owner[seen]] += step
            v[seen] -= step
            least[~seen] -= step
            j = nxt
        while j:
            owner[j] = owner[back[j]]
            j = back[j]
    pairs = [(owner[j] - 1, j - 1) for j in range(1, m + 1) if owner[j]]
    return [(b, a) for a, b in pairs] if flip else pairs


def best_matching(edges: DataFrame, keys: list[str]) -> DataFrame:
    """keys, left, right, weight of a one-to-one matching of greatest total weight in each key's edges (left, right, weight).

    Lonely components of one edge need no solver; the rest are solved component by component, so a task holds one
    component at a time. left and right are longs.
    """
    ship(edges.sparkSession)
    edges = cut(edges.filter("weight > 0"))
    node = F.xxhash64(*keys, F.lit(0), "left").alias("a"), F.xxhash64(*keys, F.lit(1), "right").alias("b")
    labelled = edges.select("*", *node)
    parts = connected_components(labelled.select("a", "b"))
    labelled = labelled.join(parts.withColumnRenamed("node", "a"), "a").drop("a", "b")
    schema = edges.select(*keys, "left", "right", "weight").schema

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["left", "right"])
        rows, cols = np.unique(pdf.left), np.unique(pdf.right)
        w = np.zeros((len(rows), len(cols)))
        w[np.searchsorted(rows, pdf.left), np.searchsorted(cols, pdf.right)] = pdf.weight
        kept = pd.DataFrame([(rows[i], cols[j]) for i, j in assignment(w) if w[i, j] > 0], columns=["left", "right"])
        return pdf.merge(kept, on=["left", "right"])[[f.name for f in schema]]

    return labelled.groupBy(*keys, "component").applyInPandas(solve, schema)
