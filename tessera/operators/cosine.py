"""Nearest rows by cosine: all pairs, block by block, as products of matrices with an exact check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.lineage import ship

#: Rows and queries of a pair of blocks, queries that are multiplied at a time, and what rounding to single precision may change of a cosine for each component.
ROWS, QUERIES, STEP, SLACK = 1 << 16, 1 << 14, 128, 5e-7


def exact(x: np.ndarray, y: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows: products in the vectors' own precision, added up in order as doubles."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += (x[:, d] * y[:, d]).astype(np.float64)
    return total / norms


def first_of_copies(x: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows without those that have k copies of a smaller id: these come before them for any query."""
    raw = np.ascontiguousarray(x).view(np.dtype((np.void, x.shape[1] * x.itemsize))).ravel()
    _, kind = np.unique(raw, return_inverse=True)
    order = np.lexsort([ids, kind])
    head = np.flatnonzero(np.r_[True, kind[order][1:] != kind[order][:-1]])
    rank = np.arange(len(order)) - np.repeat(head, np.diff(np.r_[head, len(order)]))
    return order[rank < k]


def block_nearest(q: np.ndarray, q_ids: np.ndarray, q_norm: np.ndarray, x: np.ndarray, ids: np.ndarray, norm: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in q and x, and cosines, of the k nearest rows of x for each query: single precision names all that can be, and these are computed exactly."""
    kept = first_of_copies(x, ids, k + 1)
    x, ids, norm = x[kept], ids[kept], norm[kept]
    slack = 2 * SLACK * x.shape[1]
    with np.errstate(all="ignore"):
        near, far = (q / q_norm[:, None]).astype(np.float32), np.ascontiguousarray((x / norm[:, None]).astype(np.float32).T)
    for a in range(0, len(q), STEP):
        with np.errstate(all="ignore"):
            score = near[a : a + STEP] @ far
        for j in np.flatnonzero(np.isin(ids, q_ids[a : a + STEP])):
            score[q_ids[a : a + STEP] == ids[j], j] = -np.inf
        score[np.isnan(score)] = np.inf
        last = max(0, score.shape[1] - k)
        limit = np.partition(score, last, axis=1)[:, last]
        i, j = np.nonzero((score >= (limit - slack)[:, None]) & (score > -np.inf))
        with np.errstate(all="ignore"):
            cosine = exact(q[a + i], x[j], norm[j] * q_norm[a + i])
        order = np.lexsort([ids[j], -np.where(np.isnan(cosine), np.inf, cosine), i])
        i, j, cosine = i[order], j[order], cosine[order]
        head = np.flatnonzero(np.r_[len(i) > 0, i[1:] != i[:-1]])
        rank = np.arange(len(i)) - np.repeat(head, np.diff(np.r_[head, len(i)]))
        yield a + i[rank < k], kept[j[rank < k]], cosine[rank < k]


def nearest(rows: DataFrame, asked: str, k: int) -> DataFrame:
    """query, id, place, cosine: the k rows nearest to each row that meets the condition asked, itself left out, equal ones by id. rows: id and x.

    All pairs are compared, so the work is queries times rows. Rows and queries are dealt into blocks, and a task has a pair of blocks. Pairs without a
    cosine (vectors of other lengths, of norm 0, or with a missing component) are no neighbours.
    """
    ship(rows.sparkSession)
    dot = F.aggregate(F.transform("x", lambda v: (v * v).cast("double")), F.lit(0.0), lambda s, v: s + v)
    rows = rows.filter("x is not null").withColumn("norm", F.sqrt(dot)).filter("norm > 0").withColumn("size", F.size("x"))
    n = rows.agg(F.count("*").alias("n"), F.count_if(F.expr(asked)).alias("q")).first()
    blocks, chunks = max(1, -(-n["q"] // QUERIES)), max(1, -(-n["n"] // ROWS))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    queries = rows.filter(asked).withColumns({"block": F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"), "chunk": every(chunks)})
    spread = rows.withColumns({"block": every(blocks), "chunk": F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")})
    kind = dict(rows.dtypes)["id"]

    def meet(q: pa.Table, x: pa.Table) -> pa.Table:
        found = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
        if len(q) and len(x):
            flat = lambda t: t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)
            value = lambda t, c: t.column(c).to_numpy()
            found += block_nearest(flat(q), value(q, "id"), value(q, "norm"), flat(x), value(x, "id"), value(x, "norm"), k)
        else:
            return pa.table([pa.array([], (q if len(q) else x).column("id").type)] * 2 + [pa.array([], pa.float64())], ["query", "id", "cosine"])
        i, j, cosine = (np.concatenate(c) for c in zip(*found))
        return pa.table([q.column("id").take(pa.array(i)), x.column("id").take(pa.array(j)), pa.array(cosine)], ["query", "id", "cosine"])

    at = ["size", "block", "chunk"]
    near = queries.groupBy(*at).cogroup(spread.groupBy(*at)).applyInArrow(meet, f"query {kind}, id {kind}, cosine double")
    w = Window.partitionBy("query").orderBy(F.desc("cosine"), "id")
    return near.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).select("query", "id", "place", "cosine")
