"""Centroid clustering of integer vectors: rounds of nearest centroids by the threshold algorithm, and componentwise exact means.

For each dimension the centroids lie in a list sorted by that component. A vector starts at its own value in every list and walks
outward, one centroid a round and list, the nearer side first; a centroid that is met for the first time has its whole distance
worked out. The squared distances of the lists' last steps add up to a bound below that of any centroid not yet met, and the walk
stops once it is strictly above the best distance, so that ties still go to the smaller number. A batch of vectors walks together.

Only centroids and their counts pass through the driver: k rows and, a round, k sums a component, whatever the table. Vectors are
read again each round; nothing is copied.

A vector without exactly ``size`` components, or with one that is null, NaN or infinite, is left out. Repeated rows each get a row
and count each. Vectors with a null vec_id start no cluster while there are others. Fewer vectors than k give as many centroids; an
empty table gives an empty result. Components beyond a long count as the nearest long; a distance or sum beyond a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, ship

#: Components up to here have squared distances that fit a long in 64 dimensions and more (2 ** 55 a component).
PLAIN = 1 << 26
_LONG = (1 << 63) - 1


def integers(table: DataFrame, size: int = 64, scale: int = 256) -> DataFrame:
    """vec_id and v, the components times scale rounded down, of the vectors that are whole."""
    limit = F.lit(float("inf"))
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    kept = table.select("vec_id", "embedding").filter((F.size("embedding") == size) & whole)
    return kept.select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"))


def first_centroids(vectors: DataFrame, k: int = 40, seed: int = 2) -> list[list[int]]:
    """The k vectors whose keyed id hashes are smallest, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [r["v"] for r in vectors.withColumn("h", order).orderBy(F.asc_nulls_last("h"), "v").limit(k).select("v").collect()]


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row, ties to the smaller one, and the squared distance to it."""
    n, k = len(x), len(centroids)
    dims = np.arange(x.shape[1])
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, axis=0)
    up = np.stack([np.searchsorted(lists[:, d], x[:, d]) for d in dims], axis=1) if n else np.zeros(x.shape, np.int64)
    down = up - 1
    best, which, met = np.zeros(n, x.dtype), np.full(n, k), np.zeros((n, k), bool)
    going = np.arange(n)
    while len(going):
        own, lo, hi = x[going], down[going], up[going]
        far_down, far_up = own - lists[np.maximum(lo, 0), dims], lists[np.minimum(hi, k - 1), dims] - own
        lower = (hi >= k) | (lo >= 0) & (far_down <= far_up)
        entry = np.where(lower, order[np.maximum(lo, 0), dims], order[np.minimum(hi, k - 1), dims])
        frontier = np.where(lower, far_down, far_up)
        down[going], up[going] = lo - lower, hi + ~lower
        new = np.zeros((len(going), k), bool)
        new[np.arange(len(going))[:, None], entry] = True
        new &= ~met[going]
        met[going] |= new
        for c in np.flatnonzero(new.any(axis=0)).tolist():
            rows = np.flatnonzero(new[:, c])
            distance = ((own[rows] - centroids[c]) ** 2).sum(axis=1)
            at = going[rows]
            closer = (which[at] == k) | (distance < best[at]) | (distance == best[at]) & (c < which[at])
            best[at[closer]], which[at[closer]] = distance[closer], c
        stop = ((frontier**2).sum(axis=1) > best[going]) | met[going].all(axis=1)
        going = going[~stop.astype(bool)]
    return which, best


def _rows(batch: pa.RecordBatch, size: int, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The batch's vectors and the centroids, as Python's own numbers where a long might not do."""
    v = batch.column("v")
    x = v.flatten().to_numpy().reshape(-1, size)
    c = np.array(centroids, np.int64).reshape(-1, size)
    plain = all(not len(y) or (-PLAIN <= y.min() and y.max() <= PLAIN) for y in (x, c))
    return (x, c) if plain else (x.astype(object), c.astype(object))


def means(vectors: DataFrame, centroids: list[list[int]], size: int = 64, at_once: int = 2048) -> list[list[int]]:
    """Each centroid moved to its vectors' componentwise mean, rounded down; one without vectors stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), size), object)
        for batch in batches:
            for first in range(0, batch.num_rows, at_once):
                x, c = _rows(batch.slice(first, at_once), size, centroids)
                which, _ = nearest(x, c)
                order = np.argsort(which, kind="stable")
                used, starts = np.unique(which[order], return_index=True)
                total[used] += np.add.reduceat(x[order], starts, axis=0).astype(object)
                count += np.bincount(which, minlength=len(centroids))
        on = np.flatnonzero(count).tolist()
        rows = [(c, d, Decimal(int(total[c, d])), int(count[c])) for c in on for d in range(size)]
        yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64()))], ["cluster", "d", "total", "n"])

    sums = vectors.select("v").mapInArrow(run, "cluster int, d int, total decimal(38, 0), n long").groupBy("cluster", "d")
    out = [list(c) for c in centroids]
    for r in sums.agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # k rows a dimension at most
        out[r["cluster"]][r["d"]] = int(r["total"]) // r["n"]
    return out


def assign(vectors: DataFrame, centroids: list[list[int]], size: int = 64, at_once: int = 2048) -> DataFrame:
    """vec_id, cluster, distance (squared) of each vector."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, at_once):
                part = batch.slice(first, at_once)
                which, best = nearest(*_rows(part, size, centroids))
                best = pa.array([int(b) if b <= _LONG else None for b in best] if best.dtype == object else best, pa.int64())
                yield pa.record_batch([part.column("vec_id"), pa.array(which, pa.int32()), best], ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def cluster(table: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: int = 2) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and the digest of its centroid, for each whole vector."""
    spark = table.sparkSession
    ship(spark)
    vectors = integers(table, size, scale)
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds):
        centroids = means(vectors, centroids, size)
    found = cut(assign(vectors, centroids, size))
    whole = F.count("*") == F.count("distance")
    sums = found.groupBy("cluster").agg(F.when(whole, F.sum(F.col("distance").cast("decimal(38, 0)"))).alias("s")).collect()  # k rows at most
    of_all = None if any(r["s"] is None for r in sums) else sum(int(r["s"]) for r in sums)
    long = lambda x: None if x is None or x > _LONG else int(x)
    rows = [(r["cluster"], long(r["s"]), long(of_all), hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()) for r in sums]
    each = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def sql(k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: int = 2) -> str:
    """The same rows in DuckDB's SQL, one block of CTEs a round."""
    ctes = [
        f"x as (select row_number() over () r, vec_id, list_transform(embedding, lambda e: floor({scale}.0::double * e::double)::bigint) v from embeddings"
        f" where len(embedding) = {size} and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = {size})",
        f"c0 as (select (row_number() over (order by sha256('{seed}:' || vec_id::varchar) nulls last, v) - 1)::int c, v from x qualify c < {k})",
    ]
    for i in range(rounds + 1):
        ctes.append(
            f"n{i} as (select r, arg_min(c, (d, c)) c, min(d) d from (select x.r, c{i}.c, list_sum(list_transform(list_zip(x.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint d from x, c{i}) group by r)"
        )
        if i < rounds:
            ctes.append(
                f"s{i} as (select c, d, sum(e)::hugeint s, count(*) n from (select n{i}.c, unnest(x.v) e, unnest(range({size})) d from x join n{i} using (r)) group by c, d),"
                f" m{i} as (select c, list(((s - ((s % n) + n) % n) / n)::bigint order by d) v from s{i} group by c),"
                f" c{i + 1} as (select c{i}.c, coalesce(m{i}.v, c{i}.v) v from c{i} left join m{i} using (c))"
            )
    last = f"n{rounds}"
    return (
        f"with {', '.join(ctes)} select x.vec_id, {last}.c::int as cluster, {last}.d as distance, (sum({last}.d) over (partition by {last}.c))::bigint as cluster_inertia,"
        f" (sum({last}.d) over ())::bigint as inertia, sha256(array_to_string(c{rounds}.v, ',')) as centroid_sha256 from x join {last} using (r) join c{rounds} using (c)"
    )
