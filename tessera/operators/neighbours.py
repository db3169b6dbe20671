"""Nearest neighbours of rows with missing features, exactly, and what is decided by them.

Features are scaled by their centre and spread. Two rows' distance is the root mean square of the differences of the features that both
have, where a feature that one of them lacks counts as a difference of ``penalty``; rows that share fewer than two have none.

A row's block is the set of features that it has and its place in a grid over the four that most rows have. What two sets share is known
beforehand, so a block's box gives a lower bound of the distance to all its rows. A query's own block gives an upper bound of its k-th
distance; only blocks below it are visited. Blocks hold about as many rows at any size of table, so a query meets about as many pairs, and
those are measured where block and queries meet: only each block's nearest rows leave it. Equal rows are one row of the index with the
k + 1 smallest of their ids, so copies make no pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.lineage import cut, ship

#: Rows of a block that the grid aims at, its dimensions, its most bins a dimension, and queries and pairs that are measured at a time.
BLOCK_ROWS, DIMS, MOST_BINS, QUERIES, PAIRS = 256, 4, 512, 4096, 1 << 18


def quantiles(rows: DataFrame, group: list[str], value: str, q: float) -> DataFrame:
    """The groups and ``at``, the exact q-quantile of each by linear interpolation: values are ranked by range, no task holds a group. Null values don't count."""
    ranged = rows.filter(F.col(value).isNotNull()).select(*group, value).repartitionByRange(*group, value)
    ranged = cut(ranged.withColumn("part_", F.spark_partition_id()))
    parts = ranged.groupBy(*group, "part_").agg(F.count("*").alias("n_"))
    own = Window.partitionBy(*group)
    before = F.coalesce(F.sum("n_").over(own.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.withColumns({"before_": before, "all_": F.sum("n_").over(own)}).withColumn("want_", F.lit(q) * (F.col("all_") - 1))
    parts = parts.filter((F.col("before_") <= F.ceil("want_")) & (F.floor("want_") < F.col("before_") + F.col("n_")))
    same = [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in group] + [F.col("l.part_") == F.col("r.part_")]
    found = ranged.alias("l").join(parts.alias("r"), same).select(*(f"l.{g}" for g in group), f"l.{value}", "l.part_", "before_", "want_")
    rank = F.col("before_") + F.row_number().over(Window.partitionBy(*group, "part_").orderBy(value)) - 1
    found = found.withColumn("rank_", rank).filter("rank_ between floor(want_) and ceil(want_)")
    low, high = F.min(value), F.max(value)
    return found.groupBy(*group).agg((low + (high - low) * (F.max("want_") - F.floor(F.max("want_")))).alias("at"))


def scales(rows: DataFrame, features: list[str], by: list[str] | None = None, robust: bool = True) -> DataFrame:
    """by, feature, centre, spread of each feature with two values and a spread: median and 1.4826 times the median deviation from it (the standard deviation where that is 0), or mean and standard deviation."""
    by = by or []
    long = rows.select(*by, F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features))).alias("v")).select(*by, "v.*").filter("x is not null")
    long = cut(long)
    out = long.groupBy(*by, "feature").agg(F.count("*").alias("n"), F.avg("x").alias("centre"), F.stddev_pop("x").alias("spread"))
    if robust:
        middle = quantiles(long, [*by, "feature"], "x", 0.5).withColumnRenamed("at", "middle")
        away = long.join(middle, [*by, "feature"]).withColumn("away", F.abs(F.col("x") - F.col("middle")))
        mad = quantiles(away, [*by, "feature"], "away", 0.5)
        out = out.join(middle, [*by, "feature"]).join(mad, [*by, "feature"])
        out = out.withColumns({"centre": F.col("middle"), "spread": F.when(F.col("at") > 0, 1.4826 * F.col("at")).otherwise(F.col("spread"))})
    return out.filter("n >= 2 and spread > 0").select(*by, "feature", "centre", "spread")


def standardised(rows: DataFrame, features: list[str], scale: dict[str, tuple[float, float]]) -> Column:
    """The scaled features that have a scale, as an array; null where a row has none."""
    return F.array(*((F.col(f).cast("double") - scale[f][0]) / scale[f][1] for f in features if f in scale))


def had(z: Column) -> Column:
    """The features of an array that aren't null, as bits."""
    return F.aggregate(F.transform(z, lambda x, i: F.when(x.isNotNull(), F.expr("1L")).otherwise(F.lit(0)) * F.pow(F.lit(2.0), i).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)


def distance(x: Column, y: Column, penalty: float = 1.0) -> Column:
    """Null where the two share fewer than two features."""
    square = F.filter(F.zip_with(x, y, lambda a, b: (a - b) * (a - b)), lambda d: d.isNotNull())
    one_sided = F.size(F.filter(F.zip_with(x, y, lambda a, b: a.isNull() != b.isNull()), lambda d: d)) if penalty else F.lit(0)
    total = F.aggregate(square, F.lit(0.0), lambda s, d: s + d) + one_sided * F.lit(float(penalty) ** 2)
    return F.when(F.size(square) >= 2, F.sqrt(total / (F.size(square) + one_sided)))


def _matrix(column: pa.ChunkedArray, wide: int) -> np.ndarray:
    """A list column as rows of numbers, nan for null."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, wide)


def closest(q: np.ndarray, z: np.ndarray, k: int, penalty: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in q and z of the pairs that can be among the k nearest of each query, and their distances: a row of z may be the query itself, so k + 1 of them, and all that round to the same distance."""
    found = []
    step = max(1, PAIRS // max(1, len(z)))
    for first in range(0, len(q), step):
        part = q[first : first + step]
        total, shared, apart = (np.zeros((len(part), len(z))) for _ in range(3))
        for d in range(q.shape[1]):
            a, b = part[:, d, None], z[None, :, d]
            square = (a - b) * (a - b)
            both = ~np.isnan(square)
            total += np.where(both, square, 0.0)
            shared += both
            if penalty:
                apart += np.isnan(a) != np.isnan(b)
        with np.errstate(divide="ignore", invalid="ignore"):
            away = np.where(shared >= 2, np.sqrt((total + apart * float(penalty) ** 2) / (shared + apart)), np.inf)
        last = min(k, away.shape[1] - 1)  # the k-th of others, if one is the query itself
        limit = np.partition(away, last, axis=1)[:, last] + 2e-9
        i, j = np.nonzero((away <= limit[:, None]) & np.isfinite(away))
        found.append((i + first, j, away[i, j]))
    return tuple(np.concatenate(x) for x in zip(*found))


def nearest(queries: DataFrame, rows: DataFrame, k: int, penalty: float = 1.0, within: str | None = None) -> DataFrame:
    """query, id, place, distance: the k rows nearest to each query, itself (the same id) left out, equal distances by id. Both sides have id and z.

    within names a column of both sides: only rows of a query's own group count, and a query (id and group) has its k rows there; the column comes out too.
    """
    group = F.col(within) if within else F.lit(0)
    distinct = rows.select("id", "z", group.alias("w")).withColumn("nth", F.row_number().over(Window.partitionBy("z", "w").orderBy("id"))).filter(F.col("nth") <= k + 1)
    distinct = distinct.groupBy("z", "w").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("had", had(F.col("z")))
    distinct = cut(distinct)
    shape = distinct.agg(F.count("*").alias("n"), F.max(F.size("z")).alias("d"), *(F.count(F.get("z", F.lit(i))).alias(f"c{i}") for i in range(64))).first()
    dims = sorted(range(shape["d"] or 0), key=lambda i: (-shape[f"c{i}"], i))[:DIMS]
    bins = max(1, min(MOST_BINS, round((shape["n"] / BLOCK_ROWS) ** (1 / max(1, len(dims))))))
    inner = [i / bins for i in range(1, bins)]
    edges = {i: distinct.agg(F.percentile_approx(F.get("z", F.lit(i)), inner, 10_000).alias("e")).first()["e"] or [] if inner else [] for i in dims}

    def bin_of(x: Column, i: int) -> Column:
        """The place of x among the edges of dimension i, -1 for null: edges are few numbers, halved in turn."""

        def search(at: int, end: int) -> Column:
            if at == end:
                return F.lit(at)
            mid = (at + end) // 2
            return F.when(x < edges[i][mid], search(at, mid)).otherwise(search(mid + 1, end))

        return F.when(x.isNull(), F.lit(-1)).otherwise(search(0, len(edges[i])))

    def cell(z: Column) -> list[Column]:
        return [bin_of(F.get(z, F.lit(i)), i).alias(f"g{n}") for n, i in enumerate(dims)]

    grid = [f"g{n}" for n in range(len(dims))]
    index = cut(distinct.select("z", "w", "ids", "had", *cell(F.col("z"))))
    low, high = (F.array(*(f(F.get("z", F.lit(i))) for i in range(shape["d"] or 0))) for f in (F.min, F.max))
    boxes = index.groupBy("w", "had", *grid).agg(low.alias("low"), high.alias("high"))
    asked = cut(queries.select(F.col("id").alias("query"), group.alias("w"), F.col("z").alias("q"), had(F.col("z")).alias("q_had"), *(c.alias(f"q{n}") for n, c in enumerate(cell(F.col("z"))))))

    ship(rows.sparkSession)
    wide = shape["d"] or 0

    def meet(asked: pa.Table, block: pa.Table) -> pa.Table:
        ids = block.column("ids").cast(pa.list_(block.schema.field("ids").type.value_type))  # null ids are allowed in the result's type
        q, z = _matrix(asked.column("q"), wide), _matrix(block.column("z"), wide)
        i, j, away = closest(q, z, k, penalty) if len(q) and len(z) and wide else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        return pa.table([asked.column("query").take(pa.array(i)), asked.column("w").take(pa.array(i)), ids.take(pa.array(j)), pa.array(away)], ["query", "w", "ids", "distance"])

    kinds_of = dict(asked.dtypes) | dict(index.dtypes)
    told = f"query {kinds_of['query']}, w {kinds_of['w']}, ids {kinds_of['ids']}, distance double"
    cells = ["w", "had", *grid]

    def measured(pairs: DataFrame) -> DataFrame:
        """pairs: query, w, q and the block (had, grid) where its rows are. Many queries of a block are dealt into parts, each with the block's rows."""
        pairs = cut(pairs)
        parts = pairs.groupBy(*cells).agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts"))
        dealt = pairs.join(parts, cells).withColumn("part", F.pmod(F.xxhash64("query"), F.col("parts")).cast("int"))
        held = index.join(parts, cells).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        at = [*cells, "part"]
        near = dealt.select(*at, "query", "q").groupBy(*at).cogroup(held.select(*at, "z", "ids").groupBy(*at)).applyInArrow(meet, told)
        near = near.select("query", "w", F.explode("ids").alias("id"), "distance").filter("id <> query")
        place = F.row_number().over(Window.partitionBy("query", "w").orderBy(F.round("distance", 9), "id"))
        return near.withColumn("place", place).filter(F.col("place") <= k)

    own = asked.select("query", "w", "q", F.col("q_had").alias("had"), *(F.col(f"q{n}").alias(g) for n, g in enumerate(grid)))
    reach = measured(own).groupBy("query", "w").agg(F.max("place").alias("n"), F.max("distance").alias("d")).filter(F.col("n") >= k).select("query", "w", F.col("d").alias("reach"))
    kinds = index.select("had").distinct()  # two to the number of features at most
    both, apart = F.bit_count(F.col("q_had").bitwiseAND(F.col("had"))), F.bit_count(F.col("q_had").bitwiseXOR(F.col("had"))) if penalty else F.lit(0)
    around = asked.join(reach, ["query", "w"], "left").withColumn("kind", F.explode(F.array(*(F.lit(r["had"]).cast("long") for r in kinds.collect())) if shape["n"] else F.array().cast("array<bigint>")))
    around = around.withColumnRenamed("kind", "had").filter(both >= 2).withColumn("room", F.pow(F.col("reach") + 1e-9, 2) * (both + apart) - apart * F.lit(float(penalty) ** 2))
    around = around.filter("room is null or room >= 0")
    for n, i in enumerate(dims):
        x, bit = F.get("q", F.lit(i)), F.col("had").bitwiseAND(F.lit(1 << i)) != 0
        full = F.sequence(F.lit(0), F.lit(len(edges[i])))
        close = F.sequence(bin_of(x - F.sqrt("room"), i), bin_of(x + F.sqrt("room"), i))
        around = around.withColumn(f"g{n}", F.explode(F.when(~bit, F.array(F.lit(-1))).when(x.isNull() | F.col("room").isNull(), full).otherwise(close)))
    gap = F.zip_with("q", F.zip_with("low", "high", lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda x, b: F.pow(F.greatest(b["a"] - x, x - b["b"], F.lit(0.0)) * F.when(x.isNull() | b["a"].isNull(), None).otherwise(1.0), 2))
    least = F.aggregate(F.filter(gap, lambda x: x.isNotNull()), F.lit(0.0), lambda s, x: s + x)
    blocks = around.join(boxes, ["w", "had", *grid]).filter(F.col("room").isNull() | (least <= F.col("room") + 1e-9)).select("query", "w", "q", "had", *grid)
    return measured(blocks).select("query", *([F.col("w").alias(within)] if within else []), "id", F.col("place").cast("int").alias("place"), "distance")


def range_threshold(rows: DataFrame, penalty: float = 1.0, q: float = 0.95, least: int = 5) -> DataFrame:
    """One row, threshold: the q-quantile of the rows' distances to their nearest other row; null where fewer than least have one."""
    near = nearest(rows, rows, 1, penalty).withColumn("one", F.lit(1))
    n = near.groupBy("one").agg(F.count("*").alias("n"))
    return n.join(quantiles(near, ["one"], "distance", q), "one").select(F.when(F.col("n") >= least, F.col("at")).alias("threshold"))
