"""Queries of nearest neighbours with missing features, of the range that they span, and of the tool that they recommend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import neighbour_arm, neighbours
from tessera.plans.boards import values
from tessera.plans.registry import query
from tessera.plans.views import Views

FEATURES = ["balance", "spend", "last_order", "open_share"]
_CUSTOMERS = """
SELECT c_custkey AS id, CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DOUBLE) END AS balance, spend, last_order, CASE WHEN n_open > 0 THEN n_open / n_all END AS open_share
FROM customer LEFT JOIN (SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / count(*) AS spend, CAST(max(date_diff({day}, DATE '1992-01-01', CAST(o_orderdate AS DATE))) AS DOUBLE) AS last_order,
  CAST(count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS DOUBLE) AS n_open, CAST(count(*) AS DOUBLE) AS n_all FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey"""


def _scaled(feature: str) -> str:
    return f"(x.{feature} - (SELECT centre FROM scale WHERE feature = '{feature}')) / (SELECT spread FROM scale WHERE feature = '{feature}') AS {feature}"


_SQUARES = " + ".join(f"coalesce(pow(a.{f} - b.{f}, 2), 0)" for f in FEATURES)
_SHARED = " + ".join(f"CASE WHEN a.{f} IS NOT NULL AND b.{f} IS NOT NULL THEN 1 ELSE 0 END" for f in FEATURES)
_APART = " + ".join(f"CASE WHEN (a.{f} IS NULL) <> (b.{f} IS NULL) THEN 1 ELSE 0 END" for f in FEATURES)
_CTES = f"""x AS ({_CUSTOMERS.format(day="'day'")}),
long AS (UNPIVOT x ON balance, spend, last_order, open_share INTO NAME feature VALUE v),
mid AS (SELECT feature, median(v) AS centre FROM long GROUP BY feature),
scale AS (SELECT feature, any_value(centre) AS centre, CASE WHEN median(abs(v - centre)) > 0 THEN 1.4826 * median(abs(v - centre)) ELSE stddev_pop(v) END AS spread FROM long JOIN mid USING (feature) GROUP BY feature),
z AS (SELECT id, {", ".join(map(_scaled, FEATURES))} FROM x),
near AS (SELECT a.id AS query, b.id, sqrt((squares + apart) / (shared + apart)) AS distance FROM (SELECT a.id AS aid, b.id AS bid, {_SQUARES} AS squares, {_SHARED} AS shared, {_APART} AS apart FROM z a, z b WHERE a.id <> b.id {{asked}}) p JOIN z a ON a.id = aid JOIN z b ON b.id = bid WHERE shared >= 2),
ranked AS (SELECT query, id, distance, row_number() OVER (PARTITION BY query ORDER BY round(distance, 9), id) AS place FROM near)"""


def customers(v: Views) -> DataFrame:
    """id and z, the scaled features of each customer; those without orders, or in debt, lack some."""
    rows = v.sql(_CUSTOMERS.replace("date_diff({day}, DATE '1992-01-01', CAST(o_orderdate AS DATE))", "date_diff(CAST(o_orderdate AS DATE), DATE '1992-01-01')"))
    scale = {r["feature"]: (r["centre"], r["spread"]) for r in neighbours.scales(rows, FEATURES).collect()}  # a row a feature
    return rows.select("id", neighbours.standardised(rows, FEATURES, scale).alias("z"))


@query("c14_neighbours_with_missing", "SELECT query, id, CAST(place AS INTEGER) AS place, round(distance, 6) AS distance FROM ranked WHERE place <= 5", _CTES.format(asked="AND a.id % 20 = 0"))
def c14(v: Views) -> DataFrame:
    """The five nearest of all customers for each whose id is divisible by 20."""
    z = customers(v)
    return neighbours.nearest(z.filter("id % 20 = 0"), z, 5).withColumn("distance", F.round("distance", 6))


@query("c15_range_threshold", "SELECT round(quantile_cont(distance, 0.95), 6) AS threshold FROM ranked WHERE place = 1", _CTES.format(asked=""))
def c15(v: Views) -> DataFrame:
    return neighbours.range_threshold(customers(v)).select(F.round("threshold", 6).alias("threshold"))


_SAMPLES = """
SELECT s.sample, study, CAST(species AS STRING) AS species, CAST(species % 2 AS STRING) AS genus, CASE WHEN region < 4 THEN CAST(region % 2 AS STRING) END AS gram_group, t.n_truth, t.mean_length, c.depth, g.n_genes FROM v_sheet s
LEFT JOIN (SELECT sample, CAST(count(*) AS DOUBLE) AS n_truth, avg(length) AS mean_length FROM v_truth GROUP BY sample) t ON t.sample = s.sample LEFT JOIN (SELECT sample, avg(depth) AS depth FROM v_contig GROUP BY sample) c ON c.sample = s.sample
LEFT JOIN (SELECT sample, CAST(count(*) AS DOUBLE) AS n_genes FROM v_gene GROUP BY sample) g ON g.sample = s.sample"""


@query("m04_feature_arm")
def m04(v: Views) -> DataFrame:
    """Each sample's tool by its neighbours of other studies: species, genus, group, any, or the single best; samples without genes or truth lack features."""
    return neighbour_arm.feature_arm(values(v), v.sql(_SAMPLES), ["n_truth", "mean_length", "depth", "n_genes"])
