"""Queries of records and the references that they are close to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import references
from tessera.plans.coverage import r6
from tessera.plans.registry import query
from tessera.plans.views import Views

_HITS = "SELECT qname AS query, tname AS ref, 1 - CAST(matches AS DOUBLE) / block_length AS distance, CASE WHEN mapq > 0 THEN CAST(1 AS DOUBLE) / mapq END AS p FROM v_aln WHERE is_primary AND block_length > 60"
_QUERIES = "SELECT o_orderkey AS query, o_custkey % 5000 + 100 AS length FROM orders"
_CLUSTERS = "SELECT sequence_id AS ref, sample AS cluster, members FROM v_truth JOIN (SELECT sample AS c, count(*) AS members FROM v_truth GROUP BY sample) ON c = sample"


@query("c17_reference_classes", """
SELECT query, status, CASE WHEN told THEN ref END AS best_ref, CASE WHEN told THEN cluster END AS cluster, round(CASE WHEN told THEN distance END, 6) AS distance, CASE WHEN told THEN rival END AS rival,
  round(CASE WHEN NOT told THEN NULL WHEN status = 'ambiguous_between_references' THEN 0 WHEN status = 'close_reference_match' THEN greatest(0, 1 - distance / 0.01) ELSE least(1, (distance - 0.01) / 0.01) END, 6) AS distance_margin
FROM (SELECT q.query, b.*, v.rival, length >= 150 AND b.ref IS NOT NULL AS told, CASE WHEN length < 150 THEN 'insufficient_sequence' WHEN b.ref IS NULL THEN 'insufficient_reference' WHEN close AND rival IS NOT NULL THEN 'ambiguous_between_references' WHEN close THEN 'close_reference_match' ELSE 'no_close_reference' END AS status
FROM q LEFT JOIN best b ON b.of = q.query LEFT JOIN (SELECT of, arg_min(h.ref, (h.distance, h.ref)) AS rival FROM best JOIN hit h ON h.query = of WHERE close AND h.ref <> best.ref AND h.cluster <> best.cluster AND h.distance - best.distance <= 0.002 AND (h.p IS NULL OR h.p <= 0.5) GROUP BY of) v ON v.of = q.query)""", f"""
q AS ({_QUERIES}), hit AS (SELECT h.*, cluster, members FROM ({_HITS}) h LEFT JOIN ({_CLUSTERS}) USING (ref)),
best AS (SELECT of, ref, distance, cluster, distance <= 0.01 AND members >= 3 AND (p IS NULL OR p <= 0.5) AS close FROM (SELECT query AS of, *, row_number() OVER (PARTITION BY query ORDER BY distance, ref, p NULLS FIRST) AS k FROM hit) WHERE k = 1)""")  # fmt: skip
def c17(v: Views) -> DataFrame:
    """Orders against the references that they align to: distance is one less identity, p falls with mapping quality."""
    rows = references.classify(v.sql(_QUERIES), v.sql(_HITS), v.sql(_CLUSTERS), 0.01, 3, 0.5, 150, 0.002)
    return r6(rows, "distance", "distance_margin")
