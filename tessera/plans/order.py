"""Queries of gene order, and of samples that a database could have held."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import gene_order, releases
from tessera.plans.coverage import r6
from tessera.plans.registry import query
from tessera.plans.views import Views

#: The tables' alignments are shorter than their genes, so a quarter of a gene places it.
LEAST_COVER = 0.25
_NGOC = f"""
hit AS (SELECT r.sample, r.tool, g.copy_id, arg_min((r.s, r.e, r.qname, least(qstart, qend), greatest(qstart, qend), r.strand, start_pos, end_pos), (greatest(r.s, start_pos) - least(r.e, end_pos), r.s, r.e, r.qname, least(qstart, qend), greatest(qstart, qend), r.strand)) AS b
  FROM v_gene g JOIN v_retained r ON r.sample = g.sample AND r.tname = g.sequence_id AND r.s < end_pos AND r.e > start_pos GROUP BY ALL),
flat AS (SELECT sample, tool, copy_id, b[1] AS bs, b[2] AS be, b[3] AS record, b[4] AS qs, b[5] AS qe, b[6] AS strand, b[7] AS gs, b[8] AS ge FROM hit),
spot AS (SELECT *, CASE WHEN strand = '+' THEN qs + along ELSE qe - along END AS position FROM (SELECT *, (least(greatest((gs + ge) / 2.0::DOUBLE, bs), be) - bs) / greatest(be - bs, 1) * (qe - qs) AS along FROM flat WHERE least(be, ge) - greatest(bs, gs) >= {LEAST_COVER} * (ge - gs))),
ranked AS (SELECT p.*, row_number() OVER (PARTITION BY p.sample, tool, record ORDER BY position, g.sequence_id, g.start_pos, g.end_pos, p.copy_id) AS rank, count(*) OVER (PARTITION BY p.sample, tool, record) AS size FROM spot p JOIN v_gene g USING (sample, copy_id)),
next AS (SELECT sample, copy_id AS i, coalesce(lead(copy_id) OVER w, CASE WHEN is_circular AND count(*) OVER (PARTITION BY sample, sequence_id) > 2 THEN first_value(copy_id) OVER w END) AS j FROM (SELECT g.*, t.is_circular FROM v_gene g JOIN v_truth t USING (sequence_id)) WINDOW w AS (PARTITION BY sample, sequence_id ORDER BY start_pos, end_pos, copy_id)),
kept AS (SELECT a.sample, a.tool, count(*) AS n FROM next JOIN ranked a ON a.sample = next.sample AND a.copy_id = i JOIN ranked b ON b.sample = a.sample AND b.tool = a.tool AND b.copy_id = j WHERE a.record = b.record AND a.strand = b.strand
  AND (b.rank - a.rank = CASE a.strand WHEN '+' THEN 1 ELSE -1 END OR a.size > 2 AND b.rank - a.rank = CASE a.strand WHEN '+' THEN 1 - a.size ELSE a.size - 1 END) GROUP BY ALL)"""


@query("d30_gene_order_conservation", """
SELECT r.sample, r.tool, p.n AS pairs, coalesce(k.n, 0) AS conserved, coalesce(s.n, 0) AS projected, round(coalesce(k.n, 0) / p.n, 6) AS ngoc FROM (SELECT DISTINCT sample, tool FROM v_record) r JOIN (SELECT sample, count(*) AS n FROM next WHERE j IS NOT NULL GROUP BY sample) p USING (sample)
LEFT JOIN kept k USING (sample, tool) LEFT JOIN (SELECT sample, tool, count(*) AS n FROM ranked GROUP BY ALL) s USING (sample, tool)""", _NGOC)  # fmt: skip
def d30(v: Views) -> DataFrame:
    rows = gene_order.conserved(v.v_gene, v.v_truth.filter("is_circular").select("sequence_id"), v.retained, v.v_record, LEAST_COVER)
    return r6(rows, "ngoc")


_RELEASES = """SELECT 'tool ' || o_custkey AS tool, o_orderkey AS release, CAST(o_orderdate AS DATE) AS released, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) - INTERVAL '90' DAY END AS db_date FROM orders WHERE o_orderpriority = '1-URGENT'"""
_RAN = """SELECT o_orderkey AS sample, 'tool ' || o_custkey AS tool, CAST(o_orderdate AS DATE) AS ran, CASE o_custkey % 5 WHEN 0 THEN CAST(year(o_orderdate) AS VARCHAR(4)) WHEN 1 THEN CAST(year(o_orderdate) AS VARCHAR(4)) || '-06' WHEN 2 THEN 'not recorded' ELSE CAST(CAST(o_orderdate AS DATE) - INTERVAL '200' DAY AS DATE) || '' END AS collected, o_custkey % 11 > 0 AS uses_database FROM orders WHERE o_orderpriority <> '1-URGENT'"""


@query("c07_database_releases", """
SELECT sample, tool, release, CASE WHEN NOT uses_database THEN 'no_reference_database' WHEN truth IS NULL OR db_date IS NULL THEN 'unknown' WHEN truth <= db_date THEN 'possible_overlap' ELSE 'after_database' END AS overlap FROM (
SELECT s.sample, s.tool, uses_database, CASE WHEN length(collected) = 4 THEN try_cast(collected || '-01-01' AS DATE) WHEN length(collected) = 7 THEN try_cast(collected || '-01' AS DATE) ELSE try_cast(collected AS DATE) END AS truth, arg_max(release, (released, release)) AS release, arg_max((db_date, 1), (released, release))[1]::DATE AS db_date
FROM s LEFT JOIN r ON r.tool = s.tool AND r.released <= s.ran GROUP BY ALL)""", f"r AS ({_RELEASES}), s AS ({_RAN})")  # fmt: skip
def c07(v: Views) -> DataFrame:
    """Each run against the release of its tool's database that was out when it ran."""
    runs = v.sql(_RAN.replace("|| ''", "").replace("VARCHAR(4)", "STRING").replace("ELSE CAST(CAST(o_orderdate AS DATE) - INTERVAL '200' DAY AS DATE)", "ELSE CAST(CAST(CAST(o_orderdate AS DATE) - INTERVAL '200' DAY AS DATE) AS STRING)"))
    found = releases.in_force(runs, v.sql(_RELEASES).withColumn("db_date", F.col("db_date").cast("date")))
    both = runs.select("sample", "collected", "uses_database").join(found, "sample")
    kind = releases.overlap_class(releases.tolerant_date(F.col("collected")), F.col("uses_database"), F.col("db_date"))
    return both.select("sample", "tool", "release", kind.alias("overlap"))
