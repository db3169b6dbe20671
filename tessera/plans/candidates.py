"""Queries of predicted records that share a plasmid, and of alignments read base by base."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import cigar, multiplicity, scoring
from tessera.plans.coverage import r6
from tessera.plans.registry import query
from tessera.plans.views import Views, islands_text

#: The alignments of the tables are some hundred bases long, so a part of a chimera is 100 here, not 1,000.
LEAST_BP = 100
_CTES = (
    islands_text("own_of", "v_retained", "sample, tool, qname, tname") + "," + islands_text("all_of", "v_retained", "sample, tool, tname") + f""",
per AS (SELECT sample, tool, qname, tname, molecule_type AS mol, sum(e - s) AS bp FROM own_of JOIN (SELECT sequence_id, molecule_type FROM v_truth) t ON tname = sequence_id GROUP BY ALL),
sums AS (SELECT sample, tool, qname, sum(bp) AS all_bp, sum(CASE WHEN mol = 'PLASMID' THEN bp ELSE 0 END) AS plasmid_bp, sum(CASE WHEN mol = 'CHROMOSOME' THEN bp ELSE 0 END) AS chromosome_bp,
  arg_min(tname, (-bp, tname)) FILTER (mol = 'PLASMID') AS home, max(bp) FILTER (mol = 'PLASMID') AS home_bp FROM per GROUP BY ALL),
base AS (SELECT r.sample, r.tool, r.record_id AS qname, r.length, least(r.length, coalesce(all_bp, 0)) AS aligned_bp, coalesce(plasmid_bp, 0) AS plasmid_bp, coalesce(chromosome_bp, 0) AS chromosome_bp, home, coalesce(home_bp, 0) AS home_bp
  FROM v_record r LEFT JOIN sums s ON r.sample = s.sample AND r.tool = s.tool AND r.record_id = s.qname),
large AS (SELECT p.sample, p.tool, p.qname, count(*) AS n FROM per p JOIN base b USING (sample, tool, qname) WHERE bp >= {LEAST_BP} AND aligned_bp > 0 AND bp >= 0.1 * aligned_bp GROUP BY ALL),
aside AS (SELECT b.*, CASE WHEN aligned_bp = 0 THEN 'unmapped' WHEN chromosome_bp > plasmid_bp THEN 'off_target' WHEN coalesce(n, 0) >= 2 THEN 'chimeric' END AS aside FROM base b LEFT JOIN large USING (sample, tool, qname)),
member AS (SELECT *, row_number() OVER (PARTITION BY sample, tool, home ORDER BY home_bp DESC, qname) AS place FROM aside WHERE aside IS NULL AND home IS NOT NULL AND home_bp >= 0.5 * aligned_bp),
held AS (SELECT m.sample, m.tool, m.home, m.place, o.s, o.e FROM member m JOIN own_of o ON o.sample = m.sample AND o.tool = m.tool AND o.qname = m.qname AND o.tname = m.home),
stop AS (SELECT sample, tool, home, p, lead(p) OVER (PARTITION BY sample, tool, home ORDER BY p) AS q FROM (SELECT DISTINCT sample, tool, home, unnest([s, e]) AS p FROM held)),
piece AS (SELECT a.sample, a.tool, a.home, p, q, min(place) AS place FROM stop a JOIN held h ON a.sample = h.sample AND a.tool = h.tool AND a.home = h.home AND s <= p AND p < e GROUP BY ALL),
fresh AS (SELECT sample, tool, home, place, sum(q - p) AS fresh FROM piece GROUP BY ALL),
kinds AS (SELECT a.sample, a.tool, a.qname AS candidate, a.length, a.aligned_bp, a.home, a.home_bp, a.plasmid_bp, a.chromosome_bp, coalesce(f.fresh, 0) AS fresh, m.place IS NOT NULL AS is_member,
  CASE WHEN a.aside IS NOT NULL THEN a.aside WHEN m.place IS NULL THEN 'other_plasmid_part' WHEN m.place = 1 THEN 'primary' WHEN coalesce(f.fresh, 0) < 0.1 * a.home_bp THEN 'redundant' ELSE 'complementary_fragment' END AS relationship
  FROM aside a LEFT JOIN member m USING (sample, tool, qname) LEFT JOIN fresh f ON f.sample = m.sample AND f.tool = m.tool AND f.home = m.home AND f.place = m.place)"""
)
_TOUCH = """,
touch AS (SELECT p.sample, p.tool, p.tname, p.qname, p.bp AS own, k.relationship AS kind, k.is_member AND k.home = p.tname AS member FROM per p JOIN kinds k ON k.sample = p.sample AND k.tool = p.tool AND k.candidate = p.qname WHERE p.mol = 'PLASMID'),
each AS (SELECT sample, tool, tname, count(*) AS n_touching, count(*) FILTER (member) AS n_candidates, sum(own) AS all_own, arg_min((qname, own), (NOT member, -own, qname)) AS best, count(*) FILTER (member AND kind = 'complementary_fragment') AS n_fragments,
  count(*) FILTER (member AND kind = 'redundant') AS n_redundant, count(*) FILTER (kind = 'chimeric') AS n_chimeric FROM touch GROUP BY ALL),
whole AS (SELECT sample, tool, tname, sum(e - s) AS bp FROM all_of GROUP BY ALL),
runs AS (SELECT DISTINCT sample, tool FROM v_record)"""


def found(v: Views, unmapped: bool = True) -> DataFrame:
    records = v.v_aln.select("sample", "tool", F.col("qname").alias("record_id"), F.col("qlen").alias("length")).repartition("sample", "tool", "record_id").distinct()  # v_record, dealt as its joins want it
    return multiplicity.candidates(v.retained, records, v.v_truth, least_bp=LEAST_BP, unmapped=unmapped)


@query("d26_candidate_kinds", "SELECT sample, tool, candidate, aligned_bp, home, home_bp, plasmid_bp, chromosome_bp, relationship, CASE WHEN is_member THEN fresh ELSE 0 END AS new_bp_on_home FROM kinds", _CTES)
def d26_kinds(v: Views) -> DataFrame:
    return found(v).drop("length", "is_member")


@query("d26_plasmid_multiplicity", """
SELECT r.sample, r.tool, t.sequence_id AS plasmid, CASE WHEN n_touching IS NULL THEN 'missed' WHEN n_candidates = 0 THEN 'carried_only_in_other_candidates' WHEN n_fragments > 0 AND n_redundant > 0 THEN 'fragmented_and_duplicated'
  WHEN n_fragments > 0 THEN 'fragmented' WHEN n_redundant > 0 THEN 'duplicated' ELSE 'single' END AS outcome, coalesce(n_candidates, 0) AS n_candidates, coalesce(n_touching, 0) AS n_touching, best[1] AS best_candidate,
  round(coalesce(best[2], 0) / t.length, 6) AS best_candidate_coverage, round(coalesce(w.bp, 0) / t.length, 6) AS combined_coverage, round((coalesce(w.bp, 0) - coalesce(best[2], 0)) / t.length, 6) AS coverage_gain,
  CAST(coalesce(all_own, 0) - coalesce(w.bp, 0) AS BIGINT) AS redundant_bp, round(coalesce((all_own - w.bp) / all_own, 0), 6) AS redundancy_fraction, coalesce(n_fragments, 0) AS n_fragments, coalesce(n_redundant, 0) AS n_redundant, coalesce(n_chimeric, 0) AS n_chimeric_touching
FROM runs r JOIN v_truth t ON t.sample = r.sample AND t.molecule_type = 'PLASMID' LEFT JOIN each e ON e.sample = r.sample AND e.tool = r.tool AND e.tname = t.sequence_id LEFT JOIN whole w ON w.sample = r.sample AND w.tool = r.tool AND w.tname = t.sequence_id""", _CTES + _TOUCH)  # fmt: skip
def d26_plasmids(v: Views) -> DataFrame:
    rows = multiplicity.plasmids(v.retained, found(v, unmapped=False), v.v_truth, v.v_record)
    return r6(rows, "best_candidate_coverage", "combined_coverage", "coverage_gain", "redundancy_fraction")


_SIZE = "coalesce(list_sum(list_transform(regexp_extract_all(cg, '([0-9]+)[{}]', 1), lambda x: x::BIGINT)), 0)"
_DECODED = f"""
dec AS (SELECT *, {_SIZE.format("M=X")} AS a, {_SIZE.format("I")} AS ins, {_SIZE.format("D")} AS del, CASE WHEN cg IS NULL THEN NULL WHEN regexp_matches(cg, '[=X]') THEN {_SIZE.format("X")} WHEN nm IS NOT NULL THEN greatest(0, nm - {_SIZE.format("I")} - {_SIZE.format("D")}) END AS mm FROM v_mapped_retained)"""


def mapped(v: Views) -> DataFrame:
    """Retained alignments with their CIGAR text."""
    return scoring.retain(v.v_mapped)


@query("d28_nucleotide_accuracy", """
SELECT sample, tool, n_blocks, n_blocks_without_cigar, mm AS mismatch_bp, ins AS inserted_bp, del AS deleted_bp, a + ins + del AS aligned_columns, round((a - mm) / nullif(a + ins + del, 0), 6) AS identity,
  round(mm / nullif(a + ins + del, 0), 6) AS mismatch_rate, round(ins / nullif(a + ins + del, 0), 6) AS insertion_rate, round(del / nullif(a + ins + del, 0), 6) AS deletion_rate
FROM (SELECT sample, tool, count(*) AS n_blocks, count(*) FILTER (mm IS NULL) AS n_blocks_without_cigar, coalesce(sum(a) FILTER (mm IS NOT NULL), 0)::BIGINT AS a, coalesce(sum(mm), 0)::BIGINT AS mm, coalesce(sum(ins) FILTER (mm IS NOT NULL), 0)::BIGINT AS ins,
  coalesce(sum(del) FILTER (mm IS NOT NULL), 0)::BIGINT AS del FROM dec GROUP BY sample, tool)""", _DECODED)  # fmt: skip
def d28_accuracy(v: Views) -> DataFrame:
    return r6(cigar.accuracy(mapped(v), ["sample", "tool"]), "identity", "mismatch_rate", "insertion_rate", "deletion_rate")


@query("d28_missing_regions", """
SELECT sample, tool, sequence_id, length, coalesce(covered, 0)::BIGINT AS covered_bp, coalesce(n, 0) + CASE WHEN length > coalesce(last, 0) THEN 1 ELSE 0 END AS missing_regions, (length - coalesce(covered, 0))::BIGINT AS missing_bp,
  greatest(coalesce(longest, 0), length - coalesce(last, 0)) AS longest_missing_bp
FROM (SELECT DISTINCT sample, tool FROM v_record) JOIN (SELECT sample, sequence_id, length FROM v_truth WHERE molecule_type = 'PLASMID') USING (sample) LEFT JOIN (SELECT sample, tool, tname AS sequence_id, sum(e - s) AS covered, count(*) FILTER (gap > 0) AS n, max(gap) AS longest, max(e) AS last
  FROM (SELECT *, s - coalesce(lag(e) OVER (PARTITION BY sample, tool, tname ORDER BY s), 0) AS gap FROM all_of) GROUP BY ALL) USING (sample, tool, sequence_id)""", islands_text("all_of", "v_retained", "sample, tool, tname"))  # fmt: skip
def d28_regions(v: Views) -> DataFrame:
    targets = v.v_record.select("sample", "tool").distinct().join(v.v_truth.filter("molecule_type = 'PLASMID'").select("sample", "sequence_id", "length"), "sample")
    return cigar.missing_regions(v.retained.withColumnRenamed("tname", "sequence_id"), targets, ["sample", "tool", "sequence_id"])


@query("d28_edits_in_genes", """
SELECT o.sample, o.tool, o.tname, g.copy_id, CAST(sum(CASE WHEN op = 'X' THEN least(le, end_pos) - greatest(ls, start_pos) ELSE 0 END) AS BIGINT) AS mismatch_bp, CAST(sum(CASE WHEN op = 'D' THEN least(le, end_pos) - greatest(ls, start_pos) ELSE 0 END) AS BIGINT) AS deleted_bp,
  count(*) FILTER (op = 'I') AS insertions, CAST(sum(CASE WHEN op = 'I' THEN n ELSE 0 END) AS BIGINT) AS inserted_bp
FROM (SELECT *, tstart + to_t AS ls, greatest(tstart + to_t + CASE WHEN op IN ('X', 'D') THEN n ELSE 0 END, tstart + to_t + 1) AS le FROM (SELECT *, coalesce(sum(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN n ELSE 0 END) OVER (PARTITION BY r ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS to_t FROM op) WHERE op IN ('X', 'I', 'D')) o
JOIN v_gene g ON g.sequence_id = o.tname AND g.sample = o.sample AND ls < end_pos AND le > start_pos GROUP BY ALL""", """
op AS (SELECT sample, tool, tname, tstart, r, k, sizes[k]::BIGINT AS n, ops[k] AS op FROM (SELECT *, unnest(range(1, len(sizes) + 1)) AS k FROM (SELECT sample, tool, tname, tstart, row_number() OVER () AS r, regexp_extract_all(cg, '([0-9]+)([MIDNSHP=X])', 1) AS sizes, regexp_extract_all(cg, '([0-9]+)([MIDNSHP=X])', 2) AS ops FROM v_mapped_retained)))""")  # fmt: skip
def d28_edits(v: Views) -> DataFrame:
    genes = v.v_gene.select("sample", F.col("sequence_id").alias("tname"), "copy_id", F.col("start_pos").alias("rs"), F.col("end_pos").alias("re"))
    return cigar.edits_in_regions(mapped(v), genes, ["sample", "tool", "tname"], ["copy_id"])


@query("i08_operations", "SELECT sample, tool, qname, tname, a AS aligned, ins AS inserted, del AS deleted, mm AS mismatches, count(*) AS blocks FROM dec WHERE mm IS NOT NULL GROUP BY ALL", _DECODED)
def i08(v: Views) -> DataFrame:
    rows = cigar.decoded(mapped(v)).filter("mismatches is not null")
    return rows.groupBy("sample", "tool", "qname", "tname", "aligned", "inserted", "deleted", "mismatches").agg(F.count("*").alias("blocks"))
