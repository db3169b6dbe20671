"""Bins against plasmids by whole rules: eligible matching, verdicts, outcomes, agreement with unclaimed bases, discordances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import reconstruction as rec
from tessera.operators.intervals import union_bp
from tessera.operators.lineage import cut
from tessera.plans.agreement import BINNED
from tessera.plans.coverage import r6
from tessera.plans.registry import query
from tessera.plans.views import Views, islands_text

RUN = ["sample", "tool"]
#: Parts of a plasmid that one bin covers in the test tables are small, and so are these limits; the functions' defaults are the usual ones.
COMPLETE, PURE, SHARE = 0.012, 0.7, 0.01
#: bp decides; a mark of the names keeps two matchings of equal bp apart in both engines.
WEIGHT = "bp * 1048576 + (bin * 7919 + ref * 104729) % 1009"

PARTS = BINNED + """,
ov AS (SELECT sample, tool, bin, ref, bp, length FROM tab JOIN (SELECT sequence_id, length, molecule_type FROM v_truth) t ON ref = sequence_id WHERE molecule_type = 'PLASMID'),
ch AS (SELECT sample, tool, bin, sum(bp) AS bp FROM tab JOIN (SELECT sequence_id, molecule_type FROM v_truth) t ON ref = sequence_id WHERE molecule_type = 'CHROMOSOME' GROUP BY ALL),
bs AS (SELECT DISTINCT r.sample, r.tool, b.bin_id AS bin FROM v_record r JOIN v_bins b ON r.record_id = b.sequence_id),
rn AS (SELECT DISTINCT sample, tool FROM v_record),
pm AS (SELECT rn.sample, rn.tool, sequence_id AS ref, length FROM rn JOIN v_truth t ON rn.sample = t.sample WHERE molecule_type = 'PLASMID'),
bt AS (SELECT sample, tool, bin, coalesce(p, 0) AS plasmid_bp, coalesce(c, 0) AS chromosome_bp, coalesce(p, 0) + coalesce(c, 0) AS mapped_bp, CASE WHEN coalesce(p, 0) + coalesce(c, 0) > 0 THEN coalesce(p, 0) / CAST(coalesce(p, 0) + coalesce(c, 0) AS DOUBLE) ELSE 0 END AS purity
FROM bs LEFT JOIN (SELECT sample, tool, bin, sum(bp) AS p FROM ov GROUP BY ALL) USING (sample, tool, bin) LEFT JOIN (SELECT sample, tool, bin, bp AS c FROM ch) USING (sample, tool, bin))"""


def matching_text(name: str, edges: str) -> str:
    """CTEs that end in ``name`` (sample, tool, bin, ref): the matching of greatest weight of edges (sample, tool, bin, ref, bp), by trying every set of refs bin by bin."""
    return f""",
{name}_e AS (SELECT *, dense_rank() OVER (PARTITION BY sample, tool ORDER BY bin) - 1 AS l, CAST(1 AS BIGINT) << (dense_rank() OVER (PARTITION BY sample, tool ORDER BY ref) - 1) AS bit, bp * 1048576 + (bin * 7919 + ref * 104729) % 1009 AS w FROM ({edges})),
{name}_x AS (SELECT sample, tool, l, bin, ref, bit, w FROM {name}_e UNION ALL SELECT DISTINCT sample, tool, l, bin, NULL, CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM {name}_e),
{name}_d AS (WITH RECURSIVE st(sample, tool, l, mask, w, path) AS (SELECT DISTINCT sample, tool, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST([] AS VARCHAR[]) FROM {name}_e
UNION ALL SELECT st.sample, st.tool, st.l + 1, st.mask | x.bit, CAST(max(st.w + x.w) AS BIGINT), max_by(CASE WHEN x.ref IS NULL THEN st.path ELSE list_append(st.path, x.bin || ':' || x.ref) END, st.w + x.w) FROM st JOIN {name}_x x ON st.sample = x.sample AND st.tool = x.tool AND st.l = x.l AND st.mask & x.bit = 0 GROUP BY ALL) SELECT * FROM st),
{name} AS (SELECT sample, tool, CAST(split_part(p, ':', 1) AS BIGINT) AS bin, CAST(split_part(p, ':', 2) AS BIGINT) AS ref FROM (SELECT sample, tool, unnest(path) AS p FROM (SELECT sample, tool, max_by(path, w) AS path FROM {name}_d GROUP BY sample, tool)))"""


class Parts:
    """The tables of operators.reconstruction, from the views."""

    def __init__(self, v: Views) -> None:
        truth = v.v_truth.select(F.col("sequence_id").alias("ref"), "length", "molecule_type")
        joined = v.retained.join(v.v_bins, F.col("qname") == F.col("sequence_id")).drop("sequence_id").withColumnRenamed("bin_id", "bin").withColumnRenamed("tname", "ref").join(truth, "ref")
        table = cut(union_bp(joined, [*RUN, "bin", "ref", "molecule_type"]))  # read several times, and far smaller than the alignments
        runs = v.v_record.select(*RUN).distinct()
        self.overlaps = table.filter("molecule_type = 'PLASMID'").select(*RUN, "bin", "ref", "bp")
        self.chromosome = table.filter("molecule_type = 'CHROMOSOME'").groupBy(*RUN, "bin").agg(F.sum("bp").alias("bp"))
        self.plasmids = runs.join(v.v_truth.filter("molecule_type = 'PLASMID'"), "sample").select(*RUN, F.col("sequence_id").alias("ref"), "length")
        self.bins = cut(v.v_aln.join(v.v_bins, F.col("qname") == F.col("sequence_id")).select(*RUN, F.col("bin_id").alias("bin")).distinct())
        self.identities = joined.groupBy(*RUN, "bin", "ref").agg(F.sum("matches").alias("matches"), F.sum("block_length").alias("block_length"))


@query("k01_maximum_weight_matching", "SELECT sample, tool, count(*) AS pairs, CAST(sum(bp) AS BIGINT) AS bp FROM mt JOIN tab USING (sample, tool, bin, ref) GROUP BY ALL", BINNED + matching_text("mt", "SELECT * FROM tab"))
def k01(v: Views) -> DataFrame:
    from tessera.plans.agreement import table

    return rec.matched(table(v), RUN, WEIGHT).groupBy(*RUN).agg(F.count("*").alias("pairs"), F.sum("bp").alias("bp"))


@query("d14_bin_scores", f"""
SELECT sample, tool, bins, plasmids, matched, bins - matched AS unmatched_bins, plasmids - matched AS missed, round(CASE WHEN plasmids = 0 AND bins > 0 THEN 0 WHEN bins > 0 THEN matched / bins END, 6) AS precision, round(CASE WHEN plasmids > 0 THEN matched / plasmids END, 6) AS recall,
round(CASE WHEN plasmids = 0 OR bins = 0 THEN NULL WHEN matched = 0 THEN 0 ELSE 2 * (matched / bins) * (matched / plasmids) / (matched / bins + matched / plasmids) END, 6) AS f1, splits, merges, contaminated, chromosome_bp, round(CASE WHEN mapped_bp > 0 THEN chromosome_bp / mapped_bp END, 6) AS contamination
FROM (SELECT rn.sample, rn.tool, count(pm.ref) AS plasmids FROM rn LEFT JOIN pm USING (sample, tool) GROUP BY ALL) JOIN (SELECT sample, tool, count(*) AS bins, count(*) FILTER (chromosome_bp > 0) AS contaminated, CAST(sum(chromosome_bp) AS BIGINT) AS chromosome_bp, sum(mapped_bp) AS mapped_bp FROM bt GROUP BY ALL) USING (sample, tool)
LEFT JOIN (SELECT sample, tool, coalesce(count(m.bin), 0) AS matched FROM rn LEFT JOIN mt m USING (sample, tool) GROUP BY ALL) USING (sample, tool)
LEFT JOIN (SELECT sample, tool, CAST(coalesce(sum(k - 1), 0) AS BIGINT) AS splits FROM rn LEFT JOIN (SELECT sample, tool, ref, count(*) AS k FROM ov WHERE bp >= {SHARE} * length GROUP BY ALL) USING (sample, tool) GROUP BY ALL) USING (sample, tool)
LEFT JOIN (SELECT sample, tool, CAST(coalesce(sum(k - 1), 0) AS BIGINT) AS merges FROM rn LEFT JOIN (SELECT sample, tool, bin, count(*) AS k FROM ov WHERE bp >= {SHARE} * length GROUP BY ALL) USING (sample, tool) GROUP BY ALL) USING (sample, tool)""",
    PARTS + matching_text("mt", f"SELECT o.* FROM ov o JOIN bt USING (sample, tool, bin) WHERE bp >= {COMPLETE} * length AND purity >= {PURE}"))
def d14(v: Views) -> DataFrame:
    p = Parts(v)
    out = rec.bin_scores(p.overlaps, p.chromosome, p.plasmids, p.bins, RUN, COMPLETE, PURE, SHARE, WEIGHT)
    return r6(out, "precision", "recall", "f1", "contamination")


@query("d15_length_weighted_binning", """
SELECT sample, tool, round(good / mapped, 6) AS precision, round(good / truth, 6) AS recall, round(2 * (good / mapped) * (good / truth) / (good / mapped + good / truth), 6) AS f1 FROM (SELECT sample, tool, sum(bp) AS good FROM mt JOIN ov USING (sample, tool, bin, ref) GROUP BY ALL) JOIN (SELECT sample, tool, sum(mapped_bp) AS mapped FROM bt GROUP BY ALL) USING (sample, tool) JOIN (SELECT sample, tool, sum(length) AS truth FROM pm GROUP BY ALL) USING (sample, tool)""", PARTS + matching_text("mt", "SELECT * FROM ov"))
def d15(v: Views) -> DataFrame:
    """bp of the best matching over all that bins map and over all plasmids."""
    p = Parts(v)
    good = rec.matched(p.overlaps, RUN, WEIGHT).groupBy(*RUN).agg(F.sum("bp").alias("good"))
    mapped = rec.bin_totals(p.overlaps, p.chromosome, p.bins, RUN).groupBy(*RUN).agg(F.sum("mapped_bp").alias("mapped"))
    truth = p.plasmids.groupBy(*RUN).agg(F.sum("length").alias("truth"))
    precision, recall = rec.ratio(F.col("good"), F.col("mapped")), rec.ratio(F.col("good"), F.col("truth"))
    out = good.join(mapped, RUN).join(truth, RUN).select(*RUN, precision.alias("precision"), recall.alias("recall"), rec.f1_of(precision, recall).alias("f1"))
    return r6(out, "precision", "recall", "f1")


@query("d16_correct_plasmids", f"""
SELECT sample, tool, ref, m.bin, round(coalesce(o.bp / length, 0), 6) AS coverage, round(coalesce(o.bp / mapped_bp, 0), 6) AS bin_share, round(coalesce(matches / block_length, 0), 6) AS identity, coalesce(holders, 0) > 0 AS split,
m.bin IS NOT NULL AND o.bp >= 0.01 * length AND o.bp >= 0.2 * mapped_bp AND coalesce(holders, 0) = 0 AS correct_without_identity, m.bin IS NOT NULL AND o.bp >= 0.01 * length AND o.bp >= 0.2 * mapped_bp AND coalesce(holders, 0) = 0 AND matches / block_length >= 0.99 AS correct
FROM pm LEFT JOIN mt m USING (sample, tool, ref) LEFT JOIN (SELECT sample, tool, bin, ref, bp FROM ov) o USING (sample, tool, bin, ref) LEFT JOIN (SELECT sample, tool, bin, mapped_bp FROM bt) USING (sample, tool, bin)
LEFT JOIN (SELECT sample, tool, bin_id AS bin, tname AS ref, sum(matches) AS matches, sum(block_length) AS block_length FROM ba GROUP BY ALL) USING (sample, tool, bin, ref)
LEFT JOIN (SELECT sample, tool, ov.ref, count(*) FILTER (mm.bin IS NULL OR ov.bin <> mm.bin) AS holders FROM ov LEFT JOIN (SELECT sample, tool, ref, bin FROM mt) mm USING (sample, tool, ref) WHERE ov.bp >= 0.018 * length GROUP BY ALL) USING (sample, tool, ref)""", PARTS + matching_text("mt", "SELECT * FROM ov"))
def d16(v: Views) -> DataFrame:
    p = Parts(v)
    out = rec.correct_plasmids(p.overlaps, p.identities, p.chromosome, p.plasmids, p.bins, RUN, 0.01, 0.2, 0.99, 0.018, WEIGHT)
    return r6(out, "coverage", "bin_share", "identity")


OUTCOMES = """,
bst AS (SELECT *, row_number() OVER (PARTITION BY sample, tool, ref ORDER BY bp DESC, bin DESC) AS k, count(*) FILTER (bp >= 0.012 * length) OVER (PARTITION BY sample, tool, ref) AS holders, count(*) FILTER (bp >= 0.012 * length) OVER (PARTITION BY sample, tool, bin) - CASE WHEN bp >= 0.012 * length THEN 1 ELSE 0 END AS others FROM ov),
oc AS (SELECT sample, tool, pm.ref, CASE WHEN b.bp IS NULL OR b.bp < 0.006 * pm.length THEN 'missed' WHEN holders > 1 AND others > 0 THEN 'fragmented_and_merged' WHEN holders > 1 THEN 'fragmented' WHEN others > 0 THEN 'merged' WHEN b.bp >= 0.01 * pm.length AND b.bp >= 0.01 * mapped_bp THEN 'perfect' ELSE 'partial' END AS outcome
FROM pm LEFT JOIN (SELECT * FROM bst JOIN (SELECT sample, tool, bin, mapped_bp FROM bt) USING (sample, tool, bin) WHERE k = 1) b USING (sample, tool, ref))"""


def outcomes(v: Views) -> DataFrame:
    p = Parts(v)
    return rec.outcomes(p.overlaps, p.chromosome, p.plasmids, p.bins, RUN, 0.01, 0.012, 0.006)


@query("d18_outcome_of_each_plasmid", "SELECT sample, tool, ref, outcome FROM oc", PARTS + OUTCOMES)
def d18(v: Views) -> DataFrame:
    return outcomes(v).drop("bin")


@query("d19_agreement_by_run", """
SELECT sample, tool, CAST(n AS BIGINT) AS bp, round(CASE WHEN hr <= 1e-12 AND hc <= 1e-12 THEN 1 WHEN hr <= 1e-12 OR hc <= 1e-12 THEN 0 ELSE least(1, greatest(0, 2 * (hr + hc - hb) / (hr + hc))) END, 6) AS nmi, round(greatest(0, hr + hc - 2 * (hr + hc - hb)), 6) AS vi, round((cp - rp * kp / (n * (n - 1) / 2)) / ((rp + kp) / 2 - rp * kp / (n * (n - 1) / 2)), 6) AS ari FROM (
SELECT sample, tool, n, ln(n) - rl / n AS hr, ln(n) - kl / n AS hc, ln(n) - cl / n AS hb, rp, kp, cp FROM (SELECT sample, tool, sum(x) AS n, sum(x * ln(x)) AS kl, sum(x * (x - 1) / 2) AS kp FROM (SELECT sample, tool, col, CAST(sum(bp) AS DOUBLE) AS x FROM (SELECT sample, tool, col, bp FROM ce UNION ALL SELECT * FROM al) GROUP BY ALL) GROUP BY ALL)
JOIN (SELECT sample, tool, sum(x * ln(x)) AS rl, sum(x * (x - 1) / 2) AS rp FROM (SELECT sample, tool, bin, CAST(sum(bp) AS DOUBLE) AS x FROM ce GROUP BY ALL) GROUP BY ALL) USING (sample, tool) JOIN (SELECT sample, tool, sum(bp * ln(bp)) AS cl, sum(CAST(bp AS DOUBLE) * (bp - 1) / 2) AS cp FROM ce GROUP BY ALL) USING (sample, tool))""", PARTS + """,
ce AS (SELECT sample, tool, bin, CAST(ref AS VARCHAR) AS col, bp FROM ov UNION ALL SELECT sample, tool, bin, 'CHROMOSOME', bp FROM ch), al AS (SELECT sample, tool, CAST(ref AS VARCHAR), length - coalesce(bp, 0) FROM pm LEFT JOIN (SELECT sample, tool, ref, sum(bp) AS bp FROM ov GROUP BY ALL) USING (sample, tool, ref) WHERE length > coalesce(bp, 0))""")
def d19(v: Views) -> DataFrame:
    p = Parts(v)
    return r6(rec.clustering_agreement(p.overlaps, p.chromosome, p.plasmids, RUN), "nmi", "vi", "ari")


JOINS = """jn AS (SELECT sample, tool, qname, tname AS l, rt AS r, rb, gap, gap - (rq - qend) AS drift, CASE WHEN tname <> rt THEN 'inter_replicon_junction' WHEN strand <> rs THEN 'inversion_junction'
WHEN abs(rq - qend) <= 100 AND CASE WHEN strand = '+' THEN e >= tlen - 100 AND r_s <= 100 ELSE s <= 100 AND r_e >= tlen - 100 END THEN 'origin_wrap' WHEN gap < -100 AND gap <= -200 THEN 'tandem_duplication' WHEN gap < -100 THEN 'relocation' WHEN gap - (rq - qend) >= 200 THEN 'reference_deletion' WHEN gap - (rq - qend) <= -200 THEN 'reference_insertion' END AS kind
FROM (SELECT *, CASE WHEN strand = '+' THEN r_s - e ELSE s - r_e END AS gap FROM (SELECT *, lead(qstart) OVER w AS rq, lead(strand) OVER w AS rs, lead(tname) OVER w AS rt, lead(s) OVER w AS r_s, lead(e) OVER w AS r_e, lead(block_length) OVER w AS rb FROM v_retained WINDOW w AS (PARTITION BY sample, tool, qname ORDER BY qstart, qend, tname, s, e, strand, mapq)) WHERE rq IS NOT NULL))"""


@query("d31_block_joins", "SELECT sample, tool, kind, count(*) AS n, CAST(sum(CASE WHEN kind IN ('inter_replicon_junction', 'inversion_junction') THEN rb WHEN kind IN ('tandem_duplication', 'relocation') THEN -gap WHEN kind = 'origin_wrap' THEN 0 ELSE abs(drift) END) AS BIGINT) AS span FROM jn WHERE kind IS NOT NULL GROUP BY ALL", JOINS)
def d31(v: Views) -> DataFrame:
    return rec.block_joins(v.retained, RUN).filter("kind is not null").groupBy(*RUN, "kind").agg(F.count("*").alias("n"), F.sum("span").alias("span"))


@query("d46_perfect_but_rearranged", """
SELECT sample, tool, count(DISTINCT CASE WHEN hit.ref IS NOT NULL THEN oc.ref END) AS touched, count(DISTINCT oc.ref) AS "of" FROM oc LEFT JOIN (SELECT DISTINCT sample, tool, unnest([l, r]) AS ref FROM jn WHERE kind IS NOT NULL AND kind <> 'origin_wrap') hit ON oc.sample = hit.sample AND oc.tool = hit.tool AND oc.ref = hit.ref WHERE outcome IN ('perfect', 'merged') GROUP BY oc.sample, oc.tool""".replace("SELECT sample, tool, count", "SELECT oc.sample, oc.tool, count", 1), PARTS + OUTCOMES + ",\n" + JOINS)
def d46(v: Views) -> DataFrame:
    """Plasmids that one bin holds, and how many of them a discordance touches all the same."""
    whole = outcomes(v).filter("outcome in ('perfect', 'merged')").select(*RUN, "ref")
    return rec.rearranged(whole, rec.block_joins(v.retained, RUN), RUN)


PLACED = PARTS + matching_text("mt", "SELECT * FROM ov") + """,
gp AS (SELECT a.sample, a.tool, g.copy_id, a.qname, greatest(a.s, g.start_pos) AS s, least(a.e, g.end_pos) AS e FROM v_retained a JOIN v_gene g ON a.sample = g.sample AND a.tname = g.sequence_id AND a.s < g.end_pos AND g.start_pos < a.e),""" + islands_text("gr", "gp", "sample, tool, copy_id, qname") + "," + islands_text("ga", "gp", "sample, tool, copy_id") + """,
pl AS (SELECT x.sample, x.tool, g.copy_id, g.sequence_id AS ref, g.gene_class, CASE WHEN a.bp >= 0.25 * len THEN r.qname END AS record, CASE WHEN a.bp >= 0.25 * len AND r.bp >= 0.25 * len THEN b.bin_id END AS bin,
CASE WHEN a.bp IS NULL OR a.bp < 0.25 * len THEN 'not_recovered' WHEN r.bp < 0.25 * len OR b.bin_id IS NULL THEN 'unassigned_contig' WHEN m.ref = g.sequence_id THEN 'correct_plasmid' ELSE 'wrong_plasmid' END AS placement
FROM (SELECT *, greatest(end_pos - start_pos, 1) AS len FROM v_gene) g JOIN (SELECT DISTINCT sample, tool FROM v_retained) x ON x.sample = g.sample LEFT JOIN (SELECT sample, tool, copy_id, sum(e - s) AS bp FROM ga GROUP BY ALL) a ON a.sample = x.sample AND a.tool = x.tool AND a.copy_id = g.copy_id
LEFT JOIN (SELECT sample, tool, copy_id, qname, bp, row_number() OVER (PARTITION BY sample, tool, copy_id ORDER BY bp DESC, qname) AS k FROM (SELECT sample, tool, copy_id, qname, sum(e - s) AS bp FROM gr GROUP BY ALL)) r ON r.k = 1 AND r.sample = x.sample AND r.tool = x.tool AND r.copy_id = g.copy_id
LEFT JOIN v_bins b ON b.sequence_id = r.qname LEFT JOIN mt m ON m.sample = x.sample AND m.tool = x.tool AND m.bin = b.bin_id)"""


def placed(v: Views) -> DataFrame:
    p = Parts(v)
    homes = rec.matched(p.overlaps, RUN, WEIGHT).select(*RUN, "bin", F.col("ref").alias("home"))
    genes = v.v_gene.withColumnRenamed("sequence_id", "ref")
    members = v.v_bins.select(F.col("sequence_id").alias("qname"), F.col("bin_id").alias("bin"))
    return rec.gene_placement(v.retained.select(*RUN, "qname", F.col("tname").alias("ref"), "s", "e"), genes, members, homes, RUN, least=0.25)


@query("d34_placement_of_each_copy", "SELECT sample, tool, copy_id, ref, gene_class, record, bin, placement FROM pl", PLACED)
def d34(v: Views) -> DataFrame:
    return placed(v)


@query("d35_placement_rates_by_class", """
SELECT tool, class, count(*) AS copies, count(*) FILTER (placement <> 'not_recovered') AS recovered, count(*) FILTER (placement = 'correct_plasmid') AS correct_plasmid, count(*) FILTER (placement = 'wrong_plasmid') AS wrong_plasmid, count(*) FILTER (placement = 'unassigned_contig') AS unassigned_contig, round(count(*) FILTER (placement = 'correct_plasmid') / count(*), 6) AS correct_rate
FROM (SELECT *, unnest([gene_class, 'all']) AS class FROM pl) GROUP BY tool, class""", PLACED)
def d35(v: Views) -> DataFrame:
    return r6(rec.class_rates(placed(v)), "correct_rate")
