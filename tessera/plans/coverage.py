"""Alignments, intervals and base-level scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import rates
from tessera.operators import curves, scoring
from tessera.operators.intervals import islands, overlap_join, sweep, union_bp
from tessera.plans.registry import query
from tessera.plans.views import Views, islands_text

RUN = ["sample", "tool"]
ISLANDS = islands_text("isl", "v_retained", "sample, tool, tname")
COVERED = ISLANDS + ", cov AS (SELECT sample, tool, tname, CAST(sum(e - s) AS BIGINT) AS covered FROM isl GROUP BY ALL)"
COUNTS = COVERED + """,
got AS (SELECT c.sample, tool, CAST(sum(CASE WHEN molecule_type = 'PLASMID' THEN covered ELSE 0 END) AS BIGINT) AS tp, CAST(sum(CASE WHEN molecule_type = 'CHROMOSOME' THEN covered ELSE 0 END) AS BIGINT) AS fp FROM cov c JOIN v_truth t ON c.tname = t.sequence_id GROUP BY ALL),
tot AS (SELECT sample, CAST(sum(CASE WHEN molecule_type = 'PLASMID' THEN length ELSE 0 END) AS BIGINT) AS pl, CAST(sum(CASE WHEN molecule_type = 'CHROMOSOME' THEN length ELSE 0 END) AS BIGINT) AS ch FROM v_truth GROUP BY ALL),
cnt AS (SELECT got.sample, tool, tp, fp, greatest(pl - tp, 0) AS fn, ch - fp AS tn, pl FROM got JOIN tot USING (sample)),
rat AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) END AS p, CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) END AS r FROM cnt)"""


def r6(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("b01_alignment_retention", """
SELECT sample, tool, count(*) AS alignments, count(*) FILTER (NOT is_primary) AS secondary, count(*) FILTER (block_length < 200) AS short,
       count(*) FILTER (CAST(matches AS DOUBLE) / block_length < 0.9) AS unlike, count(*) FILTER (mapq < 20) AS ambiguous,
       count(*) FILTER (CAST(abs(qend - qstart) AS DOUBLE) / qlen < 0.2) AS partial,
       count(*) FILTER (is_primary AND block_length >= 200 AND CAST(matches AS DOUBLE) / block_length >= 0.9 AND mapq >= 20 AND CAST(abs(qend - qstart) AS DOUBLE) / qlen >= 0.2) AS retained
FROM v_aln GROUP BY ALL""")
def b01(v: Views) -> DataFrame:
    return scoring.rejections(v.v_aln)


@query("b02_identity_and_coverage", """
SELECT sample, tool, round(avg(CASE WHEN block_length = 0 THEN 0 ELSE CAST(matches AS DOUBLE) / block_length END), 6) AS mean_identity, round(min(CAST(abs(qend - qstart) AS DOUBLE) / qlen), 6) AS least_coverage
FROM v_aln GROUP BY ALL""")
def b02(v: Views) -> DataFrame:
    return r6(v.v_aln.groupBy(*RUN).agg(F.avg(scoring.identity()).alias("mean_identity"), F.min(scoring.query_coverage()).alias("least_coverage")), "mean_identity", "least_coverage")


@query("b03_coordinate_clip", """
SELECT sample, tool, CAST(sum(greatest(0, least(tend, tstart + 300))) AS BIGINT) AS starts, CAST(sum(least(tlen, greatest(tend, tstart + 300))) AS BIGINT) AS ends FROM v_aln GROUP BY ALL""")
def b03(v: Views) -> DataFrame:
    s, e = scoring.clip("a", "b", "tlen")
    swapped = v.v_aln.select(*RUN, "tlen", F.col("tend").alias("a"), (F.col("tstart") + 300).alias("b"))
    return swapped.groupBy(*RUN).agg(F.sum(s).alias("starts"), F.sum(e).alias("ends"))


@query("b04_input_contradictions", """
SELECT sample, tool, count(*) AS alignments, count(*) FILTER (p.record_id IS NULL) AS unknown_query, count(*) FILTER (t.sequence_id IS NULL) AS unknown_target, count(*) FILTER (t.length <> a.tlen) AS target_length
FROM (SELECT *, CASE WHEN tname % 10 = 0 THEN -tname ELSE tname END AS target FROM v_aln) a LEFT JOIN v_prob p ON a.qname = p.record_id LEFT JOIN (SELECT sequence_id, length FROM v_truth) t ON a.target = t.sequence_id GROUP BY ALL""")
def b04(v: Views) -> DataFrame:
    aln = v.v_aln.withColumn("target", F.when(F.col("tname") % 10 == 0, -F.col("tname")).otherwise(F.col("tname")))
    joined = aln.join(v.v_prob, F.col("qname") == F.col("record_id"), "left").join(v.v_truth.select("sequence_id", "length"), F.col("target") == F.col("sequence_id"), "left")
    return joined.groupBy(*RUN).agg(F.count("*").alias("alignments"), F.count_if(F.col("record_id").isNull()).alias("unknown_query"), F.count_if(F.col("sequence_id").isNull()).alias("unknown_target"), F.count_if(F.col("length") != F.col("tlen")).alias("target_length"))


@query("c01_alignment_truth_join", """
SELECT a.sample, tool, molecule_type, count(*) AS n, CAST(sum(e - s) AS BIGINT) AS bp FROM v_retained a JOIN (SELECT sequence_id, molecule_type FROM v_truth) t ON tname = sequence_id GROUP BY ALL""")
def c01(v: Views) -> DataFrame:
    joined = v.retained.join(v.v_truth.select("sequence_id", "molecule_type"), F.col("tname") == F.col("sequence_id"))
    return joined.groupBy(*RUN, "molecule_type").agg(F.count("*").alias("n"), F.sum(F.col("e") - F.col("s")).alias("bp"))


@query("c02_alignment_bin_join", """
SELECT sample, tool, count(*) FILTER (bin_id IS NOT NULL) AS binned, count(*) FILTER (bin_id IS NULL) AS unbinned, count(DISTINCT bin_id) AS bins FROM v_retained LEFT JOIN v_bins ON qname = sequence_id GROUP BY ALL""")
def c02(v: Views) -> DataFrame:
    joined = v.retained.join(v.v_bins, F.col("qname") == F.col("sequence_id"), "left")
    return joined.groupBy(*RUN).agg(F.count("bin_id").alias("binned"), F.count_if(F.col("bin_id").isNull()).alias("unbinned"), F.count_distinct("bin_id").alias("bins"))


OVERLAPS = ISLANDS + """,
ovl AS (SELECT i.tool, g.sample, g.copy_id, CAST(sum(least(i.e, g.end_pos) - greatest(i.s, g.start_pos)) AS BIGINT) AS overlap FROM isl i JOIN v_gene g ON i.tname = g.sequence_id AND i.s < g.end_pos AND g.start_pos < i.e GROUP BY ALL)"""


def gene_overlaps(v: Views) -> DataFrame:
    isl = islands(v.retained, [*RUN, "tname"]).select("tool", F.col("tname").alias("sequence_id"), F.col("s").alias("rs"), F.col("e").alias("re"))
    genes = v.v_gene.select("sample", "sequence_id", "copy_id", F.col("start_pos").alias("ls"), F.col("end_pos").alias("le"))
    return overlap_join(genes, isl, ["sequence_id"]).groupBy("tool", "sample", "copy_id").agg(F.sum("overlap").alias("overlap"))


@query("c03_interval_overlap_join", "SELECT tool, sample, copy_id, overlap FROM ovl", OVERLAPS)
def c03(v: Views) -> DataFrame:
    return gene_overlaps(v)


@query("c04_flank_coverage", """
SELECT tool, copy_id, side, CAST(sum(least(i.e, f.fe) - greatest(i.s, f.fs)) AS BIGINT) AS bp, round(sum(least(i.e, f.fe) - greatest(i.s, f.fs)) / max(f.fe - f.fs), 6) AS share
FROM isl i JOIN fl f ON i.tname = f.sequence_id AND i.s < f.fe AND f.fs < i.e GROUP BY ALL""", ISLANDS + """,
fl AS (SELECT g.sequence_id, copy_id, 'left' AS side, greatest(0, start_pos - 500) AS fs, start_pos AS fe FROM v_gene g UNION ALL
       SELECT g.sequence_id, copy_id, 'right', end_pos, least(length, end_pos + 500) FROM v_gene g JOIN v_truth t ON g.sequence_id = t.sequence_id)""")
def c04(v: Views) -> DataFrame:
    genes = v.v_gene.join(v.v_truth.select("sequence_id", "length"), "sequence_id")
    sides = F.array(F.struct(F.lit("left").alias("side"), F.greatest(F.lit(0), F.col("start_pos") - 500).alias("ls"), F.col("start_pos").alias("le")), F.struct(F.lit("right").alias("side"), F.col("end_pos").alias("ls"), F.least(F.col("length"), F.col("end_pos") + 500).alias("le")))
    flanks = genes.select("sequence_id", "copy_id", F.inline(sides))
    isl = islands(v.retained, [*RUN, "tname"]).select("tool", F.col("tname").alias("sequence_id"), F.col("s").alias("rs"), F.col("e").alias("re"))
    got = overlap_join(flanks, isl, ["sequence_id"]).groupBy("tool", "copy_id", "side").agg(F.sum("overlap").alias("bp"), (F.sum("overlap") / F.max(F.col("le") - F.col("ls"))).alias("share"))
    return r6(got, "share")


@query("c05_best_block_projection", """
SELECT tool, copy_id, qname, overlap, CAST(floor((greatest(start_pos, s) + least(end_pos, e)) / 2) AS BIGINT) AS mid,
       CASE WHEN strand = '+' THEN qstart + CAST(floor((greatest(start_pos, s) + least(end_pos, e)) / 2) AS BIGINT) - s ELSE qend - (CAST(floor((greatest(start_pos, s) + least(end_pos, e)) / 2) AS BIGINT) - s) END AS query_mid
FROM (SELECT a.*, g.copy_id, g.start_pos, g.end_pos, least(e, end_pos) - greatest(s, start_pos) AS overlap, row_number() OVER (PARTITION BY a.tool, g.copy_id ORDER BY least(e, end_pos) - greatest(s, start_pos) DESC, qname, s, qstart, a.strand, e, mapq) AS n
      FROM v_retained a JOIN v_gene g ON a.tname = g.sequence_id AND s < end_pos AND start_pos < e) WHERE n = 1 AND overlap >= 0.2 * (end_pos - start_pos)""")
def c05(v: Views) -> DataFrame:
    genes = v.v_gene.select("sequence_id", "copy_id", F.col("start_pos").alias("ls"), F.col("end_pos").alias("le"))
    blocks = v.retained.select("tool", "qname", "qstart", "qend", "strand", "mapq", F.col("tname").alias("sequence_id"), F.col("s").alias("rs"), F.col("e").alias("re"))
    best = Window.partitionBy("tool", "copy_id").orderBy(F.desc("overlap"), "qname", "rs", "qstart", "strand", "re", "mapq")
    top = overlap_join(genes, blocks, ["sequence_id"]).withColumn("n", F.row_number().over(best)).filter((F.col("n") == 1) & (F.col("overlap") >= 0.2 * (F.col("le") - F.col("ls"))))
    mid = F.floor((F.greatest("ls", "rs") + F.least("le", "re")) / 2)
    return top.select("tool", "copy_id", "qname", "overlap", mid.alias("mid"), F.when(F.col("strand") == "+", F.col("qstart") + mid - F.col("rs")).otherwise(F.col("qend") - (mid - F.col("rs"))).alias("query_mid"))


@query("d01_interval_union_length", "SELECT sample, tool, tname, covered FROM cov", COVERED)
def d01(v: Views) -> DataFrame:
    return scoring.covered(v.retained)


@query("d01_interval_union_by_cells", "SELECT sample, tool, tname, covered FROM cov", COVERED)
def d01_cells(v: Views) -> DataFrame:
    return islands(v.retained, [*RUN, "tname"], width=5000).groupBy(*RUN, "tname").agg(F.sum(F.col("e") - F.col("s")).alias("covered"))


@query("d02_base_confusion", "SELECT sample, tool, tp, fp, fn, tn, pl AS plasmid_bp FROM cnt", COUNTS)
def d02(v: Views) -> DataFrame:
    return scoring.confusion(v.retained, v.v_truth)


@query("d03_precision_recall_f1", "SELECT sample, tool, tp, fp, fn, tn, pl AS plasmid_bp, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN tp + fn > 0 THEN CASE WHEN coalesce(p, 0) + r = 0 THEN 0 ELSE coalesce(2 * p * r / (p + r), 0) END END, 6) AS f1 FROM rat", COUNTS)
def d03(v: Views) -> DataFrame:
    return r6(scoring.rated(scoring.confusion(v.retained, v.v_truth)), "precision", "recall", "f1")


@query("d04_more_rates", """
SELECT sample, tool, round(CASE WHEN p + r = 0 THEN 0 ELSE 5 * p * r / (4 * p + r) END, 6) AS f2, round(CASE WHEN p + r = 0 THEN 0 ELSE 1.25 * p * r / (0.25 * p + r) END, 6) AS f05,
       round(CASE WHEN CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn) > 0 THEN (CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn) / sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)) END, 6) AS mcc,
       round(CASE WHEN tn + fp > 0 THEN tn / CAST(tn + fp AS DOUBLE) END, 6) AS specificity FROM rat""", COUNTS)
def d04(v: Views) -> DataFrame:
    return r6(scoring.more_rates(scoring.confusion(v.retained, v.v_truth)), "f2", "f05", "mcc", "specificity")


Q_ALL = "q AS (SELECT sample, tool, qname, tname, least(qstart, qend) AS s, greatest(qstart, qend) AS e FROM v_retained), qt AS (SELECT q.* FROM q SEMI JOIN v_truth t ON q.tname = t.sequence_id AND t.molecule_type = 'PLASMID')," + islands_text("ia", "q", "sample, tool, qname") + "," + islands_text("io", "qt", "sample, tool, qname")


@query("d05_query_side_burden", """
SELECT r.sample, r.tool, CAST(sum(least(coalesce(o.bp, 0), length)) AS BIGINT) AS mapped_bp, CAST(sum(least(coalesce(a.bp, 0), length) - least(coalesce(o.bp, 0), length)) AS BIGINT) AS off_truth_bp,
       CAST(sum(length - least(coalesce(a.bp, 0), length)) AS BIGINT) AS unmapped_bp, CAST(sum(length) AS BIGINT) AS predicted_bp
FROM v_record r LEFT JOIN (SELECT sample, tool, qname, sum(e - s) AS bp FROM ia GROUP BY ALL) a ON r.sample = a.sample AND r.tool = a.tool AND r.record_id = a.qname
LEFT JOIN (SELECT sample, tool, qname, sum(e - s) AS bp FROM io GROUP BY ALL) o ON r.sample = o.sample AND r.tool = o.tool AND r.record_id = o.qname GROUP BY ALL""", Q_ALL)
def d05(v: Views) -> DataFrame:
    return scoring.query_burden(v.retained, v.v_truth.filter("molecule_type = 'PLASMID'"), v.v_record)


@query("d06_ambiguous_query_bp", """
SELECT sample, tool, CAST(sum(CASE WHEN pl > 0 AND ch > 0 THEN e - s ELSE 0 END) AS BIGINT) AS ambiguous_bp FROM seg WHERE e IS NOT NULL GROUP BY ALL""", """
q6 AS (SELECT a.sample, tool, qname, least(qstart, qend) AS s, greatest(qstart, qend) AS e, CASE WHEN molecule_type = 'PLASMID' THEN 1 ELSE 0 END AS is_pl FROM v_retained a JOIN v_truth t ON tname = sequence_id),
ev AS (SELECT sample, tool, qname, pos, sum(pl) AS pl, sum(ch) AS ch FROM (SELECT sample, tool, qname, s AS pos, is_pl AS pl, 1 - is_pl AS ch FROM q6 UNION ALL SELECT sample, tool, qname, e, -is_pl, is_pl - 1 FROM q6) GROUP BY ALL),
seg AS (SELECT sample, tool, pos AS s, lead(pos) OVER w AS e, sum(pl) OVER (w ROWS UNBOUNDED PRECEDING) AS pl, sum(ch) OVER (w ROWS UNBOUNDED PRECEDING) AS ch FROM ev WINDOW w AS (PARTITION BY sample, tool, qname ORDER BY pos))""")
def d06(v: Views) -> DataFrame:
    return scoring.ambiguous_bp(v.retained, v.v_truth)


@query("d07_redundant_bp", """
SELECT sample, tool, CAST(sum(raw - covered) AS BIGINT) AS redundant_bp FROM (SELECT sample, tool, tname, sum(e - s) AS raw FROM v_retained SEMI JOIN v_truth t ON tname = t.sequence_id AND molecule_type = 'PLASMID' GROUP BY ALL) JOIN cov USING (sample, tool, tname) GROUP BY ALL""", COVERED)
def d07(v: Views) -> DataFrame:
    return scoring.redundant_bp(v.retained, v.v_truth)


@query("d08_false_positive_records", "SELECT a.sample, tool, count(DISTINCT qname) AS fp_records FROM v_retained a JOIN v_truth t ON tname = sequence_id WHERE molecule_type = 'CHROMOSOME' GROUP BY ALL")
def d08(v: Views) -> DataFrame:
    return scoring.false_positive_records(v.retained, v.v_truth)


COMPLETE = COVERED + """,
tools AS (SELECT DISTINCT sample, tool FROM v_retained),
cpl AS (SELECT t.sample, tool, sequence_id, length, is_circular, coalesce(covered, 0) AS covered, coalesce(covered, 0) / CAST(length AS DOUBLE) AS c FROM v_truth t JOIN tools USING (sample) LEFT JOIN cov USING (sample, tool) WHERE molecule_type = 'PLASMID' AND (tname = sequence_id OR tname IS NULL)),
cpl2 AS (SELECT t.sample, t2.tool, t.sequence_id, t.length, is_circular, coalesce(covered, 0) AS covered, coalesce(covered, 0) / CAST(length AS DOUBLE) AS c FROM v_truth t JOIN tools t2 ON t.sample = t2.sample LEFT JOIN cov ON cov.sample = t.sample AND cov.tool = t2.tool AND cov.tname = t.sequence_id WHERE molecule_type = 'PLASMID')"""


@query("d09_plasmid_completeness", "SELECT sample, tool, sequence_id, length, is_circular, covered, round(c, 6) AS completeness, c >= 0.9 AS recovered, c >= 0.5 AS half, is_circular AND c >= 0.99995 AS complete_circular FROM cpl2", COMPLETE)
def d09(v: Views) -> DataFrame:
    return r6(scoring.completeness(v.retained, v.v_truth), "completeness")


@query("d10_gene_recovery", """
SELECT t.sample, t.tool, count(*) AS genes, count(*) FILTER (coalesce(overlap, 0) / CAST(end_pos - start_pos AS DOUBLE) >= 0.5) AS recovered
FROM v_gene g JOIN (SELECT DISTINCT sample, tool FROM v_retained) t ON g.sample = t.sample LEFT JOIN ovl o ON o.tool = t.tool AND o.copy_id = g.copy_id GROUP BY ALL""", OVERLAPS)
def d10(v: Views) -> DataFrame:
    return scoring.gene_recovery(v.retained, v.v_gene, 0.5)


@query("d11_recall_ceiling", """
SELECT tool, (SELECT CAST(sum(e - s) AS BIGINT) FROM gi) AS scorable_bp, CAST(sum(least(i.e, g.e) - greatest(i.s, g.s)) AS BIGINT) AS hit_bp, round(sum(least(i.e, g.e) - greatest(i.s, g.s)) / CAST((SELECT sum(e - s) FROM gi) AS DOUBLE), 6) AS ceiling_recall
FROM gi g JOIN isl i ON i.tname = g.sequence_id AND i.s < g.e AND g.s < i.e GROUP BY tool""", ISLANDS + ", gs AS (SELECT sequence_id, start_pos AS s, end_pos AS e FROM v_gene)," + islands_text("gi", "gs", "sequence_id"))
def d11(v: Views) -> DataFrame:
    scorable = islands(v.v_gene, ["sequence_id"], "start_pos", "end_pos")
    isl = islands(v.retained, [*RUN, "tname"]).select("tool", F.col("tname").alias("sequence_id"), F.col("s").alias("rs"), F.col("e").alias("re"))
    hit = overlap_join(scorable.select("sequence_id", F.col("s").alias("ls"), F.col("e").alias("le")), isl, ["sequence_id"]).groupBy("tool").agg(F.sum("overlap").alias("hit_bp"))
    total = scorable.agg(F.sum(F.col("e") - F.col("s")).alias("scorable_bp"))
    tools = v.retained.select("tool").distinct()
    out = tools.join(hit, "tool", "left").withColumn("one", F.lit(1)).join(total.withColumn("one", F.lit(1)), "one").drop("one").withColumn("hit_bp", F.coalesce("hit_bp", F.lit(0)))
    return r6(out.withColumn("ceiling_recall", F.col("hit_bp") / F.col("scorable_bp")), "ceiling_recall").select("tool", "scorable_bp", "hit_bp", "ceiling_recall")


@query("d42_coverage_depth_segments", "SELECT tname, s, e, depth FROM dseg WHERE e IS NOT NULL AND e > s", """
dev AS (SELECT tname, pos, sum(d) AS d FROM (SELECT tname, s AS pos, 1 AS d FROM v_retained UNION ALL SELECT tname, e, -1 FROM v_retained UNION ALL SELECT sequence_id, 0, 0 FROM v_truth UNION ALL SELECT sequence_id, length, 0 FROM v_truth) GROUP BY ALL),
dseg AS (SELECT tname, pos AS s, lead(pos) OVER (PARTITION BY tname ORDER BY pos) AS e, CAST(sum(d) OVER (PARTITION BY tname ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM dev)""")
def d42(v: Views) -> DataFrame:
    whole = v.v_truth.select(F.col("sequence_id").alias("tname"), F.lit(0).cast("long").alias("s"), F.col("length").cast("long").alias("e"), F.lit(0).alias("d"))
    every = v.retained.select("tname", F.col("s").cast("long"), F.col("e").cast("long"), F.lit(1).alias("d")).union(whole)
    return sweep(every, ["tname"], {"depth": F.col("d")})


@query("d46_gaps_and_longest", """
SELECT sample, tool, count(*) AS gaps, CAST(sum(gap) AS BIGINT) AS gap_bp, CAST(max(gap) AS BIGINT) AS longest FROM (SELECT sample, tool, lead(s) OVER (PARTITION BY sample, tool, tname ORDER BY s) - e AS gap FROM isl) WHERE gap > 0 GROUP BY ALL""", ISLANDS)
def d28_gaps(v: Views) -> DataFrame:
    order = Window.partitionBy(*RUN, "tname").orderBy("s")
    gaps = islands(v.retained, [*RUN, "tname"]).withColumn("gap", F.lead("s").over(order) - F.col("e")).filter("gap > 0")
    return gaps.groupBy(*RUN).agg(F.count("*").alias("gaps"), F.sum("gap").alias("gap_bp"), F.max("gap").alias("longest"))


@query("d45_block_arrangement", """
SELECT tool, qname, count(*) AS blocks, count(*) - 1 AS breakpoints, count(*) FILTER (strand = '-') AS reversed, count(DISTINCT tname) AS targets FROM v_retained GROUP BY ALL HAVING count(*) > 1""")
def d45(v: Views) -> DataFrame:
    return v.retained.groupBy("tool", "qname").agg(F.count("*").alias("blocks"), (F.count("*") - 1).alias("breakpoints"), F.count_if(F.col("strand") == "-").alias("reversed"), F.count_distinct("tname").alias("targets")).filter("blocks > 1")


@query("d31_structural_events", """
SELECT tool, kind, count(*) AS n FROM (SELECT tool, CASE WHEN tname <> lead(tname) OVER w THEN 'inter_replicon' WHEN strand <> lead(strand) OVER w THEN 'inversion' WHEN abs((lead(s) OVER w - e) - (lead(qstart) OVER w - qend)) > 1000 THEN 'relocation' END AS kind
FROM v_retained WINDOW w AS (PARTITION BY tool, qname ORDER BY qstart, qend, tname, s, e, strand, mapq)) WHERE kind IS NOT NULL GROUP BY ALL""")
def d31(v: Views) -> DataFrame:
    w = Window.partitionBy("tool", "qname").orderBy("qstart", "qend", "tname", "s", "e", "strand", "mapq")
    shift = F.abs((F.lead("s").over(w) - F.col("e")) - (F.lead("qstart").over(w) - F.col("qend")))
    kind = F.when(F.col("tname") != F.lead("tname").over(w), "inter_replicon").when(F.col("strand") != F.lead("strand").over(w), "inversion").when(shift > 1000, "relocation")
    return v.retained.select("tool", kind.alias("kind")).filter("kind is not null").groupBy("tool", "kind").agg(F.count("*").alias("n"))


@query("h04_footprint_jaccard", """
SELECT a, b, CAST(sum(both_bp) AS BIGINT) AS both_bp, round(sum(both_bp) / CAST(sum(either_bp) AS DOUBLE), 6) AS jaccard FROM (
SELECT x.tool AS a, y.tool AS b, CASE WHEN f.d1 AND f.d2 THEN 1 ELSE 0 END * bp AS both_bp, CASE WHEN f.d1 OR f.d2 THEN 1 ELSE 0 END * bp AS either_bp
FROM (SELECT DISTINCT tool FROM v_retained) x JOIN (SELECT DISTINCT tool FROM v_retained) y ON x.tool < y.tool CROSS JOIN LATERAL (SELECT list_contains(tools, x.tool) AS d1, list_contains(tools, y.tool) AS d2, bp FROM tseg) f) GROUP BY ALL""", ISLANDS + """,
pts AS (SELECT DISTINCT tname, p FROM (SELECT tname, s AS p FROM isl UNION ALL SELECT tname, e FROM isl)),
el AS (SELECT tname, p AS s, lead(p) OVER (PARTITION BY tname ORDER BY p) AS e FROM pts),
tseg AS (SELECT el.tname, el.s, any_value(el.e - el.s) AS bp, list(DISTINCT i.tool) AS tools FROM el JOIN isl i ON i.tname = el.tname AND i.s <= el.s AND i.e >= el.e WHERE el.e IS NOT NULL GROUP BY el.tname, el.s)""")
def h04(v: Views) -> DataFrame:
    isl = islands(v.retained, ["tool", "tname"])
    own = isl.groupBy("tool").agg(F.sum(F.col("e") - F.col("s")).alias("bp"))
    left, right = isl.select(F.col("tool").alias("a"), "tname", F.col("s").alias("ls"), F.col("e").alias("le")), isl.select(F.col("tool").alias("b"), "tname", F.col("s").alias("rs"), F.col("e").alias("re"))
    both = overlap_join(left, right, ["tname"]).filter("a < b").groupBy("a", "b").agg(F.sum("overlap").alias("both_bp"))
    out = both.join(own.select(F.col("tool").alias("a"), F.col("bp").alias("a_bp")), "a").join(own.select(F.col("tool").alias("b"), F.col("bp").alias("b_bp")), "b")
    return r6(out.select("a", "b", "both_bp", (F.col("both_bp") / (F.col("a_bp") + F.col("b_bp") - F.col("both_bp"))).alias("jaccard")), "jaccard")


SWEEP = """
scored AS (SELECT tool, tname, s, e, probability, molecule_type FROM v_retained a JOIN v_prob p ON a.qname = p.record_id JOIN v_truth t ON a.tname = t.sequence_id),
spt AS (SELECT DISTINCT tool, tname, p FROM (SELECT tool, tname, s AS p FROM scored UNION ALL SELECT tool, tname, e FROM scored)),
sel AS (SELECT tool, tname, p AS s, lead(p) OVER (PARTITION BY tool, tname ORDER BY p) AS e FROM spt),
smx AS (SELECT sel.tool, sel.tname, sel.s, any_value(sel.e - sel.s) AS bp, max(probability) AS probability, any_value(molecule_type) AS molecule_type FROM sel JOIN scored c ON c.tool = sel.tool AND c.tname = sel.tname AND c.s <= sel.s AND c.e >= sel.e WHERE sel.e IS NOT NULL GROUP BY sel.tool, sel.tname, sel.s),
stp AS (SELECT tool, probability, sum(CASE WHEN molecule_type = 'PLASMID' THEN bp ELSE 0 END) AS tp, sum(CASE WHEN molecule_type = 'CHROMOSOME' THEN bp ELSE 0 END) AS fp FROM smx GROUP BY ALL),
crv AS (SELECT tool, probability, CAST(sum(tp) OVER w AS BIGINT) AS tp, CAST(sum(fp) OVER w AS BIGINT) AS fp FROM stp WINDOW w AS (PARTITION BY tool ORDER BY probability DESC ROWS UNBOUNDED PRECEDING)),
tpl AS (SELECT CAST(sum(length) AS BIGINT) AS total FROM v_truth WHERE molecule_type = 'PLASMID'),
prc AS (SELECT tool, probability, tp, fp, total - tp AS fn, tp / CAST(tp + fp AS DOUBLE) AS p, tp / CAST(total AS DOUBLE) AS r FROM crv CROSS JOIN tpl)"""


def curve(v: Views) -> DataFrame:
    kept = v.retained.join(v.v_prob, F.col("qname") == F.col("record_id")).join(v.v_truth.select("sequence_id", "molecule_type"), F.col("tname") == F.col("sequence_id"))
    return curves.threshold_sweep(kept, v.v_truth, ["tool"])


@query("f02_pr_threshold_sweep", "SELECT tool, probability, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall FROM prc", SWEEP)
def f02(v: Views) -> DataFrame:
    return r6(curve(v), "precision", "recall")


@query("f03_curve_areas", """
SELECT tool, round(sum((r - coalesce(lr, 0)) * (p + coalesce(lp, 1)) / 2), 6) AS auc, round(sum((r - coalesce(lr, 0)) * p), 6) AS average_precision
FROM (SELECT *, lag(r) OVER w AS lr, lag(p) OVER w AS lp FROM prc WINDOW w AS (PARTITION BY tool ORDER BY probability DESC)) GROUP BY tool""", SWEEP)
def f03(v: Views) -> DataFrame:
    return r6(curves.areas(curve(v), ["tool"]), "auc", "average_precision")


@query("f04_f_optimal_point", "SELECT tool, probability, round(2 * p * r / (p + r), 6) AS f1 FROM (SELECT *, row_number() OVER (PARTITION BY tool ORDER BY 2 * p * r / (p + r) DESC, probability DESC) AS n FROM prc WHERE p + r > 0) WHERE n = 1", SWEEP)
def f04(v: Views) -> DataFrame:
    return r6(curves.f_optimal(curve(v), ["tool"]), "f1")


SAMPLE_SWEEP = SWEEP.replace("scored AS (SELECT tool,", "scored AS (SELECT t.sample || ':' || tool AS tool,")


@query("c08_state_at_threshold", "SELECT a.tool, g.t, CAST(coalesce(max(tp), 0) AS BIGINT) AS tp, CAST(coalesce(max(fp), 0) AS BIGINT) AS fp FROM (SELECT DISTINCT tool FROM crv) a CROSS JOIN (SELECT DISTINCT probability AS t FROM v_prob) g LEFT JOIN crv c ON c.tool = a.tool AND c.probability >= g.t GROUP BY ALL", SWEEP)
def c08(v: Views) -> DataFrame:
    return curves.states(curve(v), v.v_prob.select(F.col("probability").alias("t")).distinct(), ["tool"])


@query("j15_calibration", """
SELECT bin, CAST(sum(w) AS BIGINT) AS bp, round(sum(w * probability) / sum(w), 6) AS mean_p, round(sum(w * y) / sum(w), 6) AS mean_y, round(sum(w * (probability - y) * (probability - y)) / sum(w), 6) AS brier
FROM (SELECT probability, least(CAST(floor(probability * 10) AS BIGINT), 9) AS bin, w, y FROM v_prob p JOIN (SELECT qname, sum(e - s) AS w, sum(CASE WHEN molecule_type = 'PLASMID' THEN e - s ELSE 0 END) / CAST(sum(e - s) AS DOUBLE) AS y FROM v_retained a JOIN v_truth t ON a.tname = t.sequence_id GROUP BY qname) l ON p.record_id = l.qname) GROUP BY bin""")
def j15(v: Views) -> DataFrame:
    return r6(curves.calibration(v.retained, v.v_prob, v.v_truth), "mean_p", "mean_y", "brier")


@query("j15_expected_error", """
SELECT round(sum(bp * abs(mp - my)) / sum(bp), 6) AS expected_error, round(max(abs(mp - my)), 6) AS largest_error, round(sum(bp * brier) / sum(bp), 6) AS brier, CAST(sum(bp) AS BIGINT) AS bp FROM (SELECT least(CAST(floor(probability * 10) AS BIGINT), 9) AS bin, sum(w) AS bp, sum(w * probability) / sum(w) AS mp, sum(w * y) / sum(w) AS my, sum(w * (probability - y) * (probability - y)) / sum(w) AS brier
FROM v_prob p JOIN (SELECT qname, sum(e - s) AS w, sum(CASE WHEN molecule_type = 'PLASMID' THEN e - s ELSE 0 END) / CAST(sum(e - s) AS DOUBLE) AS y FROM v_retained a JOIN v_truth t ON a.tname = t.sequence_id GROUP BY qname) l ON p.record_id = l.qname GROUP BY bin)""")
def j15_error(v: Views) -> DataFrame:
    return r6(curves.expected_error(curves.calibration(v.retained, v.v_prob, v.v_truth)), "expected_error", "largest_error", "brier")
