"""Bins, contigs, communities, matching and graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import rates
from tessera.operators import bins, graph, scoring
from tessera.plans.coverage import r6
from tessera.plans.registry import query
from tessera.plans.views import Views, islands_text

BIN = ["sample", "tool", "bin_id"]
BINNED = "ba AS (SELECT a.sample, tool, bin_id, tname, s, e, matches, block_length, qname FROM v_retained a JOIN v_bins b ON a.qname = b.sequence_id)," + islands_text("bi", "ba", "sample, tool, bin_id, tname") + """,
tab AS (SELECT sample, tool, bin_id AS bin, tname AS ref, CAST(sum(e - s) AS BIGINT) AS bp FROM bi GROUP BY ALL)"""


def table(v: Views) -> DataFrame:
    from tessera.operators.intervals import union_bp

    joined = v.retained.join(v.v_bins, F.col("qname") == F.col("sequence_id"))
    return union_bp(joined, [*BIN, "tname"]).select("sample", "tool", F.col("bin_id").alias("bin"), F.col("tname").alias("ref"), "bp")


@query("b05_contig_label_decision", """
SELECT contig, CASE WHEN length < 1000 THEN 'SHORT' WHEN p >= 0.8 AND c >= 0.8 THEN 'AMBIGUOUS' WHEN p >= 0.8 THEN 'PLASMID' WHEN c >= 0.8 THEN 'CHROMOSOME' WHEN p >= 0.3 AND c >= 0.3 AND p + c >= 0.8 THEN 'CHIMERIC' ELSE 'UNPLACED' END AS decision
FROM (SELECT contig, length, CAST(depth % 11 AS DOUBLE) / 10 AS p, CAST(depth % 7 AS DOUBLE) / 6 AS c FROM v_contig)""")
def b05(v: Views) -> DataFrame:
    p, c = (F.col("depth") % 11) / F.lit(10.0), (F.col("depth") % 7) / F.lit(6.0)
    return v.v_contig.select("contig", scoring_label(F.col("length"), p, c).alias("decision"))


def scoring_label(length, p, c, shortest: int = 1000, cover: float = 0.8, segment: float = 0.3):
    """A contig's label from the shares of it that plasmid and chromosome alignments cover; the first that holds."""
    return F.when(length < shortest, "SHORT").when((p >= cover) & (c >= cover), "AMBIGUOUS").when(p >= cover, "PLASMID").when(c >= cover, "CHROMOSOME").when((p >= segment) & (c >= segment) & (p + c >= cover), "CHIMERIC").otherwise("UNPLACED")


@query("b06_banding", "SELECT CASE WHEN length < 2000 THEN 'small' WHEN length < 5000 THEN 'medium' WHEN length IS NULL THEN 'not_recorded' ELSE 'large' END AS size_band, CASE WHEN depth < 10 THEN 'low' WHEN depth < 30 THEN 'mid' ELSE 'high' END AS depth_band, count(*) AS n, CAST(sum(length) AS BIGINT) AS bp FROM v_contig GROUP BY ALL")
def b06(v: Views) -> DataFrame:
    size = F.when(F.col("length") < 2000, "small").when(F.col("length") < 5000, "medium").when(F.col("length").isNull(), "not_recorded").otherwise("large")
    depth = F.when(F.col("depth") < 10, "low").when(F.col("depth") < 30, "mid").otherwise("high")
    return v.v_contig.groupBy(size.alias("size_band"), depth.alias("depth_band")).agg(F.count("*").alias("n"), F.sum("length").alias("bp"))


@query("d12_contig_confusion", """
SELECT sample, count(*) FILTER (label = 'PLASMID' AND called) AS tp, count(*) FILTER (label = 'CHROMOSOME' AND called) AS fp, count(*) FILTER (label = 'PLASMID' AND NOT called) AS fn, count(*) FILTER (label = 'CHROMOSOME' AND NOT called) AS tn,
CAST(sum(CASE WHEN label = 'PLASMID' AND called THEN length ELSE 0 END) AS BIGINT) AS tp_bp, CAST(sum(CASE WHEN label NOT IN ('PLASMID', 'CHROMOSOME') THEN length ELSE 0 END) AS BIGINT) AS excluded_bp FROM v_contig GROUP BY sample""")
def d12(v: Views) -> DataFrame:
    p, c = F.col("label") == "PLASMID", F.col("label") == "CHROMOSOME"
    return v.v_contig.groupBy("sample").agg(F.count_if(p & F.col("called")).alias("tp"), F.count_if(c & F.col("called")).alias("fp"), F.count_if(p & ~F.col("called")).alias("fn"), F.count_if(c & ~F.col("called")).alias("tn"), F.sum(F.when(p & F.col("called"), F.col("length")).otherwise(0)).alias("tp_bp"), F.sum(F.when(~p & ~c, F.col("length")).otherwise(0)).alias("excluded_bp"))


@query("d13_bin_plasmid_overlap", "SELECT sample, tool, bin, ref, bp FROM tab", BINNED)
def d13(v: Views) -> DataFrame:
    return table(v)


@query("d14_splits_and_merges", """
SELECT sample, tool, coalesce(splits, 0) AS splits, coalesce(merges, 0) AS merges FROM (SELECT sample, tool, CAST(sum(k - 1) AS BIGINT) AS splits FROM (SELECT sample, tool, ref, count(*) AS k FROM t2 WHERE bp >= 0.2 * in_ref GROUP BY ALL) GROUP BY ALL)
FULL JOIN (SELECT sample, tool, CAST(sum(k - 1) AS BIGINT) AS merges FROM (SELECT sample, tool, bin, count(*) AS k FROM t2 WHERE bp >= 0.2 * in_bin GROUP BY ALL) GROUP BY ALL) USING (sample, tool)""", BINNED + ", t2 AS (SELECT *, sum(bp) OVER (PARTITION BY sample, tool, bin) AS in_bin, sum(bp) OVER (PARTITION BY sample, tool, ref) AS in_ref FROM tab)")
def d14(v: Views) -> DataFrame:
    return bins.splits_and_merges(table(v), ["sample", "tool"])


TOP = BINNED + ", tp AS (SELECT sample, tool, bin, ref, bp, bin_bp, row_number() OVER (PARTITION BY sample, tool, bin ORDER BY bp DESC, ref) AS k FROM (SELECT *, sum(bp) OVER (PARTITION BY sample, tool, bin) AS bin_bp FROM tab))"


@query("d16_correct_reconstruction", "SELECT tool, count(*) AS bins, count(*) FILTER (bp >= 0.9 * bin_bp) AS pure, count(*) FILTER (bp >= 0.9 * bin_bp AND bp >= 0.01 * length) AS correct FROM tp JOIN (SELECT sequence_id, length FROM v_truth) t ON ref = sequence_id WHERE k = 1 GROUP BY tool", TOP)
def d16(v: Views) -> DataFrame:
    top = bins.top_reference(table(v), ["sample", "tool"]).join(v.v_truth.select("sequence_id", "length"), F.col("ref") == F.col("sequence_id"))
    pure = F.col("bp") >= 0.9 * F.col("bin_bp")
    return top.groupBy("tool").agg(F.count("*").alias("bins"), F.count_if(pure).alias("pure"), F.count_if(pure & (F.col("bp") >= 0.01 * F.col("length"))).alias("correct"))


@query("g02_arg_max_with_ties", "SELECT sample, tool, bin, ref, bp, CAST(bin_bp AS BIGINT) AS bin_bp, round(bp / CAST(bin_bp AS DOUBLE), 6) AS purity FROM tp WHERE k = 1", TOP)
def g02(v: Views) -> DataFrame:
    return r6(bins.top_reference(table(v), ["sample", "tool"]), "purity")


@query("d17_threshold_sweep_and_auc", """
SELECT tool, round(sum((n + ln) / 2.0 * 0.01) / 0.19, 6) AS auc, CAST(max(n) AS BIGINT) AS at_80, CAST(min(n) AS BIGINT) AS at_99 FROM (SELECT tool, t, n, lag(n) OVER (PARTITION BY tool ORDER BY t) AS ln FROM (
SELECT tool, t, count(*) FILTER (100 * bp >= t * bin_bp) AS n FROM tp CROSS JOIN (SELECT unnest(range(80, 100)) AS t) WHERE k = 1 GROUP BY ALL)) GROUP BY tool""", TOP)
def d17(v: Views) -> DataFrame:
    top = bins.top_reference(table(v), ["sample", "tool"]).withColumn("t", F.explode(F.sequence(F.lit(80), F.lit(99))))
    swept = top.groupBy("tool", "t").agg(F.count_if(100 * F.col("bp") >= F.col("t") * F.col("bin_bp")).alias("n"))
    before = F.lag("n").over(Window.partitionBy("tool").orderBy("t"))
    return r6(swept.withColumn("area", (F.col("n") + before) / 2.0 * 0.01).groupBy("tool").agg((F.sum("area") / 0.19).alias("auc"), F.max("n").alias("at_80"), F.min("n").alias("at_99")), "auc")


@query("d18_plasmid_outcomes", """
SELECT tool, outcome, count(*) AS n FROM (SELECT t.sequence_id, x.tool, CASE WHEN best IS NULL THEN 'missed' WHEN holders > 1 AND bins > 1 THEN 'both' WHEN holders > 1 THEN 'fragmented' WHEN bins > 1 THEN 'merged' WHEN best >= 0.1 * length THEN 'perfect' ELSE 'partial' END AS outcome
FROM v_truth t JOIN (SELECT DISTINCT sample, tool FROM tab) x ON x.sample = t.sample LEFT JOIN (SELECT tool, ref, max(bp) AS best, count(*) FILTER (bp >= 0.2 * in_ref) AS holders, max(mates) AS bins FROM (SELECT *, sum(bp) OVER (PARTITION BY sample, tool, ref) AS in_ref, sum(CASE WHEN bp >= 400 THEN 1 ELSE 0 END) OVER (PARTITION BY sample, tool, bin) AS mates FROM tab) GROUP BY ALL) b ON b.tool = x.tool AND b.ref = t.sequence_id
WHERE molecule_type = 'PLASMID') GROUP BY ALL""", BINNED)
def d18(v: Views) -> DataFrame:
    t = table(v)
    t = t.withColumn("in_ref", F.sum("bp").over(Window.partitionBy("sample", "tool", "ref"))).withColumn("mates", F.sum((F.col("bp") >= 400).cast("int")).over(Window.partitionBy("sample", "tool", "bin")))
    per = t.groupBy("tool", "ref").agg(F.max("bp").alias("best"), F.count_if(F.col("bp") >= 0.2 * F.col("in_ref")).alias("holders"), F.max("mates").alias("bins"))
    plasmids = v.v_truth.filter("molecule_type = 'PLASMID'").join(t.select("sample", "tool").distinct(), "sample").withColumnRenamed("sequence_id", "ref").join(per, ["tool", "ref"], "left")
    outcome = F.when(F.col("best").isNull(), "missed").when((F.col("holders") > 1) & (F.col("bins") > 1), "both").when(F.col("holders") > 1, "fragmented").when(F.col("bins") > 1, "merged").when(F.col("best") >= 0.1 * F.col("length"), "perfect").otherwise("partial")
    return plasmids.groupBy("tool", outcome.alias("outcome")).agg(F.count("*").alias("n"))


ENT = BINNED + """,
nn AS (SELECT tool, CAST(sum(bp) AS DOUBLE) AS n FROM tab GROUP BY tool), tb AS (SELECT tool, bin, ref, sum(bp) AS bp FROM tab GROUP BY ALL),
hb AS (SELECT tool, -sum(x / n * ln(x / n)) AS hb, sum(x * (x - 1) / 2) AS pb FROM (SELECT tool, bin, CAST(sum(bp) AS DOUBLE) AS x FROM tb GROUP BY ALL) JOIN nn USING (tool) GROUP BY tool),
hr AS (SELECT tool, -sum(x / n * ln(x / n)) AS hr, sum(x * (x - 1) / 2) AS pr FROM (SELECT tool, ref, CAST(sum(bp) AS DOUBLE) AS x FROM tb GROUP BY ALL) JOIN nn USING (tool) GROUP BY tool),
hc AS (SELECT tool, any_value(n) AS n, -sum(x / n * ln(x / n)) AS hc, sum(x * (x - 1) / 2) AS pc FROM (SELECT tool, CAST(bp AS DOUBLE) AS x FROM tb) JOIN nn USING (tool) GROUP BY tool),
en AS (SELECT *, hb + hr - hc AS mi, pb * pr / (n * (n - 1) / 2) AS chance FROM hc JOIN hb USING (tool) JOIN hr USING (tool))"""


def entropies(v: Views) -> DataFrame:
    pooled = table(v).groupBy("tool", "bin", "ref").agg(F.sum("bp").alias("bp"))
    return bins.entropy_scores(pooled, ["tool"])


@query("d19_nmi_and_vi", "SELECT tool, round(2 * mi / (hb + hr), 6) AS nmi, round(hc - mi, 6) AS vi FROM en", ENT)
def d19(v: Views) -> DataFrame:
    return r6(entropies(v).select("tool", "nmi", "vi"), "nmi", "vi")


@query("d20_adjusted_rand", "SELECT tool, round((pc - chance) / ((pb + pr) / 2 - chance), 6) AS ari FROM en", ENT)
def d20(v: Views) -> DataFrame:
    return r6(entropies(v).select("tool", "ari"), "ari")


@query("d21_homogeneity_completeness", "SELECT tool, round(mi / hr, 6) AS homogeneity, round(mi / hb, 6) AS completeness, round(2 * (mi / hr) * (mi / hb) / (mi / hr + mi / hb), 6) AS v_measure FROM en", ENT)
def d21(v: Views) -> DataFrame:
    return r6(entropies(v).select("tool", "homogeneity", "completeness", "v_measure"), "homogeneity", "completeness", "v_measure")


@query("d22_bin_quality_tiers", "SELECT tool, CASE WHEN bp >= 0.95 * bin_bp AND bp >= 600 THEN 'high' WHEN bp >= 0.7 * bin_bp THEN 'medium' WHEN bp >= 0.3 * bin_bp THEN 'low' ELSE 'spurious' END AS tier, count(*) AS n FROM tp WHERE k = 1 GROUP BY ALL", TOP)
def d22(v: Views) -> DataFrame:
    top = bins.top_reference(table(v), ["sample", "tool"])
    tier = F.when((F.col("bp") >= 0.95 * F.col("bin_bp")) & (F.col("bp") >= 600), "high").when(F.col("bp") >= 0.7 * F.col("bin_bp"), "medium").when(F.col("bp") >= 0.3 * F.col("bin_bp"), "low").otherwise("spurious")
    return top.groupBy("tool", tier.alias("tier")).agg(F.count("*").alias("n"))


CT = "ct AS (SELECT sample, bin_id AS bin, best_plasmid AS ref, CAST(sum(length) AS BIGINT) AS bp FROM v_contig WHERE label = 'PLASMID' GROUP BY ALL)"


@query("d23_best_match_agreement", """
SELECT sample, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1 FROM (SELECT sample, sum(m) / CAST(sum(a) AS DOUBLE) AS p FROM (SELECT sample, bin, max(bp) AS m, sum(bp) AS a FROM ct GROUP BY ALL) GROUP BY sample) JOIN (SELECT sample, sum(m) / CAST(sum(a) AS DOUBLE) AS r FROM (SELECT sample, ref, max(bp) AS m, sum(bp) AS a FROM ct GROUP BY ALL) GROUP BY sample) USING (sample)""", CT)
def d23(v: Views) -> DataFrame:
    t = v.v_contig.filter("label = 'PLASMID'").groupBy("sample", F.col("bin_id").alias("bin"), F.col("best_plasmid").alias("ref")).agg(F.sum("length").alias("bp"))
    return r6(bins.best_match(t, ["sample"]), "precision", "recall", "f1")


@query("d24_bin_dissimilarity", """
SELECT sample, round(extra, 6) AS extra, round(missing, 6) AS missing, round(total, 6) AS total, round(coalesce(split, 0), 6) AS split, round(coalesce(joined, 0), 6) AS joined, round((coalesce(split, 0) + coalesce(joined, 0) + extra + missing) / total, 6) AS dissimilarity
FROM (SELECT sample, sum(CASE WHEN bin IS NOT NULL AND ref IS NULL THEN w ELSE 0 END) AS extra, sum(CASE WHEN bin IS NULL AND ref IS NOT NULL THEN w ELSE 0 END) AS missing, sum(w) AS total FROM mb GROUP BY sample)
LEFT JOIN (SELECT sample, sum(c) AS split FROM (SELECT sample, ref, sum(w) - max(w) AS c FROM (SELECT sample, ref, bin, sum(w) AS w FROM mb WHERE bin IS NOT NULL AND ref IS NOT NULL GROUP BY ALL) GROUP BY ALL) GROUP BY sample) USING (sample)
LEFT JOIN (SELECT sample, sum(c) AS joined FROM (SELECT sample, bin, sum(w) - max(w) AS c FROM (SELECT sample, ref, bin, sum(w) AS w FROM mb WHERE bin IS NOT NULL AND ref IS NOT NULL GROUP BY ALL) GROUP BY ALL) GROUP BY sample) USING (sample)""", "mb AS (SELECT sample, CASE WHEN called THEN bin_id END AS bin, CASE WHEN label = 'PLASMID' THEN best_plasmid END AS ref, pow(length, 0.5) AS w FROM v_contig)")
def d24(v: Views) -> DataFrame:
    members = v.v_contig.select("sample", F.when(F.col("called"), F.col("bin_id")).alias("bin"), F.when(F.col("label") == "PLASMID", F.col("best_plasmid")).alias("ref"), "length")
    return r6(bins.dissimilarity(members, ["sample"]), "extra", "missing", "total", "split", "joined", "dissimilarity")


@query("d27_assembly_adequacy", "SELECT sample, count(*) AS contigs, CAST(sum(length) AS BIGINT) AS bp, round(sum(CASE WHEN label = 'UNPLACED' THEN length ELSE 0 END) / CAST(sum(length) AS DOUBLE), 6) AS unplaced_share, sum(CASE WHEN label = 'UNPLACED' THEN length ELSE 0 END) / CAST(sum(length) AS DOUBLE) <= 0.1 AS adequate FROM v_contig GROUP BY sample")
def d27(v: Views) -> DataFrame:
    share = rates.share(F.sum(F.when(F.col("label") == "UNPLACED", F.col("length")).otherwise(0)), F.sum("length"))
    return r6(v.v_contig.groupBy("sample").agg(F.count("*").alias("contigs"), F.sum("length").alias("bp"), share.alias("unplaced_share"), (share <= 0.1).alias("adequate")), "unplaced_share")


@query("d36_copy_number", """
SELECT sample, bin_id, round(sum(depth * length) / CAST(sum(length) AS DOUBLE), 6) AS bin_depth, round(sum(depth * length) / CAST(sum(length) AS DOUBLE) / any_value(chrom), 6) AS copies, round(log2(sum(depth * length) / CAST(sum(length) AS DOUBLE) / any_value(chrom)), 6) AS log2_copies FROM v_contig JOIN (
SELECT sample, CAST(min(depth) AS DOUBLE) AS chrom FROM (SELECT sample, depth, sum(w) OVER (PARTITION BY sample ORDER BY depth ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY sample) AS total FROM (SELECT sample, depth, sum(length) AS w FROM v_contig WHERE label = 'CHROMOSOME' GROUP BY ALL)) WHERE run >= 0.5 * total GROUP BY sample) USING (sample) WHERE label = 'PLASMID' GROUP BY ALL""")
def d36(v: Views) -> DataFrame:
    from tessera.operators.ranking import weighted_quantile

    chrom = weighted_quantile(v.v_contig.filter("label = 'CHROMOSOME'"), ["sample"], "depth", "length", 0.5).withColumnRenamed("quantile", "chrom")
    per = v.v_contig.filter("label = 'PLASMID'").groupBy("sample", "bin_id").agg((F.sum(F.col("depth") * F.col("length")) / F.sum("length")).alias("bin_depth")).join(chrom, "sample")
    copies = F.col("bin_depth") / F.col("chrom")
    return r6(per.select("sample", "bin_id", "bin_depth", copies.alias("copies"), F.log2(copies).alias("log2_copies")), "bin_depth", "copies", "log2_copies")


@query("d38_presence_prevalence", "SELECT gene_name, count(DISTINCT sequence_id) AS carriers, round(count(DISTINCT sequence_id) / CAST((SELECT count(DISTINCT sequence_id) FROM v_gene) AS DOUBLE), 6) AS share FROM v_gene GROUP BY gene_name")
def d38(v: Views) -> DataFrame:
    all_ = v.v_gene.agg(F.count_distinct("sequence_id").alias("n")).withColumn("one", F.lit(1))
    per = v.v_gene.groupBy("gene_name").agg(F.count_distinct("sequence_id").alias("carriers")).withColumn("one", F.lit(1)).join(all_, "one")
    return r6(per.select("gene_name", "carriers", (F.col("carriers") / F.col("n")).alias("share")), "share")


@query("d37_gene_regions", "SELECT sequence_id, CAST(region AS BIGINT) AS region, min(start_pos) AS s, max(end_pos) AS e, count(*) AS genes FROM (SELECT *, sum(n) OVER (PARTITION BY sequence_id ORDER BY start_pos, end_pos, copy_id ROWS UNBOUNDED PRECEDING) AS region FROM (SELECT *, CASE WHEN start_pos - max(end_pos) OVER (PARTITION BY sequence_id ORDER BY start_pos, end_pos, copy_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 200 THEN 0 ELSE 1 END AS n FROM v_gene)) GROUP BY ALL")
def d37(v: Views) -> DataFrame:
    w = Window.partitionBy("sequence_id").orderBy("start_pos", "end_pos", "copy_id")
    fresh = F.when(F.col("start_pos") - F.max("end_pos").over(w.rowsBetween(Window.unboundedPreceding, -1)) <= 200, 0).otherwise(1)
    marked = v.v_gene.withColumn("n", fresh).withColumn("region", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("sequence_id", "region").agg(F.min("start_pos").alias("s"), F.max("end_pos").alias("e"), F.count("*").alias("genes"))


@query("d30_gene_order", "SELECT * FROM (SELECT sequence_id, copy_id, lead(copy_id) OVER w AS next_copy, lead(strand) OVER w = strand AS same_strand FROM v_gene WINDOW w AS (PARTITION BY sequence_id ORDER BY start_pos, end_pos, copy_id)) WHERE next_copy IS NOT NULL")
def d30(v: Views) -> DataFrame:
    w = Window.partitionBy("sequence_id").orderBy("start_pos", "end_pos", "copy_id")
    return v.v_gene.select("sequence_id", "copy_id", F.lead("copy_id").over(w).alias("next_copy"), (F.lead("strand").over(w) == F.col("strand")).alias("same_strand")).filter("next_copy is not null")


@query("d35_class_rollup", "SELECT coalesce(gene_class, 'all') AS gene_class, count(*) AS genes, CAST(sum(end_pos - start_pos) AS BIGINT) AS bp FROM v_gene GROUP BY GROUPING SETS ((gene_class), ())")
def d35(v: Views) -> DataFrame:
    return v.v_gene.rollup("gene_class").agg(F.count("*").alias("genes"), F.sum(F.col("end_pos") - F.col("start_pos")).alias("bp")).withColumn("gene_class", F.coalesce("gene_class", F.lit("all")))


@query("k02_connected_components", "SELECT node, min(reach) AS component FROM walk GROUP BY node", "und AS (SELECT a, b FROM v_edges UNION SELECT b, a FROM v_edges), nod AS (SELECT a AS node FROM und), walk AS (SELECT node, reach FROM (WITH RECURSIVE r(node, reach) AS (SELECT node, node FROM (SELECT DISTINCT node FROM nod) UNION SELECT r.node, u.b FROM r JOIN und u ON u.a = r.reach) SELECT * FROM r))")
def k02(v: Views) -> DataFrame:
    return graph.connected_components(v.v_edges)


@query("k03_independence_clusters", """
SELECT sample, min(reach) AS cluster FROM (WITH RECURSIVE r(sample, reach) AS (SELECT sample, sample FROM v_sheet UNION SELECT r.sample, y.sample FROM r JOIN v_sheet x ON x.sample = r.reach JOIN v_sheet y ON x.study = y.study OR x.clonal_group = y.clonal_group) SELECT * FROM r) GROUP BY sample""")
def k03(v: Views) -> DataFrame:
    """Samples of a study or a clonal group belong together; keys are nodes below zero."""
    study = v.v_sheet.select(F.col("sample").alias("a"), (F.col("study") + 1_000_000).alias("b"))
    clone = v.v_sheet.filter("clonal_group is not null").select("sample", F.col("clonal_group") + 2_000_000)
    found = graph.connected_components(study.union(clone), v.v_sheet.select(F.col("sample").alias("node")))
    return found.filter("node < 1000000").select(F.col("node").alias("sample"), F.col("component").alias("cluster"))


@query("k06_dead_ends", "SELECT side, count(*) AS dead_ends FROM (SELECT a AS node, 'out' AS side FROM v_edges UNION SELECT a, 'in' FROM v_edges UNION SELECT b, 'out' FROM v_edges UNION SELECT b, 'in' FROM v_edges EXCEPT (SELECT a, 'out' FROM v_edges UNION SELECT b, 'in' FROM v_edges)) GROUP BY side")
def k06(v: Views) -> DataFrame:
    nodes = v.v_edges.select(F.col("a").alias("node")).union(v.v_edges.select("b")).distinct()
    ends = nodes.select("node", F.explode(F.array(F.lit("in"), F.lit("out"))).alias("side"))
    linked = v.v_edges.select(F.col("a").alias("node"), F.lit("out").alias("side")).union(v.v_edges.select("b", F.lit("in"))).distinct()
    return ends.join(linked, ["node", "side"], "left_anti").groupBy("side").agg(F.count("*").alias("dead_ends"))


@query("k07_holdout_groups", "SELECT design, grp, sample FROM (SELECT 'study' AS design, study AS grp, sample FROM v_sheet UNION ALL SELECT 'species', species, sample FROM v_sheet UNION ALL SELECT 'clonal', clonal_group, sample FROM v_sheet) WHERE grp IS NOT NULL")
def k07(v: Views) -> DataFrame:
    return v.v_sheet.select("sample", F.col("study").alias("study"), F.col("species"), F.col("clonal_group").alias("clonal")).unpivot("sample", ["study", "species", "clonal"], "design", "grp").filter("grp is not null").select("design", "grp", "sample")


@query("n02_three_class_scores", """
SELECT community_id, cls, tp, fp, fn, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END, 6) AS f1 FROM (SELECT community_id, cls, count(*) FILTER (truth_class = cls AND predicted_class = cls) AS tp, count(*) FILTER (truth_class <> cls AND predicted_class = cls) AS fp, count(*) FILTER (truth_class = cls AND coalesce(predicted_class, '') <> cls) AS fn
FROM v_class CROSS JOIN (SELECT unnest(['plasmid', 'chromosome', 'virus']) AS cls) GROUP BY ALL)""")
def n02(v: Views) -> DataFrame:
    rows = v.v_class.withColumn("cls", F.explode(F.array(*map(F.lit, ("plasmid", "chromosome", "virus")))))
    t, p = F.col("truth_class") == F.col("cls"), F.coalesce(F.col("predicted_class") == F.col("cls"), F.lit(False))
    out = rows.groupBy("community_id", "cls").agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"))
    return r6(out.withColumn("f1", rates.share(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))), "f1")


@query("n03_conflicting_truth", "SELECT contig_id % 200 AS item, count(DISTINCT truth_class) AS labels FROM v_class GROUP BY ALL HAVING count(DISTINCT truth_class) > 1")
def n03(v: Views) -> DataFrame:
    return v.v_class.groupBy((F.col("contig_id") % 200).alias("item")).agg(F.count_distinct("truth_class").alias("labels")).filter("labels > 1")


@query("j14_cohen_kappa", """
SELECT community_id, round((po - pe) / (1 - pe), 6) AS kappa FROM (SELECT community_id, sum(CASE WHEN truth_class = predicted_class THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS po FROM pr GROUP BY ALL) JOIN (
SELECT community_id, sum(x * y) / CAST(any_value(n) * any_value(n) AS DOUBLE) AS pe FROM (SELECT community_id, truth_class AS c, count(*) AS x FROM pr GROUP BY ALL) JOIN (SELECT community_id, predicted_class AS c, count(*) AS y FROM pr GROUP BY ALL) USING (community_id, c) JOIN (SELECT community_id, count(*) AS n FROM pr GROUP BY ALL) USING (community_id) GROUP BY community_id) USING (community_id)""", "pr AS (SELECT * FROM v_class WHERE predicted_class IS NOT NULL)")
def j14(v: Views) -> DataFrame:
    rows = v.v_class.filter("predicted_class is not null")
    one = rows.groupBy("community_id").agg(F.count("*").alias("n"), F.count_if(F.col("truth_class") == F.col("predicted_class")).alias("same"))
    x, y = (rows.groupBy("community_id", F.col(c).alias("c")).agg(F.count("*").alias(k)) for c, k in (("truth_class", "x"), ("predicted_class", "y")))
    chance = x.join(y, ["community_id", "c"]).groupBy("community_id").agg(F.sum(F.col("x") * F.col("y")).alias("xy"))
    po, pe = F.col("same") / F.col("n"), F.col("xy") / (F.col("n") * F.col("n"))
    return r6(one.join(chance, "community_id").select("community_id", ((po - pe) / (1 - pe)).alias("kappa")), "kappa")


@query("n02_macro_scores", """
SELECT community_id, round(avg(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END), 6) AS macro_f1, round(any_value(uncertain), 6) AS uncertain, round(sum(tp) / any_value(n), 6) AS accuracy FROM (SELECT community_id, cls, count(*) AS n, avg(CASE WHEN predicted_class IS NULL THEN 1.0 ELSE 0.0 END) AS uncertain, count(*) FILTER (truth_class = cls AND predicted_class = cls) AS tp, count(*) FILTER (truth_class <> cls AND predicted_class = cls) AS fp, count(*) FILTER (truth_class = cls AND coalesce(predicted_class, '') <> cls) AS fn
FROM v_class CROSS JOIN (SELECT unnest(['plasmid', 'chromosome', 'virus']) AS cls) GROUP BY ALL) GROUP BY community_id""")
def n02_macro(v: Views) -> DataFrame:
    """Mean F1 of the classes that occur, the share of contigs without a call, and the share called right."""
    per = v.v_class.groupBy("community_id").agg(F.count("*").alias("n"), F.avg(F.col("predicted_class").isNull().cast("double")).alias("uncertain"), F.count_if(F.col("predicted_class") == F.col("truth_class")).alias("right"))
    rows = v.v_class.withColumn("cls", F.explode(F.array(*map(F.lit, ("plasmid", "chromosome", "virus")))))
    t, p = F.col("truth_class") == F.col("cls"), F.coalesce(F.col("predicted_class") == F.col("cls"), F.lit(False))
    macro = rows.groupBy("community_id", "cls").agg(rates.share(2 * F.count_if(t & p), F.count_if(t) + F.count_if(p)).alias("f1")).groupBy("community_id").agg(F.avg("f1").alias("macro_f1"))
    return r6(macro.join(per, "community_id").select("community_id", "macro_f1", "uncertain", (F.col("right") / F.col("n")).alias("accuracy")), "macro_f1", "uncertain", "accuracy")
