"""File round trips, provenance rules, placement, multiplicity, robustness and recommendation."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import graph, intervals, ranking, scoring
from tessera.operators.lineage import shared_folder
from tessera.plans.agreement import TOP, table
from tessera.plans.boards import VALS, values
from tessera.plans.coverage import COVERED, OVERLAPS, SWEEP, gene_overlaps, r6
from tessera.plans.registry import query
from tessera.plans.views import Views, islands_text
from tessera.sources import readers

RUN = ["sample", "tool"]


def scratch(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder."""
    root = shared_folder(spark)
    return f"{root}/files-{uuid.uuid4().hex}"


def as_text(df: DataFrame, *columns: str | Column) -> str:
    path = scratch(df.sparkSession)
    df.select(F.concat_ws("\t", *(F.col(c).cast("string") if isinstance(c, str) else c for c in columns)).alias("value")).write.text(path)
    return path


@query("a01_table_scan", "SELECT tool, count(*) AS n, count(f1) AS scored FROM v_scores GROUP BY tool")
def a01(v: Views) -> DataFrame:
    path = scratch(v.spark)
    v.v_scores.select(*RUN, "f1").write.csv(path, sep="\t", header=True)
    return readers.read_table(v.spark, path, ["sample", "tool"]).groupBy("tool").agg(F.count("*").alias("n"), F.count("f1").alias("scored"))


@query("a02_alignment_scan", "SELECT tool, count(*) AS n, CAST(sum(tend - tstart) AS BIGINT) AS bp, count(*) FILTER (is_primary) AS tagged FROM v_aln GROUP BY tool")
def a02(v: Views) -> DataFrame:
    lines = as_text(v.v_aln.withColumn("tag", F.when(F.col("is_primary"), F.concat(F.lit("tp:A:P\t"), F.col("tool"))).otherwise(F.concat(F.lit("tp:A:S\t"), F.col("tool")))), *(c for c, _ in readers.ALIGNMENT), "tag")
    rows = readers.read_alignments(v.spark, lines)
    return rows.groupBy(F.col("tags")[1].alias("tool")).agg(F.count("*").alias("n"), F.sum(F.col("tend") - F.col("tstart")).alias("bp"), F.count_if(F.col("tags")[0] == "tp:A:P").alias("tagged"))


@query("a03_fasta_scan", "SELECT CAST(id AS VARCHAR) AS id, length(sequence) AS length, md5(sequence) AS digest FROM v_seq WHERE length(sequence) > 0")
def a03(v: Views) -> DataFrame:
    path = scratch(v.spark)
    v.v_seq.filter(F.length("sequence") > 0).select(F.concat(F.lit(">"), F.col("id"), F.lit(" "), F.col("source"), F.lit("\n"), F.col("sequence")).alias("value")).write.text(path)
    return readers.read_fasta(v.spark, path).select("id", F.length("sequence").cast("long").alias("length"), F.md5("sequence").alias("digest"))


@query("a05_graph_scan", "SELECT (SELECT count(DISTINCT a) FROM v_edges) AS nodes, (SELECT count(*) FROM v_edges) AS links")
def a05(v: Views) -> DataFrame:
    path = scratch(v.spark)
    nodes = v.v_edges.select("a").distinct().select(F.concat_ws("\t", F.lit("S"), F.col("a").cast("string"), F.lit("ACGT")).alias("value"))
    nodes.union(v.v_edges.select(F.concat_ws("\t", F.lit("L"), F.col("a").cast("string"), F.lit("+"), F.col("b").cast("string"), F.lit("-"), F.lit("0M")))).write.text(path)
    nodes, links = readers.read_graph(v.spark, path, 1)
    one = F.lit(1).alias("one")
    return nodes.agg(F.count("*").alias("nodes")).select("nodes", one).join(links.agg(F.count("*").alias("links")).select("links", one), "one").drop("one")


@query("a06_feature_scan", "SELECT gene_name, count(*) AS n, CAST(sum(end_pos - start_pos) AS BIGINT) AS bp FROM v_gene GROUP BY gene_name")
def a06(v: Views) -> DataFrame:
    name = F.concat(F.lit("name="), F.replace(F.col("gene_name"), F.lit("#"), F.lit("%23")), F.lit(";id="), F.col("copy_id"))
    path = as_text(v.v_gene, F.col("sequence_id").cast("string"), F.lit("x"), F.lit("gene"), (F.col("start_pos") + 1).cast("string"), F.col("end_pos").cast("string"), F.lit("."), "strand", F.lit("."), name)
    rows = readers.read_features(v.spark, path)
    return rows.groupBy(F.col("attributes")["name"].alias("gene_name")).agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("bp"))


@query("a15_guarded_sink", "SELECT sample, tool, correct FROM v_scores")
def a15(v: Views) -> DataFrame:
    path = scratch(v.spark)
    readers.write_table(v.v_scores.select(*RUN, "correct"), path, ["tool", "sample", "correct"])
    return v.spark.read.parquet(path)


@query("a16_partitioned_boards", "SELECT CAST(region AS INT) AS region, tool, round(avg(value), 6) AS mean, CAST(rank() OVER (PARTITION BY region ORDER BY round(avg(value), 9) DESC) AS INT) AS place FROM vals JOIN v_sheet USING (sample) GROUP BY region, tool", VALS)
def a16(v: Views) -> DataFrame:
    rows = values(v).join(v.v_sheet, "sample").groupBy("region", "tool").agg(F.avg("value").alias("mean"))
    path = scratch(v.spark)
    readers.write_boards(r6(ranking.ranked(rows, ["region"], "mean"), "mean"), path, ["region"])
    return v.spark.read.parquet(path)


@query("a12_marker_hits", "SELECT sequence_id, count(*) AS hits, min(start_pos) AS first_start FROM v_gene WHERE end_pos - start_pos >= 500 GROUP BY sequence_id")
def a12(v: Views) -> DataFrame:
    hits = v.v_gene.select(F.col("sequence_id").alias("%SEQUENCE"), F.col("start_pos").alias("START "), F.col("end_pos").alias("End"))
    named = hits.toDF(*(c.strip().upper().lstrip("%#").lower() for c in hits.columns))
    return named.filter(F.col("end") - F.col("start") >= 500).groupBy(F.col("sequence").alias("sequence_id")).agg(F.count("*").alias("hits"), F.min("start").alias("first_start"))


@query("a14_external_evidence", "SELECT CAST(sample AS VARCHAR) AS sample, tool, CAST(correct AS VARCHAR) AS correct, sha256(concat_ws('|', sample, tool, correct)) AS digest, 'published table' AS evidence_source FROM v_scores")
def a14(v: Views) -> DataFrame:
    """A third party's delimited table, archived with each row's digest and its source, and read from the archive."""
    path, archive = scratch(v.spark), scratch(v.spark)
    v.v_scores.select("sample", "tool", "correct").write.csv(path, header=True)
    readers.import_evidence(v.spark, path, archive, "published table", sep=",")
    return v.spark.read.parquet(archive).select("sample", "tool", "correct", "digest", "evidence_source")


@query("b09_sheet_constraints", "SELECT sample AS key, rule FROM (SELECT sample, 'species' AS rule FROM v_sheet WHERE NOT species IN (0, 1, 2) UNION ALL SELECT sample, 'clonal' FROM v_sheet WHERE region > 2 AND clonal_group IS NULL)")
def b09(v: Views) -> DataFrame:
    return readers.violations(v.v_sheet, {"species": F.col("species").isin(0, 1, 2), "clonal": (F.col("region") <= 2) | F.col("clonal_group").isNotNull()}, "sample")


@query("b11_method_classification", "SELECT p_partkey, CASE WHEN regexp_matches(upper(p_type), 'STEEL|COPPER') AND regexp_matches(upper(p_type), 'BRASS|PLATED') THEN 'hybrid' WHEN regexp_matches(upper(p_type), 'STEEL|NICKEL|COPPER|TIN') THEN 'long' ELSE 'unknown' END AS strategy, regexp_matches(upper(p_type), 'POLISHED') AS polished FROM part")
def b11(v: Views) -> DataFrame:
    t = F.upper("p_type")
    strategy = F.when(t.rlike("STEEL|COPPER") & t.rlike("BRASS|PLATED"), "hybrid").when(t.rlike("STEEL|NICKEL|COPPER|TIN"), "long").otherwise("unknown")
    return v.part.select("p_partkey", strategy.alias("strategy"), t.rlike("POLISHED").alias("polished"))


@query("b12_tier_and_grade", "SELECT sample, CASE WHEN clonal_group IS NOT NULL AND region < 3 THEN 1 WHEN region < 3 THEN 2 ELSE 3 END AS tier, CASE WHEN clonal_group IS NULL THEN 'unknown' WHEN species = 0 THEN 'independent' ELSE 'dependent' END AS independence, CASE WHEN clonal_group IS NOT NULL AND region < 3 THEN 'A' WHEN region < 3 THEN 'B' ELSE 'C' END AS grade FROM v_sheet")
def b12(v: Views) -> DataFrame:
    tier = F.when(F.col("clonal_group").isNotNull() & (F.col("region") < 3), 1).when(F.col("region") < 3, 2).otherwise(3)
    independence = F.when(F.col("clonal_group").isNull(), "unknown").when(F.col("species") == 0, "independent").otherwise("dependent")
    return v.v_sheet.withColumn("tier", tier).select("sample", "tier", independence.alias("independence"), F.element_at(F.array(*map(F.lit, "ABC")), F.col("tier")).alias("grade"))


@query("b13_evidence_vector", "SELECT s.sample, coalesce(CAST(s.clonal_group AS VARCHAR), CASE WHEN n > 3 THEN 'inferred' ELSE 'unknown' END) AS clonal, n > 3 AS rich FROM v_sheet s LEFT JOIN (SELECT sample, count(*) AS n FROM v_truth GROUP BY sample) t ON s.sample = t.sample")
def b13(v: Views) -> DataFrame:
    n = v.v_truth.groupBy("sample").agg(F.count("*").alias("n"))
    return v.v_sheet.join(n, "sample", "left").select("sample", F.coalesce(F.col("clonal_group").cast("string"), F.when(F.col("n") > 3, "inferred").otherwise("unknown")).alias("clonal"), (F.col("n") > 3).alias("rich"))


@query("b14_evidence_audit", "SELECT sample, CASE WHEN fails = 0 AND genes >= 50 THEN 'strong' WHEN fails <= 1 THEN 'usable_with_caveats' ELSE 'weak' END AS verdict FROM (SELECT sample, count(*) FILTER (status = 'failed') AS fails FROM v_status GROUP BY sample) JOIN (SELECT sample, count(*) AS genes FROM v_gene GROUP BY sample) USING (sample)")
def b14(v: Views) -> DataFrame:
    fails = v.v_status.groupBy("sample").agg(F.count_if(F.col("status") == "failed").alias("fails"))
    both = fails.join(v.v_gene.groupBy("sample").agg(F.count("*").alias("genes")), "sample")
    return both.select("sample", F.when((F.col("fails") == 0) & (F.col("genes") >= 50), "strong").when(F.col("fails") <= 1, "usable_with_caveats").otherwise("weak").alias("verdict"))


@query("b15_truth_label_flags", "SELECT sequence_id, string_agg(flag, ',' ORDER BY flag) AS flags FROM (SELECT sequence_id, 'large' AS flag FROM v_truth WHERE molecule_type = 'PLASMID' AND length >= 45000 UNION ALL SELECT sequence_id, 'marker_free' FROM v_truth WHERE molecule_type = 'PLASMID' AND sequence_id NOT IN (SELECT sequence_id FROM v_gene WHERE end_pos - start_pos > 700) UNION ALL SELECT sequence_id, 'longer_than_chromosome' FROM v_truth t WHERE molecule_type = 'PLASMID' AND length > (SELECT max(length) FROM v_truth c WHERE c.sample = t.sample AND molecule_type = 'CHROMOSOME')) GROUP BY sequence_id")
def b15(v: Views) -> DataFrame:
    marked = v.v_gene.filter("end_pos - start_pos > 700").select("sequence_id").distinct().withColumn("marked", F.lit(True))
    t = v.v_truth.withColumn("chromosome", F.max(F.when(F.col("molecule_type") == "CHROMOSOME", F.col("length"))).over(Window.partitionBy("sample"))).filter("molecule_type = 'PLASMID'").join(marked, "sequence_id", "left")
    flags = F.array_compact(F.array(F.when(F.col("length") >= 45000, "large"), F.when(F.col("marked").isNull(), "marker_free"), F.when(F.col("length") > F.col("chromosome"), "longer_than_chromosome")))
    return t.select("sequence_id", F.array_join(F.array_sort(flags), ",").alias("flags")).filter("flags <> ''")


@query("b17_label_schemes", "SELECT scheme, value, count(*) AS n, CAST(sum(length) AS BIGINT) AS bp, count(*) FILTER (value <> label) AS differs FROM (SELECT 'label' AS scheme, label AS value, label, length FROM v_contig UNION ALL SELECT 'called', CASE WHEN called THEN 'PLASMID' ELSE 'CHROMOSOME' END, label, length FROM v_contig) GROUP BY ALL")
def b17(v: Views) -> DataFrame:
    both = F.array(F.struct(F.lit("label").alias("scheme"), F.col("label").alias("value")), F.struct(F.lit("called").alias("scheme"), F.when(F.col("called"), "PLASMID").otherwise("CHROMOSOME").alias("value")))
    return v.v_contig.select("label", "length", F.inline(both)).groupBy("scheme", "value").agg(F.count("*").alias("n"), F.sum("length").alias("bp"), F.count_if(F.col("value") != F.col("label")).alias("differs"))


@query("b20_assembly_eligibility", "SELECT sample, bp BETWEEN 400000 AND 500000 AND deep >= 0.3 AS eligible FROM (SELECT sample, sum(length) AS bp, avg(CASE WHEN depth >= 25 THEN 1.0 ELSE 0.0 END) AS deep FROM v_contig GROUP BY sample)")
def b20(v: Views) -> DataFrame:
    per = v.v_contig.groupBy("sample").agg(F.sum("length").alias("bp"), F.avg((F.col("depth") >= 25).cast("double")).alias("deep"))
    return per.select("sample", (F.col("bp").between(400000, 500000) & (F.col("deep") >= 0.3)).alias("eligible"))


@query("b28_setting_ranges", "SELECT l_orderkey % 1000 AS bucket, count(*) AS bad FROM lineitem WHERE l_quantity > 45 OR l_discount > 0.08 GROUP BY ALL")
def b28(v: Views) -> DataFrame:
    limits = {"l_quantity": 45, "l_discount": 0.08}
    bad = F.lit(False)
    for c, most in limits.items():
        bad = bad | (F.col(c) > most)
    return v.lineitem.filter(bad).groupBy((F.col("l_orderkey") % 1000).alias("bucket")).agg(F.count("*").alias("bad"))


@query("b31_letter_grade", "SELECT sample, CASE WHEN m >= 0.8 THEN 'A' WHEN m >= 0.6 THEN 'B' WHEN m >= 0.4 THEN 'C' ELSE 'D' END AS grade FROM (SELECT sample, avg(value) AS m FROM vals GROUP BY sample)", VALS)
def b31(v: Views) -> DataFrame:
    m = values(v).groupBy("sample").agg(F.avg("value").alias("m"))
    return m.select("sample", F.when(F.col("m") >= 0.8, "A").when(F.col("m") >= 0.6, "B").when(F.col("m") >= 0.4, "C").otherwise("D").alias("grade"))


QT = "qq AS (SELECT tool, qname, tname, least(qstart, qend) AS s, greatest(qstart, qend) AS e, matches, block_length FROM v_retained)," + islands_text("qi", "qq", "tool, qname, tname")


@query("c13_best_container", "SELECT tool, qname, tname, bp, round(ident, 6) AS ident FROM (SELECT *, row_number() OVER (PARTITION BY tool, qname ORDER BY bp DESC, round(ident, 9) DESC, tname) AS k FROM (SELECT tool, qname, tname, CAST(sum(e - s) AS BIGINT) AS bp FROM qi GROUP BY ALL) JOIN (SELECT tool, qname, tname, sum(matches) / CAST(sum(block_length) AS DOUBLE) AS ident FROM qq GROUP BY ALL) USING (tool, qname, tname)) WHERE k = 1", QT)
def c13(v: Views) -> DataFrame:
    keys = ["tool", "qname", "tname"]
    q = v.retained.select(*keys, F.least("qstart", "qend").alias("s"), F.greatest("qstart", "qend").alias("e"), "matches", "block_length")
    both = intervals.union_bp(q, keys).join(q.groupBy(*keys).agg((F.sum("matches") / F.sum("block_length")).alias("ident")), keys)
    w = Window.partitionBy("tool", "qname").orderBy(F.desc("bp"), F.desc(F.round("ident", 9)), "tname")
    return r6(both.withColumn("k", F.row_number().over(w)).filter("k = 1").drop("k"), "ident")


@query("c18_two_scheme_ranks", "SELECT tool, round(a, 6) AS mean_all, round(b, 6) AS mean_kept, CAST(rank() OVER (ORDER BY round(a, 9) DESC) AS INT) AS rank_all, CAST(rank() OVER (ORDER BY round(b, 9) DESC) AS INT) AS rank_kept FROM (SELECT tool, avg(value) AS a, avg(CASE WHEN region <> 2 THEN value END) AS b FROM vals JOIN v_sheet USING (sample) GROUP BY tool)", VALS)
def c18(v: Views) -> DataFrame:
    rows = values(v).join(v.v_sheet, "sample").groupBy("tool").agg(F.avg("value").alias("mean_all"), F.avg(F.when(F.col("region") != 2, F.col("value"))).alias("mean_kept")).withColumn("one", F.lit(1))
    rows = ranking.ranked(ranking.ranked(rows, ["one"], "mean_all", "rank_all"), ["one"], "mean_kept", "rank_kept")
    return r6(rows.drop("one"), "mean_all", "mean_kept")


@query("c16_published_join", "SELECT c_custkey, n_name, o.n AS orders FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey WHERE o.n IS NOT NULL")
def c16(v: Views) -> DataFrame:
    own = v.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"))
    return v.customer.join(v.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(own, "c_custkey").select("c_custkey", "n_name", "orders")


@query("d28_cigar_decode", "SELECT tool, CAST(sum(matches) AS BIGINT) AS m, CAST(sum(block_length - matches) AS BIGINT) AS x, round(sum(matches) / CAST(sum(block_length) AS DOUBLE), 6) AS identity FROM v_retained GROUP BY tool")
def d28(v: Views) -> DataFrame:
    text = F.concat(F.col("matches"), F.lit("M"), F.col("block_length") - F.col("matches"), F.lit("X"))
    size = lambda op: F.aggregate(F.regexp_extract_all(text, F.lit(rf"(\d+){op}"), F.lit(1)), F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))
    rows = v.retained.select("tool", size("M").alias("m"), size("X").alias("x"))
    return r6(rows.groupBy("tool").agg(F.sum("m").alias("m"), F.sum("x").alias("x"), (F.sum("m") / F.sum(F.col("m") + F.col("x"))).alias("identity")), "identity")


@query("d29_feature_preservation", "SELECT o.tool, g.gene_class, count(*) AS hit, count(*) FILTER (overlap = end_pos - start_pos) AS whole, round(avg(overlap / CAST(end_pos - start_pos AS DOUBLE)), 6) AS mean_share FROM ovl o JOIN v_gene g ON g.copy_id = o.copy_id AND g.sample = o.sample GROUP BY ALL", OVERLAPS)
def d29(v: Views) -> DataFrame:
    rows = gene_overlaps(v).join(v.v_gene.select("sample", "copy_id", "gene_class", (F.col("end_pos") - F.col("start_pos")).alias("size")), ["sample", "copy_id"])
    return r6(rows.groupBy("tool", "gene_class").agg(F.count("*").alias("hit"), F.count_if(F.col("overlap") == F.col("size")).alias("whole"), F.avg(F.col("overlap") / F.col("size")).alias("mean_share")), "mean_share")


@query("d32_longest_collinear_run", "SELECT tool, qname, CAST(max(bp) AS BIGINT) AS longest FROM (SELECT tool, qname, k, sum(e - s) AS bp FROM (SELECT *, sum(fresh) OVER (PARTITION BY tool, qname ORDER BY qstart, qend, tname, s, e, strand, mapq ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT *, CASE WHEN tname = lag(tname) OVER w AND strand = lag(strand) OVER w THEN 0 ELSE 1 END AS fresh FROM v_retained WINDOW w AS (PARTITION BY tool, qname ORDER BY qstart, qend, tname, s, e, strand, mapq))) GROUP BY ALL) GROUP BY ALL")
def d32(v: Views) -> DataFrame:
    w = Window.partitionBy("tool", "qname").orderBy("qstart", "qend", "tname", "s", "e", "strand", "mapq")
    same = (F.col("tname") == F.lag("tname").over(w)) & (F.col("strand") == F.lag("strand").over(w))
    rows = v.retained.withColumn("fresh", F.when(same, 0).otherwise(1)).withColumn("k", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("tool", "qname", "k").agg(F.sum(F.col("e") - F.col("s")).alias("bp")).groupBy("tool", "qname").agg(F.max("bp").alias("longest"))


@query("d34_gene_placement", "SELECT x.tool, count(*) AS genes, count(*) FILTER (b.bin IS NULL) AS not_recovered, count(*) FILTER (b.ref = g.sequence_id) AS correct_plasmid, count(*) FILTER (b.ref <> g.sequence_id) AS wrong_plasmid FROM v_gene g JOIN (SELECT DISTINCT sample, tool FROM tab) x ON x.sample = g.sample LEFT JOIN (SELECT t.sample, t.tool, t.ref AS gene_ref, t.bin, p.ref FROM (SELECT sample, tool, ref, bin, row_number() OVER (PARTITION BY sample, tool, ref ORDER BY bp DESC, bin) AS k FROM tab) t JOIN tp p ON p.sample = t.sample AND p.tool = t.tool AND p.bin = t.bin AND p.k = 1 WHERE t.k = 1) b ON b.sample = g.sample AND b.tool = x.tool AND b.gene_ref = g.sequence_id GROUP BY x.tool", TOP)
def d34(v: Views) -> DataFrame:
    from tessera.operators.bins import top_reference

    t = table(v)
    holder = t.groupBy(*RUN, F.col("ref").alias("sequence_id")).agg(F.max_by("bin", F.struct("bp", -F.col("bin"))).alias("bin"))
    placed = holder.join(top_reference(t, RUN).select(*RUN, "bin", F.col("ref").alias("home")), [*RUN, "bin"])
    genes = v.v_gene.select("sample", "sequence_id", "copy_id").join(t.select(*RUN).distinct(), "sample").join(placed, [*RUN, "sequence_id"], "left")
    return genes.groupBy("tool").agg(F.count("*").alias("genes"), F.count_if(F.col("bin").isNull()).alias("not_recovered"), F.count_if(F.col("home") == F.col("sequence_id")).alias("correct_plasmid"), F.count_if(F.col("home") != F.col("sequence_id")).alias("wrong_plasmid"))


@query("d39_outcome_matrix", "SELECT tname, CAST(coalesce(sum(CASE WHEN tool = 'A' THEN covered END), 0) AS BIGINT) AS a, CAST(coalesce(sum(CASE WHEN tool = 'N' THEN covered END), 0) AS BIGINT) AS n, CAST(coalesce(sum(CASE WHEN tool = 'R' THEN covered END), 0) AS BIGINT) AS r FROM cov GROUP BY tname", COVERED)
def d39(v: Views) -> DataFrame:
    wide = scoring.covered(v.retained).groupBy("tname").pivot("tool", ["A", "N", "R"]).agg(F.sum("covered"))
    return wide.select("tname", *(F.coalesce(F.col(c), F.lit(0)).alias(c.lower()) for c in "ANR"))


@query("d40_recovery_funnel", "SELECT t.tool, count(*) AS genes, count(o.copy_id) AS touched, count(*) FILTER (o.overlap >= 0.5 * (end_pos - start_pos)) AS recovered, count(*) FILTER (o.overlap = end_pos - start_pos) AS whole FROM v_gene g CROSS JOIN (SELECT DISTINCT tool FROM v_retained) t LEFT JOIN ovl o ON o.tool = t.tool AND o.copy_id = g.copy_id AND o.sample = g.sample GROUP BY t.tool", OVERLAPS)
def d40(v: Views) -> DataFrame:
    every = v.v_gene.select("sample", "copy_id", (F.col("end_pos") - F.col("start_pos")).alias("size"), F.explode(F.array(*map(F.lit, "ANR"))).alias("tool"))
    rows = every.join(gene_overlaps(v), ["tool", "sample", "copy_id"], "left")
    return rows.groupBy("tool").agg(F.count("*").alias("genes"), F.count("overlap").alias("touched"), F.count_if(F.col("overlap") >= 0.5 * F.col("size")).alias("recovered"), F.count_if(F.col("overlap") == F.col("size")).alias("whole"))


@query("d26_candidate_multiplicity", "SELECT tool, CASE WHEN targets > 1 THEN 'chimeric' WHEN plasmid_bp = 0 THEN 'off_target' ELSE 'primary' END AS kind, count(*) AS n, CAST(sum(bp) AS BIGINT) AS bp FROM (SELECT tool, qname, count(DISTINCT tname) AS targets, sum(CASE WHEN molecule_type = 'PLASMID' THEN e - s ELSE 0 END) AS plasmid_bp, sum(e - s) AS bp FROM v_retained a JOIN v_truth t ON a.tname = t.sequence_id GROUP BY ALL) GROUP BY ALL")
def d26(v: Views) -> DataFrame:
    rows = v.retained.join(v.v_truth.select("sequence_id", "molecule_type"), F.col("tname") == F.col("sequence_id")).withColumn("size", F.col("e") - F.col("s"))
    per = rows.groupBy("tool", "qname").agg(F.count_distinct("tname").alias("targets"), F.sum(F.when(F.col("molecule_type") == "PLASMID", F.col("size")).otherwise(0)).alias("plasmid_bp"), F.sum("size").alias("bp"))
    return per.groupBy("tool", F.when(F.col("targets") > 1, "chimeric").when(F.col("plasmid_bp") == 0, "off_target").otherwise("primary").alias("kind")).agg(F.count("*").alias("n"), F.sum("bp").alias("bp"))


@query("e11_in_database_recovery", "SELECT tool, tname % 2 = 0 AS in_database, count(*) AS plasmids, round(avg(covered / CAST(length AS DOUBLE)), 6) AS mean FROM cov JOIN (SELECT sequence_id, length, molecule_type FROM v_truth) t ON tname = sequence_id WHERE molecule_type = 'PLASMID' GROUP BY ALL", COVERED)
def e11(v: Views) -> DataFrame:
    rows = scoring.covered(v.retained).join(v.v_truth.filter("molecule_type = 'PLASMID'").select("sequence_id", "length"), F.col("tname") == F.col("sequence_id"))
    return r6(rows.groupBy("tool", (F.col("tname") % 2 == 0).alias("in_database")).agg(F.count("*").alias("plasmids"), F.avg(F.col("covered") / F.col("length")).alias("mean")), "mean")


@query("e12_recovery_by_feature", "SELECT tool, coalesce(gene_class, 'untyped') AS feature, count(*) AS n, round(avg(c), 6) AS mean, round(quantile_cont(c, 0.5), 6) AS median FROM (SELECT tool, tname, covered / CAST(length AS DOUBLE) AS c FROM cov JOIN (SELECT sequence_id, length, molecule_type FROM v_truth) t ON tname = sequence_id WHERE molecule_type = 'PLASMID') LEFT JOIN (SELECT DISTINCT sequence_id, gene_class FROM v_gene) g ON g.sequence_id = tname GROUP BY ALL", COVERED)
def e12(v: Views) -> DataFrame:
    rows = scoring.covered(v.retained).join(v.v_truth.filter("molecule_type = 'PLASMID'").select(F.col("sequence_id").alias("tname"), "length"), "tname").select("tool", "tname", (F.col("covered") / F.col("length")).alias("c"))
    features = v.v_gene.select(F.col("sequence_id").alias("tname"), F.col("gene_class").alias("feature")).distinct()
    out = rows.join(features, "tname", "left").withColumn("feature", F.coalesce("feature", F.lit("untyped")))
    return r6(out.groupBy("tool", "feature").agg(F.count("*").alias("n"), F.avg("c").alias("mean"), F.percentile("c", F.lit(0.5)).alias("median")), "mean", "median")


@query("e21_stored_agreement_gate", "SELECT tool, count(*) AS pairs, count(*) FILTER (abs(f1 - bin_f1) <= 0.3) AS agree, max(abs(f1 - bin_f1)) <= 0.9 AS passes FROM v_scores WHERE f1 IS NOT NULL GROUP BY tool")
def e21(v: Views) -> DataFrame:
    d = F.abs(F.col("f1") - F.col("bin_f1"))
    return v.v_scores.filter("f1 is not null").groupBy("tool").agg(F.count("*").alias("pairs"), F.count_if(d <= 0.3).alias("agree"), (F.max(d) <= 0.9).alias("passes"))


@query("e26_dataset_row", "SELECT h.sample, species, replicons, plasmid_bp, genes, failed FROM v_sheet h JOIN (SELECT sample, count(*) AS replicons, CAST(sum(CASE WHEN molecule_type = 'PLASMID' THEN length ELSE 0 END) AS BIGINT) AS plasmid_bp FROM v_truth GROUP BY sample) USING (sample) JOIN (SELECT sample, count(*) AS genes FROM v_gene GROUP BY sample) USING (sample) JOIN (SELECT sample, count(*) FILTER (status = 'failed') AS failed FROM v_status GROUP BY sample) USING (sample)")
def e26(v: Views) -> DataFrame:
    t = v.v_truth.groupBy("sample").agg(F.count("*").alias("replicons"), F.sum(F.when(F.col("molecule_type") == "PLASMID", F.col("length")).otherwise(0)).alias("plasmid_bp"))
    return v.v_sheet.select("sample", "species").join(t, "sample").join(v.v_gene.groupBy("sample").agg(F.count("*").alias("genes")), "sample").join(v.v_status.groupBy("sample").agg(F.count_if(F.col("status") == "failed").alias("failed")), "sample")


@query("e32_database_overlap_summary", "SELECT tool, count(*) FILTER (region < 2) AS possible, count(*) FILTER (region >= 2) AS after_date, round(avg(CASE WHEN region >= 2 THEN f1 END), 6) AS mean_after, bool_and(clonal_group IS NULL) AS all_unknown FROM v_scores JOIN v_sheet USING (sample) GROUP BY tool")
def e32(v: Views) -> DataFrame:
    old = F.col("region") < 2
    return r6(v.v_scores.join(v.v_sheet, "sample").groupBy("tool").agg(F.count_if(old).alias("possible"), F.count_if(~old).alias("after_date"), F.avg(F.when(~old, F.col("f1"))).alias("mean_after"), F.bool_and(F.col("clonal_group").isNull()).alias("all_unknown")), "mean_after")


@query("e36_scorecard_assembly", "SELECT tool, round((2 * coalesce(avg(f1), 0) * CASE WHEN count(f1) > 0 THEN 1 ELSE 0 END + avg(bin_f1)) / (2 * CASE WHEN count(f1) > 0 THEN 1 ELSE 0 END + 1), 6) AS score FROM v_scores GROUP BY tool")
def e36(v: Views) -> DataFrame:
    long = v.v_scores.unpivot(RUN, ["f1", "bin_f1"], "metric", "value").groupBy("tool", "metric").agg(F.avg("value").alias("m")).filter("m is not null").withColumn("w", F.when(F.col("metric") == "f1", 2.0).otherwise(1.0))
    return r6(long.groupBy("tool").agg((F.sum(F.col("w") * F.col("m")) / F.sum("w")).alias("score")), "score")


@query("e18_ladder_summary", "SELECT rung, tool, count(*) AS n, round(sum(CAST(round(f1 * 1000) AS BIGINT)) / (1000.0 * count(*)), 6) AS mean FROM v_scores JOIN (SELECT unnest([2, 4, 6]) AS rung) ON correct <= rung WHERE f1 IS NOT NULL GROUP BY ALL")
def e18(v: Views) -> DataFrame:
    """Scores are whole thousandths, so their sum doesn't depend on its order."""
    rows = v.v_scores.filter("f1 is not null").withColumn("rung", F.explode(F.array(*map(F.lit, (2, 4, 6))))).filter("correct <= rung")
    return r6(rows.groupBy("rung", "tool").agg(F.count("*").alias("n"), (F.sum(F.round(F.col("f1") * 1000).cast("long")) / (1000.0 * F.count("*"))).alias("mean")), "mean")


@query("e27_training_rows", "SELECT s.sample, s.tool, round(bin_f1, 6) AS bin_f1, runtime_seconds, size, CASE WHEN f1 >= 0.5 THEN 1 WHEN f1 IS NULL THEN -1 ELSE 0 END AS label FROM v_scores s JOIN v_status t ON s.sample = t.sample AND s.tool = t.tool")
def e27(v: Views) -> DataFrame:
    rows = v.v_scores.join(v.v_status.select(*RUN, "runtime_seconds", "size"), RUN)
    return r6(rows.select(*RUN, "bin_f1", "runtime_seconds", "size", F.when(F.col("f1") >= 0.5, 1).when(F.col("f1").isNull(), -1).otherwise(0).alias("label")), "bin_f1")


@query("i01_header_depth", "SELECT contig, CAST(regexp_extract(h, '(?:cov_|depth=)([0-9.]+)x?', 1) AS DOUBLE) AS depth FROM (SELECT contig, CASE WHEN contig % 2 = 0 THEN 'NODE_' || contig || '_length_' || length || '_cov_' || depth || '.5' ELSE 'c' || contig || ' depth=' || depth || '.25x' END AS h FROM v_contig)")
def i01(v: Views) -> DataFrame:
    even = F.concat(F.lit("NODE_"), F.col("contig"), F.lit("_length_"), F.col("length"), F.lit("_cov_"), F.col("depth"), F.lit(".5"))
    odd = F.concat(F.lit("c"), F.col("contig"), F.lit(" depth="), F.col("depth"), F.lit(".25x"))
    header = F.when(F.col("contig") % 2 == 0, even).otherwise(odd)
    return v.v_contig.select("contig", F.regexp_extract(header, r"(?:cov_|depth=)([0-9.]+)x?", 1).cast("double").alias("depth"))


@query("i06_log_relative_score", "SELECT sample, tool, round(100 * greatest(0, least(1, 1 - log10(greatest(runtime_seconds, 1) / CAST(best AS DOUBLE)) / 2)), 6) AS score FROM (SELECT *, min(greatest(runtime_seconds, 1)) OVER (PARTITION BY sample) AS best FROM v_status)")
def i06(v: Views) -> DataFrame:
    s = F.greatest(F.col("runtime_seconds"), F.lit(1))
    best = F.min(s).over(Window.partitionBy("sample"))
    return r6(v.v_status.select(*RUN, (100 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.log10(s / best) / 2))).alias("score")), "score")


@query("j18_condition_sensitivity", "SELECT a.tool, CAST(rank() OVER (ORDER BY round(x, 9) DESC) AS INT) AS rank_one, CAST(rank() OVER (ORDER BY round(y, 9) DESC) AS INT) AS rank_two FROM (SELECT tool, avg(value) AS x FROM vals JOIN v_sheet USING (sample) WHERE region < 3 GROUP BY tool) a JOIN (SELECT tool, avg(value) AS y FROM vals JOIN v_sheet USING (sample) WHERE region >= 3 GROUP BY tool) b ON a.tool = b.tool", VALS)
def j18(v: Views) -> DataFrame:
    rows = values(v).join(v.v_sheet, "sample")
    x, y = (rows.filter(c).groupBy("tool").agg(F.avg("value").alias(n)) for c, n in (("region < 3", "x"), ("region >= 3", "y")))
    both = x.join(y, "tool").withColumn("one", F.lit(1))
    return ranking.ranked(ranking.ranked(both, ["one"], "x", "rank_one"), ["one"], "y", "rank_two").select("tool", "rank_one", "rank_two")


@query("j19_novelty_gap", "SELECT tool, round(avg(CASE WHEN tname % 2 = 0 THEN c END) - avg(CASE WHEN tname % 2 = 1 THEN c END), 6) AS gap FROM (SELECT tool, tname, covered / CAST(length AS DOUBLE) AS c FROM cov JOIN (SELECT sequence_id, length FROM v_truth) t ON tname = sequence_id) GROUP BY tool", COVERED)
def j19(v: Views) -> DataFrame:
    rows = scoring.covered(v.retained).join(v.v_truth.select(F.col("sequence_id").alias("tname"), "length"), "tname").withColumn("c", F.col("covered") / F.col("length"))
    known = F.col("tname") % 2 == 0
    return r6(rows.groupBy("tool").agg((F.avg(F.when(known, F.col("c"))) - F.avg(F.when(~known, F.col("c")))).alias("gap")), "gap")


@query("m06_leave_taxon_out", "SELECT g.species AS left_out, x.tool, round(avg(value) FILTER (x.species <> g.species), 6) AS train, round(avg(value) FILTER (x.species = g.species), 6) AS held FROM (SELECT DISTINCT species FROM vals JOIN v_sheet USING (sample)) g CROSS JOIN (SELECT * FROM vals JOIN v_sheet USING (sample)) x GROUP BY ALL", VALS)
def m06(v: Views) -> DataFrame:
    held = values(v).join(v.v_sheet, "sample").groupBy(F.col("species").alias("left_out"), "tool").agg(F.avg("value").alias("held"))
    out = ranking.leave_one_out(values(v), v.v_sheet, "species").join(held, ["left_out", "tool"], "left").select("left_out", "tool", F.col("mean").alias("train"), "held")
    return r6(out, "train", "held")


@query("m10_operational_choice", "SELECT h.sample, coalesce(s.tool, o.tool) AS tool, CASE WHEN s.tool IS NOT NULL THEN 'species' ELSE 'overall' END AS scope FROM v_sheet h LEFT JOIN (SELECT species, tool FROM (SELECT species, tool, row_number() OVER (PARTITION BY species ORDER BY round(m, 9) DESC, tool) AS k FROM (SELECT species, tool, avg(value) AS m FROM vals JOIN v_sheet USING (sample) GROUP BY species, tool HAVING count(*) >= 7)) WHERE k = 1) s ON s.species = h.species CROSS JOIN (SELECT tool FROM vals GROUP BY tool ORDER BY round(avg(value), 9) DESC, tool LIMIT 1) o", VALS)
def m10(v: Views) -> DataFrame:
    rows = values(v).join(v.v_sheet, "sample")
    w = Window.partitionBy("species").orderBy(F.desc(F.round("m", 9)), "tool")
    best = rows.groupBy("species", "tool").agg(F.avg("value").alias("m"), F.count("*").alias("n")).filter("n >= 7").withColumn("k", F.row_number().over(w)).filter("k = 1").select("species", F.col("tool").alias("own"))
    all_ = rows.groupBy("tool").agg(F.avg("value").alias("m")).orderBy(F.desc(F.round("m", 9)), "tool").limit(1).select(F.col("tool").alias("overall"), F.lit(1).alias("one"))
    out = v.v_sheet.select("sample", "species", F.lit(1).alias("one")).join(best, "species", "left").join(all_, "one")
    return out.select("sample", F.coalesce("own", "overall").alias("tool"), F.when(F.col("own").isNotNull(), "species").otherwise("overall").alias("scope"))


@query("n01_community_bins")
def n01(v: Views) -> DataFrame:
    """Contigs that the best matching of predicted classes and truth classes puts right, per community."""
    code = lambda c: F.element_at(F.create_map(*(F.lit(x) for k, name in enumerate(("plasmid", "chromosome", "virus")) for x in (name, k))), F.col(c)).cast("long")
    edges = v.v_class.filter("predicted_class is not null").groupBy("community_id", code("predicted_class").alias("left"), code("truth_class").alias("right")).agg(F.count("*").alias("weight"))
    return graph.best_matching(edges, ["community_id"]).groupBy("community_id").agg(F.sum("weight").alias("correct"))


@query("q01_declared_mapping", "SELECT contig AS record_id, CAST(bin_id AS VARCHAR) AS bin, depth / 50.0 AS probability FROM v_contig WHERE called")
def q01(v: Views) -> DataFrame:
    return normalize(v.v_contig, {"record_id": "contig", "bin": "cast(bin_id as string)", "probability": "depth / 50.0D", "where": "called"})


def normalize(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """A user's table as record, bin and probability columns, by a declared mapping of SQL expressions."""
    rows = df.filter(mapping["where"]) if "where" in mapping else df
    return rows.select(*(F.expr(e).alias(k) for k, e in mapping.items() if k != "where"))


@query("f05_micro_curve", "SELECT g.t, CAST(coalesce(sum(tp), 0) AS BIGINT) AS tp, CAST(coalesce(sum(fp), 0) AS BIGINT) AS fp FROM (SELECT a.tool, g.t, max(tp) AS tp, max(fp) AS fp FROM (SELECT DISTINCT tool FROM crv) a CROSS JOIN (SELECT DISTINCT probability AS t FROM v_prob) g LEFT JOIN crv c ON c.tool = a.tool AND c.probability >= g.t GROUP BY ALL) g GROUP BY g.t", SWEEP)
def f05(v: Views) -> DataFrame:
    from tessera.operators import curves
    from tessera.plans.coverage import curve

    return curves.summed_states(curve(v), v.v_prob.select(F.col("probability").alias("t")).distinct(), ["tool"], ["tp", "fp"])


@query("f05_macro_curve", """
SELECT t, count(p) AS with_precision, round(avg(p), 6) AS precision, count(r) AS with_recall, round(avg(r), 6) AS recall FROM (SELECT a.tool, g.t, CASE WHEN coalesce(max(tp), 0) + coalesce(max(fp), 0) > 0 THEN coalesce(max(tp), 0) / CAST(coalesce(max(tp), 0) + coalesce(max(fp), 0) AS DOUBLE) END AS p, CASE WHEN any_value(total) > 0 THEN coalesce(max(tp), 0) / CAST(any_value(total) AS DOUBLE) END AS r
FROM (SELECT tool, max(tp) AS total FROM crv GROUP BY tool) a CROSS JOIN (SELECT DISTINCT probability AS t FROM v_prob) g LEFT JOIN crv c ON c.tool = a.tool AND c.probability >= g.t GROUP BY a.tool, g.t) GROUP BY t""", SWEEP)
def f05_macro(v: Views) -> DataFrame:
    """Mean precision and recall over tools at each threshold, each over the tools that have it; recall is of what the lowest threshold finds."""
    from tessera.operators import curves
    from tessera.plans.coverage import curve

    own = curve(v)
    own = own.join(own.groupBy("tool").agg(F.max("tp").alias("total")), "tool")
    p, r = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))), F.when(F.col("total") > 0, F.col("tp") / F.col("total"))
    own = own.select("tool", "probability", F.coalesce(p, F.lit(0.0)).alias("p"), p.isNotNull().cast("long").alias("with_precision"), F.coalesce(r, F.lit(0.0)).alias("r"))
    tools = own.select("tool").distinct().count()
    rows = curves.summed_states(own, v.v_prob.select(F.col("probability").alias("t")).distinct(), ["tool"], ["p", "with_precision", "r"])
    out = rows.select("t", "with_precision", F.try_divide("p", "with_precision").alias("precision"), F.lit(tools).cast("long").alias("with_recall"), (F.col("r") / tools).alias("recall"))
    return r6(out, "precision", "recall")


@query("j19_gap_with_interval")
def j19_gap(v: Views) -> DataFrame:
    """How much more of circular than of linear plasmids each tool covers, with an interval over studies."""
    from tessera.operators import stats

    truth = v.v_truth.filter("molecule_type = 'PLASMID'").select("sample", F.col("sequence_id").alias("tname"), "length", "is_circular")
    rows = scoring.covered(v.retained).join(truth, ["sample", "tname"]).join(v.v_sheet.select("sample", "study"), "sample").withColumn("c", F.col("covered") / F.col("length"))
    return stats.bootstrap_gap(rows, ["tool"], "study", "c", "is_circular")
