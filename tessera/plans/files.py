"""Files that Spark writes from the views, read back by the library's readers with what they check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.coverage import r6
from tessera.plans.more import scratch
from tessera.plans.registry import query
from tessera.plans.views import Views
from tessera.sources import readers

RUN = ["sample", "tool"]


def headed(v: Views, df: DataFrame) -> str:
    path = scratch(v.spark)
    df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns)).write.csv(path, sep="\t", header=True)
    return path


@query("a03_wanted_records", "SELECT CAST(id AS VARCHAR) AS id, source AS note, md5(sequence) AS digest FROM v_seq WHERE length(sequence) > 0 AND id IN (SELECT doc_id FROM labels)")
def a03(v: Views) -> DataFrame:
    path = scratch(v.spark)
    v.v_seq.filter(F.length("sequence") > 0).select(F.concat(F.lit(">"), F.col("id"), F.lit(" "), F.col("source"), F.lit("\n"), F.col("sequence")).alias("value")).write.text(path)
    records = readers.one_of_each(readers.read_fasta(v.spark, path))
    found = readers.wanted(records, v.labels.select(F.col("doc_id").cast("string").alias("id")))
    return found.select("id", F.split("header", " ")[1].alias("note"), F.md5("sequence").alias("digest"))


@query("a07_json_lines", "SELECT event_id % 2 AS spelling, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users, 0 AS bad FROM events GROUP BY ALL UNION ALL SELECT NULL, count(DISTINCT user_id), NULL, CAST(count(DISTINCT user_id) AS BIGINT) FROM events")
def a07(v: Views) -> DataFrame:
    """Objects of two spellings, and a broken line for each user."""
    e = v.events
    even = F.to_json(F.struct(F.col("event_id").alias("eventId"), F.col("user_id").alias("userId"), "event_type"))
    odd = F.to_json(F.struct("event_id", "user_id", F.col("event_type").alias("eventType")))
    broken = e.select("user_id").distinct().select(F.concat(F.lit('{"user_id": '), F.col("user_id"), F.lit(', "event')).alias("value"))
    path = scratch(v.spark)
    e.select(F.when(F.col("event_id") % 2 == 0, even).otherwise(odd).alias("value")).union(broken).write.text(path)
    rows = readers.json_lines(v.spark, path, {"event_id": ("event_id", "eventId"), "user_id": ("user_id", "userId"), "event_type": ("event_type", "eventType")})
    rows = rows.withColumn("spelling", F.when(~F.col("bad"), F.col("event_id").cast("long") % 2))
    return rows.groupBy("spelling").agg(F.count("*").alias("n"), F.sum(F.when(~F.col("bad"), F.col("user_id").cast("long"))).alias("users"), F.count_if("bad").alias("bad"))


@query("a09_bin_members", "SELECT bin_id, count(*) AS n, CAST(sum(sequence_id) AS BIGINT) AS ids FROM v_bins GROUP BY bin_id")
def a09(v: Views) -> DataFrame:
    rows = readers.read_members(v.spark, headed(v, v.v_bins.select("sequence_id", "bin_id")))
    return rows.groupBy(F.col("bin_id").cast("long").alias("bin_id")).agg(F.count("*").alias("n"), F.sum(F.col("sequence_id").cast("long")).alias("ids"))


@query("a10_probability_table", "SELECT CAST(coalesce(p.record_id, b.sequence_id) AS VARCHAR) AS record_id, CASE WHEN p.record_id IS NULL THEN 'missing' ELSE 'extra' END AS problem FROM v_prob p FULL JOIN v_bins b ON p.record_id = b.sequence_id WHERE p.record_id IS NULL OR b.sequence_id IS NULL")
def a10(v: Views) -> DataFrame:
    rows = readers.read_probabilities(v.spark, headed(v, v.v_prob))
    return readers.probability_problems(rows, v.v_bins.select(F.col("sequence_id").cast("string").alias("record_id")))


@query("a12_hit_tables", """
SELECT CAST(sequence_id AS VARCHAR) AS sequence_id, program, count(*) AS hits, CAST(sum(end_pos - start_pos) AS BIGINT) AS bp FROM (SELECT *, unnest(['one', 'two']) AS program FROM v_gene) WHERE (end_pos - start_pos) % 100 >= 40 GROUP BY ALL""")
def a12(v: Views) -> DataFrame:
    """Two programs' tables of one set of genes: their own headings, one with percent signs; hits under 40 % identity stay out."""
    g = v.v_gene.withColumn("share", (F.col("end_pos") - F.col("start_pos")) % 100)
    one = g.select(F.col("sequence_id").alias("#SEQUENCE"), (F.col("start_pos") + 1).alias("START"), F.col("end_pos").alias("END"), F.col("gene_name").alias("GENE"), F.concat("share", F.lit("%")).alias("%IDENTITY"))
    two = g.select(F.col("sequence_id").alias("Contig id"), F.col("end_pos").alias("Start"), (F.col("start_pos") + 1).alias("Stop"), F.col("gene_name").alias("Element symbol"), F.col("share").alias("% Identity to reference"))
    rows = [readers.read_hits(v.spark, headed(v, t), "gene", name, least_identity=40) for name, t in (("one", one), ("two", two))]
    return rows[0].union(rows[1]).groupBy("sequence_id", F.col("source").alias("program")).agg(F.count("*").alias("hits"), F.sum(F.col("end") - F.col("start")).alias("bp"))


@query("a13_interval_table", "SELECT g.copy_id AS key, CASE WHEN t.length IS NULL THEN 'unknown' ELSE 'range' END AS problem FROM v_gene g LEFT JOIN (SELECT sequence_id, length - 1000 AS length FROM v_truth WHERE is_circular) t ON g.sequence_id = t.sequence_id WHERE t.length IS NULL OR end_pos > length")
def a13(v: Views) -> DataFrame:
    """Genes against the circular sequences, each without its last thousand bases."""
    genes = headed(v, v.v_gene.select("copy_id", "sequence_id", "start_pos", "end_pos"))
    rows = readers.read_table(v.spark, genes, ["sequence_id", "start_pos", "end_pos"]).select(*(F.col(c).cast("long").alias(k) for c, k in (("copy_id", "key"), ("sequence_id", "sequence_id"), ("start_pos", "start"), ("end_pos", "end"))))
    return readers.interval_problems(rows, v.v_truth.filter("is_circular").select("sequence_id", (F.col("length") - 1000).alias("length")))


@query("b28_settings_table", """
SELECT name, value, CASE WHEN name = 'other' THEN 'unknown' WHEN x IS NULL THEN 'not a number' WHEN name = 'threads' AND x <> floor(x) THEN 'not whole' WHEN name = 'threads' AND x < 1 OR name = 'share' AND x < 0 THEN 'below' WHEN name = 'threads' AND x > 40 OR name = 'share' AND x > 0.08 THEN 'above' END AS problem
FROM (SELECT *, TRY_CAST(value AS DOUBLE) AS x FROM (SELECT DISTINCT CASE l_linenumber % 3 WHEN 0 THEN 'threads' WHEN 1 THEN 'share' ELSE 'other' END AS name, CASE l_linenumber % 3 WHEN 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) WHEN 1 THEN CASE WHEN l_returnflag = 'R' THEN 'high' ELSE '0.0' || CAST(CAST(l_quantity AS BIGINT) % 10 AS VARCHAR) END ELSE '1' END AS value FROM lineitem)) WHERE problem IS NOT NULL""")
def b28(v: Views) -> DataFrame:
    """Settings that order lines stand for, against a table of kinds and limits."""
    kind = F.col("l_linenumber") % 3
    quantity = F.col("l_quantity").cast("long")
    value = F.when(kind == 0, quantity.cast("string")).when(kind == 1, F.when(F.col("l_returnflag") == "R", "high").otherwise(F.concat(F.lit("0.0"), quantity % 10))).otherwise("1")
    rows = v.lineitem.select(F.when(kind == 0, "threads").when(kind == 1, "share").otherwise("other").alias("name"), value.alias("value")).distinct()
    settings = v.spark.createDataFrame([("threads", "int", "1", "40"), ("share", "float", "0", "0.08")], "name string, kind string, low string, high string")
    settings = readers.read_registry(v.spark, headed(v, settings), ["name", "kind", "low", "high"], "name", {"kind": ("int", "float")})
    return readers.setting_problems(rows, settings)


@query("q03_metric_registry", "SELECT tool, metric, count(value) AS n, round(avg(CASE WHEN metric = 'correct' THEN value / 7.0 ELSE value END), 4) AS mean FROM (SELECT tool, unnest(['f1', 'bin_f1', 'correct']) AS metric, unnest([f1, bin_f1, CAST(correct AS DOUBLE)]) AS value FROM v_scores) GROUP BY ALL")
def q03(v: Views) -> DataFrame:
    """Metrics that a registry file names, each with its column and scale, from the score table."""
    registry = v.spark.createDataFrame([("f1", "f1", "1", "up"), ("bin_f1", "bin_f1", "1", "up"), ("correct", "correct", "7", "up")], "metric string, column string, scale string, direction string")
    registry = readers.read_registry(v.spark, headed(v, registry), ["metric", "column", "scale", "direction"], "metric", {"direction": ("up", "down")})
    columns = ["f1", "bin_f1", "correct"]
    long = v.v_scores.select(*RUN, *(F.col(c).cast("double").alias(c) for c in columns)).unpivot(RUN, columns, "column", "value")
    rows = long.join(registry, "column").groupBy("tool", "metric").agg(F.count("value").alias("n"), F.round(F.avg(F.col("value") / F.col("scale").cast("double")), 4).alias("mean"))
    return rows


@query("q04_tools_of_a_task", "SELECT tool, task, scored, task = 'binning' AND scored > 0 AS board FROM (SELECT tool, CASE WHEN right(tool, 1) = 'F' THEN 'binning' ELSE 'classification' END AS task, count(f1) AS scored FROM v_scores GROUP BY tool)")
def q04(v: Views) -> DataFrame:
    """Every tool's task by the registry file, and whether it belongs on the binning board."""
    tools = v.v_scores.select("tool").distinct().select("tool", F.when(F.endswith("tool", F.lit("F")), "binning").otherwise("classification").alias("task"))
    registry = readers.read_registry(v.spark, headed(v, tools), ["tool", "task"], "tool", {"task": ("binning", "classification")})
    scored = v.v_scores.groupBy("tool").agg(F.count("f1").alias("scored"))
    return r6(scored.join(registry, "tool").select("tool", "task", "scored", ((F.col("task") == "binning") & (F.col("scored") > 0)).alias("board")))
