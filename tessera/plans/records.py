"""Records, audits, joins by rule, scalar functions and event logs over the base tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import cosine, selection
from tessera.plans.coverage import r6
from tessera.plans.registry import query
from tessera.plans.views import Views
from tessera.sources import readers
from tessera.streaming import runs

RUN = ["sample", "tool"]


@query("a08_truth_violations", "SELECT sequence_id AS key, rule FROM (SELECT sequence_id, 'length' AS rule FROM v_truth WHERE NOT length > 25000 UNION ALL SELECT sequence_id, 'type' FROM v_truth WHERE molecule_type NOT IN ('PLASMID')) ")
def a08(v: Views) -> DataFrame:
    return readers.violations(v.v_truth, {"length": F.col("length") > 25000, "type": F.col("molecule_type").isin("PLASMID")}, "sequence_id")


@query("a08_truth_totals", "SELECT sample, count(*) AS sequences, CAST(sum(CASE WHEN molecule_type = 'PLASMID' THEN length ELSE 0 END) AS BIGINT) AS plasmid_bp, CAST(sum(CASE WHEN molecule_type = 'CHROMOSOME' THEN length ELSE 0 END) AS BIGINT) AS chromosome_bp FROM v_truth GROUP BY sample")
def a08_totals(v: Views) -> DataFrame:
    bp = lambda k: F.sum(F.when(F.col("molecule_type") == k, F.col("length")).otherwise(0))
    return v.v_truth.groupBy("sample").agg(F.count("*").alias("sequences"), bp("PLASMID").alias("plasmid_bp"), bp("CHROMOSOME").alias("chromosome_bp"))


@query("a09_bin_uniqueness", "SELECT sequence_id % 5000 AS item, count(DISTINCT bin_id) AS bins FROM v_bins GROUP BY ALL HAVING count(DISTINCT bin_id) > 1")
def a09(v: Views) -> DataFrame:
    return v.v_bins.groupBy((F.col("sequence_id") % 5000).alias("item")).agg(F.count_distinct("bin_id").alias("bins")).filter("bins > 1")


@query("a10_probability_id_sets", "SELECT coalesce(p.record_id, b.sequence_id) AS record_id, CASE WHEN p.record_id IS NULL THEN 'missing' WHEN b.sequence_id IS NULL THEN 'extra' ELSE 'range' END AS problem FROM v_prob p FULL JOIN v_bins b ON p.record_id = b.sequence_id WHERE p.record_id IS NULL OR b.sequence_id IS NULL OR NOT probability BETWEEN 0 AND 0.95")
def a10(v: Views) -> DataFrame:
    both = v.v_prob.join(v.v_bins, F.col("record_id") == F.col("sequence_id"), "full")
    problem = F.when(F.col("record_id").isNull(), "missing").when(F.col("sequence_id").isNull(), "extra").when(~F.col("probability").between(0, 0.95), "range")
    return both.select(F.coalesce("record_id", "sequence_id").alias("record_id"), problem.alias("problem")).filter("problem is not null")


@query("a07_json_fields", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def a07(v: Views) -> DataFrame:
    return v.events.select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("a11_shard_union", "SELECT shard, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys FROM (SELECT o_orderkey % 3 AS shard, o_custkey FROM orders) GROUP BY shard")
def a11(v: Views) -> DataFrame:
    shards = [v.orders.filter(F.col("o_orderkey") % 3 == k).select(F.lit(k).cast("long").alias("shard"), "o_custkey") for k in range(3)]
    return shards[0].unionByName(shards[1]).unionByName(shards[2]).groupBy("shard").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("keys"))


@query("a13_interval_checks", "SELECT g.copy_id, CASE WHEN t.sequence_id IS NULL THEN 'unknown' ELSE 'range' END AS problem FROM v_gene g LEFT JOIN v_truth t ON g.sequence_id = t.sequence_id WHERE t.sequence_id IS NULL OR end_pos > length - 1000")
def a13(v: Views) -> DataFrame:
    truth = v.v_truth.select(F.col("sequence_id").alias("known"), "length")
    rows = v.v_gene.join(truth, F.col("sequence_id") == F.col("known"), "left")
    return rows.select("copy_id", F.when(F.col("known").isNull(), "unknown").when(F.col("end_pos") > F.col("length") - 1000, "range").alias("problem")).filter("problem is not null")


@query("b07_failure_class", "SELECT sample, tool, CASE exit_code WHEN 124 THEN 'resource' WHEN 137 THEN 'resource' WHEN 125 THEN 'infrastructure' WHEN 126 THEN 'infrastructure' WHEN 127 THEN 'infrastructure' ELSE 'tool' END AS class FROM v_status WHERE status = 'failed'")
def b07(v: Views) -> DataFrame:
    kind = F.when(F.col("exit_code").isin(124, 137), "resource").when(F.col("exit_code").isin(125, 126, 127), "infrastructure").otherwise("tool")
    return v.v_status.filter("status = 'failed'").select(*RUN, kind.alias("class"))


@query("b08_threshold_decision", """
SELECT contig, CASE max(sev) WHEN 2 THEN 'REJECT' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS decision, coalesce(string_agg(CASE WHEN sev > 0 THEN metric END, ';' ORDER BY metric), '') AS reasons FROM (
SELECT contig, metric, CASE WHEN (dir = 'min' AND value < reject) OR (dir = 'max' AND value > reject) THEN 2 WHEN (dir = 'min' AND value < warn) OR (dir = 'max' AND value > warn) THEN 1 ELSE 0 END AS sev
FROM (SELECT contig, 'length' AS metric, CAST(length AS DOUBLE) AS value FROM v_contig UNION ALL SELECT contig, 'depth', CAST(depth AS DOUBLE) FROM v_contig) JOIN (VALUES ('length', 'min', 2000.0, 1000.0), ('depth', 'max', 40.0, 48.0)) t(m, dir, warn, reject) ON metric = m) GROUP BY contig""")
def b08(v: Views) -> DataFrame:
    long = v.v_contig.select("contig", F.col("length").cast("double").alias("length"), F.col("depth").cast("double").alias("depth")).unpivot("contig", ["length", "depth"], "metric", "value")
    limits = v.spark.createDataFrame([("length", "min", 2000.0, 1000.0), ("depth", "max", 40.0, 48.0)], "metric string, dir string, warn double, reject double")
    past = lambda c: ((F.col("dir") == "min") & (F.col("value") < F.col(c))) | ((F.col("dir") == "max") & (F.col("value") > F.col(c)))
    rows = long.join(limits, "metric").withColumn("sev", F.when(past("reject"), 2).when(past("warn"), 1).otherwise(0))
    out = rows.groupBy("contig").agg(F.max("sev").alias("sev"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("sev") > 0, F.col("metric")))), ";").alias("reasons"))
    return out.select("contig", F.when(F.col("sev") == 2, "REJECT").when(F.col("sev") == 1, "WARN").otherwise("PASS").alias("decision"), "reasons")


@query("b10_first_failing_rule", """
SELECT reason, count(*) AS n FROM (SELECT CASE WHEN k > 1 THEN 'duplicate' WHEN o_orderstatus = 'P' THEN 'status' WHEN o_custkey % 10 = 0 THEN 'ledger' WHEN o_totalprice < 50000 THEN 'price' ELSE 'kept' END AS reason
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS k FROM orders)) GROUP BY reason""")
def b10(v: Views) -> DataFrame:
    k = F.row_number().over(Window.partitionBy("o_custkey", "o_orderstatus").orderBy("o_orderkey"))
    reason = F.when(F.col("k") > 1, "duplicate").when(F.col("o_orderstatus") == "P", "status").when(F.col("o_custkey") % 10 == 0, "ledger").when(F.col("o_totalprice") < 50000, "price").otherwise("kept")
    return v.orders.withColumn("k", k).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("b18_run_table_audit", """
SELECT problem, count(*) AS n FROM (SELECT 'completed_without_score' AS problem FROM v_status s WHERE status = 'completed' AND NOT EXISTS (SELECT 1 FROM v_scores x WHERE x.sample = s.sample AND x.tool = s.tool AND f1 IS NOT NULL AND bin_f1 > 0.2)
UNION ALL SELECT 'score_without_completion' FROM v_scores x JOIN v_status s ON x.sample = s.sample AND x.tool = s.tool WHERE status <> 'completed' AND f1 IS NOT NULL UNION ALL SELECT 'blank_metric' FROM v_scores WHERE f1 IS NULL) GROUP BY problem""")
def b18(v: Views) -> DataFrame:
    good = v.v_scores.filter("f1 is not null and bin_f1 > 0.2")
    found = [("completed_without_score", v.v_status.filter("status = 'completed'").join(good, RUN, "left_anti")), ("score_without_completion", v.v_scores.filter("f1 is not null").join(v.v_status.filter("status <> 'completed'"), RUN, "left_semi")), ("blank_metric", v.v_scores.filter("f1 is null"))]
    rows = [df.select(F.lit(name).alias("problem")) for name, df in found]
    return rows[0].union(rows[1]).union(rows[2]).groupBy("problem").agg(F.count("*").alias("n"))


@query("b19_table_fingerprint")
def b19(v: Views) -> DataFrame:
    """A count and a sum of row hashes, whatever the order of rows."""
    return v.v_scores.groupBy("tool").agg(F.count("*").alias("n"), F.sum(F.xxhash64("sample", "tool", "f1", "bin_f1", "correct") % (1 << 40)).alias("fingerprint"))


def band_score(value: Column, excellent: float, good: float, moderate: float, floor: float) -> Column:
    """0 to 100 by straight lines between the anchors, in either direction of better."""
    anchors = ((excellent, 100.0), (good, 75.0), (moderate, 50.0), (floor, 0.0))
    up = excellent > floor
    out = F.when(value >= excellent if up else value <= excellent, 100.0)
    for (x1, y1), (x0, y0) in zip(anchors, anchors[1:]):
        out = out.when(value >= x0 if up else value <= x0, y0 + (value - x0) / (x1 - x0) * (y1 - y0))
    return out.otherwise(0.0)


@query("b21_scorecard_score", "SELECT sample, tool, round(CASE WHEN bin_f1 >= 0.9 THEN 100 WHEN bin_f1 >= 0.7 THEN 75 + (bin_f1 - 0.7) / (0.9 - 0.7) * 25 WHEN bin_f1 >= 0.5 THEN 50 + (bin_f1 - 0.5) / (0.7 - 0.5) * 25 WHEN bin_f1 >= 0.1 THEN (bin_f1 - 0.1) / (0.5 - 0.1) * 50 ELSE 0 END, 6) AS score FROM v_scores")
def b21(v: Views) -> DataFrame:
    return r6(v.v_scores.select(*RUN, band_score(F.col("bin_f1"), 0.9, 0.7, 0.5, 0.1).alias("score")), "score")


@query("b22_scenario_tags", "SELECT sample, CASE WHEN plasmids >= 4 THEN 'multi' WHEN largest >= 45000 THEN 'large' ELSE 'plain' END AS scenario FROM (SELECT sample, count(*) AS plasmids, max(length) AS largest FROM v_truth WHERE molecule_type = 'PLASMID' GROUP BY sample)")
def b22(v: Views) -> DataFrame:
    per = v.v_truth.filter("molecule_type = 'PLASMID'").groupBy("sample").agg(F.count("*").alias("plasmids"), F.max("length").alias("largest"))
    return per.select("sample", F.when(F.col("plasmids") >= 4, "multi").when(F.col("largest") >= 45000, "large").otherwise("plain").alias("scenario"))


@query("b23_mixed_kind_guard", "SELECT region, count(DISTINCT sample % 2) AS kinds, count(DISTINCT sample % 2) > 1 AS mixed FROM v_sheet GROUP BY region")
def b23(v: Views) -> DataFrame:
    return v.v_sheet.groupBy("region").agg(F.count_distinct(F.col("sample") % 2).alias("kinds"), (F.count_distinct(F.col("sample") % 2) > 1).alias("mixed"))


@query("b29_species_name", "SELECT p_partkey, lower(regexp_extract(regexp_replace('[' || p_type || ']', '[\\[\\]]', '', 'g'), '^\\s*(\\S+\\s+\\S+)', 1)) AS name FROM part")
def b29(v: Views) -> DataFrame:
    bare = F.regexp_replace(F.concat(F.lit("["), F.col("p_type"), F.lit("]")), r"[\[\]]", "")
    return v.part.select("p_partkey", F.lower(F.regexp_extract(bare, r"^\s*(\S+\s+\S+)", 1)).alias("name"))


@query("b26_perfect_labels", "SELECT sample, tool, CASE WHEN f1 IS NULL THEN 'blank' WHEN f1 >= 0.9 AND bin_f1 >= 0.5 THEN 'yes' ELSE 'no' END AS perfect FROM v_scores")
def b26(v: Views) -> DataFrame:
    return v.v_scores.select(*RUN, F.when(F.col("f1").isNull(), "blank").when((F.col("f1") >= 0.9) & (F.col("bin_f1") >= 0.5), "yes").otherwise("no").alias("perfect"))


@query("b27_masked_metrics", "SELECT s.sample, tool, CASE WHEN clonal_group IS NOT NULL THEN round(bin_f1, 6) END AS bin_f1 FROM v_scores s LEFT JOIN v_sheet h ON s.sample = h.sample")
def b27(v: Views) -> DataFrame:
    return r6(v.v_scores.join(v.v_sheet, "sample", "left").select(*RUN, F.when(F.col("clonal_group").isNotNull(), F.col("bin_f1")).alias("bin_f1")), "bin_f1")


@query("c06_metadata_join", "SELECT s.sample, tool, species, coalesce(clonal_group, -1) AS clonal_group FROM v_scores s LEFT JOIN v_sheet h ON s.sample = h.sample")
def c06(v: Views) -> DataFrame:
    return v.v_scores.join(v.v_sheet, "sample", "left").select(*RUN, "species", F.coalesce("clonal_group", F.lit(-1).cast("long")).alias("clonal_group"))


@query("c07_date_cutoff", "SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'unknown' WHEN CAST(o_orderdate AS DATE) <= DATE '1996-06-30' THEN 'possible_overlap' ELSE 'after_database' END AS class, count(*) AS n FROM orders GROUP BY ALL")
def c07(v: Views) -> DataFrame:
    date = F.when(F.col("o_orderkey") % 11 != 0, F.to_date("o_orderdate"))
    return v.orders.groupBy(F.when(date.isNull(), "unknown").when(date <= F.lit("1996-06-30").cast("date"), "possible_overlap").otherwise("after_database").alias("class")).agg(F.count("*").alias("n"))


@query("c11_label_cross_check", "SELECT a.label AS one, CASE WHEN b.called THEN 'PLASMID' ELSE 'CHROMOSOME' END AS two, count(*) AS n FROM v_contig a JOIN v_contig b ON a.contig = b.contig WHERE a.length >= 1000 GROUP BY ALL")
def c11(v: Views) -> DataFrame:
    low = v.v_contig.filter("length < 1000").select("contig")
    two = v.v_contig.select("contig", F.when(F.col("called"), "PLASMID").otherwise("CHROMOSOME").alias("two"))
    return v.v_contig.select("contig", F.col("label").alias("one")).join(two, "contig").join(low, "contig", "left_anti").groupBy("one", "two").agg(F.count("*").alias("n"))


@query("c20_semi_and_anti", "SELECT count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders)) AS has_orders, count(*) FILTER (c_custkey NOT IN (SELECT o_custkey FROM orders)) AS has_none FROM customer")
def c20(v: Views) -> DataFrame:
    keys = v.orders.select(F.col("o_custkey").alias("c_custkey"))
    one = F.lit(1).alias("one")
    semi = v.customer.join(keys, "c_custkey", "left_semi").agg(F.count("*").alias("has_orders")).select("has_orders", one)
    return semi.join(v.customer.join(keys, "c_custkey", "left_anti").agg(F.count("*").alias("has_none")).select("has_none", one), "one").drop("one")


@query("c21_side_summary_merge", "SELECT s.sample, s.tool, round(f1, 6) AS f1, status, runtime_seconds FROM v_scores s LEFT JOIN v_status t ON s.sample = t.sample AND s.tool = t.tool")
def c21(v: Views) -> DataFrame:
    return r6(v.v_scores.select(*RUN, "f1").join(v.v_status.select(*RUN, "status", "runtime_seconds"), RUN, "left"), "f1")


@query("c14_nearest_neighbours")
def c14(v: Views) -> DataFrame:
    """The five nearest of all rows for each query row (ids divisible by 20) by cosine, by pairs of blocks."""
    e = v.embeddings
    key, vec = [c for c, t in e.dtypes if t in ("bigint", "int")][0], [c for c, t in e.dtypes if t.startswith("array")][0]
    near = cosine.nearest(e.select(F.col(key).alias("id"), F.col(vec).alias("x")), "id % 20 = 0", 5)
    return near.withColumn("cosine", F.round("cosine", 6))


@query("c17_nearest_reference", "SELECT c_custkey, CAST(n_nationkey AS BIGINT) AS best, gap, rival - gap < 2 AS ambiguous FROM (SELECT c_custkey, n_nationkey, gap, lead(gap) OVER (PARTITION BY c_custkey ORDER BY gap, n_nationkey) AS rival, row_number() OVER (PARTITION BY c_custkey ORDER BY gap, n_nationkey) AS k FROM (SELECT c_custkey, n_nationkey, abs(c_custkey % 97 - n_nationkey * 4) AS gap FROM customer, nation)) WHERE k = 1")
def c17(v: Views) -> DataFrame:
    """The nearest and second nearest reference; references are a small dimension joined by a constant key."""
    refs = v.nation.select(F.col("n_nationkey").cast("long").alias("n_nationkey"), F.lit(1).alias("one"))
    rows = v.customer.select("c_custkey", F.lit(1).alias("one")).join(refs, "one").withColumn("gap", F.abs(F.col("c_custkey") % 97 - F.col("n_nationkey") * 4))
    top = rows.groupBy("c_custkey").agg(F.slice(F.array_sort(F.collect_list(F.struct("gap", "n_nationkey"))), 1, 2).alias("t"))
    return top.select("c_custkey", F.col("t")[0]["n_nationkey"].alias("best"), F.col("t")[0]["gap"].alias("gap"), (F.col("t")[1]["gap"] - F.col("t")[0]["gap"] < 2).alias("ambiguous"))


@query("f11_adjacent_rows", "SELECT o_custkey, count(*) FILTER (o_totalprice > prev) AS rises, count(*) FILTER (o_totalprice <= prev) AS falls FROM (SELECT o_custkey, o_totalprice, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev FROM orders) GROUP BY o_custkey")
def f11(v: Views) -> DataFrame:
    prev = F.lag("o_totalprice").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    rows = v.orders.select("o_custkey", "o_totalprice", prev.alias("prev"))
    return rows.groupBy("o_custkey").agg(F.count_if(F.col("o_totalprice") > F.col("prev")).alias("rises"), F.count_if(F.col("o_totalprice") <= F.col("prev")).alias("falls"))


@query("f12_first_per_group_seeded", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY sha256('7:' || CAST(o_orderkey AS VARCHAR))) AS k FROM orders) WHERE k = 1")
def f12(v: Views) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.sha2(F.concat(F.lit("7:"), F.col("o_orderkey").cast("string")), 256))
    return v.orders.withColumn("k", F.row_number().over(w)).filter("k = 1").select("o_custkey", "o_orderkey")


@query("f13_round_robin_order", """
SELECT c_custkey, row_number() OVER (ORDER BY turn, c_nationkey) AS place FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY s, a, arm, c_mktsegment, c_custkey) AS turn FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey, s, arm ORDER BY c_mktsegment, c_custkey) AS a FROM (
SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY arm, c_custkey) AS s FROM (SELECT c_custkey, c_nationkey, c_mktsegment, CASE WHEN c_acctbal < 5000 THEN 1 ELSE 0 END AS arm FROM customer))))""")
def f13(v: Views) -> DataFrame:
    """Every customer's place in a rotation over nations, segments as studies and balances as arms."""
    rows = v.customer.select("c_custkey", "c_nationkey", "c_mktsegment", F.when(F.col("c_acctbal") < 5000, 1).otherwise(0).alias("arm"))
    return selection.balanced_order(rows, "c_nationkey", "arm", "c_mktsegment", "c_custkey").select("c_custkey", "place")


@query("f14_tie_offsets", "SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) - (count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) + 1) / 2.0 AS shift FROM customer")
def f14(v: Views) -> DataFrame:
    w = Window.partitionBy("c_nationkey", "c_mktsegment")
    return v.customer.select("c_custkey", (F.row_number().over(w.orderBy("c_custkey")) - (F.count("*").over(w) + 1) / 2.0).alias("shift"))


@query("g04_most_structured", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 20")
def g04(v: Views) -> DataFrame:
    return v.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l_suppkey").limit(20)


@query("i02_tolerant_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders")
def i02(v: Views) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 5 == 0, "not a date").otherwise(F.concat(F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit("T00:00:00")))
    return v.orders.withColumn("t", text).select("o_orderkey", F.try_to_date(F.regexp_replace(F.substring("t", 1, 10), "/", "-"), "yyyy-MM-dd").cast("string").alias("day"))


@query("i03_prefix_class", "SELECT copy_id, max_by(cls, length(prefix)) AS cls FROM v_gene JOIN (VALUES ('Brand#1', 'one'), ('Brand#13', 'thirteen'), ('Brand#2', 'two')) t(prefix, cls) ON starts_with(gene_name, prefix) GROUP BY copy_id")
def i03(v: Views) -> DataFrame:
    known = (("Brand#13", "thirteen"), ("Brand#1", "one"), ("Brand#2", "two"))  # longest first
    cls = F.coalesce(*(F.when(F.col("gene_name").startswith(p), F.lit(c)) for p, c in known))
    return v.v_gene.select("copy_id", cls.alias("cls")).filter("cls is not null")


@query("i04_accession_normalise", "SELECT c_custkey, regexp_replace(c_name, '#0*', '_') AS name FROM customer")
def i04(v: Views) -> DataFrame:
    return v.customer.select("c_custkey", F.regexp_replace("c_name", "#0*", "_").alias("name"))


@query("i09_parse_number_list", "SELECT part_id, CAST(list_sum(list_transform(string_split(list, ','), lambda x: CAST(x AS BIGINT))) AS BIGINT) AS total FROM (SELECT p_partkey AS part_id, CAST(p_size AS VARCHAR) || ',' || CAST(p_partkey % 7 AS VARCHAR) AS list FROM part)")
def i09(v: Views) -> DataFrame:
    text = F.concat_ws(",", F.col("p_size").cast("string"), (F.col("p_partkey") % 7).cast("string"))
    numbers = F.transform(F.split(text, ","), lambda x: x.try_cast("bigint"))
    whole = F.when(F.forall(numbers, lambda x: x.isNotNull()), F.aggregate(numbers, F.lit(0).cast("bigint"), lambda s, x: s + x))
    return v.part.select(F.col("p_partkey").alias("part_id"), whole.alias("total"))


@query("i10_attribute_map", "SELECT p_partkey, CAST(p_size AS VARCHAR) AS size, p_brand AS brand FROM part")
def i10(v: Views) -> DataFrame:
    text = F.concat(F.lit("size="), F.col("p_size").cast("string"), F.lit(";brand="), F.replace(F.col("p_brand"), F.lit("#"), F.lit("%23")))
    m = readers.attributes(text)
    return v.part.select("p_partkey", m["size"].alias("size"), m["brand"].alias("brand"))


@query("i11_category_rules", "SELECT p_partkey, CASE WHEN regexp_matches(lower(p_type), 'steel|brass') THEN 'metal' WHEN regexp_matches(lower(p_type), 'tin') THEN 'tin' ELSE 'other' END AS category FROM part")
def i11(v: Views) -> DataFrame:
    t = F.lower("p_type")
    return v.part.select("p_partkey", F.when(t.rlike("steel|brass"), "metal").when(t.rlike("tin"), "tin").otherwise("other").alias("category"))


@query("n04_classifier_normalise", "SELECT contig_id, coalesce(predicted_class, 'uncertain') AS cls, predicted_class IS NULL AS uncertain FROM v_class")
def n04(v: Views) -> DataFrame:
    return v.v_class.select("contig_id", F.coalesce("predicted_class", F.lit("uncertain")).alias("cls"), F.col("predicted_class").isNull().alias("uncertain"))


@query("p01_latest_state", "SELECT user_id, max(ts) AS ts, max_by(event_id, (ts, event_id)) AS event_id, max_by(event_type, (ts, event_id)) AS event_type, count(*) AS events FROM events GROUP BY user_id")
def p01(v: Views) -> DataFrame:
    return runs.latest_state(v.events)


@query("p02_sessions", """
SELECT user_id, min(ts) AS opened, max(ts) + INTERVAL 30 MINUTE AS closed, count(*) AS events, round(sum(value), 4) AS value FROM (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS n FROM events)) GROUP BY user_id, k""")
def p02(v: Views) -> DataFrame:
    return runs.sessions(v.events).withColumn("value", F.round("value", 4))


@query("p02_tumbling_counts", "SELECT date_trunc('day', ts) AS opened, event_type, count(*) AS events FROM events GROUP BY ALL")
def p02_tumbling(v: Views) -> DataFrame:
    return runs.tumbling(v.events)


@query("p03_board_of_sums", "SELECT event_type AS key, round(sum(value), 4) AS s, count(value) AS n FROM events GROUP BY event_type")
def p03(v: Views) -> DataFrame:
    rows = v.events.select(F.col("event_type").alias("key"), "value", (F.col("event_id") % 2).alias("half"))
    state = runs.merge_sums(None, rows.filter("half = 0"))
    return runs.merge_sums(state, rows.filter("half = 1")).withColumn("s", F.round("s", 4))


@query("q04_capability_registry", "SELECT s.sample, s.tool, task FROM v_scores s LEFT JOIN (VALUES ('AF', 'binning'), ('NF', 'classification'), ('NO', 'classification')) t(tool, task) ON s.tool = t.tool")
def q04(v: Views) -> DataFrame:
    registry = v.spark.createDataFrame([("AF", "binning"), ("NF", "classification"), ("NO", "classification")], "tool string, task string")
    return v.v_scores.select(*RUN).join(registry, "tool", "left").select(*RUN, "task")


@query("q03_metric_registry_gaps", "SELECT tool, metric FROM (SELECT DISTINCT tool FROM v_scores) CROSS JOIN (SELECT unnest(['f1', 'bin_f1', 'speed']) AS metric) EXCEPT (SELECT tool, 'f1' FROM v_scores WHERE f1 IS NOT NULL UNION SELECT tool, 'bin_f1' FROM v_scores)")
def q03(v: Views) -> DataFrame:
    want = v.v_scores.select("tool").distinct().select("tool", F.explode(F.array(*map(F.lit, ("f1", "bin_f1", "speed")))).alias("metric"))
    have = v.v_scores.unpivot(RUN, ["f1", "bin_f1"], "metric", "value").filter("value is not null").select("tool", "metric").distinct()
    return want.join(have, ["tool", "metric"], "left_anti")


@query("p02_stalled_runs", "SELECT user_id, event_id, event_type, round(epoch(now - ts), 6) AS age, epoch(now - ts) > 90 AND event_type <> 'signup' AS stalled FROM (SELECT user_id, max(ts) AS ts, max_by(event_id, (ts, event_id)) AS event_id, max_by(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id), (SELECT max(ts) AS now FROM events)")
def p02_stalled(v: Views) -> DataFrame:
    """As seen when the log's last event came: runs silent for over 90 seconds whose last event doesn't end them."""
    now = v.events.agg(F.max(F.col("ts").cast("timestamp")).alias("now")).first()["now"]
    return r6(runs.stalled(v.events, F.lit(now), 90, ("signup",)).select("user_id", "event_id", "event_type", "age", "stalled"), "age")
