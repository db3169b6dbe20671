"""Evidence rules, compositions, studentised resampling, profiles, held-out models and guards."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import bins, ranking, regression, selection, stats
from tessera.operators.intervals import union_bp
from tessera.plans.agreement import BINNED, table
from tessera.plans.boards import VALS, values
from tessera.plans.coverage import r6
from tessera.plans.registry import query
from tessera.plans.views import Views
from tessera.sources import readers

RUN = ["sample", "tool"]


@query("b16_evidence_label", "SELECT contig, CASE WHEN depth >= 40 AND called THEN 'PLASMID' WHEN length >= 8000 OR NOT called AND depth < 20 THEN 'CHROMOSOME' ELSE 'AMBIGUOUS' END AS evidence FROM v_contig")
def b16(v: Views) -> DataFrame:
    label = F.when((F.col("depth") >= 40) & F.col("called"), "PLASMID").when((F.col("length") >= 8000) | ~F.col("called") & (F.col("depth") < 20), "CHROMOSOME").otherwise("AMBIGUOUS")
    return v.v_contig.select("contig", label.alias("evidence"))


@query("b24_curated_evidence_checks", "SELECT copy_id AS key, rule FROM (SELECT copy_id, 'range' AS rule FROM v_gene g JOIN v_truth t ON g.sequence_id = t.sequence_id WHERE NOT end_pos <= length - 500 UNION ALL SELECT copy_id, 'strand' FROM v_gene WHERE strand <> '+')")
def b24(v: Views) -> DataFrame:
    rows = v.v_gene.join(v.v_truth.select("sequence_id", "length"), "sequence_id")
    return readers.violations(rows, {"range": F.col("end_pos") <= F.col("length") - 500, "strand": F.col("strand") == "+"}, "copy_id")


@query("b25_community_checks", "SELECT community_id, count(*) FILTER (predicted_class IS NULL) AS missing, count(*) - count(DISTINCT contig_id) AS duplicates, count(DISTINCT truth_class) > 2 AS several FROM v_class GROUP BY community_id")
def b25(v: Views) -> DataFrame:
    return v.v_class.groupBy("community_id").agg(F.count_if(F.col("predicted_class").isNull()).alias("missing"), (F.count("*") - F.count_distinct("contig_id")).alias("duplicates"), (F.count_distinct("truth_class") > 2).alias("several"))


@query("b30_database_provenance", "SELECT coalesce(a.tool, b.tool) AS tool, CASE WHEN a.tool IS NULL OR b.tool IS NULL THEN 'unrecorded' WHEN blanks = 0 THEN 'recorded' ELSE 'partly' END AS status FROM (SELECT tool, count(*) - count(f1) AS blanks FROM v_scores GROUP BY tool) a FULL JOIN (SELECT DISTINCT tool FROM v_status) b ON a.tool = b.tool")
def b30(v: Views) -> DataFrame:
    own = v.v_scores.groupBy("tool").agg((F.count("*") - F.count("f1")).alias("blanks")).withColumn("a", F.lit(1))
    both = own.join(v.v_status.select("tool").distinct().withColumn("b", F.lit(1)), "tool", "full")
    return both.select("tool", F.when(F.col("a").isNull() | F.col("b").isNull(), "unrecorded").when(F.col("blanks") == 0, "recorded").otherwise("partly").alias("status"))


@query("c15_out_of_range_threshold", "SELECT species, round(quantile_cont(d, 0.9), 6) AS threshold FROM (SELECT a.species, a.sample, min(abs(x.m - y.m)) AS d FROM v_sheet a JOIN (SELECT sample, avg(bin_f1) AS m FROM v_scores GROUP BY sample) x ON x.sample = a.sample JOIN v_sheet b ON a.species = b.species AND a.sample <> b.sample JOIN (SELECT sample, avg(bin_f1) AS m FROM v_scores GROUP BY sample) y ON y.sample = b.sample GROUP BY a.species, a.sample) GROUP BY species")
def c15(v: Views) -> DataFrame:
    """A sorted neighbour is the nearest in one dimension, so no pairs are made."""
    rows = v.v_sheet.select("sample", "species").join(v.v_scores.groupBy("sample").agg(F.avg("bin_f1").alias("m")), "sample")
    w = Window.partitionBy("species").orderBy("m", "sample")
    near = rows.select("species", F.least(F.col("m") - F.lag("m").over(w), F.lead("m").over(w) - F.col("m")).alias("d"))
    return r6(near.filter("d is not null").groupBy("species").agg(F.percentile("d", F.lit(0.9)).alias("threshold")), "threshold")


@query("c19_accession_match_kind", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'exact' WHEN c_custkey % 3 = 1 THEN 'version' ELSE 'none' END AS kind FROM customer")
def c19(v: Views) -> DataFrame:
    """Published names against own ones: equal, or equal without their version."""
    published = F.concat(F.col("c_name"), F.lit("."), F.when(F.col("c_custkey") % 3 == 0, "1").otherwise("2"), F.when(F.col("c_custkey") % 3 == 2, "x").otherwise(""))
    own = F.concat(F.col("c_name"), F.lit(".1"))
    bare = lambda x: F.regexp_replace(x, r"\.\d+$", "")
    return v.customer.select("c_custkey", F.when(published == own, "exact").when(bare(published) == bare(own), "version").otherwise("none").alias("kind"))


@query("d25_error_composition", """
SELECT bin_id, alpha, count(*) AS n, round(avg((extra + missing + split + joined) / total), 6) AS dissimilarity, round(avg(split / total), 6) AS split, round(avg(joined / total), 6) AS joined, round(avg(extra / total), 6) AS extra, round(avg(missing / total), 6) AS missing, CAST(rank() OVER (PARTITION BY alpha ORDER BY round(avg((extra + missing + split + joined) / total), 9)) AS INT) AS place
FROM (SELECT bin_id, alpha, sample, sum(w) AS total, sum(CASE WHEN bin IS NOT NULL AND ref IS NULL THEN w ELSE 0 END) AS extra, sum(CASE WHEN bin IS NULL AND ref IS NOT NULL THEN w ELSE 0 END) AS missing FROM mb GROUP BY ALL)
JOIN (SELECT bin_id, alpha, sample, coalesce(sum(c), 0) AS split FROM (SELECT DISTINCT bin_id, alpha, sample FROM mb) LEFT JOIN (SELECT bin_id, alpha, sample, ref, sum(w) - max(w) AS c FROM (SELECT bin_id, alpha, sample, ref, bin, sum(w) AS w FROM mb WHERE bin IS NOT NULL AND ref IS NOT NULL GROUP BY ALL) GROUP BY ALL) USING (bin_id, alpha, sample) GROUP BY ALL) USING (bin_id, alpha, sample)
JOIN (SELECT bin_id, alpha, sample, coalesce(sum(c), 0) AS joined FROM (SELECT DISTINCT bin_id, alpha, sample FROM mb) LEFT JOIN (SELECT bin_id, alpha, sample, bin, sum(w) - max(w) AS c FROM (SELECT bin_id, alpha, sample, ref, bin, sum(w) AS w FROM mb WHERE bin IS NOT NULL AND ref IS NOT NULL GROUP BY ALL) GROUP BY ALL) USING (bin_id, alpha, sample) GROUP BY ALL) USING (bin_id, alpha, sample) GROUP BY bin_id, alpha""",
    "mb AS (SELECT bin_id % 4 AS bin_id, alpha, sample, CASE WHEN called THEN bin_id END AS bin, CASE WHEN label = 'PLASMID' THEN best_plasmid END AS ref, pow(length, alpha) AS w FROM v_contig, (SELECT unnest([0.0, 0.5, 1.0]) AS alpha))")
def d25(v: Views) -> DataFrame:
    """Mean share of each part of the dissimilarity over samples, per family of bins, and the families' order at each alpha."""
    family = (F.col("bin_id") % 4).alias("family")
    members = v.v_contig.select(family, "sample", F.when(F.col("called"), F.col("bin_id")).alias("bin"), F.when(F.col("label") == "PLASMID", F.col("best_plasmid")).alias("ref"), "length")
    out = None
    for alpha in (0.0, 0.5, 1.0):
        per = bins.dissimilarity(members, ["family", "sample"], alpha)
        one = per.groupBy(F.col("family").alias("bin_id"), F.lit(alpha).alias("alpha")).agg(F.count("*").alias("n"), F.avg("dissimilarity").alias("dissimilarity"), *(F.avg(F.col(c) / F.col("total")).alias(c) for c in ("split", "joined", "extra", "missing")))
        out = one if out is None else out.union(one)
    out = out.withColumn("place", F.rank().over(Window.partitionBy("alpha").orderBy(F.round("dissimilarity", 9))))
    return r6(out, "dissimilarity", "split", "joined", "extra", "missing")


EVENTS = "ev AS (SELECT DISTINCT tool, tname FROM (SELECT tool, tname, strand <> lead(strand) OVER (PARTITION BY tool, qname ORDER BY qstart, qend, tname, s, e, strand, mapq) AS turned FROM v_retained) WHERE turned)"


@query("d33_targets_without_events", "SELECT tool, count(*) AS targets, count(*) FILTER (NOT EXISTS (SELECT 1 FROM ev WHERE ev.tool = c.tool AND ev.tname = c.tname)) AS quiet FROM (SELECT DISTINCT tool, tname FROM v_retained) c GROUP BY tool", EVENTS)
def d33(v: Views) -> DataFrame:
    w = Window.partitionBy("tool", "qname").orderBy("qstart", "qend", "tname", "s", "e", "strand", "mapq")
    events = v.retained.withColumn("turned", F.col("strand") != F.lead("strand").over(w)).filter("turned").select("tool", "tname").distinct()
    every = v.retained.select("tool", "tname").distinct()
    quiet = every.join(events, ["tool", "tname"], "left_anti").groupBy("tool").agg(F.count("*").alias("quiet"))
    return every.groupBy("tool").agg(F.count("*").alias("targets")).join(quiet, "tool", "left").fillna(0, ["quiet"])


@query("d41_strict_binning", "SELECT tool, bins, CAST(true_bp AS BIGINT) AS true_bp, CAST(mapped AS BIGINT) AS mapped, CAST(records * 1000 - mapped AS BIGINT) AS unaligned FROM (SELECT tool, count(DISTINCT bin) AS bins, sum(bp) AS true_bp FROM tab GROUP BY tool) JOIN (SELECT tool, sum(least(1000, bp)) AS mapped, count(*) AS records FROM (SELECT a.tool, a.qname, max(qend - qstart) AS bp FROM v_retained a JOIN v_bins b ON a.qname = b.sequence_id GROUP BY ALL) GROUP BY tool) USING (tool)", BINNED)
def d41(v: Views) -> DataFrame:
    per = v.retained.join(v.v_bins, F.col("qname") == F.col("sequence_id")).groupBy("tool", "qname").agg(F.least(F.lit(1000), F.max(F.col("qend") - F.col("qstart"))).alias("bp"))
    own = per.groupBy("tool").agg(F.sum("bp").alias("mapped"), F.count("*").alias("records"))
    out = table(v).groupBy("tool").agg(F.count_distinct("bin").alias("bins"), F.sum("bp").alias("true_bp")).join(own, "tool")
    return out.select("tool", "bins", "true_bp", "mapped", (F.col("records") * 1000 - F.col("mapped")).alias("unaligned"))


@query("d43_composition_per_tool", "SELECT tool, CAST(sum(CASE WHEN molecule_type = 'PLASMID' THEN e - s ELSE 0 END) AS BIGINT) AS plasmid_bp, CAST(sum(CASE WHEN molecule_type = 'CHROMOSOME' THEN e - s ELSE 0 END) AS BIGINT) AS chromosome_bp, count(DISTINCT qname) AS records FROM v_retained a JOIN v_truth t ON a.tname = t.sequence_id GROUP BY tool")
def d43(v: Views) -> DataFrame:
    rows = v.retained.join(v.v_truth.select("sequence_id", "molecule_type"), F.col("tname") == F.col("sequence_id"))
    bp = lambda k: F.sum(F.when(F.col("molecule_type") == k, F.col("e") - F.col("s")).otherwise(0))
    return rows.groupBy("tool").agg(bp("PLASMID").alias("plasmid_bp"), bp("CHROMOSOME").alias("chromosome_bp"), F.count_distinct("qname").alias("records"))


@query("d44_assignment_flows", "SELECT tool, bin, ref, CAST(sum(bp) AS BIGINT) AS bp FROM tab GROUP BY ALL HAVING sum(bp) >= 250", BINNED)
def d44(v: Views) -> DataFrame:
    return table(v).groupBy("tool", "bin", "ref").agg(F.sum("bp").alias("bp")).filter("bp >= 250")


@query("i08_cigar_lengths", "SELECT o_orderkey, o_custkey % 90 + 1 AS m, o_custkey % 7 AS i FROM orders")
def i08(v: Views) -> DataFrame:
    text = F.concat((F.col("o_custkey") % 90 + 1).cast("string"), F.lit("M"), (F.col("o_custkey") % 7).cast("string"), F.lit("I"))
    size = lambda op: F.aggregate(F.regexp_extract_all(text, F.lit(rf"(\d+){op}"), F.lit(1)), F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))
    return v.orders.select("o_orderkey", size("M").alias("m"), size("I").alias("i"))


@query("i12_json_variants", "SELECT event_id, coalesce(json_extract_string(props, '$.key'), json_extract_string(props, '$.k')) AS k FROM events")
def i12(v: Views) -> DataFrame:
    return v.events.select("event_id", F.coalesce(F.get_json_object("props", "$.key"), F.get_json_object("props", "$.k")).alias("k"))


@query("l09_depth_over_length", "SELECT tname, round(sum(e - s) / CAST(any_value(tlen) AS DOUBLE), 6) AS depth FROM v_retained GROUP BY tname")
def l09(v: Views) -> DataFrame:
    return r6(v.retained.groupBy("tname").agg((F.sum(F.col("e") - F.col("s")) / F.max("tlen")).alias("depth")), "depth")


@query("m07_method_validation", "SELECT left_out, region, round(avg(held), 6) AS mean, count(*) AS n FROM (SELECT left_out, tool FROM (SELECT *, row_number() OVER (PARTITION BY left_out ORDER BY round(train, 9) DESC, tool) AS k FROM (SELECT g.study AS left_out, x.tool, avg(value) FILTER (x.study <> g.study) AS train FROM (SELECT DISTINCT study FROM vals JOIN v_sheet USING (sample)) g CROSS JOIN (SELECT * FROM vals JOIN v_sheet USING (sample)) x GROUP BY ALL)) WHERE k = 1) p JOIN (SELECT study, tool, region, value AS held FROM vals JOIN v_sheet USING (sample)) h ON h.study = p.left_out AND h.tool = p.tool GROUP BY ALL", VALS)
def m07(v: Views) -> DataFrame:
    w = Window.partitionBy("left_out").orderBy(F.desc(F.round("mean", 9)), "tool")
    pick = ranking.leave_one_out(values(v), v.v_sheet, "study").withColumn("k", F.row_number().over(w)).filter("k = 1").select("left_out", "tool")
    held = values(v).join(v.v_sheet, "sample").select(F.col("study").alias("left_out"), "tool", "region", "value")
    return r6(pick.join(held, ["left_out", "tool"]).groupBy("left_out", "region").agg(F.avg("value").alias("mean"), F.count("*").alias("n")), "mean")


@query("j06_studentised_bootstrap")
def j06(v: Views) -> DataFrame:
    """Bootstrap-t interval: each draw of clusters has its own cluster-robust error; limits come from the draws' t values."""
    draws, keys = 400, ["tool"]
    rows = values(v).join(v.v_sheet, "sample")
    sums = stats.cluster_sums(rows, keys, "study", "value").filter("g >= 5")
    base = stats.cluster_t(rows, keys, "study", "value").select("tool", "mean", "se")
    slots = sums.select(*keys, "i", "g").withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws)))).withColumn("pick", stats.hash_index(3, F.col("draw"), F.col("i"), F.col("g")))
    drawn = slots.join(sums.select(*keys, F.col("i").cast("long").alias("pick"), "s", "n"), [*keys, "pick"])
    per = drawn.groupBy(*keys, "draw", "g").agg(F.sum("s").alias("S"), F.sum("n").alias("N"), F.sum(F.col("s") * F.col("s")).alias("ss"), F.sum(F.col("s") * F.col("n")).alias("sn"), F.sum(F.col("n") * F.col("n")).alias("nn"))
    m = F.col("S") / F.col("N")
    se = F.sqrt(F.greatest(F.col("ss") - 2 * m * F.col("sn") + m * m * F.col("nn"), F.lit(0.0)) * F.col("g") / (F.col("g") - 1)) / F.col("N")
    t = per.select(*keys, m.alias("m"), se.alias("e")).join(base, "tool").filter("e > 0").withColumn("t", (F.col("m") - F.col("mean")) / F.col("e"))
    out = t.groupBy("tool").agg(F.first("mean").alias("mean"), F.first("se").alias("se"), F.percentile("t", F.lit(0.975)).alias("hi"), F.percentile("t", F.lit(0.025)).alias("lo"))
    return out.select("tool", "mean", (F.col("mean") - F.col("hi") * F.col("se")).alias("low"), (F.col("mean") - F.col("lo") * F.col("se")).alias("high"))


def average_linkage(pdf: pd.DataFrame) -> pd.DataFrame:
    """Merges of a small distance table (a, b, d) by average linkage, ties to the smallest names."""
    names = sorted(set(pdf.a) | set(pdf.b))
    d = {frozenset((r.a, r.b)): r.d for r in pdf.itertuples()}
    size, merges = dict.fromkeys(names, 1), []
    while len(size) > 1:
        x, y = min(((p, q) for p in size for q in size if p < q), key=lambda p: (round(d[frozenset(p)], 9), p))
        merges.append((x, y, d[frozenset((x, y))], len(merges)))
        for z in size:
            if z not in (x, y):
                d[frozenset((x, z))] = (size[x] * d[frozenset((x, z))] + size[y] * d[frozenset((y, z))]) / (size[x] + size[y])
        size[x] += size.pop(y)
    return pd.DataFrame(merges, columns=["left", "right", "height", "step"])


@query("k05_average_linkage")
def k05(v: Views) -> DataFrame:
    """Tools by 1 - correlation of their scores: distances in Spark, one row a pair of tools; merging in one call over those few."""
    d = ranking.pairs(values(v)).groupBy("a", "b").agg((1 - F.coalesce(F.corr("va", "vb"), F.lit(0.0))).alias("d"))
    return d.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(lambda pdf: average_linkage(pdf), "left string, right string, height double, step long")


@query("m04_neighbour_arm")
def m04(v: Views) -> DataFrame:
    """For each sample the tool that was best on its three nearest samples of other studies, by standardised replicon features."""
    return neighbour_arm(v, 3)


def neighbour_arm(v: Views, k: int) -> DataFrame:
    per = v.v_truth.groupBy("sample").agg(F.count("*").alias("n"), F.avg("length").alias("size"))
    spread = per.agg(F.stddev_samp("n").alias("sn"), F.stddev_samp("size").alias("sz")).withColumn("one", F.lit(1))
    x = per.withColumn("one", F.lit(1)).join(spread, "one").select("sample", F.coalesce(F.try_divide(F.col("n"), F.col("sn")), F.lit(0.0)).alias("f1_"), F.coalesce(F.try_divide(F.col("size"), F.col("sz")), F.lit(0.0)).alias("f2_")).join(v.v_sheet.select("sample", "study"), "sample").withColumn("one", F.lit(1))
    y = x.select("one", F.col("sample").alias("other"), F.col("study").alias("other_study"), F.col("f1_").alias("g1"), F.col("f2_").alias("g2"))
    near = x.join(y, "one").filter("study <> other_study").withColumn("d", F.sqrt((F.pow(F.col("f1_") - F.col("g1"), 2) + F.pow(F.col("f2_") - F.col("g2"), 2)) / 2))
    near = near.withColumn("r", F.row_number().over(Window.partitionBy("sample").orderBy("d", "other"))).filter(F.col("r") <= k)
    scored = near.join(values(v).select(F.col("sample").alias("other"), "tool", "value"), "other").groupBy("sample", "tool").agg(F.avg("value").alias("m"))
    return scored.groupBy("sample").agg(F.max_by("tool", F.struct(F.round("m", 9), "tool")).alias("pick"))


@query("m05_arm_sensitivity")
def m05(v: Views) -> DataFrame:
    """Mean score of the neighbour arm's picks for several numbers of neighbours."""
    parts = [neighbour_arm(v, k).withColumnRenamed("pick", "tool").join(values(v), RUN).agg(F.avg("value").alias("mean"), F.count("*").alias("n")).withColumn("k", F.lit(k)) for k in (1, 3, 5)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def drivers(v: Views) -> tuple[DataFrame, list[str]]:
    """Scores with what may drive them: the other score, the share of correct plasmids, run time, and the sample's species as columns."""
    rows = v.v_scores.filter("f1 is not null").join(v.v_sheet.select("sample", "species", "study"), "sample").join(v.v_status.select(*RUN, "runtime_seconds"), RUN)
    rows = rows.select("tool", "study", "species", F.col("f1").alias("y"), "bin_f1", (F.col("correct") / F.col("plasmids")).alias("correct_share"), F.log1p("runtime_seconds").alias("log_runtime"))
    rows, species = regression.one_hot(rows, "species", [0, 1, 2, 3])  # the sheet's vocabulary
    return rows, ["bin_f1", "correct_share", "log_runtime", *species]


@query("m08_ridge_by_sums")
def m08(v: Views) -> DataFrame:
    """Ridge of a tool's f1 on its drivers, standardised, with the penalty of least error on studies left out, nested error, baseline and calibration."""
    rows, features = drivers(v)
    return regression.ridge_by_study(rows, ["tool"], "study", features, "y")


@query("j20_clustered_regression")
def j20_clustered(v: Views) -> DataFrame:
    """What each driver adds to f1 with the others held, with intervals over studies."""
    rows, features = drivers(v)
    return regression.clustered_regression(rows, ["tool"], "study", features, "y")


#: Columns that only the truth gives; a recommender's features may not hold them.
FROM_TRUTH = {"f1", "bin_f1", "correct", "plasmids", "tp", "fp", "fn", "completeness"}


def truth_free(df: DataFrame) -> DataFrame:
    if held := sorted(FROM_TRUTH & set(df.columns)):
        raise ValueError(f"columns that come from the truth: {', '.join(held)}")
    return df


@query("m09_truth_free_features", "SELECT sample, tool, runtime_seconds, size FROM v_status")
def m09(v: Views) -> DataFrame:
    return truth_free(v.v_status.select(*RUN, "runtime_seconds", "size"))


@query("q02_format_detection")
def q02(v: Views) -> DataFrame:
    """What kind of table each view is, by its columns' names and values."""
    kinds = []
    for name in ("v_prob", "v_bins", "v_truth", "v_aln"):
        df = getattr(v, name)
        columns = set(df.columns)
        if {"qname", "tname", "mapq"} <= columns:
            kind = df.agg(F.lit("alignment").alias("kind"))
        elif "probability" in columns:
            kind = df.agg(F.when(F.min("probability").between(0, 1) & F.max("probability").between(0, 1), "probabilities").otherwise("unknown").alias("kind"))
        elif {"molecule_type", "length"} <= columns:
            kind = df.agg(F.when(F.bool_and(F.col("molecule_type").isin("PLASMID", "CHROMOSOME")), "truth").otherwise("unknown").alias("kind"))
        else:
            kind = df.agg(F.when(F.count("*") == F.count_distinct("sequence_id"), "bins").otherwise("unknown").alias("kind"))
        kinds.append(kind.select(F.lit(name).alias("source"), "kind"))
    out = kinds[0]
    for k in kinds[1:]:
        out = out.union(k)
    return out


@query("f15_dual_cap_shortlist")
def f15(v: Views) -> DataFrame:
    """Orders by customer, day and number, kept while their customer has fewer than 5 kept ones and their day fewer than 4."""
    rows = v.orders.select("o_orderkey", F.col("o_custkey").alias("p"), F.to_date("o_orderdate").alias("q"))
    return selection.dual_cap(rows, "p", "q", ["p", "q", "o_orderkey"], 5, 4)


@query("q05_grouped_function_points")
def q05(v: Views) -> DataFrame:
    """Covered bp by a grouped function, beside the same by windows: the two agree."""
    def covered(pdf: pd.DataFrame) -> pd.DataFrame:
        total, reach = 0, -1
        for s, e in sorted(zip(pdf.s, pdf.e, strict=True)):
            total += max(0, e - max(s, reach))
            reach = max(reach, e)
        return pd.DataFrame([(pdf.tool.iloc[0], pdf.tname.iloc[0], total)], columns=["tool", "tname", "grouped_bp"])

    kept = v.retained.select("tool", "tname", "s", "e")
    by = kept.groupBy("tool", "tname").applyInPandas(covered, "tool string, tname long, grouped_bp long")
    return union_bp(kept, ["tool", "tname"]).join(by, ["tool", "tname"]).groupBy("tool").agg(F.sum("bp").alias("bp"), F.sum("grouped_bp").alias("grouped_bp"))
