"""Sequences, k-mers, reads and depth windows."""

from __future__ import annotations

import functools
import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import sketches
from tessera.operators.intervals import windows_of
from tessera.operators.kmers import key_codes, kmer_sample, kmer_sums, repeat_content
from tessera.operators.ranking import weighted_quantile
from tessera.plans.coverage import r6
from tessera.plans.registry import query
from tessera.plans.views import Views

K = 15


def reverse_complement(s: Column) -> Column:
    return F.reverse(F.translate(s, "ACGT", "TGCA"))


SMALL = "km AS (SELECT id, source, least(w, reverse(translate(w, 'ACGT', 'TGCA'))) AS kmer FROM (SELECT id, source, substr(sequence, i, 15) AS w FROM (SELECT id, source, sequence, unnest(range(1, length(sequence) - 13)) AS i FROM v_seq WHERE length(sequence) >= 15)))"


@query("l01_canonical_kmers", "SELECT source, count(*) AS kmers, count(DISTINCT kmer) AS distinct_kmers FROM km GROUP BY source", SMALL)
def l01(v: Views) -> DataFrame:
    def tell(keys: pa.Table, key: np.ndarray, kmer: np.ndarray, n: np.ndarray) -> tuple[list, np.ndarray]:
        return ["kmers", "distinct_kmers"], np.stack([np.bincount(key, n, len(keys)), np.bincount(key, minlength=len(keys))], 1)

    return kmer_sums(v.v_seq, K, ["source"], tell).select("source", F.get("sums", F.lit(0)).alias("kmers"), F.get("sums", F.lit(1)).alias("distinct_kmers"))


@query("l02_repeat_content", """
SELECT id, count(*) AS kmers, count(*) FILTER (own > 1) AS repeated, count(*) FILTER (docs > 1) AS shared FROM (SELECT id, count(*) OVER (PARTITION BY id, kmer) AS own, (max(r) OVER (PARTITION BY kmer)) AS docs FROM (SELECT id, kmer, dense_rank() OVER (PARTITION BY kmer ORDER BY id) AS r FROM km)) GROUP BY id""", SMALL)
def l02(v: Views) -> DataFrame:
    """All sequences of a k-mer meet in its share, where those of their k-mers that are repeated or shared are added up."""

    def tell(keys: pa.Table, key: np.ndarray, kmer: np.ndarray, n: np.ndarray) -> tuple[list, np.ndarray]:
        same = np.cumsum(np.r_[0, kmer[1:] != kmer[:-1]])
        several = (np.bincount(same) > 1)[same]
        return ["kmers", "repeated", "shared"], np.stack([np.bincount(key, n * held, len(keys)) for held in (1, n > 1, several)], 1)

    sums = kmer_sums(v.v_seq, K, ["id"], tell)
    return sums.select("id", *(F.get("sums", F.lit(i)).alias(c) for i, c in enumerate(("kmers", "repeated", "shared"))))


_KINDS = "SELECT id, source AS sample, CASE WHEN id % 7 = 0 THEN 'CHROMOSOME' ELSE 'PLASMID' END AS molecule_type, sequence FROM v_seq"


@query("l02_repeat_shares", """
SELECT s.sample, s.id, coalesce(n, 0) AS n_kmers, round(inside / n, 6) AS internal_repeat_fraction, CASE WHEN NOT chromosome AND has_chromosome THEN round(with_chromosome / n, 6) END AS chromosome_shared_fraction,
  CASE WHEN NOT chromosome THEN round(with_plasmids / n, 6) END AS shared_with_other_plasmids_fraction, CASE WHEN n > 0 THEN inside / n >= 0.05 OR NOT chromosome AND has_chromosome AND with_chromosome / n >= 0.05 END AS repeat_rich,
  CASE WHEN coalesce(n, 0) = 0 THEN 'too_short' WHEN has_chromosome THEN 'ok' ELSE 'no_chromosome' END AS status
FROM (SELECT sample, id, molecule_type = 'CHROMOSOME' AS chromosome, bool_or(molecule_type = 'CHROMOSOME') OVER (PARTITION BY sample) AS has_chromosome FROM kinds) s LEFT JOIN (
SELECT id, sum(n)::BIGINT AS n, sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS inside, sum(CASE WHEN c THEN n ELSE 0 END) AS with_chromosome, sum(CASE WHEN p > 1 THEN n ELSE 0 END) AS with_plasmids FROM (
SELECT km.id, count(*) AS n, bool_or(any_value(molecule_type) = 'CHROMOSOME') OVER same AS c, sum(CASE WHEN any_value(molecule_type) = 'PLASMID' THEN 1 ELSE 0 END) OVER same AS p FROM km JOIN kinds USING (id) GROUP BY km.id, sample, kmer WINDOW same AS (PARTITION BY sample, kmer)) GROUP BY id) c USING (id)""", SMALL + f", kinds AS ({_KINDS})")  # fmt: skip
def l02_shares(v: Views) -> DataFrame:
    """Shares of each sequence's k-mers, sources being samples; every seventh text stands for a chromosome."""
    rows = repeat_content(v.sql(_KINDS), K)
    return r6(rows, "internal_repeat_fraction", "chromosome_shared_fraction", "shared_with_other_plasmids_fraction")


def sampled(v: Views) -> DataFrame:
    return kmer_sample(v.v_seq, K, 50, "id").select("id", "kmer")


@query("l03_scaled_kmer_sample")
def l03(v: Views) -> DataFrame:
    return sampled(v).groupBy("id").agg(F.count("*").alias("sampled"))


@query("k04_sketch_distance_pairs")
def k04(v: Views) -> DataFrame:
    return sketches.pairs(sampled(v), K, 0.1)


@query("c12_kmer_containment", """
SELECT a.id, c.source AS class, count(*) AS inside, round(count(*) / CAST(max(a.n) AS DOUBLE), 6) AS containment FROM (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM (SELECT DISTINCT id, kmer FROM km)) a JOIN (SELECT DISTINCT source, kmer FROM km) c ON a.kmer = c.kmer GROUP BY a.id, c.source""", SMALL)
def c12(v: Views) -> DataFrame:
    """All sequences and so all classes of a k-mer meet in its share, where each sequence's k-mers are counted class by class: a row a sequence and share, as wide as there are classes."""

    def tell(keys: pa.Table, key: np.ndarray, kmer: np.ndarray, n: np.ndarray) -> tuple[list, np.ndarray]:
        classes = keys.column("source").combine_chunks().dictionary_encode(null_encoding="encode")
        names = classes.dictionary.to_pylist()
        own = classes.indices.to_numpy(zero_copy_only=False)[key]
        first, code = key_codes(keys.select(["id"]))
        same = np.cumsum(np.r_[0, kmer[1:] != kmer[:-1]])
        once, at = first[code[key]], same
        if len(first) < len(keys):  # an id of several classes has each k-mer once
            pairs = np.unique(same * len(keys) + once)
            once, at = pairs % len(keys), pairs // len(keys)
        sums = [np.bincount(once, minlength=len(keys))]
        for i in range(len(names)):
            held = np.zeros(same[-1] + 1, bool)
            held[same[own == i]] = True
            sums.append(np.bincount(once[held[at]], minlength=len(keys)))
        return ["n", *(None if x is None else f"={x}" for x in names)], np.stack(sums, 1)

    told = kmer_sums(v.v_seq, K, ["id", "source"], tell).select("id", F.explode(F.arrays_zip("names", "sums")).alias("x")).select("id", "x.names", "x.sums")
    told = told.repartition("id").groupBy("id", "names").agg(F.sum("sums").alias("inside"))
    n = F.max(F.when(F.col("names") == "n", F.col("inside"))).over(Window.partitionBy("id"))
    told = told.withColumn("n", n).filter("(names is null or names <> 'n') and inside > 0")
    return r6(told.select("id", F.substr("names", F.lit(2)).alias("class"), "inside", (F.col("inside") / F.col("n")).alias("containment")), "containment")


@query("i07_reverse_complement", "SELECT id, md5(reverse(translate(sequence, 'ACGT', 'TGCA'))) AS digest FROM v_seq")
def i07(v: Views) -> DataFrame:
    return v.v_seq.select("id", F.md5(reverse_complement(F.col("sequence"))).alias("digest"))


@query("l04_tandem_multimer", """
SELECT id, coalesce(max(CASE WHEN ident >= 0.95 THEN k END), 1) AS copies FROM (SELECT id, k, list_min([list_sum([CASE WHEN chars[j] = chars[CAST(p * part + j AS BIGINT)] THEN 1 ELSE 0 END FOR j IN range(1, part + 1)]) / CAST(part AS DOUBLE) FOR p IN range(1, k)]) AS ident
FROM (SELECT id, chars, k, CASE WHEN len(chars) // k >= 100 THEN len(chars) // k END AS part FROM (SELECT id, string_split(sequence, '') AS chars FROM v_seq), (SELECT unnest(range(2, 7)) AS k))) GROUP BY id""")
def l04(v: Views) -> DataFrame:
    """The most equal parts, each of 100 bases or more, that are all at least 95 % like the first; 1 if there are none. Whole sequences are compared, base by base."""
    rows = v.v_seq.select("id", F.filter(F.split("sequence", ""), lambda c: c != "").alias("chars"))
    part = lambda k: F.floor(F.size("chars") / k).cast("int")

    def alike(k: int) -> Column:
        same = lambda p: F.aggregate(F.zip_with(F.slice("chars", F.lit(1), part(k)), F.slice("chars", p * part(k) + 1, part(k)), lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + x)
        return (part(k) >= 100) & functools.reduce(operator.and_, (same(p) >= 0.95 * part(k) for p in range(1, k)))

    copies = F.greatest(*(F.when(alike(k), k).otherwise(1) for k in range(2, 7)))
    return rows.select("id", copies.cast("long").alias("copies"))


@query("f06_n50_l50", """
SELECT sample, max(CASE WHEN 2 * run >= total THEN length END) AS n50, min(CASE WHEN 2 * run >= total THEN n END) AS l50 FROM (SELECT sample, length, sum(length) OVER w AS run, row_number() OVER w AS n, sum(length) OVER (PARTITION BY sample) AS total FROM v_contig WINDOW w AS (PARTITION BY sample ORDER BY length DESC, contig ROWS UNBOUNDED PRECEDING)) GROUP BY sample""")
def f06(v: Views) -> DataFrame:
    w = Window.partitionBy("sample").orderBy(F.desc("length"), "contig")
    rows = v.v_contig.select("sample", "length", F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"), F.row_number().over(w).cast("long").alias("n"), F.sum("length").over(Window.partitionBy("sample")).alias("total"))
    reached = F.when(2 * F.col("run") >= F.col("total"), F.col("length"))
    return rows.groupBy("sample").agg(F.max(reached).alias("n50"), F.min(F.when(2 * F.col("run") >= F.col("total"), F.col("n"))).alias("l50"))


@query("l05_assembly_statistics", "SELECT sample, count(*) AS contigs, CAST(sum(length) AS BIGINT) AS bp, max(length) AS largest, CAST(sum(CASE WHEN length >= 1000 THEN length ELSE 0 END) AS BIGINT) AS bp_1k, CAST(sum(CASE WHEN length >= 5000 THEN length ELSE 0 END) AS BIGINT) AS bp_5k FROM v_contig GROUP BY sample")
def l05(v: Views) -> DataFrame:
    at_least = lambda n: F.sum(F.when(F.col("length") >= n, F.col("length")).otherwise(0))
    return v.v_contig.groupBy("sample").agg(F.count("*").alias("contigs"), F.sum("length").alias("bp"), F.max("length").alias("largest"), at_least(1000).alias("bp_1k"), at_least(5000).alias("bp_5k"))


@query("l06_gc_spread", """
SELECT source, round(max(CASE WHEN q = 0.9 THEN gc END) - max(CASE WHEN q = 0.1 THEN gc END), 6) AS spread FROM (SELECT source, q, min(gc) AS gc FROM (SELECT source, gc, sum(w) OVER (PARTITION BY source ORDER BY gc ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY source) AS total FROM (SELECT source, round((length(sequence) - length(replace(replace(sequence, 'G', ''), 'C', ''))) / CAST(length(sequence) AS DOUBLE), 6) AS gc, sum(length(sequence)) AS w FROM v_seq WHERE length(sequence) > 0 GROUP BY ALL)) JOIN (SELECT unnest([0.1, 0.9]) AS q) ON run >= q * total GROUP BY ALL) GROUP BY source""")
def l06(v: Views) -> DataFrame:
    n = F.length("sequence")
    gc = F.round((n - F.length(F.translate("sequence", "GC", ""))) / n, 6)
    rows = v.v_seq.filter(n > 0).select("source", gc.alias("gc"), n.alias("w"))
    high, low = (weighted_quantile(rows, ["source"], "gc", "w", q).withColumnRenamed("quantile", name) for q, name in ((0.9, "high"), (0.1, "low")))
    return r6(high.join(low, "source").select("source", (F.col("high") - F.col("low")).alias("spread")), "spread")


@query("f10_gc_windows", """
SELECT id, s, round((g + c) / CAST(n AS DOUBLE), 6) AS gc, round(CASE WHEN g + c = 0 THEN 0 ELSE (g - c) / CAST(g + c AS DOUBLE) END, 6) AS skew FROM (SELECT id, s, length(w) AS n, length(w) - length(replace(w, 'G', '')) AS g, length(w) - length(replace(w, 'C', '')) AS c FROM (SELECT id, s, substr(sequence, CAST(s + 1 AS BIGINT), 500) AS w FROM (SELECT id, sequence, unnest(range(0, length(sequence), 500)) AS s FROM v_seq WHERE id % 10 >= 0 AND length(sequence) > 0)))""")
def f10(v: Views) -> DataFrame:
    rows = v.v_seq.filter(F.length("sequence") > 0).select("id", "sequence", F.explode(F.sequence(F.lit(0).cast("long"), (F.length("sequence") - 1).cast("long"), F.lit(500).cast("long"))).alias("s"))
    rows = rows.withColumn("w", F.substring("sequence", (F.col("s") + 1).cast("int"), F.lit(500)))
    count = lambda x: F.length("w") - F.length(F.replace(F.col("w"), F.lit(x), F.lit("")))
    g, c = count("G"), count("C")
    return r6(rows.select("id", "s", ((g + c) / F.length("w")).alias("gc"), F.when(g + c == 0, 0.0).otherwise((g - c) / (g + c)).alias("skew")), "gc", "skew")


@query("f08_sliding_windows", """
SELECT id, count(*) AS windows, CAST(max(s) AS BIGINT) AS last_start FROM (SELECT DISTINCT id, s FROM (SELECT id, unnest(range(0, greatest(length(sequence) - 1000, 0) + 1, 250)) AS s FROM v_seq UNION ALL SELECT id, greatest(length(sequence) - 1000, 0) FROM v_seq)) GROUP BY id""")
def f08(v: Views) -> DataFrame:
    return v.v_seq.select("id", F.explode(windows_of(F.length("sequence"), 1000, 250)).alias("s")).groupBy("id").agg(F.count("*").alias("windows"), F.max("s").alias("last_start"))


@query("f07_tumbling_depth_windows", "SELECT replicon, CAST(floor(pos / 1000.0) AS BIGINT) AS win, count(*) AS n, round(avg(depth), 6) AS mean_depth FROM v_depth GROUP BY ALL")
def f07(v: Views) -> DataFrame:
    return r6(v.v_depth.groupBy("replicon", F.floor(F.col("pos") / 1000.0).alias("win")).agg(F.count("*").alias("n"), F.avg("depth").alias("mean_depth")), "mean_depth")


@query("f09_anomaly_regions", """
SELECT CAST(region AS BIGINT) AS region, kind, min(win) AS first_win, max(win) AS last_win, count(*) AS windows FROM (SELECT *, sum(fresh) OVER (PARTITION BY kind ORDER BY win ROWS UNBOUNDED PRECEDING) AS region FROM (SELECT *, CASE WHEN win - lag(win) OVER (PARTITION BY kind ORDER BY win) <= 2 THEN 0 ELSE 1 END AS fresh FROM (
SELECT win, CASE WHEN m > med + 1.0 * 1.4826 * mad THEN 'high' WHEN m < med - 1.0 * 1.4826 * mad THEN 'low' END AS kind FROM wn CROSS JOIN (SELECT med, quantile_cont(abs(m - med), 0.5) AS mad FROM wn CROSS JOIN (SELECT quantile_cont(m, 0.5) AS med FROM wn) GROUP BY med)) WHERE kind IS NOT NULL)) GROUP BY ALL""", "wn AS (SELECT CAST(floor(pos / 300.0) AS BIGINT) AS win, round(avg(depth), 6) AS m FROM v_depth GROUP BY ALL)")
def f09(v: Views) -> DataFrame:
    one = F.lit(1).alias("one")
    wins = v.v_depth.groupBy(F.floor(F.col("pos") / 300.0).alias("win")).agg(F.round(F.avg("depth"), 6).alias("m")).withColumn("one", F.lit(1))
    med = wins.agg(F.percentile("m", F.lit(0.5)).alias("med")).select("med", one)
    wins = wins.join(med, "one")
    mad = wins.agg(F.percentile(F.abs(F.col("m") - F.col("med")), F.lit(0.5)).alias("mad")).select("mad", one)
    reach = 1.4826 * F.col("mad")
    kind = F.when(F.col("m") > F.col("med") + reach, "high").when(F.col("m") < F.col("med") - reach, "low")
    odd = wins.join(mad, "one").select("win", kind.alias("kind")).filter("kind is not null")
    w = Window.partitionBy("kind").orderBy("win")
    odd = odd.withColumn("fresh", F.when(F.col("win") - F.lag("win").over(w) <= 2, 0).otherwise(1)).withColumn("region", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return odd.groupBy("region", "kind").agg(F.min("win").alias("first_win"), F.max("win").alias("last_win"), F.count("*").alias("windows"))


@query("l10_depth_ratio", "SELECT sample, round(quantile_cont(depth, 0.5) FILTER (label = 'PLASMID') / quantile_cont(depth, 0.5) FILTER (label = 'CHROMOSOME'), 6) AS ratio FROM v_contig GROUP BY sample")
def l10(v: Views) -> DataFrame:
    med = lambda k: F.percentile(F.when(F.col("label") == k, F.col("depth")), F.lit(0.5))
    return r6(v.v_contig.groupBy("sample").agg((med("PLASMID") / med("CHROMOSOME")).alias("ratio")), "ratio")


@query("l11_thinning_ladder")
def l11(v: Views) -> DataFrame:
    """Nested subsamples: a pair is in a rung if its keyed draw is below the rung's fraction."""
    rows = v.conversations.select("conv_id", "turn", F.explode(F.array(*map(F.lit, (0.1, 0.25, 0.5, 1.0)))).alias("rung"))
    return rows.filter(F.pmod(F.xxhash64(F.lit(5), "conv_id"), F.lit(1_000_000)) < F.col("rung") * 1_000_000).groupBy("rung").agg(F.count("*").alias("reads"), F.count_distinct("conv_id").alias("pairs"))


@query("l13_coverage_baseline", """
SELECT sample, count(*) AS contigs, count(*) FILTER (depth >= 1.3 * med) AS predicted, count(*) FILTER (depth >= 1.3 * med AND label = 'PLASMID') AS right_ones FROM v_contig JOIN (SELECT sample, min(depth) AS med FROM (SELECT sample, depth, sum(w) OVER (PARTITION BY sample ORDER BY depth ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY sample) AS total FROM (SELECT sample, depth, sum(length) AS w FROM v_contig GROUP BY ALL)) WHERE run >= 0.5 * total GROUP BY sample) USING (sample) GROUP BY sample""")
def l13(v: Views) -> DataFrame:
    med = weighted_quantile(v.v_contig, ["sample"], "depth", "length", 0.5).withColumnRenamed("quantile", "med")
    hit = F.col("depth") >= 1.3 * F.col("med")
    return v.v_contig.join(med, "sample").groupBy("sample").agg(F.count("*").alias("contigs"), F.count_if(hit).alias("predicted"), F.count_if(hit & (F.col("label") == "PLASMID")).alias("right_ones"))


@query("l08_depth_per_replicon", "SELECT replicon, count(*) AS positions, round(sum(depth), 4) AS total, round(sum(depth) / (max(pos) - min(pos) + 1), 6) AS mean_depth FROM v_depth GROUP BY replicon")
def l08(v: Views) -> DataFrame:
    return v.v_depth.groupBy("replicon").agg(F.count("*").alias("positions"), F.round(F.sum("depth"), 4).alias("total"), F.round(F.sum("depth") / (F.max("pos") - F.min("pos") + 1), 6).alias("mean_depth"))


@query("l05_sequence_statistics", """
SELECT source, count(*) AS sequences, CAST(sum(n) AS BIGINT) AS bp, max(n) AS largest, max(CASE WHEN 2 * run >= total THEN n END) AS n50, min(CASE WHEN 2 * run >= total THEN k END) AS l50, round(100.0 * sum(gc) / sum(acgt), 6) AS gc_percent FROM (SELECT *, sum(n) OVER w AS run, row_number() OVER w AS k, sum(n) OVER (PARTITION BY source) AS total
FROM (SELECT id, source, length(sequence) AS n, length(sequence) - length(translate(sequence, 'GC', '')) AS gc, length(sequence) - length(translate(sequence, 'ACGT', '')) AS acgt FROM v_seq WHERE length(sequence) > 0) WINDOW w AS (PARTITION BY source ORDER BY n DESC, id ROWS UNBOUNDED PRECEDING)) GROUP BY source""")
def l05_sequences(v: Views) -> DataFrame:
    held = lambda letters: F.length("sequence") - F.length(F.translate("sequence", letters, ""))
    rows = v.v_seq.filter(F.length("sequence") > 0).select("id", "source", F.length("sequence").cast("long").alias("n"), held("GC").alias("gc"), held("ACGT").alias("acgt"))
    w = Window.partitionBy("source").orderBy(F.desc("n"), "id")
    rows = rows.select("*", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"), F.row_number().over(w).cast("long").alias("k"), F.sum("n").over(Window.partitionBy("source")).alias("total"))
    reached = lambda c: F.when(2 * F.col("run") >= F.col("total"), F.col(c))
    return r6(rows.groupBy("source").agg(F.count("*").alias("sequences"), F.sum("n").alias("bp"), F.max("n").alias("largest"), F.max(reached("n")).alias("n50"), F.min(reached("k")).alias("l50"), (100 * F.sum("gc") / F.sum("acgt")).alias("gc_percent")), "gc_percent")
