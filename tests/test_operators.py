"""Hand-computed examples and properties."""

import random

from pyspark.sql import functions as F

from tessera.functions import rates
from tessera.operators import bins, graph, intervals, scoring, stats
from tessera.sources import readers
from tessera.streaming import runs


def test_touching_intervals_merge(spark):
    df = spark.createDataFrame([("a", 0, 10), ("a", 10, 12), ("a", 20, 25), ("a", 21, 22)], "k string, s long, e long")
    assert sorted(map(tuple, intervals.islands(df, ["k"]).collect())) == [("a", 0, 12), ("a", 20, 25)]


def test_union_equals_brute_force_and_cells_change_nothing(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(3), s := rng.randrange(900), s + rng.randrange(60)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k long, s long, e long")
    want = {k: len({p for q, s, e in rows if q == k for p in range(s, e)}) for k in range(3)}
    assert {r.k: r.bp for r in intervals.union_bp(df, ["k"]).collect()} == want
    again = intervals.islands(df.filter("e > s"), ["k"], width=50).groupBy("k").agg(F.sum(F.col("e") - F.col("s")).alias("bp"))
    assert {r.k: r.bp for r in again.collect()} == want
    once = intervals.islands(df, ["k"])
    assert sorted(map(tuple, intervals.islands(once, ["k"]).collect())) == sorted(map(tuple, once.collect()))


def test_overlap_join_counts_each_pair_once(spark):
    a = spark.createDataFrame([("x", 0, 5000), ("x", 7000, 7001)], "k string, ls long, le long")
    b = spark.createDataFrame([("x", 4000, 9000), ("x", 5000, 6000)], "k string, rs long, re long")
    assert sorted((r.ls, r.rs, r.overlap) for r in intervals.overlap_join(a, b, ["k"], 100).collect()) == [(0, 4000, 1000), (7000, 4000, 1)]


def test_hand_checked_genome(spark):
    truth = spark.createDataFrame([(1, 1, "CHROMOSOME", 10000, False), (1, 2, "PLASMID", 2000, True), (1, 3, "PLASMID", 1000, False)], "sample long, sequence_id long, molecule_type string, length long, is_circular boolean")
    kept = spark.createDataFrame([(1, "t", 9, 2, 0, 1800), (1, "t", 9, 3, 100, 800), (1, "t", 8, 1, 0, 300)], "sample long, tool string, qname long, tname long, s long, e long")
    r = scoring.rated(scoring.confusion(kept, truth)).first()
    assert (r.tp, r.fp, r.fn) == (2500, 300, 500)
    assert (round(r.precision, 4), round(r.recall, 4), round(r.f1, 4)) == (0.8929, 0.8333, 0.8621)


def test_undefined_rates(spark):
    df = spark.createDataFrame([(0, 0, 0), (0, 0, 5), (5, 0, 0)], "tp long, fp long, fn long").select(rates.precision(F.col("tp"), F.col("fp")).alias("p"), rates.recall(F.col("tp"), F.col("fn")).alias("r"), (F.col("tp") + F.col("fn")).alias("t"))
    assert [r.f for r in df.select(rates.f_beta(F.col("p"), F.col("r"), 1.0, F.col("t")).alias("f")).collect()] == [None, 0.0, 1.0]


def test_components_and_matching(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {n: n for e in edges for n in e}
    for _ in range(100):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label
    w = [("g", 1, 1, 5), ("g", 1, 2, 4), ("g", 2, 1, 4), ("g", 3, 3, 1), ("h", 1, 1, 2)]
    found = graph.best_matching(spark.createDataFrame(w, "k string, left long, right long, weight long"), ["k"])
    assert sorted((r.k, r.left, r.right) for r in found.collect()) == [("g", 1, 2), ("g", 2, 1), ("g", 3, 3), ("h", 1, 1)]


def test_identical_bins_agree(spark):
    t = spark.createDataFrame([("a", 1, 7, 10), ("a", 2, 8, 20)], "k string, bin long, ref long, bp long")
    r = bins.entropy_scores(t, ["k"]).first()
    assert abs(r.nmi - 1) < 1e-9 and abs(r.ari - 1) < 1e-9 and abs(r.vi) < 1e-9


def test_statistics(spark):
    df = spark.createDataFrame([("x", c, 1.0) for c in range(6)], "k string, c long, v double")
    assert stats.exact_sign_flip(df, ["k"], "c", "v").first().p == 2 / 64
    assert abs(stats.t_quantile(0.975, 5) - 2.5706) < 1e-3
    w = stats.wilcoxon(spark.createDataFrame([("x", float(i)) for i in (1, 2, 3, -4, 5)], "k string, v double"), ["k"], "v").first()
    assert w.w_plus == 11 and abs(w.exact_p - 0.4375) < 1e-9
    h = stats.holm(spark.createDataFrame([("f", "a", 0.01), ("f", "b", 0.04), ("f", "c", None)], "f string, k string, p double"), ["f"], "p", "k")
    assert {r.k: r.adjusted for r in h.collect()} == {"a": 0.02, "b": 0.04, "c": None}


def test_partitions_change_nothing(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 1000).alias("s"), (F.col("id") * 37 % 1000 + 20).alias("e"))
    assert sorted(map(tuple, intervals.union_bp(df.repartition(1), ["k"]).collect())) == sorted(map(tuple, intervals.union_bp(df.repartition(13), ["k"]).collect()))


def test_readers(spark, tmp_path):
    paf = tmp_path / "a.paf"
    paf.write_text("q\t100\t0\t50\t+\tt\t1000\t10\t60\t49\t50\t60\ttp:A:P\nbroken line\n")
    rows = readers.read_alignments(spark, str(paf), strict=False).collect()
    assert [(r.qname, r.mapq, r.tags) for r in rows] == [("q", 60, ["tp:A:P"])]
    fasta = tmp_path / "a.fa"
    fasta.write_text(">one first\nACg\nT\n>two\nGG\n")
    assert [(r.id, r.sequence) for r in readers.read_fasta(spark, str(fasta)).collect()] == [("one", "ACGT"), ("two", "GG")]
    gff = tmp_path / "a.gff"
    gff.write_text("##gff\nchr\tx\tgene\t1\t9\t.\t+\t.\tID=g%201;note=a+b\n")
    assert readers.read_features(spark, str(gff)).first().attributes == {"ID": "g 1", "note": "a+b"}


def test_streams_equal_batches(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = runs.latest_state(stream).writeStream.outputMode("complete").format("memory").queryName("latest").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("latest").collect())) == sorted(map(tuple, runs.latest_state(events).collect()))
    board = runs.incremental_board(stream.select(F.col("event_type").alias("key"), "value"), str(tmp_path / "out"), str(tmp_path / "cp"))
    board.awaitTermination()
    last = max((tmp_path / "out").glob("version=*"), key=lambda p: int(p.name.split("=")[1]))
    got = {r.key: (round(r.s, 4), r.n) for r in spark.read.parquet(str(last)).collect()}
    want = {r.key: (round(r.s, 4), r.n) for r in runs.merge_sums(None, events.select(F.col("event_type").alias("key"), "value")).collect()}
    assert got == want
