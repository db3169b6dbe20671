"""Candidates of six kinds, first holders and CIGAR walks, on small cases worked out by hand and by brute force."""

import random

from tessera.operators import cigar, intervals, multiplicity


def test_first_holders_by_position(spark):
    draw = random.Random(2)
    rows = [(k, draw.randint(1, 6), s, s + draw.choice([0, 1, 5, 40, 700])) for k in "ab" for _ in range(60) if (s := draw.randint(0, 900)) >= 0]
    df = spark.createDataFrame(rows, "k string, place long, s long, e long")
    want = {}
    for k in "ab":
        held = {}
        for kk, place, s, e in rows:
            if kk == k:
                for p in range(s, e):
                    held[p] = min(held.get(p, place), place)
        for place in held.values():
            want[k, place] = want.get((k, place), 0) + 1
    for width in (7, 500):
        assert {(r.k, r.place): r.fresh for r in intervals.first_holders(df, ["k"], "place", width=width).collect()} == want


def test_six_kinds(spark):
    truth = spark.createDataFrame([(1, "P", "PLASMID", 10_000), (1, "Q", "PLASMID", 5_000), (1, "C", "CHROMOSOME", 90_000), (1, "M", "PLASMID", 700)], "sample long, sequence_id string, molecule_type string, length long")
    found = [("main", "P", 0, 6000), ("main", "P", 5000, 6500), ("copy", "P", 100, 4000), ("tail", "P", 6000, 9000), ("both", "P", 0, 2000), ("both", "Q", 0, 2000), ("host", "C", 0, 4000), ("host", "Q", 0, 500), ("part", "P", 0, 400), ("part", "Q", 0, 300), ("part", "C", 0, 290)]
    aligned = spark.createDataFrame([(1, "t", *r) for r in found], "sample long, tool string, qname string, tname string, s long, e long")
    records = spark.createDataFrame([(1, "t", q, n) for q, n in {"main": 7000, "copy": 4000, "tail": 3000, "both": 4000, "host": 4500, "part": 990, "none": 800}.items()], "sample long, tool string, record_id string, length long")
    kinds = multiplicity.candidates(aligned, records, truth)
    got = {r.candidate: (r.relationship, r.new_bp_on_home) for r in kinds.collect()}
    assert got == {"main": ("primary", 6500), "copy": ("redundant", 0), "tail": ("complementary_fragment", 2500), "both": ("chimeric", 0), "host": ("off_target", 0), "part": ("other_plasmid_part", 0), "none": ("unmapped", 0)}
    per = {r.plasmid: r for r in multiplicity.plasmids(aligned, kinds, truth).collect()}
    assert {k: (r.outcome, r.n_candidates, r.n_touching) for k, r in per.items()} == {"P": ("fragmented_and_duplicated", 3, 5), "Q": ("carried_only_in_other_candidates", 0, 3), "M": ("missed", 0, 0)}
    p = per["P"]
    assert (p.best_candidate, p.best_candidate_coverage, p.combined_coverage, p.coverage_gain, p.redundant_bp) == ("main", 0.65, 0.9, 0.25, 6500 + 3900 + 3000 + 2000 + 400 - 9000)


def test_cigar_walk(spark):
    rows = [("a", "3S10=2X5I4D6=2H", 100, None), ("b", "10M2I3D5M", 0, 9), ("c", "10M", 0, None), ("d", None, 0, 3), ("e", "", 7, 1), ("f", "5M10N5M", 50, 0)]
    df = spark.createDataFrame(rows, "id string, cg string, tstart long, nm long")
    got = {r.id: (r.aligned, r.inserted, r.deleted, r.mismatches) for r in cigar.decoded(df).collect()}
    assert got == {"a": (18, 5, 4, 2), "b": (15, 2, 3, 4), "c": (10, 0, 0, None), "d": (None, None, None, None), "e": (None, None, None, None), "f": (10, 0, 0, 0)}
    steps = [(r.op, r.s, r.e) for r in cigar.walk(df.filter("id = 'a'"), ["id"]).collect()]
    assert steps == [("S", 100, 100), ("=", 100, 110), ("X", 110, 112), ("I", 112, 112), ("D", 112, 116), ("=", 116, 122), ("H", 122, 122)]
    assert [(r.s, r.e) for r in cigar.walk(df.filter("id = 'f'"), ["id"]).collect()] == [(50, 55), (55, 65), (65, 70)]
    sums = cigar.accuracy(df, []).first()
    assert (sums.n_blocks, sums.n_blocks_without_cigar, sums.aligned_columns, sums.mismatch_bp) == (6, 3, 18 + 9 + 15 + 5 + 10, 6)
    lost = cigar.accuracy(df.filter("id in ('c', 'd')"), []).first()
    assert lost.aligned_columns == 0 and lost.identity is None


def test_missing_regions(spark):
    aligned = spark.createDataFrame([("a", 10, 20), ("a", 15, 40), ("a", 60, 80), ("full", 0, 50)], "t string, s long, e long")
    targets = spark.createDataFrame([("a", 100), ("full", 50), ("none", 30)], "t string, length long")
    got = {r.t: (r.covered_bp, r.missing_regions, r.missing_bp, r.longest_missing_bp) for r in cigar.missing_regions(aligned, targets, ["t"]).collect()}
    assert got == {"a": (50, 3, 50, 20), "full": (50, 0, 0, 0), "none": (0, 1, 30, 30)}
