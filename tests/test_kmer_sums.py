"""Sums over k-mers against plain counting, in small shares and pieces, and plans in which no row is a k-mer of a sequence."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera import catalog
from tessera.operators import kmers

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("k", [3, 11, 31])
def test_sums(spark, monkeypatch, k):
    def tell(keys, key, kmer, n):
        same = np.cumsum(np.r_[0, kmer[1:] != kmer[:-1]])
        return ["n", "distinct", "shared"], np.stack([np.bincount(key, n, len(keys)), np.bincount(key, minlength=len(keys)), np.bincount(key, (np.bincount(same) > 1)[same], len(keys))], 1)

    for name, size in (("CHUNK", 37), ("SLICE", 200), ("NEAR", 16), ("SORTED", 5)):
        monkeypatch.setattr(kmers, name, size)
    rng = random.Random(k)
    texts = ["".join(rng.choice("ACGTACGTN") for _ in range(rng.randrange(0, 200))) for _ in range(20)]
    rows = [(i % 9, None if i % 9 == 4 else f"s{i % 2}", texts[i % 20]) for i in range(40)] + [(7, "s0", None), (8, "s1", "ACGT" * 50)]
    held = collections.defaultdict(collections.Counter)
    for i, s, x in rows:
        for at in range(len(x or "") - k + 1):
            w = x[at : at + k]
            if "N" not in w:
                held[i, s][min(w, w[::-1].translate(str.maketrans("ACGT", "TGCA")))] += 1
    by = collections.Counter(w for c in held.values() for w in c)
    want = {key: [sum(c.values()), len(c), sum(by[w] > 1 for w in c)] for key, c in held.items() if c}
    frame = spark.createDataFrame(rows, "id long, source string, sequence string")
    got = kmers.kmer_sums(frame, k, ["id", "source"], tell).collect()
    assert {(r.id, r.source): r.sums for r in got} == want and len(got) == len(want)


def test_hashes_are_sparks(spark):
    x = [0, 1, -1, 2**62, *(random.Random(1).randrange(2**62) for _ in range(500))]
    want = [r.h for r in spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i long, v long").orderBy("i").select(F.xxhash64("v").alias("h")).collect()]
    assert kmers.hashes(np.array(x, np.int64)).tolist() == want


@pytest.mark.parametrize("name", ["c12_kmer_containment", "l01_canonical_kmers", "l02_repeat_content", "l02_repeat_shares"])
def test_no_row_is_a_kmer(spark, name):
    plan = catalog.queries()[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("kmer#" in line for line in exchanges)


def test_sample_is_taken_before_rows_leave_numpy(spark):
    plan = catalog.queries()["l03_scaled_kmer_sample"](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "xxhash64(kmer" not in plan


def test_keys_are_packed(spark):
    """What a key costs beside its k-mers: differences of whole numbers, places among distinct values for the rest."""
    for x in ([5, 5, 7, 1 << 62, -(1 << 63), (1 << 63) - 1], ["a", None, "a", "b"], [True, False, True], [3, None, 3], [1.5, float("inf"), 1.5]):
        column = pa.array(x)
        values, b = kmers.pack_values(column)
        assert kmers.unpack_values(values, b, len(x)).to_pylist() == x and kmers.unpack_values(values, b, len(x)).type == column.type
    ids = pa.array(np.cumsum(np.random.default_rng(1).integers(1, 2000, 4000)))
    assert len(kmers.pack_values(ids)[1]) < 2 * len(ids)


def test_more_partitions_do_not_repeat_keys(spark):
    """Keys go along once a share; before, each shuffle partition was a share and had all keys again."""
    own = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "600")
        assert kmers.shares_of(spark) == kmers.SHARES
        spark.conf.set("spark.sql.shuffle.partitions", "8000")
        assert kmers.shares_of(spark) == 1000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", own)


@pytest.mark.parametrize("k", [3, 15, 31])
def test_runs(k):
    """Runs hold each k-mer once, both strands of it in one part, and take a byte or so a k-mer (before, some three)."""
    rng = random.Random(k)
    text = "".join(rng.choice("ACGT" * 50 + "N") for _ in range(5000))
    other = text[::-1].translate(str.maketrans("ACGT", "TGCA"))
    held = collections.defaultdict(set)
    for t in (text, other):
        b = np.frombuffer(t.encode(), np.uint8)
        start, n, part = kmers.runs(b, k, 64)
        assert np.array_equal(kmers._spread(start, n), kmers.codes(b, k)[0])
        again = kmers.unpack_bases(kmers.pack_bases(b, start, n + k - 1)).tobytes().decode()
        for a, m, p, at in zip(start.tolist(), n.tolist(), part.tolist(), (np.cumsum(n + k - 1) - (n + k - 1)).tolist()):
            assert again[at : at + m + k - 1] == t[a : a + m + k - 1]
            for i in range(m):
                w = t[a + i : a + i + k]
                held[min(w, w[::-1].translate(str.maketrans("ACGT", "TGCA")))].add(p)
    assert all(len(p) == 1 for p in held.values()) and kmers.runs(b[: k - 1], k, 64)[0].size == 0
    assert k < 15 or len(kmers.pack_bases(b, start, n + k - 1)) < 1.4 * n.sum()
