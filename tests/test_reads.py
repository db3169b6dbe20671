"""Record files of reads: numbering over several files and blocks, the kinds of damage, and metrics by hand."""

import gzip

import pytest

from tessera.sources import reads


def record(k, mate, seq="ACGTN", qual="II5+@"):
    return f"@r{k}/{mate} note\n{seq}\n+\n{qual}\n"


@pytest.fixture
def pair(spark, tmp_path):
    def make(one, two):
        for mate, text in ((1, one), (2, two)):
            (tmp_path / f"sample=s/mate={mate}").mkdir(parents=True)
            for k, part in enumerate(text if isinstance(text, list) else [text]):
                (tmp_path / f"sample=s/mate={mate}/part-{k}.txt").write_text(part)
        return reads.pairs(reads.read_fastq(spark, str(tmp_path), ["sample", "mate"]), ["sample"])

    return make


GOOD = "".join(record(k, 1) for k in range(4))


@pytest.mark.parametrize(
    ("one", "two", "kind"),
    [
        (GOOD, GOOD, "ok"), (GOOD, GOOD + record(4, 2), "unequal_read_counts"), (GOOD + "@r9\nAC\n+\n", GOOD + record(4, 2), "truncated"), (GOOD + record(4, 1, "ACG", "II"), GOOD + record(4, 2), "malformed_fastq"),
        (GOOD + "r9\nAC\n+\nII\n", GOOD + record(4, 2), "malformed_fastq"), (GOOD, "", "unequal_read_counts"), (GOOD[:-12], GOOD, "truncated"), (GOOD, GOOD + record(4, 2) + record(5, 2, "ACG", "II"), "unequal_read_counts"),
    ],
)
def test_integrity(pair, one, two, kind):
    assert [r.integrity for r in reads.integrity(pair(one, two), ["sample"]).collect()] == [kind]


def test_files_in_order(spark, tmp_path):
    """Records run on over a folder's files, blocks and gzip alike; an '@' opens qualities too."""
    (tmp_path / "mate=1").mkdir()
    for k in range(3):
        text = "".join(record(100 * k + j, 1, qual="@@@@@") for j in range(50))
        (gzip.open if k == 1 else open)(tmp_path / f"mate=1/part-{k}.txt{'.gz' if k == 1 else ''}", "wt").write(text)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    rows = sorted(reads.read_fastq(spark, str(tmp_path), ["mate"]).collect(), key=lambda r: r.record)
    spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert [r.name for r in rows] == [f"r{100 * k + j}" for k in range(3) for j in range(50)] and not any(r.problem for r in rows)


def test_metrics(pair):
    one = record(0, 1, "GGCCA", "IIIII") + record(1, 1, "GGCCA", "IIIII") + record(2, 1, "AGATCGGAAGAGC", "5" * 13)
    two = record(0, 2, "NNTTT", "!!!!!") + record(1, 2, "NNTTT", "!!!!!") + record(7, 2, "AAAAA", "?????")
    r = reads.pair_metrics(pair(one, two), ["sample"], genome_mb=1.0).first()
    assert (r.pairs, r.bases, r.median1, r.median2, r.median_length) == (3, 38, 5.0, 5.0, 5.0)
    assert r.mean_quality == pytest.approx((10 * 40 + 13 * 20 + 5 * 30) / 38) and r.q20 == pytest.approx(28 / 38) and r.q30 == pytest.approx(15 / 38)
    assert r.gc_percent == pytest.approx(100 * (8 + 7) / 34) and r.n_share == pytest.approx(4 / 38)
    assert (r.adapter_share, r.duplicate_share, r.mismatch_share, r.depth) == tuple(pytest.approx(x) for x in (1 / 3, 1 / 3, 1 / 3, 38e-6))


def test_rungs():
    assert reads.parse_rungs("1000:8,5000:10") == [(1000, 8.0), (5000, 10.0)]
    for bad in ("", "10:1,10:1", "0:4", "5:-1", "x"):
        with pytest.raises(ValueError):
            reads.parse_rungs(bad)
