"""The pipeline against a plain version of its stages on a small table."""

import pytest

from tessera.llm import pii, queries

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r.asDict() for r in docs.collect()}
    kept = {r.doc_id for r in queries.op1_quality_rules(spark, DIR).collect() if r.kept}
    frame = docs
    for k, (name, stage) in enumerate(p.STAGES[:-1]):
        frame = stage(spark, frame, DIR)
        assert frame.columns == columns, name
        got = {r.doc_id: r.asDict() for r in frame.collect()}
        if k == 0:
            assert set(got) == kept
        if name == "personal_data":
            assert all(not pii.FINDER.search(rows[i]["text"]) or r["text"] != rows[i]["text"] for i, r in got.items()) and all(r["n_chars"] == len(r["text"]) for r in got.values())
        else:
            assert all(rows[i] == r for i, r in got.items())
    packed = p.run(spark, DIR).collect()
    assert {r.doc_id for r in packed} == set(got)


@pytest.mark.parametrize("empty", [True])
def test_empty(spark, empty):
    import corpus_pipeline as p

    frame = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for _, stage in p.STAGES:
        frame = stage(spark, frame, DIR)
    assert frame.count() == 0


def test_odd_rows(spark):
    """Nulls in every column, repeated rows, empty and long texts, and columns with names of the stages' own: each stage keeps the columns and fails at nothing."""
    import corpus_pipeline as p

    base = " ".join(f"alpha{i} beta{i} gamma{i}" for i in range(40))
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, None, None, None), (None, base + " end", None, "a"), (4, "", "en", "b"), (5, long, "de", None), (None, None, None, None), (6, base + " Frau Anna Weber", None, "a")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row_id string, _row_key string, class string, component_id string, key string"
    frame = spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *["clash"] * 5) for r in rows], schema)
    columns = frame.columns
    for name, stage in p.STAGES[:-1]:
        frame = stage(spark, frame, DIR)
        assert frame.columns == columns, name
        frame = spark.createDataFrame(frame.collect(), schema)
    kept = frame.collect()
    assert sum(r.doc_id == 1 for r in kept) == 1 and not any(r.doc_id == 2 for r in kept) and sum(r.doc_id is None for r in kept) == 1 and all(r.row_id == "clash" for r in kept)
    assert p.STAGES[-1][1](spark, frame, DIR).count() >= len(kept)
