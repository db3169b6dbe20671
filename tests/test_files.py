"""Readers refuse what they must, by name."""

import pytest

from tessera.sources import readers


def put(tmp_path, text, name="t.tsv"):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


@pytest.mark.parametrize(("text", "word"), [("sequence_id\tbin_id\na\t1\na\t2\n", "two bins"), ("sequence_id\tbin_id\na\t\n", "needs a sequence"), ("sequence_id\tother\na\t1\n", "bin_id")])
def test_members(spark, tmp_path, text, word):
    with pytest.raises(Exception, match=word):
        readers.read_members(spark, put(tmp_path, text)).collect()
    assert readers.read_members(spark, put(tmp_path, "sequence_id\tbin_id\na\t1\na\t1\nb\t2\n", "ok.tsv")).count() == 2


def test_registry(spark, tmp_path):
    good = put(tmp_path, "# note\nname\tkind\na\tint\nb\tfloat\n", "good.tsv")
    assert readers.read_registry(spark, good, ["name", "kind"], "name", {"kind": ("int", "float")}).count() == 2
    for text, word in (("name\tkind\na\tint\na\tint\n", "second row"), ("name\tkind\na\tx\n", "none of"), ("name\tkind\n\tint\n", "without a key")):
        with pytest.raises(Exception, match=word):
            readers.read_registry(spark, put(tmp_path, text), ["name", "kind"], "name", {"kind": ("int", "float")}).collect()


def test_records(spark):
    rows = spark.createDataFrame([("a", "a x", "AC"), ("a", "a b", "GG"), ("b", "b", "T")], "id string, header string, sequence string")
    with pytest.raises(Exception, match="second record"):
        readers.one_of_each(rows).collect()
    assert sorted((r.id, r.sequence) for r in readers.one_of_each(rows, "first").collect()) == [("a", "GG"), ("b", "T")]
    with pytest.raises(Exception, match="without a name"):
        readers.one_of_each(spark.createDataFrame([("", "", "AC")], rows.schema)).collect()


def test_probabilities_and_settings(spark, tmp_path):
    rows = readers.read_probabilities(spark, put(tmp_path, "record_id\tprobability\na\t0.5\nb\t1.5\nc\tx\nd\t0.1\nd\t0.2\nz\t0\n"))
    wanted = spark.createDataFrame([(x,) for x in "abcde"], "record_id string")
    assert {r.record_id: r.problem for r in readers.probability_problems(rows, wanted).collect()} == {"b": "range", "c": "not a number", "d": "duplicate", "e": "missing", "z": "extra"}
    settings = spark.createDataFrame([("t", "int", "1", "8")], "name string, kind string, low string, high string")
    values = spark.createDataFrame([("t", "4"), ("t", "0"), ("t", "9"), ("t", "2.5"), ("t", "x"), ("u", "1")], "name string, value string")
    assert {r.value: r.problem for r in readers.setting_problems(values, settings).collect()} == {"0": "below", "9": "above", "2.5": "not whole", "x": "not a number", "1": "unknown"}
