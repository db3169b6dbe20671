"""Readers of delimited and line-record files with declared schemas, and writers that refuse a wrong column list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALIGNMENT = (("qname", "string"), ("qlen", "long"), ("qstart", "long"), ("qend", "long"), ("strand", "string"), ("tname", "string"), ("tlen", "long"), ("tstart", "long"), ("tend", "long"), ("matches", "long"), ("block_length", "long"), ("mapq", "int"))


def read_table(spark: SparkSession, path: str, required: list[str], comment: str | None = None) -> DataFrame:
    """A headed tab-separated file, all values text, blanks null. A missing required column is an error that names it."""
    df = spark.read.csv(path, sep="\t", header=True, nullValue="", comment=comment)
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    return df


def read_alignments(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Alignment lines: twelve typed columns and an array of tags. Malformed lines raise (strict) or are left out."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).filter("trim(value) <> ''").select("value", *(F.try_element_at(parts, F.lit(k + 1)).try_cast(t).alias(c) for k, (c, t) in enumerate(ALIGNMENT)), F.slice(parts, F.lit(13), F.greatest(F.size(parts) - 12, F.lit(0))).alias("tags"))
    bad = ~F.forall(F.array(*(F.col(c).isNotNull() for c, _ in ALIGNMENT)), lambda x: x)
    if strict:
        first = F.when(bad, F.raise_error(F.concat(F.lit("malformed alignment: "), F.col("value")))).otherwise(F.col("qname"))
        return rows.withColumn("qname", first).drop("value")
    return rows.filter(~bad).drop("value")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """id (first word of the header), header and sequence of each record; gzip by file name."""
    rows = spark.read.text(path, lineSep=">").filter("trim(value) <> ''")
    lines = F.split(F.col("value"), "\r?\n")
    return rows.select(F.split(F.element_at(lines, 1), r"\s+")[0].alias("id"), F.element_at(lines, 1).alias("header"), F.upper(F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), "")).alias("sequence"))


def read_graph(spark: SparkSession, path: str, shortest: int = 0) -> tuple[DataFrame, DataFrame]:
    """Segments (node, length) of at least shortest and links (a, a_side, b, b_side) of an assembly graph file."""
    rows = spark.read.text(path).select(F.split("value", "\t").alias("f"))
    nodes = rows.filter("f[0] = 'S'").select(F.col("f")[1].alias("node"), F.length(F.col("f")[2]).alias("length")).filter(F.col("length") >= shortest)
    return nodes, rows.filter("f[0] = 'L'").select(F.col("f")[1].alias("a"), F.col("f")[2].alias("a_side"), F.col("f")[3].alias("b"), F.col("f")[4].alias("b_side"))


def attributes(text: Column, pair: str = ";", value: str = "=") -> Column:
    """A map of k=v pairs, values URL-decoded (a plus sign stays one)."""
    raw = F.str_to_map(text, F.lit(pair), F.lit(value))
    return F.transform_values(raw, lambda k, v: F.url_decode(F.replace(v, F.lit("+"), F.lit("%2B"))))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Feature lines of nine columns, half-open from 0, with an attribute map."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).filter("value not like '#%' and trim(value) <> ''")
    return rows.select(f[0].alias("sequence_id"), f[2].alias("feature_type"), (f[3].cast("long") - 1).alias("start"), f[4].cast("long").alias("end"), f[6].alias("strand"), attributes(f[8]).alias("attributes"))


def violations(df: DataFrame, rules: dict[str, Column], key: str) -> DataFrame:
    """rule, key of every row for which a rule's condition isn't true."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))
    return df.select(F.col(key).alias("key"), F.explode(broken).alias("rule"))


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).count().filter("count > 1")


def write_table(df: DataFrame, path: str, columns: list[str]) -> None:
    """df's columns in the given order as Parquet; refuses a list that isn't exactly df's."""
    if sorted(columns) != sorted(df.columns):
        raise ValueError(f"columns differ: {sorted(set(columns) ^ set(df.columns))}")
    df.select(*columns).write.mode("overwrite").parquet(path)


def write_boards(df: DataFrame, path: str, by: list[str]) -> None:
    """One leaderboard per partition."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def import_evidence(spark: SparkSession, path: str, archive: str, source: str, sep: str = "\t") -> None:
    """Append a headed delimited file's rows, as text, to an archive of Parquet files: each with the SHA-256 of its values, its source and its file.

    Evidence stays apart: nothing in the library reads an archive into scores.
    """
    rows = spark.read.csv(path, sep=sep, header=True)
    values = F.concat_ws("|", *(F.col(f"`{c}`") for c in rows.columns))
    rows.select("*", F.sha2(values, 256).alias("digest"), F.lit(source).alias("evidence_source"), F.col("_metadata.file_path").alias("evidence_file")).write.mode("append").parquet(archive)


TRUTH = T.StructType([T.StructField("sequence_id", T.StringType()), T.StructField("molecule_type", T.StringType()), T.StructField("length", T.LongType())])


def json_lines(spark: SparkSession, path: str, fields: dict[str, tuple[str, ...]]) -> DataFrame:
    """One row a line of JSON objects: each field's first spelling that the line has, as text; bad tells lines that are no object."""
    raw = F.from_json("value", "map<string,string>")
    rows = spark.read.text(path).filter("trim(value) <> ''").select(raw.alias("m"), F.trim("value").alias("line"))
    bad = F.col("m").isNull() | ~F.startswith("line", F.lit("{"))
    return rows.select(*(F.coalesce(*(F.col("m")[k] for k in names)).alias(name) for name, names in fields.items()), bad.alias("bad"))


def refuse(df: DataFrame, problem: Column, what: Column) -> DataFrame:
    """df, which fails at the first row that has a problem (a text; null where there is none)."""
    stop = F.when(problem.isNotNull(), F.raise_error(F.concat(problem, F.lit(": "), F.coalesce(what.cast("string"), F.lit("(none)")))))
    return df.filter(stop.isNull())


def read_members(spark: SparkSession, path: str) -> DataFrame:
    """sequence_id, bin_id of a headed file; a row that lacks one, or a sequence in two bins, is an error."""
    rows = read_table(spark, path, ["sequence_id", "bin_id"]).select("sequence_id", "bin_id")
    rows = refuse(rows, F.when(F.col("sequence_id").isNull() | F.col("bin_id").isNull(), F.lit("a row needs a sequence and a bin")), F.coalesce("sequence_id", "bin_id"))
    per = rows.groupBy("sequence_id").agg(F.min("bin_id").alias("bin_id"), F.max("bin_id").alias("last"))
    return refuse(per, F.when(F.col("bin_id") != F.col("last"), F.lit("a sequence in two bins")), F.col("sequence_id")).drop("last")


def probability_problems(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """record_id, problem of (record_id, probability) rows against the ids that must be there: missing, extra, duplicate, range, not a number."""
    per = rows.groupBy("record_id").agg(F.count("*").alias("n"), F.min("probability").alias("low"), F.max("probability").alias("high"), F.count("probability").alias("numbers"))
    both = per.withColumn("has", F.lit(True)).join(candidates.select("record_id").distinct().withColumn("wanted", F.lit(True)), "record_id", "full")
    problem = F.when(F.col("has").isNull(), "missing").when(F.col("wanted").isNull(), "extra").when(F.col("n") > 1, "duplicate").when(F.col("numbers") < F.col("n"), "not a number").when((F.col("low") < 0) | (F.col("high") > 1), "range")
    return both.select("record_id", problem.alias("problem")).filter("problem is not null")


def read_probabilities(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, ["record_id", "probability"]).select("record_id", F.col("probability").try_cast("double").alias("probability"))


#: Column names by which hit tables of several programs give the same things, in capitals and without signs.
HIT_COLUMNS = {
    "sequence_id": ("SEQUENCE", "CONTIG ID", "CONTIG_ID", "QSEQID"), "start": ("START", "QSTART"), "end": ("END", "STOP", "QEND"), "label": ("GENE", "GENE SYMBOL", "ELEMENT SYMBOL", "SSEQID"),
    "identity": ("IDENTITY", "% IDENTITY TO REFERENCE", "IDENTITY TO REFERENCE", "PIDENT"), "coverage": ("COVERAGE", "% COVERAGE OF REFERENCE", "COVERAGE OF REFERENCE", "QCOVS"),
}


def read_hits(spark: SparkSession, path: str, feature_type: str, source: str, least_identity: float = 0.0, least_coverage: float = 0.0) -> DataFrame:
    """Feature rows (sequence_id, start from 0, end, feature_type, label, source) of a headed hit table, whichever program wrote it; percentages under the limits stay out."""
    raw = spark.read.csv(path, sep="\t", header=True)
    named = raw.toDF(*(c.strip().lstrip("#%").strip().upper() for c in raw.columns))
    pick = {k: next((F.col(f"`{c}`") for c in names if c in named.columns), None) for k, names in HIT_COLUMNS.items()}
    if missing := [k for k in ("sequence_id", "start", "end", "label") if pick[k] is None]:
        raise ValueError(f"{path}: no column for {', '.join(missing)}")
    number = lambda c: F.regexp_replace(c, "%", "").try_cast("double")
    for k, least in (("identity", least_identity), ("coverage", least_coverage)):
        if pick[k] is not None:
            named = named.filter(F.coalesce(number(pick[k]), F.lit(0.0)) >= least)
    low, high = F.least(pick["start"].cast("long"), pick["end"].cast("long")), F.greatest(pick["start"].cast("long"), pick["end"].cast("long"))
    return named.select(pick["sequence_id"].alias("sequence_id"), (low - 1).alias("start"), high.alias("end"), F.lit(feature_type).alias("feature_type"), pick["label"].alias("label"), F.lit(source).alias("source"))


def interval_problems(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """key, problem of (key, sequence_id, start, end) rows, half-open from 0: unknown sequence, empty or reversed, outside its sequence."""
    both = rows.join(lengths.select("sequence_id", "length"), "sequence_id", "left")
    problem = F.when(F.col("length").isNull(), "unknown").when(F.col("end") <= F.col("start"), "empty").when((F.col("start") < 0) | (F.col("end") > F.col("length")), "range")
    return both.select("key", problem.alias("problem")).filter("problem is not null")


def read_registry(spark: SparkSession, path: str, required: list[str], key: str, allowed: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """A headed file of one row a key; a blank or second key, or a value that isn't allowed, is an error."""
    rows = read_table(spark, path, required, comment="#")
    rows = refuse(rows, F.when(F.col(key).isNull(), F.lit("a row without a key")), F.lit(path))
    for c, values in (allowed or {}).items():
        rows = refuse(rows, F.when(~F.coalesce(F.col(c).isin(*values), F.lit(False)), F.lit(f"{c} is none of {', '.join(values)}")), F.col(key))
    once = rows.groupBy(key).agg(F.count("*").alias("_n"), *(F.first(c).alias(c) for c in rows.columns if c != key))
    return refuse(once, F.when(F.col("_n") > 1, F.lit("a second row")), F.col(key)).drop("_n")


def setting_problems(values: DataFrame, settings: DataFrame) -> DataFrame:
    """name, value, problem of (name, value) texts against (name, kind, low, high): unknown, not a number, not whole, below, above."""
    both = values.join(settings.select("name", "kind", F.col("low").try_cast("double").alias("low"), F.col("high").try_cast("double").alias("high")), "name", "left")
    x = F.col("value").try_cast("double")
    problem = F.when(F.col("kind").isNull(), "unknown").when(x.isNull(), "not a number").when((F.col("kind") == "int") & (x != F.floor(x)), "not whole").when(x < F.col("low"), "below").when(x > F.col("high"), "above")
    return both.select("name", "value", problem.alias("problem")).filter("problem is not null")


def wanted(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Records of the ids that are asked for."""
    return records.join(ids.select("id").distinct(), "id", "left_semi")


def one_of_each(records: DataFrame, duplicates: str = "error") -> DataFrame:
    """Records by id: a second one of an id, or a blank id, is an error; or, with duplicates="first", the one of the smallest header stays."""
    if duplicates == "first":
        return records.filter("id <> ''").groupBy("id").agg(F.min_by(F.struct("header", "sequence"), "header").alias("r")).select("id", "r.*")
    counted = records.groupBy("id").agg(F.count("*").alias("n"), F.first("header").alias("header"), F.first("sequence").alias("sequence"))
    return refuse(counted, F.when(F.col("id") == "", F.lit("a record without a name")).when(F.col("n") > 1, F.lit("a second record of the name")), F.col("id")).drop("n")
