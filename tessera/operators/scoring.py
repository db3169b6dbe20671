"""Base-level scoring of predictions by their alignments to truth sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import rates
from tessera.operators.intervals import islands, overlap_join, sweep, union_bp

RUN = ["sample", "tool"]


def identity() -> Column:
    """Matches over block length; 0 for a block of length zero."""
    return F.coalesce(F.try_divide(F.col("matches").cast("double"), F.col("block_length").cast("double")), F.lit(0.0))


def query_coverage() -> Column:
    return F.coalesce(F.try_divide(F.abs(F.col("qend") - F.col("qstart")).cast("double"), F.col("qlen").cast("double")), F.lit(0.0))


def clip(start: str, end: str, length: str) -> tuple[Column, Column]:
    """Start and end in order, inside [0, length]."""
    return F.greatest(F.lit(0), F.least(start, end)), F.least(F.col(length), F.greatest(start, end))


def passes(block: int = 200, ident: float = 0.90, mapq: int = 20, coverage: float = 0.20, contig: int = 0) -> Column:
    """An alignment's own merits: primary, long, alike, well mapped, covering its query."""
    return F.col("is_primary") & (F.col("block_length") >= block) & (identity() >= ident) & (F.col("mapq") >= mapq) & (query_coverage() >= coverage) & (F.col("qlen") >= contig)


def retain(aln: DataFrame, **limits) -> DataFrame:
    """Alignments that pass, with s and e clipped to the target."""
    s, e = clip("tstart", "tend", "tlen")
    return aln.filter(passes(**limits)).withColumn("s", s).withColumn("e", e)


def rejections(aln: DataFrame, block: int = 200, ident: float = 0.90, mapq: int = 20, coverage: float = 0.20) -> DataFrame:
    """How many alignments of each run fail each test, each on its own."""
    tests = {"secondary": ~F.col("is_primary"), "short": F.col("block_length") < block, "unlike": identity() < ident, "ambiguous": F.col("mapq") < mapq, "partial": query_coverage() < coverage}
    return aln.groupBy(*RUN).agg(F.count("*").alias("alignments"), *(F.count_if(c).alias(k) for k, c in tests.items()), F.count_if(passes(block, ident, mapq, coverage)).alias("retained"))


def covered(kept: DataFrame) -> DataFrame:
    """Union bp of each run on each target."""
    return union_bp(kept, [*RUN, "tname"], name="covered")


def confusion(kept: DataFrame, truth: DataFrame) -> DataFrame:
    """TP, FP, FN, TN base counts of each run: covered plasmid bp, covered chromosome bp, and the rest of each."""
    runs = covered(kept).join(truth.select("sequence_id", "molecule_type"), F.col("tname") == F.col("sequence_id"))
    is_plasmid = F.col("molecule_type") == "PLASMID"
    got = runs.groupBy(*RUN).agg(F.sum(F.when(is_plasmid, F.col("covered")).otherwise(0)).alias("tp"), F.sum(F.when(~is_plasmid, F.col("covered")).otherwise(0)).alias("fp"))
    total = truth.groupBy("sample").agg(F.sum(F.when(is_plasmid, F.col("length")).otherwise(0)).alias("plasmid_bp"), F.sum(F.when(~is_plasmid, F.col("length")).otherwise(0)).alias("chromosome_bp"))
    out = got.join(total, "sample").withColumn("fn", F.greatest(F.col("plasmid_bp") - F.col("tp"), F.lit(0))).withColumn("tn", F.col("chromosome_bp") - F.col("fp"))
    return out.select(*RUN, "tp", "fp", "fn", "tn", "plasmid_bp")


def rated(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 beside counts; undefined values are null."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    out = counts.withColumn("precision", rates.precision(tp, fp)).withColumn("recall", rates.recall(tp, fn))
    return out.withColumn("f1", rates.f_beta(F.col("precision"), F.col("recall"), 1.0, tp + fn))


def more_rates(counts: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    p, r = rates.precision(tp, fp), rates.recall(tp, fn)
    return counts.select(*RUN, rates.f_beta(p, r, 2.0).alias("f2"), rates.f_beta(p, r, 0.5).alias("f05"), rates.mcc(tp, fp, fn, tn).alias("mcc"), rates.share(tn, tn + fp).alias("specificity"))


def query_burden(kept: DataFrame, truth: DataFrame, records: DataFrame) -> DataFrame:
    """Predicted bp of each run that map to truth, only elsewhere, or nowhere; each record's union is capped by its length."""
    q = kept.select(*RUN, F.col("qname").alias("record_id"), "tname", F.least("qstart", "qend").alias("s"), F.greatest("qstart", "qend").alias("e"))
    on = union_bp(q.join(truth.select(F.col("sequence_id").alias("tname")), "tname", "left_semi"), [*RUN, "record_id"], name="on_truth")
    any_ = union_bp(q, [*RUN, "record_id"], name="anywhere")
    out = records.join(any_, [*RUN, "record_id"], "left").join(on, [*RUN, "record_id"], "left")
    on, any_ = (F.least(F.coalesce(c, F.lit(0)), F.col("length")) for c in (F.col("on_truth"), F.col("anywhere")))
    return out.groupBy(*RUN).agg(F.sum(on).alias("mapped_bp"), F.sum(any_ - on).alias("off_truth_bp"), F.sum(F.col("length") - any_).alias("unmapped_bp"), F.sum("length").alias("predicted_bp"))


def ambiguous_bp(kept: DataFrame, truth: DataFrame) -> DataFrame:
    """Query bp of each run that lie under both a plasmid and a chromosome alignment."""
    q = kept.join(truth.select(F.col("sequence_id").alias("tname"), "molecule_type"), "tname")
    q = q.select(*RUN, "qname", F.least("qstart", "qend").alias("s"), F.greatest("qstart", "qend").alias("e"), (F.col("molecule_type") == "PLASMID").cast("int").alias("is_plasmid"))
    both = sweep(q, [*RUN, "qname"], {"plasmid": F.col("is_plasmid"), "chromosome": 1 - F.col("is_plasmid")})
    return both.groupBy(*RUN).agg(F.sum(F.when((F.col("plasmid") > 0) & (F.col("chromosome") > 0), F.col("e") - F.col("s")).otherwise(0)).alias("ambiguous_bp"))


def redundant_bp(kept: DataFrame, truth: DataFrame) -> DataFrame:
    """Plasmid bp covered again: raw less union."""
    own = kept.join(truth.filter("molecule_type = 'PLASMID'").select(F.col("sequence_id").alias("tname")), "tname", "left_semi")
    raw = own.groupBy(*RUN, "tname").agg(F.sum(F.col("e") - F.col("s")).alias("raw"))
    return raw.join(covered(own), [*RUN, "tname"]).groupBy(*RUN).agg(F.sum(F.col("raw") - F.col("covered")).alias("redundant_bp"))


def false_positive_records(kept: DataFrame, truth: DataFrame) -> DataFrame:
    on = kept.join(truth.filter("molecule_type = 'CHROMOSOME'").select(F.col("sequence_id").alias("tname")), "tname", "left_semi")
    return on.groupBy(*RUN).agg(F.count_distinct("qname").alias("fp_records"))


def completeness(kept: DataFrame, truth: DataFrame) -> DataFrame:
    """Each plasmid's covered share for every tool of its sample, with graded recovery."""
    tools = kept.select(*RUN).distinct()
    out = truth.filter("molecule_type = 'PLASMID'").join(tools, "sample").join(covered(kept).withColumnRenamed("tname", "sequence_id"), [*RUN, "sequence_id"], "left")
    c = F.coalesce(F.col("covered"), F.lit(0)) / F.col("length")
    out = out.select(*RUN, "sequence_id", "length", "is_circular", F.coalesce(F.col("covered"), F.lit(0)).alias("covered"), c.alias("completeness"))
    return out.withColumn("recovered", F.col("completeness") >= 0.9).withColumn("half", F.col("completeness") >= 0.5).withColumn("complete_circular", F.col("is_circular") & (F.col("completeness") >= 0.99995))


def gene_recovery(kept: DataFrame, genes: DataFrame, least: float = 0.9) -> DataFrame:
    """Genes of each run whose covered share is least or more."""
    isl = islands(kept, [*RUN, "tname"]).select("tool", F.col("tname").alias("sequence_id"), F.col("s").alias("rs"), F.col("e").alias("re"))
    tools = kept.select(*RUN).distinct()
    every = genes.join(tools, "sample")
    got = overlap_join(genes.select("sequence_id", "copy_id", F.col("start_pos").alias("ls"), F.col("end_pos").alias("le")), isl, ["sequence_id"])
    got = got.groupBy("tool", "copy_id").agg(F.sum("overlap").alias("overlap"))
    out = every.join(got, ["tool", "copy_id"], "left").withColumn("share", F.coalesce(F.col("overlap"), F.lit(0)) / (F.col("end_pos") - F.col("start_pos")))
    return out.groupBy(*RUN).agg(F.count("*").alias("genes"), F.count_if(F.col("share") >= least).alias("recovered"))
