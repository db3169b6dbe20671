"""How a ranking of tools holds under other settings, labels, metrics and cohorts: all variants are rows of one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import scoring
from tessera.operators.intervals import union_bp

RUN = ["sample", "tool"]
#: The least identity and mapping quality of the settings' variants.
SETTINGS = {"default": (20, 0.9), "loose": (0, 0.0), "strict": (40, 0.98)}


def counts(aln: DataFrame, labels: DataFrame) -> DataFrame:
    """setting, scheme, sample, tool, tp, fp, fn in bases: the default scheme under every setting, the other schemes under the default setting.

    labels: scheme ('default' and others), sample, sequence_id, molecule_type, length. Alignments meet the settings once and labels by equality.
    """
    settings = F.array(*(F.struct(F.lit(n).alias("setting"), F.lit(q).alias("q"), F.lit(i).alias("ident")) for n, (q, i) in SETTINGS.items()))
    s, e = scoring.clip("tstart", "tend", "tlen")
    rows = aln.filter("is_primary and block_length >= 200").select("*", F.inline(settings)).filter((F.col("mapq") >= F.col("q")) & (scoring.identity() >= F.col("ident")))
    covered = union_bp(rows.select("setting", *RUN, F.col("tname").alias("sequence_id"), s.alias("s"), e.alias("e")), ["setting", *RUN, "sequence_id"])
    wanted = (F.col("setting") == "default") | (F.col("scheme") == "default")
    both = covered.join(labels.select("scheme", "sequence_id", "molecule_type"), "sequence_id").filter(wanted)
    of = lambda kind: F.sum(F.when(F.col("molecule_type") == kind, F.col("bp")).otherwise(0))
    held = both.groupBy("setting", "scheme", *RUN).agg(of("PLASMID").alias("tp"), of("CHROMOSOME").alias("fp"))
    total = labels.filter("molecule_type = 'PLASMID'").groupBy("scheme", "sample").agg(F.sum("length").alias("total"))
    return held.join(total, ["scheme", "sample"]).select("setting", "scheme", *RUN, "tp", "fp", (F.col("total") - F.col("tp")).alias("fn"))


def table(found: DataFrame, cohorts: DataFrame) -> DataFrame:
    """variant, sample, tool, value: the baseline's F1, that of each setting and scheme, the baseline's precision and recall, and its F1 in each cohort (cohort, sample)."""
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    rows = found.withColumns({"f1": F.try_divide(2 * tp, 2 * tp + fp + fn), "precision": F.try_divide(tp, tp + fp), "recall": F.try_divide(tp, tp + fn)})
    name = F.when((F.col("setting") == "default") & (F.col("scheme") == "default"), "baseline").when(F.col("scheme") == "default", F.concat(F.lit("setting:"), "setting")).otherwise(F.concat(F.lit("scheme:"), "scheme"))
    rows = rows.withColumn("variant", name)
    base = rows.filter("variant = 'baseline'")
    parts = [rows.select("variant", *RUN, F.col("f1").alias("value")), *(base.select(F.lit(f"metric:{m}").alias("variant"), *RUN, F.col(m).alias("value")) for m in ("precision", "recall"))]
    parts.append(base.join(cohorts, "sample").select(F.concat(F.lit("cohort:"), "cohort").alias("variant"), *RUN, F.col("f1").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter("value is not null")


def compared(values: DataFrame) -> DataFrame:
    """variant, tool, mean, n, place, baseline_place, moved, tau, top, same_top. Tools rank by their mean over the samples that all tools of the variant have, ties by name;
    tau counts the pairs of tools that the baseline orders alike less those that it doesn't."""
    tools = values.groupBy("variant").agg(F.count_distinct("tool").alias("tools"))
    shared = values.groupBy("variant", "sample").agg(F.count_distinct("tool").alias("has")).join(tools, "variant").filter("has = tools").select("variant", "sample")
    means = values.join(shared, ["variant", "sample"]).groupBy("variant", "tool").agg(F.avg("value").alias("mean"), F.count("*").alias("n"))
    order = Window.partitionBy("variant").orderBy(F.desc(F.round("mean", 9)), "tool")
    ranks = means.withColumns({"place": F.row_number().over(order), "top": F.first("tool").over(order)})
    base = ranks.filter("variant = 'baseline'").select("tool", F.col("place").alias("baseline_place"), F.col("top").alias("baseline_top"))
    rows = ranks.join(base, "tool", "left")
    known = rows.filter("baseline_place is not null").select("variant", "tool", "place", "baseline_place")
    other = known.select("variant", *(F.col(c).alias(f"{c}_") for c in ("tool", "place", "baseline_place")))
    pairs = known.join(other, "variant").filter("tool < tool_").select("variant", F.signum((F.col("place") - F.col("place_")) * (F.col("baseline_place") - F.col("baseline_place_"))).alias("sign"))
    tau = pairs.groupBy("variant").agg(F.avg("sign").alias("tau"))
    first = F.first("baseline_top", True).over(Window.partitionBy("variant"))
    return rows.join(tau, "variant", "left").select("variant", "tool", "mean", "n", "place", "baseline_place", (F.col("baseline_place") - F.col("place")).alias("moved"), "tau", "top", (F.col("top") == first).alias("same_top"))
