"""Several predicted records for one plasmid: what each is to the others, and what a plasmid gets out of all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.intervals import first_holders, union_bp
from tessera.operators.lineage import cut

RUN = ["sample", "tool"]
#: Records that are no candidate for a plasmid of their own.
ASIDE = ("unmapped", "off_target", "chimeric")


def candidates(aligned: DataFrame, records: DataFrame, truth: DataFrame, least_bp: int = 1000, least_share: float = 0.1, home_share: float = 0.5, fresh_share: float = 0.1, unmapped: bool = True) -> DataFrame:
    """A row a record: aligned bases, its home plasmid, what it is (of six kinds), and the bases that it adds there to all longer candidates.

    aligned: retained alignments (sample, tool, qname, tname, s, e); records: sample, tool, record_id, length; truth: sequence_id,
    molecule_type, length. A record is unmapped; off target if more of it lies on chromosomes; chimeric if two targets or more each hold
    least_bp bases and least_share of it. The rest are candidates of their home, the plasmid that holds most of them (home_share at
    least, else they are part of another): the first by own bases is the primary one, others are redundant if less than
    fresh_share of their bases there are new, and complementary fragments otherwise. Without unmapped, records of no alignment are left out
    before anything is joined to them.
    """
    aligned = aligned.repartition(*RUN, "qname")  # all that is summed up by record stays where it is
    per = union_bp(aligned, [*RUN, "qname", "tname"]).join(truth.select(F.col("sequence_id").alias("tname"), "molecule_type"), "tname")
    plasmid = F.col("molecule_type") == "PLASMID"
    sums = per.groupBy(*RUN, "qname").agg(
        F.sum("bp").alias("all_bp"), F.sum(F.when(plasmid, F.col("bp")).otherwise(0)).alias("plasmid_bp"), F.sum(F.when(F.col("molecule_type") == "CHROMOSOME", F.col("bp")).otherwise(0)).alias("chromosome_bp"),
        F.min(F.when(plasmid, F.struct((-F.col("bp")).alias("less"), F.col("tname").alias("home")))).alias("best"), F.collect_list(F.when(F.col("bp") >= least_bp, F.col("bp"))).alias("large"),
    )
    rows = records.withColumnRenamed("record_id", "qname").join(sums, [*RUN, "qname"])
    rows = rows.withColumns({"aligned_bp": F.least("length", "all_bp"), "home": F.col("best.home"), "home_bp": F.coalesce(-F.col("best.less"), F.lit(0))})
    rows = rows.withColumn("n_large", F.size(F.filter("large", lambda bp: F.try_divide(bp, F.col("aligned_bp")) >= least_share)))
    aside = F.when(F.col("aligned_bp") == 0, "unmapped").when(F.col("chromosome_bp") > F.col("plasmid_bp"), "off_target").when(F.col("n_large") >= 2, "chimeric")
    rows = rows.withColumns({"aside": aside, "is_member": aside.isNull() & F.col("home").isNotNull() & (F.try_divide(F.col("home_bp"), F.col("aligned_bp")) >= home_share)})
    rows = mapped = cut(rows.drop("large", "best"))  # few of the records, and all that is joined below
    members = rows.filter("is_member").select(*RUN, "qname", F.col("home").alias("tname"), F.struct((-F.col("home_bp")).alias("less"), F.col("qname").alias("q")).alias("place"))
    fresh = first_holders(aligned.join(members, [*RUN, "qname", "tname"]), [*RUN, "tname"], "place")
    first = fresh.groupBy(*RUN, "tname").agg(F.min("place").alias("first"))  # the first member has all of its bases, so it is among them
    fresh = fresh.join(first, [*RUN, "tname"]).select(*RUN, F.col("place.q").alias("qname"), "fresh", (F.col("place") == F.col("first")).alias("is_first"))
    rows = rows.join(fresh, [*RUN, "qname"], "left").fillna(0, ["fresh"])
    inside = F.when(F.col("is_first"), "primary").when(F.col("fresh") < fresh_share * F.col("home_bp"), "redundant").otherwise("complementary_fragment")
    kind = F.coalesce("aside", F.when(F.col("is_member"), inside), F.lit("other_plasmid_part"))
    rows = rows.select(
        *RUN, F.col("qname").alias("candidate"), "length", "aligned_bp", "home", "home_bp", "plasmid_bp", "chromosome_bp", kind.alias("relationship"), F.when(F.col("is_member"), F.col("fresh")).otherwise(0).alias("new_bp_on_home"), "is_member"
    )
    if not unmapped:
        return rows
    others = records.withColumnRenamed("record_id", "candidate").join(mapped.select(*RUN, F.col("qname").alias("candidate")), [*RUN, "candidate"], "left_anti")
    zero = {c: F.lit(0).cast("long") for c in ("aligned_bp", "home_bp", "plasmid_bp", "chromosome_bp", "new_bp_on_home")}
    return rows.unionByName(others.withColumns(zero | {"home": F.lit(None).cast(rows.schema["home"].dataType), "relationship": F.lit("unmapped"), "is_member": F.lit(False)}).select(*rows.columns))


def plasmids(aligned: DataFrame, found: DataFrame, truth: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """A row a run and plasmid: outcome, candidates, coverage by the best and by all of them, and redundancy.

    found: what candidates() gives; with runs (sample, tool) it needs no unmapped records.
    """
    wanted = truth.filter("molecule_type = 'PLASMID'").select(F.col("sequence_id").alias("tname"), F.col("length").alias("plasmid_length"), "sample")
    own = union_bp(aligned, [*RUN, "qname", "tname"], name="own")
    union = union_bp(aligned, [*RUN, "tname"], name="union_bp")
    kinds = found.select(*RUN, F.col("candidate").alias("qname"), "relationship", "is_member", "home")
    touching = own.join(kinds, [*RUN, "qname"]).withColumn("member", F.col("is_member") & (F.col("home") == F.col("tname")))
    order = F.struct((~F.col("member")).alias("aside"), (-F.col("own")).alias("less"), F.col("qname").alias("q"))
    mine = lambda kind: F.count_if(F.col("member") & (F.col("relationship") == kind))
    per = touching.groupBy(*RUN, "tname").agg(
        F.count("*").alias("n_touching"), F.count_if("member").alias("n_candidates"), F.sum("own").alias("all_own"), F.min(order).alias("best"), mine("complementary_fragment").alias("n_fragments"), mine("redundant").alias("n_redundant"),
        F.count_if(F.col("relationship") == "chimeric").alias("n_chimeric_touching"),
    )
    rows = wanted.join((found if runs is None else runs).select(*RUN).distinct(), "sample").join(per, [*RUN, "tname"], "left").join(union, [*RUN, "tname"], "left")
    rows = rows.fillna(0, ["n_touching", "n_candidates", "all_own", "n_fragments", "n_redundant", "n_chimeric_touching", "union_bp"])
    several = F.when((F.col("n_fragments") > 0) & (F.col("n_redundant") > 0), "fragmented_and_duplicated").when(F.col("n_fragments") > 0, "fragmented").when(F.col("n_redundant") > 0, "duplicated")
    outcome = F.when(F.col("n_touching") == 0, "missed").when(F.col("n_candidates") == 0, "carried_only_in_other_candidates").otherwise(F.coalesce(several, F.lit("single")))
    best = F.coalesce(-F.col("best.less"), F.lit(0))
    share = lambda x: (x / F.col("plasmid_length")).cast("double")
    return rows.select(
        *RUN, F.col("tname").alias("plasmid"), outcome.alias("outcome"), "n_candidates", "n_touching", F.col("best.q").alias("best_candidate"), share(best).alias("best_candidate_coverage"), share(F.col("union_bp")).alias("combined_coverage"),
        share(F.col("union_bp") - best).alias("coverage_gain"), (F.col("all_own") - F.col("union_bp")).alias("redundant_bp"), F.coalesce(F.try_divide(F.col("all_own") - F.col("union_bp"), F.col("all_own")), F.lit(0.0)).alias("redundancy_fraction"),
        "n_fragments", "n_redundant", "n_chimeric_touching",
    )
