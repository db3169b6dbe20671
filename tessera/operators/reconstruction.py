"""How well bins rebuild plasmids, and where alignments of one record disagree with the reference.

Tables: overlaps (keys, bin, ref, bp) of plasmids alone; chromosome (keys, bin, bp); plasmids (keys, ref, length) of every run;
bins (keys, bin) of every run. keys name a run. A run without a bin or a plasmid has null where a share is undefined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import graph
from tessera.operators.intervals import overlap_join, union_bp


def bin_totals(overlaps: DataFrame, chromosome: DataFrame, bins: DataFrame, keys: list[str]) -> DataFrame:
    """keys, bin, plasmid_bp, chromosome_bp, mapped_bp, purity (0 for a bin that maps nowhere)."""
    own = overlaps.groupBy(*keys, "bin").agg(F.sum("bp").alias("plasmid_bp"))
    other = chromosome.groupBy(*keys, "bin").agg(F.sum("bp").alias("chromosome_bp"))
    out = bins.join(own, [*keys, "bin"], "left").join(other, [*keys, "bin"], "left").fillna(0, ["plasmid_bp", "chromosome_bp"])
    mapped = F.col("plasmid_bp") + F.col("chromosome_bp")
    return out.withColumn("mapped_bp", mapped).withColumn("purity", F.when(mapped > 0, F.col("plasmid_bp") / mapped).otherwise(0.0))


def matched(edges: DataFrame, keys: list[str], weight: str = "bp") -> DataFrame:
    """The one-to-one matching of bins and plasmids of greatest total weight (SQL over the edges' columns), with their other columns."""
    pairs = graph.best_matching(edges.select(*keys, F.col("bin").alias("left"), F.col("ref").alias("right"), F.expr(weight).cast("double").alias("weight")), keys)
    return edges.join(pairs.select(*keys, F.col("left").alias("bin"), F.col("right").alias("ref")), [*keys, "bin", "ref"], "left_semi")


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def f1_of(p: Column, r: Column) -> Column:
    """Harmonic mean, 0 where both are 0; null where either is undefined."""
    return F.when(p.isNotNull() & r.isNotNull(), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))


def bin_scores(overlaps: DataFrame, chromosome: DataFrame, plasmids: DataFrame, bins: DataFrame, keys: list[str], completeness: float = 0.9, purity: float = 0.9, share: float = 0.1, weight: str = "bp") -> DataFrame:
    """One row a run: precision, recall and F1 over bins and plasmids, matched one to one on edges complete and pure enough; and what went wrong.

    A split is a further bin that holds a share of a plasmid, a merge a further plasmid of which a bin holds a share.
    """
    totals = bin_totals(overlaps, chromosome, bins, keys)
    edges = overlaps.join(plasmids, [*keys, "ref"]).join(totals.select(*keys, "bin", "purity"), [*keys, "bin"])
    found = matched(edges.filter((F.col("bp") >= completeness * F.col("length")) & (F.col("purity") >= purity)), keys, weight).groupBy(*keys).agg(F.count("*").alias("matched"))
    held = edges.filter(F.col("bp") >= share * F.col("length"))
    extra = lambda side, name: held.groupBy(*keys, side).agg((F.count("*") - 1).alias("x")).groupBy(*keys).agg(F.sum("x").alias(name))
    per_bin = totals.groupBy(*keys).agg(F.count("*").alias("bins"), F.count_if(F.col("chromosome_bp") > 0).alias("contaminated"), F.sum("chromosome_bp").alias("chromosome_bp"), F.sum("mapped_bp").alias("mapped_bp"))
    out = plasmids.groupBy(*keys).agg(F.count("*").alias("plasmids")).join(per_bin, keys, "full")
    for part in (found, extra("ref", "splits"), extra("bin", "merges")):
        out = out.join(part, keys, "left")
    out = out.fillna(0, ["plasmids", "bins", "contaminated", "chromosome_bp", "mapped_bp", "matched", "splits", "merges"])
    p, r = F.when(F.col("plasmids") > 0, ratio(F.col("matched"), F.col("bins"))).otherwise(F.when(F.col("bins") > 0, 0.0)), ratio(F.col("matched"), F.col("plasmids"))
    return out.select(
        *keys, "bins", "plasmids", "matched", (F.col("bins") - F.col("matched")).alias("unmatched_bins"), (F.col("plasmids") - F.col("matched")).alias("missed"), p.alias("precision"), r.alias("recall"), f1_of(p, r).alias("f1"),
        "splits", "merges", "contaminated", "chromosome_bp", ratio(F.col("chromosome_bp"), F.col("mapped_bp")).alias("contamination"),
    )


def correct_plasmids(overlaps: DataFrame, identities: DataFrame, chromosome: DataFrame, plasmids: DataFrame, bins: DataFrame, keys: list[str], coverage: float = 0.95, bin_share: float = 0.95, identity: float = 0.99, split: float = 0.1, weight: str = "bp") -> DataFrame:
    """One row a plasmid: its bin in the matching of greatest bp, and whether it meets each test: found, covered, most of its bin, not split, alike.

    identities: keys, bin, ref, matches, block_length sums of the alignments.
    """
    totals = bin_totals(overlaps, chromosome, bins, keys).select(*keys, "bin", "mapped_bp")
    best = matched(overlaps, keys, weight).join(totals, [*keys, "bin"]).join(identities, [*keys, "bin", "ref"], "left")
    holders = overlaps.join(plasmids, [*keys, "ref"]).filter(F.col("bp") >= split * F.col("length")).groupBy(*keys, "ref").agg(F.collect_set("bin").alias("holders"))
    rows = plasmids.join(best, [*keys, "ref"], "left").join(holders, [*keys, "ref"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    rows = rows.withColumn("coverage", zero(F.col("bp") / F.col("length"))).withColumn("bin_share", zero(F.col("bp") / F.col("mapped_bp"))).withColumn("identity", zero(F.col("matches") / F.col("block_length")))
    others = F.when(F.col("bin").isNull(), F.size("holders")).otherwise(F.size(F.array_remove("holders", F.col("bin"))))
    rows = rows.withColumn("split", F.coalesce(others > 0, F.lit(False)))
    whole = F.col("bin").isNotNull() & (F.col("coverage") >= coverage) & (F.col("bin_share") >= bin_share) & ~F.col("split")
    return rows.select(*keys, "ref", "bin", "coverage", "bin_share", "identity", "split", whole.alias("correct_without_identity"), (whole & (F.col("identity") >= identity)).alias("correct"))


def outcomes(overlaps: DataFrame, chromosome: DataFrame, plasmids: DataFrame, bins: DataFrame, keys: list[str], perfect: float = 0.95, share: float = 0.20, missed: float = 0.50) -> DataFrame:
    """One outcome a plasmid by the bin that holds most of it: missed, fragmented, merged, fragmented_and_merged, perfect or partial."""
    totals = bin_totals(overlaps, chromosome, bins, keys).select(*keys, "bin", "mapped_bp")
    rows = overlaps.join(plasmids, [*keys, "ref"]).withColumn("large", F.col("bp") >= share * F.col("length"))
    per_bin = rows.groupBy(*keys, "bin").agg(F.count_if("large").alias("large_refs"))
    per_ref = rows.groupBy(*keys, "ref").agg(F.max_by(F.struct("bin", "bp", "large"), F.struct("bp", "bin")).alias("best"), F.count_if("large").alias("holders"))
    best = per_ref.select(*keys, "ref", "best.bin", "best.bp", "best.large", "holders").join(totals, [*keys, "bin"]).join(per_bin, [*keys, "bin"])
    out = plasmids.join(best, [*keys, "ref"], "left")
    merged = F.col("large_refs") - F.col("large").cast("int") > 0
    fragmented = F.col("holders") > 1
    outcome = (
        F.when(F.coalesce(F.col("bp") < missed * F.col("length"), F.lit(True)), "missed").when(fragmented & merged, "fragmented_and_merged").when(fragmented, "fragmented").when(merged, "merged")
        .when((F.col("bp") >= perfect * F.col("length")) & (F.col("bp") >= perfect * F.col("mapped_bp")), "perfect").otherwise("partial")
    )
    return out.select(*keys, "ref", "bin", outcome.alias("outcome"))


def clustering_agreement(overlaps: DataFrame, chromosome: DataFrame, plasmids: DataFrame, keys: list[str]) -> DataFrame:
    """NMI, variation of information and adjusted Rand index of each run over base pairs.

    Rows are bins, columns plasmids and one column for chromosome that bins claim. A plasmid base that no bin claims is a bin of its
    own: such bins enter as sums, so a missed megabase costs nothing. Chromosome that no bin claims isn't counted.
    """
    cells = overlaps.filter("bp > 0").select(*keys, "bin", F.col("ref").cast("string").alias("col"), "bp")
    cells = cells.unionByName(chromosome.filter("bp > 0").groupBy(*keys, "bin").agg(F.sum("bp").alias("bp")).withColumn("col", F.lit("CHROMOSOME")))
    claimed = overlaps.groupBy(*keys, "ref").agg(F.sum("bp").alias("claimed"))
    alone = plasmids.join(claimed, [*keys, "ref"], "left").select(*keys, F.col("ref").cast("string").alias("col"), F.greatest(F.col("length") - F.coalesce("claimed", F.lit(0)), F.lit(0)).alias("bp")).filter("bp > 0")
    ln = lambda c: F.sum(F.col(c) * F.ln(c))
    chosen = lambda c: F.sum(F.col(c).cast("double") * (F.col(c) - 1) / 2)
    single = alone.groupBy(*keys).agg(F.sum("bp").alias("single"))
    rows = cells.groupBy(*keys, "bin").agg(F.sum("bp").alias("x")).groupBy(*keys).agg(ln("x").alias("row_ln"), chosen("x").alias("row_pairs"))
    cols = cells.drop("bin").unionByName(alone).groupBy(*keys, "col").agg(F.sum("bp").alias("x")).groupBy(*keys).agg(ln("x").alias("col_ln"), F.sum("x").alias("n"), chosen("x").alias("col_pairs"))
    both = cells.groupBy(*keys).agg(ln("bp").alias("cell_ln"), chosen("bp").alias("cell_pairs"))
    t = cols.join(rows, keys, "left").join(both, keys, "left").join(single, keys, "left").fillna(0, ["row_ln", "row_pairs", "cell_ln", "cell_pairs", "single"])
    n = F.col("n").cast("double")
    h_row, h_col, h_both = (F.greatest(F.ln(n) - F.col(c) / n, F.lit(0.0)) for c in ("row_ln", "col_ln", "cell_ln"))  # x ln x is 0 for a single base
    mi = h_row + h_col - h_both
    none = F.lit(1e-12)
    nmi = F.when((h_row <= none) & (h_col <= none), 1.0).when((h_row <= none) | (h_col <= none), 0.0).otherwise(F.least(F.greatest(2 * mi / (h_row + h_col), F.lit(0.0)), F.lit(1.0)))
    chance = F.col("row_pairs") * F.col("col_pairs") / (n * (n - 1) / 2)
    ari = F.try_divide(F.col("cell_pairs") - chance, (F.col("row_pairs") + F.col("col_pairs")) / 2 - chance)
    return t.select(*keys, F.col("n").alias("bp"), nmi.alias("nmi"), F.greatest(h_row + h_col - 2 * mi, F.lit(0.0)).alias("vi"), ari.alias("ari"))


def block_joins(blocks: DataFrame, keys: list[str], tolerance: int = 100, least_event: int = 200, least_overlap: int = 200) -> DataFrame:
    """What lies between each record's neighbouring alignment blocks: keys, qname, kind, span, left_target, right_target.

    blocks: keys, qname, qstart, qend, strand, tname, tlen, s, e, block_length, mapq. Kinds: inter_replicon_junction,
    inversion_junction, origin_wrap (no discordance: a circle was opened elsewhere), tandem_duplication, relocation,
    reference_deletion, reference_insertion; null where the two go on.
    """
    order = Window.partitionBy(*keys, "qname").orderBy("qstart", "qend", "tname", "s", "e", "strand", "mapq")
    names = ("qstart", "strand", "tname", "s", "e", "block_length")
    rows = blocks.select(*keys, "qname", "qend", "tlen", *names, *(F.lead(c).over(order).alias(f"r_{c}") for c in names)).filter("r_qstart is not null")
    forward = F.col("strand") == "+"
    near_end, near_start = F.col("tlen") - tolerance, F.lit(tolerance)
    wrap = (F.abs(F.col("r_qstart") - F.col("qend")) <= tolerance) & F.when(forward, (F.col("e") >= near_end) & (F.col("r_s") <= near_start)).otherwise((F.col("s") <= near_start) & (F.col("r_e") >= near_end))
    gap = F.when(forward, F.col("r_s") - F.col("e")).otherwise(F.col("s") - F.col("r_e"))
    drift = gap - (F.col("r_qstart") - F.col("qend"))
    least = max(least_event, tolerance)
    kind = (
        F.when(F.col("tname") != F.col("r_tname"), "inter_replicon_junction").when(F.col("strand") != F.col("r_strand"), "inversion_junction").when(wrap, "origin_wrap")
        .when((gap < -tolerance) & (gap <= -least_overlap), "tandem_duplication").when(gap < -tolerance, "relocation").when(drift >= least, "reference_deletion").when(drift <= -least, "reference_insertion")
    )
    rows = rows.withColumn("kind", kind)
    span = F.when(F.col("kind").isin("inter_replicon_junction", "inversion_junction"), F.col("r_block_length")).when(F.col("kind").isin("tandem_duplication", "relocation"), -gap).when(F.col("kind") == "origin_wrap", 0).otherwise(F.abs(drift))
    return rows.select(*keys, "qname", "kind", span.cast("long").alias("span"), F.col("tname").alias("left_target"), F.col("r_tname").alias("right_target"))


def touched(joins: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ref: targets that a discordance stands on."""
    events = joins.filter("kind is not null and kind <> 'origin_wrap'")
    return events.select(*keys, F.explode(F.array("left_target", "right_target")).alias("ref")).distinct()


def rearranged(chosen: DataFrame, joins: DataFrame, keys: list[str]) -> DataFrame:
    """By run: how many of the chosen plasmids (keys, ref) a discordance touches nevertheless, of how many."""
    hit = touched(joins, keys).withColumn("hit", F.lit(1))
    return chosen.join(hit, [*keys, "ref"], "left").groupBy(*keys).agg(F.count("hit").alias("touched"), F.count("*").alias("of"))


def gene_placement(blocks: DataFrame, genes: DataFrame, membership: DataFrame, homes: DataFrame, keys: list[str], sample: str = "sample", least: float = 0.9) -> DataFrame:
    """One row a gene copy and run: whether it is recovered, on which record and bin, and on the right plasmid.

    blocks: keys, qname, ref, s, e; genes: sample, ref, copy_id, start_pos, end_pos; membership: qname, bin; homes: keys, bin, home (the
    plasmid that a bin is matched to). A copy is recovered if all records together cover the least share of it. It is
    placed by the record that covers most of it (the smallest name of equals), if that one alone covers as much and has a bin.
    """
    runs = blocks.select(*keys).distinct()
    held = overlap_join(blocks.withColumnsRenamed({"s": "ls", "e": "le"}), genes.select(sample, "ref", "copy_id", F.col("start_pos").alias("rs"), F.col("end_pos").alias("re")), [sample, "ref"])
    held = held.select(*keys, "copy_id", "qname", F.greatest("ls", "rs").alias("s"), F.least("le", "re").alias("e"))
    of_record = union_bp(held, [*keys, "copy_id", "qname"]).groupBy(*keys, "copy_id").agg(F.min_by(F.struct("qname", "bp"), F.struct(-F.col("bp"), "qname")).alias("best"))
    of_all = union_bp(held, [*keys, "copy_id"], name="all_bp")
    rows = genes.join(runs, sample).join(of_all, [*keys, "copy_id"], "left").join(of_record, [*keys, "copy_id"], "left").withColumn("qname", F.col("best.qname")).join(membership, "qname", "left").join(homes, [*keys, "bin"], "left")
    length = F.greatest(F.col("end_pos") - F.col("start_pos"), F.lit(1))
    recovered = F.coalesce(F.col("all_bp") >= least * length, F.lit(False))
    whole = F.col("best.bp") >= least * length
    placement = F.when(~recovered, "not_recovered").when(~whole | F.col("bin").isNull(), "unassigned_contig").when(F.col("home") == F.col("ref"), "correct_plasmid").otherwise("wrong_plasmid")
    rows = rows.withColumn("placement", placement).withColumn("bin", F.when(recovered & whole, F.col("bin")))
    return rows.select(*keys, "copy_id", "ref", "gene_class", F.when(recovered, F.col("qname")).alias("record"), "bin", "placement")


def class_rates(placed: DataFrame, by: str = "tool") -> DataFrame:
    """Placements by tool and gene class, and over all classes: counts, and the share of copies on the right plasmid."""
    count = lambda k: F.count_if(F.col("placement") == k).alias(k)
    out = placed.withColumn("class", F.explode(F.array("gene_class", F.lit("all")))).groupBy(by, "class").agg(F.count("*").alias("copies"), F.count_if(F.col("placement") != "not_recovered").alias("recovered"), count("correct_plasmid"), count("wrong_plasmid"), count("unassigned_contig"))
    return out.withColumn("correct_rate", F.col("correct_plasmid") / F.col("copies"))
