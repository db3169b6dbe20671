"""Conservation of gene order: neighbours on the truth, the step over a circle's origin included, that stay neighbours on the prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.intervals import overlap_join

RUN = ["sample", "tool"]


def projected(genes: DataFrame, blocks: DataFrame, least_cover: float = 0.5) -> DataFrame:
    """sample, tool, copy_id, record, position and strand of each gene whose best block covers least_cover of it: its middle, carried over proportionally.

    genes: sample, sequence_id, copy_id, start_pos, end_pos; blocks: sample, tool, qname, tname, qstart, qend, s, e, strand. Of blocks that
    cover as much the first on the target counts.
    """
    own = genes.select("sample", F.col("sequence_id").alias("tname"), "copy_id", F.col("start_pos").alias("ls"), F.col("end_pos").alias("le"))
    over = blocks.select(*RUN, "tname", F.col("s").alias("rs"), F.col("e").alias("re"), F.col("qname").alias("record"), F.least("qstart", "qend").alias("qs"), F.greatest("qstart", "qend").alias("qe"), F.col("strand").alias("way"))
    both = overlap_join(own, over, ["sample", "tname"])
    best = both.groupBy(*RUN, "copy_id").agg(F.min(F.struct((-F.col("overlap")).alias("less"), "rs", "re", "record", "qs", "qe", "way", "ls", "le")).alias("b")).select(*RUN, "copy_id", "b.*")
    best = best.filter(-F.col("less") >= least_cover * (F.col("le") - F.col("ls")))
    middle = F.least(F.greatest((F.col("ls") + F.col("le")) / 2, F.col("rs")), F.col("re"))
    along = (middle - F.col("rs")) / F.greatest(F.col("re") - F.col("rs"), F.lit(1)) * (F.col("qe") - F.col("qs"))
    return best.select(*RUN, "copy_id", "record", F.when(F.col("way") == "+", F.col("qs") + along).otherwise(F.col("qe") - along).alias("position"), F.col("way").alias("strand"))


def neighbours(genes: DataFrame, circular: DataFrame) -> DataFrame:
    """sample, i, j: each gene and the next one of its sequence; a circle of more than two has a pair over its origin. circular: the sequence_ids that are."""
    order = Window.partitionBy("sample", "sequence_id").orderBy("start_pos", "end_pos", "copy_id")
    whole = Window.partitionBy("sample", "sequence_id")
    rows = genes.join(circular.select("sequence_id", F.lit(True).alias("circle")).distinct(), "sequence_id", "left")
    rows = rows.withColumns({"j": F.lead("copy_id").over(order), "n": F.count("*").over(whole), "first": F.first("copy_id").over(order)})
    wrap = F.when(F.col("circle") & (F.col("n") > 2), F.col("first"))
    return rows.select("sample", F.col("copy_id").alias("i"), F.coalesce("j", wrap).alias("j")).filter("j is not null")


def conserved(genes: DataFrame, circular: DataFrame, blocks: DataFrame, runs: DataFrame, least_cover: float = 0.5) -> DataFrame:
    """sample, tool, pairs, conserved, projected and ngoc, the conserved share, of each run (sample, tool). A pair is conserved if both genes lie on one
    record in one orientation next to each other, in the order that the orientation has, or over the ends of a record of more than two."""
    place = Window.partitionBy(*RUN, "record")
    spots = projected(genes, blocks, least_cover)
    index = genes.select("sample", "copy_id", F.struct("sequence_id", "start_pos", "end_pos", "copy_id").alias("index"))
    spots = spots.join(index, ["sample", "copy_id"]).withColumns({"rank": F.row_number().over(place.orderBy("position", "index")), "size": F.count("*").over(place)})
    pairs = neighbours(genes, circular)
    left, right = (spots.select(*RUN, F.col("copy_id").alias(g), *(F.col(c).alias(f"{c}_{g}") for c in ("record", "strand", "rank", "size"))) for g in ("i", "j"))
    both = pairs.join(left, ["sample", "i"]).join(right, [*RUN, "j"]).filter("record_i = record_j and strand_i = strand_j")
    forward = F.when(F.col("strand_i") == "+", 1).otherwise(-1)
    step = F.col("rank_j") - F.col("rank_i")
    over_end = (F.col("size_i") > 2) & (step == forward * (1 - F.col("size_i")))
    kept = both.filter((step == forward) | over_end).groupBy(*RUN).agg(F.count("*").alias("conserved"))
    out = runs.select(*RUN).distinct().join(pairs.groupBy("sample").agg(F.count("*").alias("pairs")), "sample").join(kept, RUN, "left").join(spots.groupBy(*RUN).agg(F.count("*").alias("projected")), RUN, "left")
    out = out.fillna(0, ["conserved", "projected"])
    return out.select(*RUN, "pairs", "conserved", "projected", (F.col("conserved") / F.col("pairs")).alias("ngoc"))
