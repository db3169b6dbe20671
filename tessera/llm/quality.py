"""Quality rules with adaptive thresholds: mergeable quantile sketches per language and source replace fixed cutoffs.

Features come from expressions over each whole text. KLL sketches of their rates and of the
texts' sizes are built in tasks and merged per (lang, source), over the texts that the base rules pass; each group's middle and upper spread come
from their quantiles. A text breaks a rule if its rate lies more than a multiple of its deviation above the middle: that of the group,
and that of a count in a text of its own size. No threshold is fixed. A group of too few texts takes those of its language or
of the whole table, whose sketches are merged from the groups' own. They join back on (lang, source) and decide.

Texts are read whole, however long. Null and empty texts have no words and fail the base rules. A null lang or source is a group of its own. Repeated rows each get
a row. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, let, row_id, unused
from tessera.llm.native import plain_words

SYMBOLS = "#*$%&|<>"
#: Rate: (what is counted, per what, the least step of the count, the quantile that its spread is taken at besides 0.75). A repeat is three
#: words twice at least, so it counts six. At 0.8, a group of which a fifth is junk still has the bound of its others; some hundredths of
#: good texts repeat a line or a phrase or two, so those rates' quantile lies further out.
RATES = {
    "symbol_rate": ("n_symbols", "n_words", 1, 0.8),
    "dup_line_rate": ("n_dup_lines", "n_lines", 1, 0.97),
    "repeat_rate": ("n_repeat_words", "n_words", 6, 0.97),
    "word_length": ("word_chars", "n_words", 1, 0.8),
}
SIZES = ("n_words", "n_lines")
#: Size parameter of the sketches: ranks are right to some thousandths, and exact for groups of about this many rows.
SKETCH_K = 1024
#: What the base rules reject.
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that the text holds twice or more, the first of them included."""

    def places(grams: Column) -> Column:
        def same(x: Column, i: Column) -> Column:
            return (x["h"] == F.get(grams, i - 1)["h"]) | (x["h"] == F.get(grams, i + 1)["h"])

        return F.array_sort(F.transform(F.filter(grams, lambda x, i: F.coalesce(same(x, i), F.lit(False))), lambda x: x["p"]))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda p, i: F.coalesce(F.least(F.get(at, i + 1) - p, F.lit(3)), F.lit(3))), F.lit(0), lambda s, x: s + x)

    def count(w: Column) -> Column:
        gram = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")))
        return let(let(F.sort_array(gram), places), covered)

    return let(words, lambda w: F.when(F.size(w) < 3, F.lit(0)).otherwise(count(w))).cast("long")


def features(docs: DataFrame) -> DataFrame:
    """doc_id (of any type), lang, source and the counts of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    rows = docs.select("doc_id", "lang", "source", text.alias("text"))
    words = plain_words(F.col("text"))
    return rows.select(
        "doc_id", "lang", "source",
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))).alias("w"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
    ).select("doc_id", "lang", "source", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines")


def bounds(rows: DataFrame, least_rows: int = 200) -> DataFrame:
    """lang, source and each rate's middle and spread between texts, from sketches of the rows that the base rules pass.

    A rate that a share q of the texts don't have at all has no quantile to go by. Counts of which a text of the group's median size
    has none with probability q come at -ln(q) of their steps a text: no lower spread can be told from the group.
    """
    rated = rows.filter(f"not ({BASE_FAILED})").select("lang", "source", *(F.expr(f"{of} / greatest({per}, 1)").alias(k) for k, (of, per, *_) in RATES.items()), *(F.col(c).cast("double") for c in SIZES))
    sketched = [*RATES, *SIZES]
    own = rated.groupBy("lang", "source").agg(F.count("*").alias("n"), *(F.kll_sketch_agg_double(k, SKETCH_K).alias(k) for k in sketched))
    own = cut(own)

    def merged(*keys: str) -> DataFrame:
        return own.groupBy(*keys).agg(F.sum("n").alias("n"), *(F.kll_merge_agg_double(k, SKETCH_K).alias(k) for k in sketched))

    def limits() -> Column:
        def one(rate: str, per: str, step: int, tail: float) -> Column:
            middle, upper, far = (F.kll_sketch_get_quantile_double(rate, F.lit(q)) for q in (0.5, 0.75, tail))
            alike = NormalDist().inv_cdf(tail) / NormalDist().inv_cdf(0.75)  # both spreads are the same for normal rates
            unseen = -step * math.log(tail) / F.greatest(F.kll_sketch_get_quantile_double(per, F.lit(0.5)), F.lit(1.0))
            return F.struct(middle.alias("middle"), F.greatest(upper - middle, (far - middle) / alike, unseen).alias("spread"))

        return F.struct(*(one(k, *how).alias(k) for k, (_, *how) in RATES.items()))

    def bounded(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, F.when(F.col("n") >= least_rows, limits())).drop("n", *sketched)

    everything = own.agg(*(F.kll_merge_agg_double(k, SKETCH_K).alias(k) for k in sketched)).select(limits().alias("of_all"))
    by_lang = bounded(merged("lang"), "of_lang").withColumnRenamed("lang", "its_lang")
    out = bounded(own, "of_group").join(by_lang, F.col("lang").eqNullSafe(F.col("its_lang")), "left")
    out = out.withColumn("one", F.lit(1)).join(everything.withColumn("one", F.lit(1)), "one", "left")
    return out.select("lang", "source", F.coalesce("of_group", "of_lang", "of_all").alias("bound"))


def over(rate: str, spreads: float) -> str:
    """The condition that a text's rate is too high: by more than spreads deviations, of which the texts' spread is one part and the
    chance of a count in a text of this size the other."""
    of, per, step, _ = RATES[rate]
    size, b = f"greatest({per}, 1)", f"bound.{rate}"
    return f"n_words > 0 and {of} / {size} > {b}.middle + {spreads} * sqrt({b}.spread * {b}.spread + {step} * ({b}.middle + {b}.spread) / {size})"


def score(docs: DataFrame, least_rows: int = 200, spreads: float = 6.0) -> DataFrame:
    """Counts, base_failed, the rates, the first rule that a text breaks, and kept, for each row."""
    return judge(docs.withColumn("doc_id", F.col("doc_id").cast("long")), least_rows, spreads)


def judge(docs: DataFrame, least_rows: int = 200, spreads: float = 6.0) -> DataFrame:
    rows = cut(features(docs))
    limit = bounds(rows, least_rows)
    limit = limit.select(F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), "bound")
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    rated = rows.join(limit, same, "left").withColumn("base_failed", F.expr(BASE_FAILED))
    odd = F.coalesce(*(F.when(F.expr(over(k, spreads)), F.lit(k)) for k in RATES))
    rated = rated.withColumn("broken_rule", F.when(F.col("base_failed"), F.lit("base")).otherwise(odd))
    return rated.withColumn("kept", F.col("broken_rule").isNull()).drop("of_lang", "of_source", "bound")


def keep(docs: DataFrame, least_rows: int = 200, spreads: float = 6.0) -> DataFrame:
    """docs without the rows that the rules reject; rows with a null doc_id are judged by their text like others."""
    key, of = unused(docs, "row_id"), row_id(F.col("text"), F.col("lang"), F.col("source"))
    judged = judge(docs.select(of.alias("doc_id"), "text", "lang", "source"), least_rows, spreads)
    gone = judged.filter("not kept").select(F.col("doc_id").alias(key)).distinct()
    return docs.withColumn(key, of).join(gone, key, "left_anti").select(docs.columns)
