"""License scans by diagonal voting.

Base labels are exact phrases. Beside them every 3-word gram of every text is hashed and joined to the positions at
which license templates hold it; a gram votes for the diagonal (its place in the text less its place in the template).
Votes of neighbouring diagonals are merged, so a word added or lost inside a notice doesn't part it, and a merged span
is verified: its grams are compared word by word with the template's, and decide how much of it is covered; and it must be about as long as the template. The templates
are a fixed short list, so their table is of fixed size; grams that fall on none of its bits leave before they become
rows.

Null and empty texts have no words, no places and no labels. Repeated rows each get a row. A null doc_id is carried along. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, let, row_id
from tessera.llm.native import bit_table, bucket, in_table, letter_words

GRAM = 3
TABLE_BITS = 1 << 14
#: Phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Label and wording of short notices, as their licenses suggest them.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
)


def gram_hash(words: Column, at: Column) -> Column:
    return F.xxhash64(*(F.get(words, at + k) for k in range(GRAM)))


def templates(spark: SparkSession, known: tuple[tuple[str, str], ...]) -> DataFrame:
    """gram, said (its words), template, label, template_words, template_at: the positions of every gram of every template."""
    rows = spark.createDataFrame([(k, label, text) for k, (label, text) in enumerate(known)], "template int, label string, text string")
    rows = rows.select("template", "label", letter_words(F.col("text")).alias("w")).withColumn("template_words", F.size("w"))
    rows = rows.withColumn("template_at", F.explode(F.sequence(F.lit(0), F.col("template_words") - GRAM)))
    return rows.select(gram_hash(F.col("w"), F.col("template_at")).alias("gram"), F.slice("w", F.col("template_at") + 1, F.lit(GRAM)).alias("said"), "template", "label", "template_words", "template_at")


def places(words: Column, phrase: str, label: str) -> Column:
    """First words of a phrase's places."""
    parts = phrase.split()

    def is_place(x: Column, i: Column) -> Column:
        all_ = x == parts[0]
        for k, p in enumerate(parts[1:], 1):
            all_ = all_ & F.coalesce(F.get(words, i + k) == p, F.lit(False))
        return all_

    # an item is its index where the phrase stands, else null
    at = F.filter(F.transform(words, lambda x, i: F.when(is_place(x, i), i)), lambda i: i.isNotNull())
    rare = parts[-1] if len(parts[-1]) > len(parts[0]) else parts[0]
    none = F.array().cast("array<int>")
    return F.transform(F.when(F.array_contains(words, rare), at).otherwise(none), lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))


def scan(docs: DataFrame, known: tuple[tuple[str, str], ...] = TEMPLATES, least_cover: float = 0.8, drift: int = 3) -> DataFrame:
    """doc_id, n_words, the base places and labels, all labels, score, and the verified spans (label, first_word, last_word, cover)."""
    spark = docs.sparkSession
    table = templates(spark, known)
    bits: dict[int, int] = {}
    for row in table.select(bucket(F.col("gram"), TABLE_BITS).alias("b")).collect():  # as many rows as the fixed templates have grams
        bits[row.b >> 6] = bits.get(row.b >> 6, 0) | 1 << (row.b & 63)
    have = bit_table({k: v - (1 << 64) if v >> 63 else v for k, v in bits.items()}, TABLE_BITS)

    def found(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - GRAM), lambda i: F.struct(gram_hash(w, i).alias("gram"), i.alias("at")))
        hits = F.when(F.size(w) >= GRAM, F.filter(grams, lambda x: in_table(have, x["gram"], TABLE_BITS)))
        hits = F.transform(hits, lambda x: F.struct(x["gram"].alias("gram"), x["at"].alias("at"), F.slice(w, x["at"] + 1, F.lit(GRAM)).alias("said")))
        base = F.concat(*(places(w, phrase, label) for phrase, label in BASE.items()))
        return F.struct(F.size(w).cast("long").alias("n_words"), base.alias("base"), F.coalesce(hits, F.expr("cast(array() as array<struct<gram: bigint, at: int, said: array<string>>>)")).alias("hits"))

    row_key = row_id(F.col("doc_id").cast("long"), F.col("text")).alias("row_key")
    rows = docs.select(F.col("doc_id").cast("long"), row_key, let(letter_words(F.col("text")), found).alias("f"))
    rows = cut(rows.select("doc_id", "row_key", "f.n_words", "f.base", "f.hits"))

    votes = rows.filter(F.size("hits") > 0).dropDuplicates(["row_key"]).select("row_key", F.inline("hits")).join(table, ["gram", "said"])
    votes = votes.withColumn("diagonal", F.col("at") - F.col("template_at"))
    lines = votes.groupBy("row_key", "template", "label", "template_words", "diagonal").agg(F.collect_set("template_at").alias("covers"), F.min("at").alias("first"), F.max("at").alias("last"))
    along = Window.partitionBy("row_key", "template").orderBy("diagonal")
    fresh = (F.col("diagonal") - F.lag("diagonal").over(along) > drift) | F.lag("diagonal").over(along).isNull()
    lines = lines.withColumn("band", F.sum(fresh.cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    bands = lines.groupBy("row_key", "template", "label", "template_words", "band").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("covers")))).alias("covers"), F.min("first").alias("first_word"), (F.max("last") + GRAM - 1).alias("last_word"))
    covered = let(F.col("covers"), lambda c: F.aggregate(F.transform(c, lambda p, i: F.coalesce(F.least(F.get(c, i + 1) - p, F.lit(GRAM)), F.lit(GRAM))), F.lit(0), lambda s, x: s + x))
    bands = bands.withColumn("cover", covered / F.col("template_words"))
    length = F.col("last_word") - F.col("first_word") + 1
    spans = bands.filter((F.col("cover") >= least_cover) & (length <= 1.5 * F.col("template_words") + drift))
    spans = spans.groupBy("row_key").agg(F.array_sort(F.collect_set(F.struct("label", "first_word", "last_word", "cover"))).alias("spans"))

    out = rows.drop("hits").join(spans, "row_key", "left")
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda x: x["label"])))
    own = F.coalesce(F.transform("spans", lambda x: x["label"]), F.array().cast("array<string>"))
    best = F.coalesce(F.array_max(F.transform("spans", lambda x: x["cover"])), F.lit(0.0))
    return out.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["at"])).alias("first_word"), F.array_max(F.transform("base", lambda x: x["at"])).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base_labels, own)), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.least(best, F.lit(1.0))).alias("score"), "spans",
    )
