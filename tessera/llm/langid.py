"""Language by compression: a text belongs to the language whose zstandard dictionary makes it smallest.

Each language's dictionary is raw content: whole training texts in hash order up to ``dict_bytes``, a bounded sample. A text that
no longer fits is left out; of a language that has longer texts only, the first one's end is taken.
Texts and dictionaries are lower-cased. Dictionaries are all that tasks get; every text is compressed once per language.
A narrow margin between the smallest and the next marks the prediction as rejected; lang_pred still names the smallest.

Null texts and texts without a letter are ``und`` with score 0, as is everything if no text has a language. A null doc_id is
carried along and never held out. Repeated rows each get a row. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, held_out, keyed, ship

#: Rows of ids that may be broadcast.
SMALL_ROWS = 100_000


def dictionaries(docs: DataFrame, dict_bytes: int, texts: int = 400) -> dict[str, bytes]:
    """For each language up to dict_bytes of at most texts training texts, the first in hash order last: near content is cheapest to refer to."""
    known = docs.filter("lang is not null and text <> '' and doc_id is not null").filter(~held_out())
    ids = known.select("lang", "doc_id", keyed(29, F.col("doc_id")).alias("draw"))
    # a draw for each id leaves some more than are wanted of a language, so that ranking them is no task's burden; no text is shuffled
    share = ids.groupBy("lang").agg(F.lit(4.0 * texts) / F.count("*")).collect()  # a row for each language
    wanted = F.coalesce(*(F.when(F.col("lang") == lang, F.lit(float(most))) for lang, most in share), F.lit(0.0))
    order = Window.partitionBy("lang").orderBy("draw", "doc_id")
    picked = ids.filter(F.col("draw") < wanted).distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= texts)
    picked = cut(picked.select("lang", "doc_id", "n"))
    near = F.broadcast(picked) if picked.count() <= SMALL_ROWS else picked
    rows = known.join(near, ["lang", "doc_id"]).dropDuplicates(["lang", "n"])
    held: dict[str, list[bytes]] = {}
    long: dict[str, bytes] = {}
    for r in rows.orderBy("lang", "n").toLocalIterator():
        text = r["text"].lower().encode()
        own = held.setdefault(r["lang"], [])
        if sum(map(len, own)) + len(own) + len(text) <= dict_bytes:
            own.append(text)
        else:
            long.setdefault(r["lang"], text[-dict_bytes:])
    return {k: b"\n".join(v[::-1]) or long[k] for k, v in held.items()}


def identify(docs: DataFrame, dict_bytes: int = 100_000, level: int = 6, margin: float = 0.01) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of each row."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text", "lang")
    known = dictionaries(docs, dict_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = sorted(known)
        by = []
        for k in names:
            content = zstandard.ZstdCompressionDict(known[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            by.append(zstandard.ZstdCompressor(level=level, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False))
        for batch in batches:
            out: list[list] = [[], [], []]
            for text in batch.column("text").to_pylist():
                if not names or text is None or not any(map(str.isalpha, text)):
                    one = ("und", 0.0, True)
                else:
                    raw = text.lower().encode()
                    sizes = sorted((len(c.compress(raw)), k) for k, c in zip(names, by, strict=True))
                    gap = (sizes[1][0] - sizes[0][0]) / sizes[1][0] if len(sizes) > 1 else 1.0
                    one = (sizes[0][1], 1 - 2 ** (-25 * gap), gap < margin)
                for held, v in zip(out, one, strict=True):
                    held.append(v)
            yield pa.record_batch([batch.column("doc_id"), pa.array(out[0], pa.string()), pa.array(out[1], pa.float64()), pa.array(out[2], pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    found = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
