"""Removal of word windows that also start in a document with a smaller doc_id, behind a count-min prefilter.

Pass 1: each task makes a count-min sketch of its documents' windows, two rows of cells, and sketches merge range by range. A window is
counted under its anchor, the smallest hash among its 8-word grams: equal windows have equal anchors, so an anchor's
count is never below the window's, and it takes a fifth of the cells that the windows themselves would. Its estimate is the least of
its two cells' counts. As only one question is asked of it, merging keeps a bit for each cell: two or more. That bit table is all that
is broadcast, at most 2 ** MAX_SKETCH_BITS bits (64 MB); a fuller table lets more windows through and loses none.

Pass 2: only windows whose anchor is estimated repeated are grouped, by a 96-bit digest beside the range that the
anchor names. A task first groups its own, so a window that a third of all documents hold sends one record a task.
Removed positions go back to their documents, and the kept words are digested there.

Null and empty texts have no words. A row with a null doc_id loses nothing and takes nothing from others. Rows that
repeat a doc_id never remove from one another. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Slice, mix, raw_texts, ship, slices, span_hashes, texts, word_bounds

MAX_SKETCH_BITS = 29
RANGES = 64
GRAM = 8


def pack(a: np.ndarray) -> bytes:
    """An array by byte planes, compressed."""
    return zstandard.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes(), 1)


def unpack(b: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(b), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).reshape(-1)


def rolling(x: np.ndarray, k: int, base: int) -> np.ndarray:
    n = len(x) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(k):
        out = out * np.uint64(base) + x[j : j + len(out)]
    return out


def windows(s: Slice, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each window of a slice: its anchor, its digest, its document's place in the slice and its first word there."""
    starts, ends = word_bounds(s.bytes)
    first = np.searchsorted(starts, s.starts)
    words = np.diff(np.r_[first, len(starts)])
    if len(starts) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = span_hashes(s.bytes, starts, ends)
    gram = min(GRAM, size)
    grams = mix(rolling(h, gram, 0xD6E8FEB86659FD93))
    anchor = grams[: len(h) - size + 1].copy()
    for j in range(1, size - gram + 1):
        np.minimum(anchor, grams[j : j + len(anchor)], out=anchor)
    digest = mix(rolling(mix(h ^ np.uint64(0x5851F42D4C957F2D)), size, 0xCA5A826395121157))
    doc = np.repeat(np.arange(len(words)), words)[: len(anchor)]
    place = np.arange(len(anchor)) - first[doc]
    whole = place + size <= words[doc]
    return anchor[whole], digest[whole], doc[whole], place[whole]


def sketch_rows(cells: np.ndarray, bits: int) -> pa.RecordBatch:
    """A task's part sketch: for each range its cells, those seen once and those seen more often."""
    cells, count = np.unique(cells, return_counts=True)
    per = max(1, (1 << bits) // RANGES)
    at = np.searchsorted(cells, np.arange(RANGES + 1) * per)
    rows = []
    for r in range(RANGES):
        c, n = cells[at[r] : at[r + 1]].astype(np.uint32) - np.uint32(r * per), count[at[r] : at[r + 1]]
        if len(c):
            rows.append((r, pack(np.diff(c[n == 1], prepend=np.uint32(0))), pack(np.diff(c[n > 1], prepend=np.uint32(0)))))
    return pa.record_batch([pa.array([x[k] for x in rows], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["range", "once", "more"])


def sketch_bits(documents: int) -> int:
    """Bits that name a cell of a sketch, by the documents that it is for: at most MAX_SKETCH_BITS."""
    return min(MAX_SKETCH_BITS, max(16, math.ceil(math.log2(1024 * max(documents, 1)))))


def cells(h: np.ndarray, bits: int) -> np.ndarray:
    """The cells of each hash, one in each row of the sketch."""
    shift, row = np.uint64(65 - bits), np.uint64(1 << (bits - 1))
    return np.stack([h >> shift, (mix(h) >> shift) + row]).astype(np.uint32)


def estimated_twice(table: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    """Whether both cells of each hash have counted two or more."""
    c = cells(h, bits)
    return ((table[c >> np.uint32(3)] >> (np.uint32(7) - (c & np.uint32(7))).astype(np.uint8)) & 1).all(0)


def repeated_cells(docs: DataFrame, size: int, bits: int, flush: int = 1 << 21) -> np.ndarray:
    """The merged sketch as packed bits: cells that two or more windows fall into."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for s in slices(*texts(batch.column("text"))):
                anchor, _, doc, _ = windows(s, size)
                if len(anchor):
                    fresh = np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]
                    held.append(cells(anchor[fresh], bits).reshape(-1))
                    n += len(held[-1])
                if n >= flush:
                    yield sketch_rows(np.concatenate(held), bits)
                    held, n = [], 0
        if n:
            yield sketch_rows(np.concatenate(held), bits)

    return merged_cells(docs.select("text").mapInArrow(sketch, "range int, once binary, more binary"), bits)


def merged_cells(parts: DataFrame, bits: int) -> np.ndarray:
    """One bit for each cell that the part sketches (range, once, more) fall into twice or more."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per, now, count = max(1, (1 << bits) // RANGES), None, None

        def done() -> pa.RecordBatch:
            return pa.record_batch([pa.array([now], pa.int32()), pa.array([np.packbits(count > 1).tobytes()], pa.binary())], ["range", "bits"])

        for batch in batches:
            for r, once, more in zip(*(batch.column(c).to_pylist() for c in ("range", "once", "more")), strict=True):
                if r != now:
                    if now is not None:
                        yield done()
                    now, count = r, np.zeros(per, np.uint8)
                for blob, add in ((once, 1), (more, 2)):
                    cells = np.cumsum(unpack(blob, np.uint32), dtype=np.uint32)
                    count[cells] = np.minimum(count[cells] + add, 2)
        if now is not None:
            yield done()

    parts = parts.repartition("range").sortWithinPartitions("range").mapInArrow(merge, "range int, bits binary")
    out = np.zeros((1 << bits) // 8, np.uint8)
    per = len(out) // RANGES
    for row in parts.toLocalIterator():
        out[row["range"] * per : (row["range"] + 1) * per] = np.frombuffer(row["bits"], np.uint8)
    return out


_FIELDS = (("anchor", np.uint32), ("digest", np.uint64), ("doc", np.int64), ("key", np.int64), ("place", np.uint32))
#: What says that windows are equal; a removal, once decided, goes without it.
_DIGEST = ("anchor", "digest")
_NAMES = ["range", "final", *(c for c, _ in _FIELDS)]
_ROWS = "range int, final boolean, " + ", ".join(f"{c} binary" for c, _ in _FIELDS)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """First rows of the runs of equal keys."""
    change = np.zeros(len(keys[0]), bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change)


def _split(rec: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Group records by window. Which of the sorted records a smaller doc_id removes, and the records in that order."""
    order = np.lexsort([rec["place"], rec["key"], rec["doc"], rec["digest"], rec["anchor"]])
    rec = {k: v[order] for k, v in rec.items()}
    head = _runs(rec["anchor"], rec["digest"])
    least = np.repeat(rec["doc"][head], np.diff(np.r_[head, len(order)]))
    return rec["doc"] > least, rec


def _dealt(rec: dict[str, np.ndarray], to: np.ndarray, final: bool) -> list[tuple]:
    """Records packed into one row for each range that they go to; final ones are removals, which go by document."""
    order = np.argsort(to, kind="stable")
    head = _runs(to[order]) if len(order) else np.zeros(0, np.int64)
    ends = np.r_[head[1:], len(order)] if len(order) else head
    return [(int(to[order[a]]), final, *(None if final and c in _DIGEST else pack(rec[c][order[a:b]].astype(t)) for c, t in _FIELDS)) for a, b in zip(head.tolist(), ends.tolist(), strict=True)]


def _removals(rec: dict[str, np.ndarray], ranges: int) -> list[tuple]:
    return _dealt(rec, (mix(rec["doc"].astype(np.uint64)) % np.uint64(ranges)).astype(np.int64), True)


def _batches(rows: list[tuple], size: int = 500) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * len(_FIELDS)]
    for i in range(0, len(rows), size):
        yield pa.record_batch([pa.array([r[k] for r in rows[i : i + size]], kinds[k]) for k in range(len(kinds))], _NAMES)


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The records of one range after another."""
    now, held = None, []

    def joined() -> dict[str, np.ndarray]:
        return {c: np.concatenate([unpack(x[c], t) for x in held]) for c, t in _FIELDS if held[0][c] is not None}

    for batch in batches:
        for x in batch.to_pylist():
            if x["range"] != now and held:
                yield joined()
                held = []
            now = x["range"]
            held.append(x)
    if held:
        yield joined()


def removals(docs: DataFrame, size: int, bits: int, ranges: int, flush: int = 1 << 20) -> DataFrame:
    """doc_id, text_key, places: packed first words of the windows that a smaller doc_id has too; a row for each document that has any."""
    flags = docs.sparkSession.sparkContext.broadcast(repeated_cells(docs, size, bits))

    def shrink(rec: dict[str, list]) -> Iterator[pa.RecordBatch]:
        gone, one = _split({k: np.concatenate(v) for k, v in rec.items()})
        yield from _batches(_removals({k: v[gone] for k, v in one.items()}, ranges))
        kept = {k: v[~gone] for k, v in one.items()}
        yield from _batches(_dealt(kept, ((kept["anchor"] >> np.uint64(32)) % np.uint64(ranges)).astype(np.int64), False))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = flags.value
        rec: dict[str, list] = {c: [] for c, _ in _FIELDS}
        n = 0
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy() for c in ("doc_id", "text_key"))
            for s in slices(*texts(batch.column("text"))):
                anchor, digest, doc, place = windows(s, size)
                hit = np.flatnonzero(estimated_twice(seen, anchor, bits))
                if len(hit):
                    row = s.first + doc[hit]
                    for c, v in (("anchor", anchor[hit]), ("digest", digest[hit]), ("doc", ids[row]), ("key", keys[row]), ("place", place[hit].astype(np.uint32))):
                        rec[c].append(v)
                    n += len(hit)
                if n >= flush:
                    yield from shrink(rec)
                    rec, n = {c: [] for c, _ in _FIELDS}, 0
        if n:
            yield from shrink(rec)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decided: list[pa.RecordBatch] = []

        def open_() -> Iterator[pa.RecordBatch]:
            for b in batches:
                decided.append(b.filter(b.column("final")))
                yield b.filter(pc.invert(b.column("final")))

        for rec in _by_range(open_()):
            gone, one = _split(rec)
            yield from _batches(_removals({k: v[gone] for k, v in one.items()}, ranges))
            while decided:
                yield decided.pop()
        yield from decided

    def by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rec in _by_range(batches):
            order = np.lexsort([rec["place"], rec["key"], rec["doc"]])
            doc, key, place = (rec[k][order] for k in ("doc", "key", "place"))
            head = _runs(doc, key)
            blobs = [pack(np.diff(x, prepend=np.uint32(0))) for x in np.split(place, head[1:])]
            yield pa.record_batch([pa.array(doc[head]), pa.array(key[head]), pa.array(blobs, pa.binary())], ["doc_id", "text_key", "places"])

    known = docs.filter(F.col("doc_id").isNotNull())
    found = known.mapInArrow(pick, _ROWS).repartition("range").sortWithinPartitions("range").mapInArrow(exact, _ROWS)
    return found.repartition("range").sortWithinPartitions("range").mapInArrow(by_document, "doc_id long, text_key long, places binary")


def keep_words(size: int) -> Callable[[bytes, bytes | None], tuple[list[bytes], int]]:
    """A function of a text and its packed places: the words that stay, and how many there were."""

    def kept(text: bytes, blob: bytes | None) -> tuple[list[bytes], int]:
        words = text.split()
        if not blob:
            return words, len(words)
        step = np.zeros(len(words) + 1, np.int32)
        at = np.cumsum(unpack(blob, np.uint32), dtype=np.uint32).astype(np.int64)
        step[at] += 1
        step[at + size] -= 1
        stay = np.cumsum(step)[:-1] == 0
        return [words[i] for i in np.flatnonzero(stay).tolist()], len(words)

    return kept


def deduplicate(docs: DataFrame, size: int = 13, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row, and with with_text the kept words as text."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    n = docs.count()
    bits = sketch_bits(n)
    ranges = max(16, n // 2000)
    kept = keep_words(size)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, blob in zip(raw_texts(batch.column("text")), batch.column("places").to_pylist(), strict=True):
                words, n = kept(text, blob)
                joined = b" ".join(words)
                for k, v in enumerate((n, n - len(words), hashlib.sha256(joined).hexdigest(), joined.decode() if with_text else None)):
                    out[k].append(v)
            yield pa.record_batch([batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    lost = removals(docs, size, bits, ranges)
    found = docs.join(lost.hint("shuffle_hash"), ["doc_id", "text_key"], "left").select("doc_id", "text", "places")
    found = found.mapInArrow(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return found if with_text else found.drop("kept_text")
