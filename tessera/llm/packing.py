"""Best-fit packing of token sequences by a configuration linear program over the length histogram.

Documents are tokenized once, in tasks; only piece lengths and checksums go further. The histogram has at most
``capacity`` entries whatever the corpus, and so has the linear program: minimise the number of sequences over all
configurations (multisets of lengths that fit) so that each length is covered. Multiplicative weights solve it, with
a knapsack over the weights as pricing of full configurations; its rounds cover parts of half the histogram that are rounded down to whole
pieces, and the other half is packed by best fit, longest first, still by length alone: a greedy packing of all that the program leaves
needs some of every length, and its waste is that of the smaller rest. Pieces then find their configuration by their rank among pieces of
their length, which is counted per bucket, so no task holds all pieces of a length.

Null and empty texts are a document of the end token alone. Rows with a null doc_id and repeated rows are packed like
others. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, ship

#: Value that a configuration may lose for each long piece that it takes in place of short ones.
SLACK = 0.02
#: Entries of a worker's table of encoded words; a full table is emptied.
CACHE_WORDS = 500_000
_NEAR_WHITE = re.compile(r"\s | \s|^ | $")
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
_TOKENIZERS: dict[str, Encoder] = {}


class Encoder(dict):
    """Ids of a byte-level BPE file, word by word: text may be cut before a space between two visible characters.

    A word's ids are looked up, and encoded when first met: by the ranks file of the same vocabulary where
    that is given and the word is plain, else by the tokenizer itself.
    """

    def __init__(self, path: str, ranks_path: str | None, pattern: str | None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.special = re.compile("|".join(re.escape(t.content) for t in self.slow.get_added_tokens_decoder().values()) or r"(?!)")
        self.quick = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.quick = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
            self.sizes[list(ranks.values())] = [len(k) for k in ranks]

    def ids(self, text: str) -> bytes:
        if self.quick is not None and text.replace("\n", "").isprintable():
            return np.array(self.quick.encode_ordinary(text), "<u4").tobytes()
        return self.whole(text)

    def learn(self, words: set[str]) -> None:
        """Add words, each as it stands behind a space: one call encodes them all, and byte lengths of tokens tell them apart."""
        plain = [w for w in words if self.quick is not None and w.replace("\n", "").isprintable()]
        for w in words.difference(plain):
            self[w] = self.ids(" " + w)
        if plain:
            ids = np.array(self.quick.encode_ordinary(" " + " ".join(plain)), "<u4")
            ends = np.cumsum([len(w.encode()) + 1 for w in plain])
            at = [0, *(np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1).tolist()]
            flat = ids.tobytes()
            for k, w in enumerate(plain):
                self[w] = flat[4 * at[k] : 4 * at[k + 1]]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        split = [None if self.special.search(t) else _INNER_SPACE.split(t) if _NEAR_WHITE.search(t) else t.split(" ") for t in texts]
        inner = [w[1:] for w in split if w]
        if len(self) > CACHE_WORDS:
            self.clear()
        self.learn(set().union(*inner).difference(self))
        look = self.__getitem__
        return [self.whole(t) if w is None else self.ids(w[0]) + b"".join(map(look, w[1:])) for t, w in zip(texts, split, strict=True)]

    def whole(self, text: str) -> bytes:
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def public_files(name: str) -> tuple[str, str, str]:
    """The tokenizer file of a public vocabulary, its ranks file and the pattern that cuts words."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN


def encoder(path: str, ranks_path: str | None, pattern: str | None) -> Encoder:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Encoder(path, ranks_path, pattern)
    return _TOKENIZERS[path]


def pieces(docs: DataFrame, path: str, ranks_path: str | None = None, pattern: str | None = None, capacity: int = 1024, end: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and the end token, cut if longer than capacity."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path, ranks_path, pattern)
        tail = int(end).to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            names, all_texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for first in range(0, len(names), 256):
                own = slice(first, first + 256)
                for doc_id, ids in zip(names[own], tokens.encode_all([t or "" for t in all_texts[own]]), strict=True):
                    ids += tail
                    n = len(ids) // 4
                    at, size = 0, (n - 1) % capacity + 1
                    for k in range(-(-n // capacity)):
                        rows.append((doc_id, k, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])))
                        at, size = at + size, capacity
            yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def price(value: np.ndarray, capacity: int) -> np.ndarray:
    """The greatest value of lengths 1..len(value) that fill each room 0..capacity exactly: dynamic programming over the room. -inf: none do."""
    best = np.full(capacity + 1, -np.inf)
    best[0] = 0.0
    back = np.ascontiguousarray(value[::-1])
    n = len(value)
    for room in range(1, capacity + 1):
        most = min(room, n)
        best[room] = (back[n - most :] + best[room - most : room]).max()
    return best


def configuration(first: int, value: np.ndarray, best: np.ndarray, left: np.ndarray, slack: float) -> np.ndarray | None:
    """How often each length stands in a full configuration that holds first, no length more often than is left: at each place the longest one that costs no more than slack of the greatest value. None if there is none."""
    used = np.zeros(len(value), np.int64)
    room, pick = len(best) - 1, first
    while True:
        used[pick - 1] += 1
        room -= pick
        if not room:
            return used
        most = min(room, len(value))
        got = np.where(left[:most] > used[:most], value[:most] + best[room - most : room][::-1], -np.inf)
        if (top := got.max()) == -np.inf:
            return None
        pick = int(np.flatnonzero(got >= top - slack)[-1]) + 1


def configurations(count: np.ndarray, capacity: int, rate: float = 0.5, share: float = 0.5, rounds: int = 8, batch: int = 24) -> tuple[dict[bytes, int], int, float]:
    """The program's solution by multiplicative weights, rounded: full configurations and how often each is used, all sequences, and a bound on any solution's.

    The program covers share of every length; the rest, of which all lengths are left alike, is what best fit completes the packing from.
    Each round raises what must be covered of every length by the same part of that, rounded down to whole pieces. A length's weight starts at its
    share of the capacity, falls by exp(-rate) times the part of it that is covered, and is zero while the round's part is. Knapsacks over
    the weights price full configurations, longest lengths first, and use them as often as what is left of the round allows. A length
    that finds none waits for the next round. Weights at their start are a solution of the dual: that is the bound.
    """
    lengths = np.arange(1, len(count) + 1)
    covered, found = np.zeros(len(count), np.int64), {}
    for k in range(1, rounds + 1):
        goal = np.floor(share * count * k / rounds).astype(np.int64)
        left = goal - covered
        waits = np.zeros(len(count), bool)
        while len(firsts := np.flatnonzero((left > 0) & ~waits)[::-1][:batch] + 1):
            value = np.where(left > 0, lengths / capacity * np.exp(-rate * covered / np.maximum(goal, 1)), -np.inf)
            best = price(value, capacity)
            for first in firsts.tolist():
                if not left[first - 1]:
                    continue
                used = configuration(first, value, best, left, SLACK)
                if used is None:
                    waits[first - 1] = True
                    continue
                on = np.flatnonzero(used)
                step = int((left[on] // used[on]).min())
                key = used.tobytes()
                found[key] = found.get(key, 0) + step
                left[on] -= step * used[on]
                covered[on] += step * used[on]
    total = sum(found.values()) + sum(n for _, n in best_fit(count - covered, capacity))
    return found, total, float(count @ lengths) / capacity


def best_fit(count: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Best fit, longest first, over equal bins at once: (lengths, how many such bins)."""
    by_room: dict[int, list[list]] = {}
    done: list[tuple[list[int], int]] = []
    rooms = np.zeros(capacity + 1, bool)
    for length in range(len(count), 0, -1):
        left = int(count[length - 1])
        while left:
            fits = np.flatnonzero(rooms[length:])
            if len(fits):
                room = int(fits[0]) + length
                held = by_room[room].pop()
                if not by_room[room]:
                    rooms[room] = False
                lengths, bins = held
                taken = min(bins, left)
                if bins > taken:
                    by_room[room].append([lengths, bins - taken])
                    rooms[room] = True
                grown, left = [*lengths, length], left - taken
            else:
                room, per = capacity, capacity // length
                taken, rest = divmod(left, per)
                if taken:
                    grown, left = [length] * per, rest
                    room = capacity - length * (per - 1)
                else:
                    grown, taken, left = [length] * rest, 1, 0
                    room = capacity - length * (rest - 1)
            if room > length:
                by_room.setdefault(room - length, []).append([grown, taken])
                rooms[room - length] = True
            else:
                done.append((grown, taken))
    return done + [(lengths, bins) for held in by_room.values() for lengths, bins in held]


def plan(count: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Bins for every piece of the histogram: the program's configurations, and best fit for the pieces that they leave."""
    count = np.asarray(count, np.int64)
    if not count.any():
        return []
    found, _, _ = configurations(count, capacity)
    left, bins = count.copy(), []
    for key, times in found.items():
        used = np.frombuffer(key, np.int64)
        left -= used * times
        bins.append((np.repeat(np.arange(len(count), 0, -1), used[::-1]).tolist(), times))
    return bins + best_fit(left, capacity)


def place(count: np.ndarray, capacity: int) -> dict[str, np.ndarray]:
    """Where pieces go, by length and rank: from rank ``base`` of a length on, ``each`` a sequence, the first in ``sequence`` at ``offset``."""
    rows, sequence = [], 0
    base = np.zeros(len(count) + 1, np.int64)
    for lengths, times in plan(count, capacity):
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            each = lengths.count(length)
            rows.append((length, base[length], each, sequence, offset))
            base[length] += each * times
            offset += each * length
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "base", "each", "sequence", "offset"), table.T, strict=True))


def pack(docs: DataFrame, path: str, ranks_path: str | None = None, pattern: str | None = None, capacity: int = 1024, end: int = 2, bucket_rows: int = 20_000) -> DataFrame:
    """Every piece with its sequence_id and its offset there."""
    parts = cut(pieces(docs, path, ranks_path, pattern, capacity, end))
    count = np.zeros(capacity, np.int64)
    for row in parts.groupBy("length").count().collect():
        count[row["length"] - 1] = row["count"]
    where = place(count, capacity)
    buckets = int(count.sum()) // bucket_rows + 1
    parts = parts.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = parts.groupBy("length", "bucket").count()
    before = before.withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count")).drop("count")
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = parts.withColumn("inside", inside).join(before, ["length", "bucket"]).withColumn("rank", F.col("inside") + F.col("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (where["length"].astype(np.int64) << 44) | where["base"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = np.searchsorted(key, (length << 44) | rank, "right") - 1
            nth = rank - where["base"][row]
            each = where["each"][row]
            sequence, offset = where["sequence"][row] + nth // each, where["offset"][row] + nth % each * length
            yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
