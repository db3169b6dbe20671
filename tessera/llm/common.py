"""What several operators share: lineage cuts, shipping of this package, and vectorised work on Arrow text buffers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.lineage import cut, shared_folder, ship

__all__ = ["cut", "shared_folder", "ship"]

#: One slice of documents that numpy works on at a time, in bytes of text; a longer text is a slice of its own.
SLICE_BYTES = 1 << 19

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def row_id(*columns: Column) -> Column:
    """128 bits that stand for the values of a row, nulls included: equal for equal rows alone, for all tables to come."""
    marked = [x for c in columns for x in (c, c.isNull())]  # a null alone leaves no trace in a hash
    return F.struct(F.xxhash64(*marked).alias("a"), F.xxhash64(F.lit("second"), *marked).alias("b"))


def written(df: DataFrame) -> DataFrame:
    """df as a table of the shared folder. Unlike a checkpoint it keeps none of the conditions that held in its plan, which pile up over many rounds."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(docs: DataFrame, name: str) -> str:
    """A column name that docs doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda's variable is bound, a repeated expression is not."""
    return F.transform(F.array(value), body)[0]


def held_out() -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 2 on division by 4."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def texts(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return memoryview(data) if data is not None else memoryview(b""), offsets


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = texts(column)
    ends = offsets.tolist()
    for i in range(len(ends) - 1):
        yield bytes(data[ends[i] : ends[i + 1]])


class Slice:
    """Some documents as one byte array, each followed by a space. rows: their places in the batch; starts: where each begins."""

    def __init__(self, data: memoryview, offsets: np.ndarray, first: int, last: int) -> None:
        ends = offsets[first : last + 1].tolist()
        joined = b" ".join([data[ends[i] : ends[i + 1]] for i in range(last - first)]) + b" "
        self.bytes = np.frombuffer(joined, np.uint8)
        self.first, self.last = first, last
        self.starts = offsets[first:last] - offsets[first] + np.arange(last - first)


def slices(data: memoryview, offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield Slice(data, offsets, first, min(last, n))
        first = min(last, n)


def word_bounds(b: np.ndarray, between: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that between doesn't hold; b ends with such a byte."""
    gap = between[b]
    change = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(b) and not gap[0]:
        change = np.concatenate([[0], change])
    return change[0::2], change[1::2]


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i < n."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        n = max(n, 2 * SLICE_BYTES)
        up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[base] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _POWERS[base]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit hash of each b[start:end], from one prefix sum over b."""
    up, down = _powers(base, len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def keyed(seed: int, value: Column) -> Column:
    """A draw for each row that depends on its key alone, not on partitions: 0 <= u < 1."""
    return (F.pmod(F.xxhash64(F.lit(seed), value), F.lit(1 << 53)) / F.lit(float(1 << 53))).cast("double")
