"""Toxicity by subword-bag embeddings averaged into a linear softmax, embeddings and weights trained jointly in numpy.

A word is a bag of hashed byte n-grams of itself between spaces, so a misspelling that no training text holds still
shares most of its vectors with the word it comes from. A text is cut into runs of ``span`` words; the vectors of a
run's n-grams are averaged, a linear softmax scores the average, and a text's score is that of its most toxic runs.
Training takes a bounded, documented sample of labelled rows (``train_rows``), picked by hash, whole texts each. As the model is linear
once averaged, scoring keeps one number for each n-gram bucket: that table, of fixed size, is all that tasks get.

Null and empty texts have no n-grams and get the score of the bias alone. Without labelled rows of both kinds the
score is the share of toxic ones among them (0 if none). Repeated rows each get a row, a null doc_id is carried along and
never held out, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Slice, held_out, mix, ship, slices, texts

BUCKETS = 1 << 16
SIZES = (3, 4, 5, 6)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.ones(256, bool)
_GAP[[*range(97, 123), *range(48, 58), *range(128, 256)]] = False
_LOWER[_GAP] = 32
_LOWER[65:91] = np.arange(97, 123)


def grams(s: Slice, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of every n-gram of a slice, the run that it stands in, and each run's document."""
    b = _LOWER[s.bytes]
    b = np.r_[np.uint8(32), b, np.full(max(SIZES), 32, np.uint8)]
    gap = b == 32
    opens = np.flatnonzero(gap[:-1] & ~gap[1:])  # the space before each word
    if not len(opens):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = np.searchsorted(s.starts, opens, "right") - 1
    first = np.searchsorted(doc, np.arange(len(s.starts)))
    nth = np.arange(len(opens)) - first[doc]
    head = nth % span == 0
    run = np.cumsum(head) - 1
    word = np.cumsum(gap[:-1] & ~gap[1:])  # how many words have opened at or before each byte
    wide = b.astype(np.uint64)
    found_b, found_r = [], []
    for n in SIZES:
        m = len(b) - n
        inside = ~gap[1 : m + 1]
        h = wide[:m] * np.uint64(0x9E3779B1)
        for k in range(1, n):
            if 1 < k < n - 1:
                inside = inside & ~gap[k : m + k]
            h = h * np.uint64(0x100000001B3) + wide[k : m + k]
        if n > 3:
            inside &= ~gap[n - 2 : m + n - 2]
        at = np.flatnonzero(inside)
        owner = word[at] - 1
        at, owner = at[owner >= 0], owner[owner >= 0]
        found_b.append((mix(h[at] + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int64))
        found_r.append(run[owner])
    return np.concatenate(found_b), np.concatenate(found_r), doc[head]


def train(sample: list[tuple[bytes, int]], span: int, dim: int = 8, epochs: int = 25, whole: int = 6, rate: float = 0.5, seed: int = 1) -> tuple[np.ndarray, float]:
    """One number for each bucket (its embedding along the toxic direction) and the bias, from (text, label) pairs.

    The first ``whole`` rounds average whole texts. From then on a text is as toxic as its most toxic run: a toxic text
    trains on that run alone, a clean one on its two most suspicious runs and one more.
    """
    labels = np.array([y for _, y in sample], np.int64)
    if not len(labels) or labels.min() == labels.max():
        p = float(labels.mean()) if len(labels) else 0.0
        return np.zeros(BUCKETS, np.float32), float(np.log((p + 1e-9) / (1 - p + 1e-9)))
    data = b"".join(t for t, _ in sample)
    offsets = np.cumsum([0, *(len(t) for t, _ in sample)])
    rng = np.random.default_rng(seed)
    bags: list[list[np.ndarray]] = [[] for _ in sample]
    for s in slices(memoryview(data), offsets):
        bucket, run, doc = grams(s, span)
        order = np.argsort(run, kind="stable")
        parts = np.split(bucket[order], np.searchsorted(run[order], np.arange(1, len(doc)))) if len(doc) else []
        for d, part in zip(doc.tolist(), parts, strict=True):
            if len(part):
                bags[s.first + d].append(part.astype(np.int32))
    used = [i for i in range(len(sample)) if bags[i]]
    flat = np.concatenate([b for i in used for b in bags[i]])
    sizes = np.array([len(b) for i in used for b in bags[i]])
    at = np.r_[0, np.cumsum(sizes)]
    runs = np.array([len(bags[i]) for i in used])
    head = np.r_[0, np.cumsum(runs)][:-1]
    y = labels[used]
    vectors = rng.normal(0, 0.1, (BUCKETS, dim))
    out = rng.normal(0, 0.1, (dim, 2))
    bias = np.log([1 - y.mean() + 1e-9, y.mean() + 1e-9])
    g_vec, g_out, g_bias = np.full((BUCKETS, 1), 1e-6), np.full((dim, 2), 1e-6), np.full(2, 1e-6)
    text_at = np.r_[at[head], at[-1]]
    for epoch in range(epochs):
        if epoch < whole:  # no direction yet: whole texts
            edge, pick, target = text_at, np.arange(len(used)), y
        else:
            along = vectors @ (out[:, 1] - out[:, 0])
            worst = np.add.reduceat(along[flat], at[:-1]) / sizes
            owner = np.repeat(np.arange(len(runs)), runs)
            by_text = np.lexsort([-worst, owner])
            top = by_text[head]
            second = by_text[head + np.minimum(1, runs - 1)]
            some = head + rng.integers(0, runs)
            edge, pick = at, np.concatenate([top, second[y == 0], some[y == 0]])
            target = np.concatenate([y, np.zeros(2 * int((y == 0).sum()), np.int64)])
        width = np.diff(edge)
        order = rng.permutation(len(pick))
        for part in np.array_split(order, max(1, len(order) // 64)):
            p, t = pick[part], target[part]
            idx = np.concatenate([flat[edge[k] : edge[k + 1]] for k in p])
            bag = np.repeat(np.arange(len(p)), width[p])
            mean = np.add.reduceat(vectors[idx], np.r_[0, np.cumsum(width[p])[:-1]]) / width[p][:, None]
            z = mean @ out + bias
            z = np.exp(z - z.max(1, keepdims=True))
            z /= z.sum(1, keepdims=True)
            z[np.arange(len(p)), t] -= 1
            d_out, d_bias = mean.T @ z / len(p), z.mean(0)
            d_vec = (z @ out.T / width[p][:, None])[bag]
            g_vec[:, 0] += np.bincount(idx, (d_vec**2).mean(1), BUCKETS)
            step = rate / np.sqrt(g_vec[idx])
            np.add.at(vectors, idx, -step * d_vec)
            g_out += d_out**2
            out -= rate * 0.2 * d_out / np.sqrt(g_out)
            g_bias += d_bias**2
            bias -= rate * 0.2 * d_bias / np.sqrt(g_bias)
    return (vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def sample_rows(docs: DataFrame, labels: DataFrame, train_rows: int) -> list[tuple[bytes, int]]:
    """At most train_rows labelled texts that aren't held out, half of them toxic where there are as many."""
    rows = labels.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.lit(17), "doc_id")
    toxic = rows.filter("toxic = 1").orderBy(order).limit(train_rows // 2)
    clean = rows.filter("toxic = 0").orderBy(order).limit(train_rows // 2)
    picked = F.broadcast(toxic.union(clean))  # at most train_rows ids and labels
    found = docs.select("doc_id", "text").join(picked, "doc_id").select("doc_id", "text", "toxic").dropDuplicates(["doc_id"])
    return [((r.text or "").encode(), r.toxic) for r in found.orderBy("doc_id").toLocalIterator()]


def score(docs: DataFrame, labels: DataFrame, train_rows: int = 3000, span: int = 8, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of docs."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    table, bias = train(sample_rows(docs, labels, train_rows), span)
    shared = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        along = shared.value
        for batch in batches:
            z = np.full(batch.num_rows, bias)
            for s in slices(*texts(batch.column("text"))):
                bucket, at, doc = grams(s, span)
                if not len(doc):
                    continue
                size = np.bincount(at, minlength=len(doc))
                mean = np.bincount(at, along[bucket], len(doc)) / np.maximum(size, 1)
                best = np.full(s.last - s.first, -np.inf)
                np.maximum.at(best, doc, np.where(size > 0, mean, -np.inf))
                z[s.first : s.last] += np.where(np.isfinite(best), best, 0.0)
            p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            yield pa.record_batch([batch.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    found = docs.mapInArrow(run, "doc_id long, score double, predicted int")
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
