"""Prefix trie of conversations: nodes are the distinct sequences of first turns, and sums over subtrees come from a centroid decomposition.

A turn is hashed with its depth, and the exclusive or of a conversation's first d turn hashes (128 bits) names its depth-d node, so the
parent's name is the node's own without its last turn and no text is shuffled. Turns are placed by range, so that one
conversation with most turns is many tasks' work.

Sums over subtrees: a component is split at its centroid, the deepest node that holds half of its weight. The centroid's subtree total
within the component goes to the centroid and is added along the path from it to the component's top; its children and what is left above
go on as components of their own. A node's weight is its number of members, whose sum over a subtree is the sum of its members'
remaining turns and so is known beforehand; every split at least halves a component's weight, so there are log2(turns) rounds at most.
Components of more than ``local_nodes`` nodes are split by joins, one round for all of them; smaller ones, in tasks.

A null role or text is empty, a null turn comes first, turns of one number follow by a hash of role and text. Rows without a
conv_id belong to no conversation. An empty table has no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, ship, written

#: Conversation ids that go into one chunk of text on their way into a digest.
CHUNK_IDS = 4096


def _xor(a: Column, b: Column) -> Column:
    return F.struct(a["a"].bitwiseXOR(b["a"]).alias("a"), a["b"].bitwiseXOR(b["b"]).alias("b"))


def _key(a: int = 0, b: int = 0) -> Column:
    return F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"))


def turns(table: DataFrame) -> DataFrame:
    """conv_id, part, inside, a, b, bytes: each turn's hash and its place, counted from 1 within the range part that holds it."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = table.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit("second"), role, text).alias("b"), F.octet_length(text).cast("long").alias("bytes")
    )
    ordered = (F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("a"), F.col("b"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            conv = batch.column("conv_id").to_numpy()
            first = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]])) if len(conv) else np.zeros(0, np.int64)
            inside = np.arange(1, len(conv) + 1) - np.repeat(first, np.diff(np.append(first, len(conv))))
            if len(conv) and conv[0] == last:
                inside[: first[1] if len(first) > 1 else len(conv)] += seen
            if len(conv):
                last, seen = conv[-1], int(inside[-1])
            yield pa.record_batch([batch.column("conv_id"), batch.column("part"), pa.array(inside), *(batch.column(c) for c in ("a", "b", "bytes"))], ["conv_id", "part", "inside", "a", "b", "bytes"])

    dealt = rows.repartitionByRange(*ordered).withColumn("part", F.spark_partition_id()).sortWithinPartitions(*ordered)
    return dealt.mapInArrow(number, "conv_id long, part int, inside long, a long, b long, bytes long")


def rebuilt(table: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and their turns (conv_id, depth, part, length, f, bytes), rebuilt.

    The first h turns are those of conversation c - c % family, h = crc32(c) % most; c's own follow after its first h.
    """
    rows = cut(turns(table))
    by_part = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    own = by_part.groupBy("conv_id").agg(F.sum("n").alias("n_own"))
    convs = own.withColumn("head_of", F.col("conv_id") - F.col("conv_id") % family).withColumn("h", F.crc32(F.col("conv_id").cast("string")) % most)
    lent = own.select(F.col("conv_id").alias("head_of"), F.col("n_own").alias("n_lent"))
    convs = convs.join(lent, "head_of", "left").withColumn("n_head", F.least("h", F.coalesce("n_lent", F.lit(0))))
    convs = cut(convs.select("conv_id", "head_of", "h", "n_head", (F.col("n_head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("length")))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = by_part.select("conv_id", "part", before.alias("before")).join(convs, "conv_id")
    placed = rows.join(parts, ["conv_id", "part"]).withColumn("place", F.col("inside") + F.col("before"))
    after = placed.filter("place > h").withColumn("depth", F.col("n_head") + F.col("place") - F.col("h"))
    heads = placed.filter(F.col("place") < most).select(F.col("conv_id").alias("head_of"), F.col("place").alias("depth"), "a", "b", "bytes")
    heads = heads.join(convs, "head_of").filter("depth <= n_head").withColumn("part", F.lit(-1))
    hashed = F.struct(F.xxhash64("depth", "a", "b").alias("a"), F.xxhash64("b", "depth", "a").alias("b"))
    both = [x.select("conv_id", "depth", "part", "length", hashed.alias("f"), "bytes") for x in (heads, after)]
    return convs.select("conv_id", "length"), both[0].unionByName(both[1])


def paths(rows: DataFrame) -> DataFrame:
    """conv_id, depth, length, k, p, bytes: the node k that each rebuilt conversation passes at a depth, and the node p above it."""
    rows = rows.select("conv_id", "part", "depth", "length", "bytes", F.col("f.a").alias("a"), F.col("f.b").alias("b"))
    total = rows.groupBy("conv_id", "part").agg(F.bit_xor("a").alias("ta"), F.bit_xor("b").alias("tb"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    total = total.select("conv_id", "part", *(F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(c) for c in ("ta", "tb")))
    so_far = Window.partitionBy("conv_id", "part").orderBy("depth")
    own = rows.withColumns({"ra": F.bit_xor("a").over(so_far), "rb": F.bit_xor("b").over(so_far)})
    f = F.struct("a", "b")
    k = _xor(F.struct(F.col("ra").alias("a"), F.col("rb").alias("b")), F.struct(F.col("ta").alias("a"), F.col("tb").alias("b")))
    return own.join(total, ["conv_id", "part"]).withColumn("k", k).select("conv_id", "depth", "length", "k", _xor(F.col("k"), f).alias("p"), "bytes")


def digests(ends: DataFrame) -> DataFrame:
    """k, ends_sha256: SHA-256 of each node's conversation ids, ascending and joined by commas.

    Ids are sorted by range and joined in chunks, whose text flows through one digest a node in order, a batch at a time.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            a, b, conv = (batch.column(c).to_pylist() for c in ("a", "b", "conv_id"))
            part, rows, at = batch.column("part"), [], 0
            while at < len(conv):
                end = at + 1
                while end < len(conv) and end - at < CHUNK_IDS and (a[end], b[end]) == (a[at], b[at]):
                    end += 1
                rows.append((a[at], b[at], part[at].as_py(), n, ",".join(map(str, conv[at:end]))))
                n, at = n + 1, end
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string())
            yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["a", "b", "part", "nth", "ids"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, done = None, None, []

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array([r[0][i] for r in rows], pa.int64()) for i in (0, 1)] + [pa.array([r[1] for r in rows], pa.string())], ["a", "b", "ends_sha256"])

        for batch in batches:
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids")), strict=True):
                if (a, b) != key:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = (a, b), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield batch_of(done)
            done = []
        if key is not None:
            yield batch_of([(key, digest.hexdigest())])

    flat = ends.select(F.col("k.a").alias("a"), F.col("k.b").alias("b"), "conv_id")
    dealt = flat.repartitionByRange("a", "b", "conv_id").withColumn("part", F.spark_partition_id()).sortWithinPartitions("a", "b", "conv_id")
    joined = dealt.mapInArrow(chunks, "a long, b long, part int, nth long, ids string").repartition("a", "b").sortWithinPartitions("a", "b", "part", "nth")
    return joined.mapInArrow(fold, "a long, b long, ends_sha256 string").select(F.struct("a", "b").alias("k"), "ends_sha256")


def component_sums(parent: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of values (one row each) over the subtrees of a forest, by centroid decomposition of all its components at once.

    Nodes are ordered by depth; parent is -1 at a top; weight is a node's subtree weight.
    """
    n = len(parent)
    parent, weight, here = parent.copy(), weight.copy(), np.arange(n)
    sums, extra, open_ = np.zeros_like(values), np.zeros_like(values), np.ones(n, bool)

    def tops() -> np.ndarray:
        at = np.where(parent < 0, here, parent)
        while (at != (up := at[at])).any():
            at = up
        return at

    def totals(top: np.ndarray) -> np.ndarray:
        out = np.zeros_like(values)
        for k in range(len(values)):
            np.add.at(out[k], top[open_], values[k][open_])
        return out

    top = tops()
    while open_.any():
        before = totals(top)
        heavy = np.flatnonzero(open_ & (2 * weight >= weight[top]))
        deepest = np.full(n, -1)
        deepest[top[heavy]] = heavy  # later ones are deeper
        centroid = deepest[deepest >= 0]
        its_top, above = top[centroid], parent[centroid]
        is_centroid = np.zeros(n, bool)
        is_centroid[centroid] = True
        parent[(parent >= 0) & is_centroid[parent]] = -1
        parent[centroid] = -1
        open_[centroid] = False
        top = tops()
        total = before[:, its_top] - totals(top)[:, its_top]
        sums[:, centroid] = extra[:, centroid] + total
        less = weight[centroid]
        while (going := above >= 0).any():
            above, total, less = above[going], total[:, going], less[going]
            extra[:, above] += total
            weight[above] -= less
            above = parent[above]
    return sums


def _in_tasks(nodes: DataFrame, columns: list[str], rows_at_once: int) -> DataFrame:
    """k and the sums of whole components, each within one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", *columns]

        def solve(t: pa.Table) -> pa.RecordBatch:
            t = t.sort_by("depth")
            a, b, pa_, pb, ca, cb, w = (t.column(c).to_numpy() for c in ("a", "b", "pa", "pb", "ca", "cb", "w"))
            at = dict(zip(zip(a.tolist(), b.tolist(), strict=True), range(len(a)), strict=True))
            places = (list(zip(x.tolist(), y.tolist(), strict=True)) for x, y in ((a, b), (ca, cb), (pa_, pb)))
            above = np.array([-1 if own == top else at[up] for own, top, up in zip(*places, strict=True)], np.int64)
            values = np.array([t.column(c).to_numpy() for c in columns])
            got = component_sums(above, w, values) + np.array([t.column("more_" + c).to_numpy() for c in columns])
            return pa.record_batch([pa.array(x) for x in (a, b, *got)], names)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(x.num_rows for x in held) >= rows_at_once:
                t = pa.Table.from_batches(held).combine_chunks()
                ca, cb = t.column("ca").to_numpy(), t.column("cb").to_numpy()
                whole = int(np.flatnonzero((ca != ca[-1]) | (cb != cb[-1]))[-1]) + 1 if ((ca != ca[-1]) | (cb != cb[-1])).any() else 0
                if whole:
                    yield solve(t.slice(0, whole))
                held = t.slice(whole).to_batches()
        if held:
            yield solve(pa.Table.from_batches(held))

    flat = nodes.select("k.a", "k.b", F.coalesce("p.a", F.lit(0)).alias("pa"), F.coalesce("p.b", F.lit(0)).alias("pb"), F.col("c.a").alias("ca"), F.col("c.b").alias("cb"), "depth", "w", *columns, *("more_" + c for c in columns))
    kinds = ", ".join(f"{c} long" for c in ("a", "b", *columns))
    out = flat.repartition("ca", "cb").sortWithinPartitions("ca", "cb").mapInArrow(run, kinds)
    return out.select(F.struct("a", "b").alias("k"), *columns)


def subtree_sums(nodes: DataFrame, path: DataFrame, columns: list[str], local_nodes: int = 20_000) -> DataFrame:
    """k and the sum of each column over k's subtree. nodes: k, p, depth, conv_id (a member), w (subtree weight) and the columns.

    path: the node k (below p) that conversation conv_id passes at each depth; it tells what lies below or above a centroid.
    """
    more = ["more_" + c for c in columns]
    state = nodes.withColumns({"c": _key()} | {c: F.lit(0).cast("long") for c in more})
    state = written(state.select("k", "p", "c", "depth", "conv_id", "w", *columns, *more))
    path, done = path.select("conv_id", "depth", "k", "p"), []
    while True:
        size = state.groupBy("c").agg(F.count("*").alias("n"), F.max("w").alias("of_all"), *(F.sum(c).alias("all_" + c) for c in columns))
        large = written(size.filter(F.col("n") > local_nodes).drop("n"))
        if large.isEmpty():
            break
        marked = state.join(large, "c", "left")
        done.append(("open", marked.filter("of_all is null").select(state.columns)))
        marked = marked.filter("of_all is not null")
        centroid = marked.filter("2 * w >= of_all").groupBy("c").agg(F.max_by(F.struct("k", "depth", "conv_id", "w"), "depth").alias("mid"))
        centroid = written(centroid)
        below = marked.join(centroid, "c").filter("depth > mid.depth").select("conv_id", (F.col("mid.depth") + 1).alias("at"), F.col("mid.k").alias("mid_k")).distinct()
        looked = path.select("conv_id", F.col("depth").alias("at"), F.col("p").alias("mid_k"), F.col("k").alias("child"))
        below = below.join(looked, ["conv_id", "at", "mid_k"])
        above = centroid.select("c", F.col("mid.conv_id").alias("conv_id"), F.col("mid.depth").alias("at")).join(path, "conv_id").filter("depth < at")
        above = above.select("c", "k").unionByName(centroid.filter("mid.depth > 0").select("c", _key().alias("k"))).withColumn("above", F.lit(True))
        split = marked.join(centroid, "c").withColumns({"at": F.when(F.col("depth") > F.col("mid.depth"), F.col("mid.depth") + 1), "mid_k": F.col("mid.k")})
        split = split.join(below, ["conv_id", "at", "mid_k"], "left").join(above, ["c", "k"], "left")
        split = split.withColumn("part", F.when(F.col("k") == F.col("mid_k"), "mid").when(F.col("child").isNotNull(), "below").when(F.col("above"), "above").otherwise("beside"))
        split = written(split.select(*state.columns, "mid", "part", F.when(F.col("part") == "below", F.col("child")).otherwise(F.col("c")).alias("new_c")))
        total = split.filter("part in ('mid', 'below')").groupBy("c").agg(*(F.sum(c).alias("sum_" + c) for c in columns))
        split = split.join(total, "c")
        done.append(("sums", split.filter("part = 'mid'").select("k", *((F.col("more_" + c) + F.col("sum_" + c)).alias(c) for c in columns))))
        gained = {"more_" + c: F.when(F.col("part") == "above", F.col("more_" + c) + F.col("sum_" + c)).otherwise(F.col("more_" + c)) for c in columns}
        lighter = F.when(F.col("part") == "above", F.col("w") - F.col("mid.w")).otherwise(F.col("w"))
        state = split.filter("part != 'mid'").withColumns(gained | {"w": lighter}).withColumn("c", F.col("new_c")).select(state.columns)
        state = written(state)
    small = state
    for kind, df in done:
        small = small.unionByName(df) if kind == "open" else small
    out = _in_tasks(small, columns, 2 * local_nodes)
    for kind, df in done:
        out = out.unionByName(df) if kind == "sums" else out
    return out


def trie(table: DataFrame, family: int = 5, most: int = 9, local_nodes: int = 20_000) -> DataFrame:
    """One row a node: its smallest member and its parent's, members, children, leaves below, tokens saved below, digest of the members that end there."""
    ship(table.sparkSession)
    convs, rows = rebuilt(table, family, most)
    path = cut(paths(rows))
    inner = path.groupBy("k", "p", "depth").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("bytes").alias("bytes"), F.sum(F.col("length") - F.col("depth") + 1).alias("w"))
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum(F.col("length") + 1).alias("w")).filter("n_convs > 0")
    root = root.withColumns({"k": _key(), "p": F.lit(None).cast("struct<a: bigint, b: bigint>"), "depth": F.lit(0).cast("long"), "bytes": F.lit(0).cast("long")})
    nodes = cut(inner.unionByName(root))
    children = nodes.filter("depth > 0").groupBy(F.col("p").alias("k")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "k", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")})
    nodes = cut(nodes)
    sums = subtree_sums(nodes, path, ["n_leaves", "saved_tokens"], local_nodes)
    ends = path.filter("depth = length").select("k", "conv_id").unionByName(convs.filter("length = 0").select(_key().alias("k"), "conv_id"))
    parents = nodes.select(F.col("k").alias("p"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.drop("n_leaves", "saved_tokens").join(sums, "k").join(digests(ends), "k", "left").join(parents, "p", "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))


def sql(family: int = 5, most: int = 9) -> str:
    """The same rows in DuckDB's SQL: nodes are digests of whole prefixes, subtrees are found through their members' paths."""
    step = "xor(c >> 1, 3988292384 * (c & 1))"
    table = "crc0 as (select i, i::bigint c from range(256) t(i))"
    for k in range(8):
        table += f", crc{k + 1} as (select i, {step} c from crc{k})"
    crc = "xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"
    return f"""with {table}, tab as (select list(c order by i) tab from crc8),
own as (select conv_id, coalesce(role, '') r, coalesce(text, '') t, row_number() over (partition by conv_id order by turn nulls first, role, text) i from conversations where conv_id is not null),
conv as (select conv_id, conv_id - conv_id % {family} b, {crc} % {most} h from (select distinct conv_id from own), tab),
head as (select c.conv_id, o.i d, o.r, o.t from conv c join own o on o.conv_id = c.b and o.i <= c.h),
n_head as (select conv_id, count(*) n from head group by 1),
turn as (select * from head union all select o.conv_id, coalesce(n.n, 0) + o.i - c.h, o.r, o.t from own o join conv c using (conv_id) left join n_head n using (conv_id) where o.i > c.h),
path as (select conv_id, d, strlen(t) b, sha256(string_agg(sha256(r) || sha256(t), '') over (partition by conv_id order by d)) k from turn),
node as (select d, k, any_value(b) b, count(*) n, min(conv_id) m from path group by d, k union all select 0, '', 0, count(*), min(conv_id) from conv having count(*) > 0),
spot as (select conv_id, d, k from path union all select conv_id, 0, '' from conv),
edge as (select n.d, n.k, p.k pk, q.m pm from node n join spot p on p.conv_id = n.m and p.d = n.d - 1 join node q on q.d = p.d and q.k = p.k),
kid as (select d - 1 d, pk k, count(*) n from edge group by 1, 2),
value as (select n.d, n.k, n.m, if(coalesce(kid.n, 0) = 0, 1, 0) leaf, (n.n - 1) * n.b saved from node n left join kid using (d, k)),
below as (select s.d, s.k, sum(v.leaf) leaf, sum(v.saved) saved from value v join spot s on s.conv_id = v.m and s.d <= v.d group by 1, 2),
last as (select conv_id, max_by(k, d) k, max(d) d from spot group by 1),
ends as (select d, k, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) s from last group by 1, 2)
select n.m as conv_id, n.d::bigint as depth, e.pm as parent_conv_id, n.n::bigint as n_convs, coalesce(kid.n, 0)::bigint as n_children, b.leaf::bigint as n_leaves, b.saved::bigint as saved_tokens, coalesce(ends.s, sha256('')) as ends_sha256
from node n left join edge e using (d, k) left join kid using (d, k) join below b using (d, k) left join ends using (d, k)"""
