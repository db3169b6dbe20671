"""Centroid clustering, url filters and prefix tries against brute force and SQL, on given tables and on odd rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from tessera.llm import centroids, prefix_trie, queries, url_filter

DIR = "/root/testdata/sf0.001"


def by_sql(sql, **tables):
    con = duckdb.connect()
    for name, t in tables.items():
        con.execute(f"create view {name} as select * from '{t}'") if isinstance(t, str) else con.register(name, t)
    got = con.execute(sql)
    return [d[0] for d in got.description], got.fetchall()


def same(df, names, rows):
    assert sorted(df.columns) == sorted(names)
    got = collections.Counter(tuple(r[c] for c in names) for r in df.collect())
    assert got == collections.Counter(map(tuple, rows))


@pytest.mark.parametrize("name, table", [("op11_centroid_clustering", "embeddings"), ("op13_prefix_trie", "conversations")])
def test_given_tables(spark, name, table):
    same(queries.QUERIES[name](spark, DIR), *by_sql(queries.ORACLES[name], **{table: f"{DIR}/{table}.parquet"}))


def brute_clusters(vectors, k, rounds, seed):
    """vectors: (vec_id, integers)."""
    start = sorted(vectors, key=lambda x: (x[0] is None, hashlib.sha256(f"{seed}:{x[0]}".encode()).hexdigest(), x[1]))[:k]
    cent = [list(v) for _, v in start]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cent))
    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, v in vectors:
            own[near(v)[1]].append(v)
        cent = [[sum(col) // len(own[i]) for col in zip(*own[i])] if own[i] else c for i, c in enumerate(cent)]
    found = [(i, *near(v)) for i, v in vectors]
    each = collections.Counter()
    for _, d, c in found:
        each[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return [(i, c, d, each[c], sum(each.values()), sha[c]) for i, d, c in found]


NAMES = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_odd_vectors(spark):
    draw = random.Random(5)
    whole = [(i, [draw.randint(-3, 3) / 2 for _ in range(4)]) for i in range(60)] + [(7, [1.0, 1.0, 1.0, 1.0])] * 3 + [(None, [0.5, 0.0, 0.0, 0.001]), (99, [-0.001, 1e5, 0.0, 0.0]), (98, [1e6, -1e6, 0.0, 0.0])]
    broken = [(200, None), (201, []), (202, [1.0] * 3), (203, [1.0] * 5), (204, [1.0, None, 1.0, 1.0]), (205, [1.0, float("nan"), 1.0, 1.0]), (206, [1.0, float("inf"), 1.0, 1.0])]
    schema = "vec_id long, embedding array<double>, cluster string, v string, h string, distance string, d string"
    table = spark.createDataFrame([(*r, *["clash"] * 5) for r in whole + broken], schema)
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v in whole]
    for k, rounds in ((6, 3), (1, 1), (100, 2)):
        same(centroids.cluster(table, k, rounds, 4), NAMES, brute_clusters(vectors, k, rounds, 2))
    assert centroids.cluster(table.limit(0)).count() == 0 and centroids.cluster(table.filter("vec_id >= 200"), size=4).count() == 0
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert {r.distance for r in centroids.cluster(huge, 1, 1, 2).collect()} == {None}


def test_walk_finds_the_nearest():
    draw = np.random.default_rng(1)
    for n, k, d, high in ((200, 40, 64, 300), (300, 7, 3, 2), (50, 1, 5, 9)):
        x, c = draw.integers(-high, high + 1, (n, d)), draw.integers(-high, high + 1, (k, d))
        every = ((x[:, None] - c) ** 2).sum(axis=2)
        which, best = centroids.nearest(x, c)
        assert (which == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()


def splits(name):
    for cuts in itertools.product((0, 1), repeat=len(name) - 1):
        out, at = [], 0
        for i, cut_here in enumerate(cuts, 1):
            if cut_here:
                out.append(name[at:i])
                at = i
        yield (*out, name[at:])


def test_split_is_the_likeliest():
    counts = {"the": 50, "th": 9, "e": 3, "tion": 20, "on": 30, "ti": 2, "then": 5, "heat": 4}
    total = sum(counts.values())
    words = url_filter.Words(counts, total)
    price = lambda w: math.log(total / counts[w]) if w in counts else math.log(total + 1) + math.log(10) * (1 + len(w))
    draw = random.Random(2)
    for name in ["the", "tionth", "thetion", "thenx", "xqz", "theat", *("".join(draw.choice("theionx") for _ in range(9)) for _ in range(30))]:
        got = words.split(name)
        assert "".join(got) == name and math.isclose(sum(map(price, got)), min(sum(map(price, s)) for s in splits(name)), rel_tol=1e-9)
    assert words.split("thetion") == ("the", "tion") and len(words.split("q" * 3000)) == 1
    assert words.tokens("h:", "The-tion1234.ON") == ["h:the", "h:tion", "h:#4", "h:on"]


def brute_verdicts(pages, rules):
    """page_id, host, path, rule, verdict, score by plain counting; pages: (page_id, url, html)."""
    found = collections.Counter(w for *_, html in pages for w in re.findall("(?<![a-z])[a-z]{1,24}(?![a-z])", re.sub("<[^<>]*>", " ", html or "").translate({c: c + 32 for c in range(65, 91)})))
    words = url_filter.Words(dict(found), sum(found.values()))
    rows = []
    for page_id, url, _ in pages:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
        fit = max((r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])), key=lambda r: len(r[0] + r[1]), default=None)
        rows.append((page_id, host, path, fit, words.tokens("h:", host) + words.tokens("p:", path)))
    by = {v: collections.Counter(t for *_, fit, tokens in rows if fit and fit[2] == v for t in tokens) for v in ("block", "allow")}
    urls = collections.Counter(fit[2] for *_, fit, _ in rows if fit)
    size = len(by["block"] | by["allow"]) + 1
    share = lambda v, t: (by[v][t] + 1) / (sum(by[v].values()) + size)
    out = {}
    for page_id, host, path, fit, tokens in rows:
        odds = math.log((urls["block"] + 1) / (urls["allow"] + 1)) + sum(math.log(share("block", t) / share("allow", t)) for t in tokens)
        out[page_id] = (host, path, fit and fit[0] + fit[1], fit[2] if fit else "block" if odds > 0 else "allow", 1 / (1 + math.exp(-odds)))
    return out


def check_verdicts(df, want):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.score) for r in df.collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k][:4] == w[:4] and math.isclose(got[k][4], w[4], rel_tol=1e-9), (k, got[k], w)


def test_url_filter_by_brute_force(spark):
    pages = spark.read.parquet(f"{DIR}/pages.parquet")
    want = brute_verdicts([tuple(r) for r in pages.select("page_id", "url", "html").collect()], url_filter.RULES)
    assert {w[3] for w in want.values()} == {"allow", "block"} and any(w[2] is None and w[3] == "block" for w in want.values())
    check_verdicts(queries.op12_url_filter(spark, DIR), want)


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "://", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com/en/", "http://notexample.com/en/", "https://a.net/es/://b.com/", "http://x.com?en/", "http://x.com#/en/",
            "http://a.com:80/en/", "http://ünï.net/fr/é", "x" * 50_000 + "://net/fr/" + "y" * 50_000, "http://" + "ab." * 20_000 + "net/es/1", "http://a.com/\n/en"]
    rows = [(i, u, "<p>the web <b>page</b></p>" if i % 3 else None, *["clash"] * 4) for i, u in enumerate(urls)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, host string, path string, rule string, n string")
    check_verdicts(url_filter.judge(table), brute_verdicts([r[:3] for r in rows], url_filter.RULES))
    assert url_filter.judge(table.limit(0)).count() == 0
    twice = url_filter.judge(table.filter("page_id = 5").union(table.filter("page_id = 5")))
    assert twice.count() == 2 and {r.verdict for r in twice.collect()} == {"allow"}


def test_rare_words_share_one_probability(spark):
    """With a large least share only the frequent words and tokens have probabilities of their own, 1 / min_share at most."""
    pages = spark.read.parquet(f"{DIR}/pages.parquet")
    counts, total = url_filter.unigrams(pages, 0.01)
    assert 0 < len(counts) <= 100 and min(counts.values()) >= 0.01 * total
    rules, words = url_filter.Rules(url_filter.RULES), url_filter.Words(counts, total)
    model = url_filter.fit(url_filter.parts(pages), rules, words, 0.05)
    assert 0 < len(model.odds) <= 20


def brute_trie(rows, family=5, most=9):
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    seq = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % most
        head = sorted(convs.get(c - math.fmod(c, family), []))[:h]
        seq[c] = tuple(x[2:] for x in head) + tuple(x[2:] for x in sorted(convs[c])[h:])
    members = collections.defaultdict(list)
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    out = []
    for node, own in members.items():
        below = [x for x in members if x[: len(node)] == node]
        inner = {x[:-1] for x in members if x}
        ends = sorted(c for c in own if seq[c] == node)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), sum(x[:-1] == node for x in members if x), sum(x not in inner for x in below), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_odd_conversations(spark):
    draw = random.Random(3)
    rows = [(c, t, draw.choice(["user", "bot", None]), draw.choice(["a", "b", "é" * 5, "", None])) for c in range(-7, 60) for t in range(draw.randint(1, 6))]
    rows = [(c, None if draw.random() < 0.02 and t == 0 else t, r, x) for c, t, r, x in rows]
    rows += [(100, t, "user", "same") for t in range(120)] + [(105 + k, t, "user", "same") for k in range(30) for t in range(14)] + [(1000, 0, "user", "z" * 100_000), (None, 1, "user", "lost"), (2**40, 3, "user", "far"), (2**40, 3, "user", "far")]
    schema = "conv_id long, turn long, role string, text string, a string, b string, k string, part string, c string, depth string"
    table = spark.createDataFrame([(*r, *["clash"] * 6) for r in rows], schema)
    want = brute_trie(rows)
    for local_nodes in (20_000, 8):
        same(prefix_trie.trie(table, local_nodes=local_nodes), COLUMNS, want)
    assert prefix_trie.trie(table.limit(0)).count() == 0 and prefix_trie.trie(table.filter("conv_id is null")).count() == 0


def test_components_of_any_shape():
    """Chains, stars and random forests: sums by centroids are the sums by plain adding up."""
    draw = np.random.default_rng(4)
    for n, pick in ((400, lambda i: i - 1), (400, lambda i: 0), (500, lambda i: int(draw.integers(0, i))), (300, lambda i: max(0, i - int(draw.integers(1, 4)))), (1, lambda i: 0)):
        parent = np.array([-1] + [pick(i) if draw.random() > 0.02 or n == 1 else -1 for i in range(1, n)])
        depth = np.zeros(n, int)
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1 if parent[i] >= 0 else 0
        order = np.argsort(depth, kind="stable")
        rank = np.argsort(order)
        parent = np.array([rank[parent[i]] if parent[i] >= 0 else -1 for i in order])
        own, values = draw.integers(1, 50, n), draw.integers(0, 1000, (2, n))
        weight, want = own.copy(), values.copy()
        for i in range(n - 1, -1, -1):
            if parent[i] >= 0:
                weight[parent[i]] += weight[i]
                want[:, parent[i]] += want[:, i]
        assert (prefix_trie.component_sums(parent, weight, values) == want).all()


def test_rounds_halve_components(spark, monkeypatch):
    """A chain of 300 nodes is down to components of 20 in 4 or 5 rounds of joins, not in one a node."""
    tables = []
    keep = prefix_trie.written
    monkeypatch.setattr(prefix_trie, "written", lambda df: tables.append(df.columns) or keep(df))
    chain = spark.createDataFrame([(5, t, "user", f"turn {t}") for t in range(300)], "conv_id long, turn long, role string, text string")
    rows = {r.depth: (r.n_leaves, r.n_children) for r in prefix_trie.trie(chain, local_nodes=20).collect()}
    assert rows == {d: (1, int(d < 300)) for d in range(301)}
    assert sum("of_all" in c for c in tables) <= 6
