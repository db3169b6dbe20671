"""Each operator against brute force on small tables, and on nulls, empty and long texts, ties, repeated rows and clashing columns."""

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import decontam, importance, langid, license_scan, packing, pii, quality, queries, simhash, substring, toxicity
from tessera.operators.graph import connected_components

DIR = "/root/testdata/sf0.001"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component string, component_id string, fp string, bound string, key string, words string, node string, places string, hits string, row_key string, bucket string, row_id string, _key string, _row_key string, item_key string"


def letters(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    base = " ".join(f"alpha{i} beta{i} gamma{i}" for i in range(40))
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base + " tail", None, "a"), (4, None, "en", None), (5, "", "en", "b"), (6, "  \n\t ", "en", "b"),
        (7, long, "en", "a"), (None, base, "en", "a"), (8, "All rights reserved. CC BY 4.0 cc by\x00cc by", "fr", "b"), (9, "12 34 !!! ...", None, "b"), (10, "a  b   c\n\nd \x1c\x85   e <|endoftext|> x", "de", "b"),
        (11, "Licensed under the Apache License, Version 2.0. " + base[:200], "en", "a"), (2, "another text under the same id " + base[200:900], "en", "a"), (12, "x" * 5000, "en", "a"),
    ]
    return spark.createDataFrame([(*r, 0, *["clash"] * 15) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 1), (7, 1, 0), (None, 1, 1), (9, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def check_quality(rows, by):
    for r in rows:
        w = SPACE.findall(by[r.doc_id] or "")
        g = collections.Counter(zip(w, w[1:], w[2:]))
        hit = {p + k for p in range(len(w) - 2) if g[tuple(w[p : p + 3])] > 1 for k in range(3)}
        lines = [x for x in (by[r.doc_id] or "").split("\n") if SPACE.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", by[r.doc_id] or "")), len(lines) - len(set(lines)), len(hit))
        assert r.base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w)) and (r.kept is False or not r.base_failed)


def test_quality(spark, docs, odd):
    check_quality(queries.op1_quality_rules(spark, DIR).collect(), texts(docs))
    one = odd.filter("doc_id is not null").dropDuplicates(["doc_id"])
    check_quality(quality.score(one).collect(), texts(one))
    assert quality.score(odd).count() == odd.count() and quality.score(odd.limit(0)).count() == 0
    kept = quality.keep(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= {1, 3}


def components(fps, limit):
    ids = sorted(fps)
    label = {i: i for i in ids}
    f = np.array([fps[i] for i in ids], np.uint64)
    while True:
        before = dict(label)
        for k, i in enumerate(ids):
            near = [ids[j] for j in np.flatnonzero(np.bitwise_count(f ^ f[k]) <= limit)]
            low = min(label[n] for n in near)
            for n in near:
                label[n] = low
        if label == before:
            return label


def test_simhash(spark, docs, odd):
    by = texts(docs)
    want = {}
    for i, t in by.items():
        w = (t or "").encode().lower().split()
        g = [b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in g]
        want[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    label = components(want, 4)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in queries.op4_simhash(spark, DIR).collect()} == {(i, f"{want[i]:016x}", label[i]) for i in by}
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count() and all((r.component_id is None) == (r.doc_id is None) for r in got)
    assert {r.component_id for r in got if r.doc_id in (4, 5, 6)} == {4}
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    left = simhash.deduplicate(odd)
    assert left.columns == odd.columns and [r.doc_id for r in left.collect() if r.text and r.text.startswith("alpha0")].count(1) == 1


@pytest.mark.parametrize(("node_rows", "limit"), [(8, 4), (2048, 4), (64, 7)])
def test_dense_fingerprints(spark, node_rows, limit):
    """Many fingerprints in one masked pattern: parts of a node and the index give what all pairs give."""
    rng = np.random.default_rng(4)
    base = int(rng.integers(1 << 62))
    fps = sorted({base ^ sum(1 << int(b) for b in rng.integers(0, 62, rng.integers(0, 12))) for _ in range(300)})
    nodes = spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, node long")
    found = {r.node: r.component for r in connected_components(simhash.links(nodes, limit, node_rows)).collect()}
    assert {i: found.get(i, i) for i in range(len(fps))} == components(dict(enumerate(fps)), limit)


def removal(by, size=13):
    words = {i: (t or "").encode().split() for i, t in by.items()}
    first = {}
    for i in sorted(words):
        for p in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][p : p + size]), i)
    for i, w in words.items():
        gone = {p + k for p in range(len(w) - size + 1) if first[tuple(w[p : p + size])] < i for k in range(size)}
        yield i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()


def test_substring(spark, docs, odd):
    assert set(removal(texts(docs))) == {tuple(r) for r in queries.op5_substring(spark, DIR).collect()}
    one = odd.filter("doc_id is not null").dropDuplicates(["doc_id"])
    assert set(removal(texts(one))) == {tuple(r) for r in substring.deduplicate(one).collect()}
    all_ = substring.deduplicate(odd).collect()
    assert len(all_) == odd.count() and [r.n_removed for r in all_ if r.doc_id is None] == [0] and [r.n_removed for r in all_ if r.doc_id == 1] == [0]
    assert substring.deduplicate(odd.limit(0)).count() == 0


def test_packing(spark, docs, odd):
    from tokenizers import Tokenizer

    path, _, _ = packing.public_files("byte_bpe_50k")
    slow = Tokenizer.from_file(path)
    for df, rows in ((docs, queries.op8_packing(spark, DIR).collect()), (odd.filter("doc_id is not null").dropDuplicates(["doc_id"]), None)):
        rows = rows or packing.pack(df, *packing.public_files("byte_bpe_50k")).collect()
        by = collections.defaultdict(list)
        for r in rows:
            by[r.doc_id].append(r)
        for i, t in texts(df).items():
            ids = (slow.encode(t, add_special_tokens=False).ids if t else []) + [2]
            raw = np.array(ids, "<u4").tobytes()
            got = sorted(by[i], key=lambda r: r.piece)
            assert [r.piece for r in got] == list(range(len(got))) and sum(r.length for r in got) == len(ids) and all(r.length == 1024 for r in got[1:])
            for r in got:
                assert zlib.crc32(raw[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32
        bins = collections.defaultdict(list)
        for r in rows:
            bins[r.sequence_id].append((r.offset, r.length))
        for held in bins.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
            assert at <= 1024
        assert len(bins) <= 1.02 * -(-sum(r.length for r in rows) // 1024) + 1
    assert packing.pack(odd, *packing.public_files("byte_bpe_50k")).count() >= odd.count() and packing.pack(odd.limit(0), path).count() == 0


def test_tokens_agree():
    e = packing.encoder(*packing.public_files("byte_bpe_50k"))
    for t in ("a   b", "a\n  b", " a", "a ", "  ", "\n\n x \n\n y", "it's  'tis <|endoftext|> z", "x\x1c y  \x85 z", "１２３ 45  ok 　 x", "한국 हि", "don't  we'll\r\n\r\n go"):
        assert e.encode_all([t])[0] == e.whole(t)


def held_by(bins, n):
    held = np.zeros(n, np.int64)
    for lengths, times in bins:
        for x in lengths:
            held[x - 1] += times
    return held


@pytest.mark.parametrize("lengths", [{5: 9, 21: 7, 32: 5, 33: 6, 41: 8, 64: 3}, {40: 100, 24: 10}, {33: 50}, {40: 30, 20: 60, 22: 45, 9: 7}, {1: 1}, {64: 2, 1: 130}])
def test_plan_covers_the_histogram(lengths):
    count = np.zeros(64, np.int64)
    for n, c in lengths.items():
        count[n - 1] = c
    bins = packing.plan(count, 64)
    assert all(sum(x) <= 64 for x, _ in bins) and (held_by(bins, 64) == count).all()
    assert sum(n for _, n in bins) <= sum(n for _, n in packing.best_fit(count, 64))


def test_program_bound_is_below_the_least():
    """The dual's bound against the true optimum by brute force, and the knapsack against all multisets."""
    rng = np.random.default_rng(1)
    for _ in range(20):
        count = rng.integers(0, 3, 12)
        pieces = np.repeat(np.arange(1, 13), count).tolist()[::-1][:8]
        count = np.bincount(pieces, minlength=13)[1:] if pieces else np.zeros(12, np.int64)
        if not pieces:
            continue

        def least(at, rooms):
            if at == len(pieces):
                return len(rooms)
            tries = [least(at + 1, tuple(sorted(rooms[:k] + (r - pieces[at],) + rooms[k + 1 :]))) for k, r in enumerate(rooms) if r >= pieces[at]]
            return min([*tries, least(at + 1, tuple(sorted((*rooms, 12 - pieces[at]))))]) if len(rooms) < len(pieces) else min(tries)

        _, value, bound = packing.configurations(count, 12)
        assert bound <= least(0, ()) + 1e-9 <= value + 1e-9
    value = rng.random(12)
    best = packing.price(value, 12)
    full = [0.0] * 13
    for room in range(13):
        full[room] = max((value[n - 1] + full[room - n] for n in range(1, room + 1)), default=0.0)
    assert np.allclose(best, full)
    assert packing.price(np.where(np.arange(1, 13) % 2, -np.inf, value), 12)[[5, 7, 11]].max() == -np.inf


@pytest.fixture(scope="module")
def real_lengths(spark):
    def histogram(sf):
        parts = packing.pieces(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").repartition(4), *packing.public_files("byte_bpe_50k"))
        count = np.zeros(1024, np.int64)
        for r in parts.groupBy("length").count().collect():
            count[r["length"] - 1] = r["count"]
        return count

    own = {sf: histogram(sf) for sf in ("sf0.001", "sf0.01", "sf0.1")}
    return own | {f"sf0.1 x {k}": k * own["sf0.1"] for k in (3, 10, 100)}


def test_program_on_real_lengths(real_lengths):
    """No more sequences than best fit alone needs, on any of the given tables and on larger ones, nearly half from configurations, all full."""
    for name, count in real_lengths.items():
        found, value, bound = packing.configurations(count, 1024)
        alone = sum(n for _, n in packing.best_fit(count, 1024))
        bins = packing.plan(count, 1024)
        assert sum(n for _, n in bins) == value <= alone and value <= 1.011 * bound and (held_by(bins, 1024) == count).all(), name
        assert all(np.frombuffer(key, np.int64) @ np.arange(1, 1025) == 1024 for key in found)
        if name not in ("sf0.001", "sf0.01"):
            assert sum(found.values()) > 0.45 * value and value <= 1.0002 * bound + 1
        if name in ("sf0.1 x 10", "sf0.1 x 100"):
            assert value < alone


def overlapped(by, items, window=12, similarity=0.8):
    """All (document, item) whose words agree along some diagonal; a word's code in items is its own, so unlike documents go at once."""
    code = {}
    items = {k: np.array([code.setdefault(x, len(code)) for x in letters(t)]) for k, t in items.items()}
    for i, t in by.items():
        w = np.array([code.get(x, -1) for x in letters(t)])
        for k, q in items.items():
            size = min(window, len(q))
            if not size or np.isin(w, q).sum() < similarity * size:
                continue
            wide = np.r_[np.full(len(q), -1), w, np.full(len(q), -1)]
            same = np.lib.stride_tricks.sliding_window_view(wide, len(q)) == q
            sums = np.cumsum(np.c_[np.zeros(len(same)), same], 1)
            if (sums[:, size:] - sums[:, :-size]).max(initial=0) >= similarity * size - 1e-9:
                yield i, k


def test_decontamination(spark, docs, odd):
    bench = spark.read.parquet(f"{DIR}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    found = [(r.doc_id, r.item_id) for r in queries.op7_decontamination(spark, DIR).collect()]
    assert sorted(overlapped(texts(docs), items)) == sorted(found)
    some = next(t for t in items.values() if len(letters(t)) > 25)
    w = some.split()
    changed = " ".join("changed" if k in (4, 11) else x for k, x in enumerate(w[:12]))
    planted = spark.createDataFrame([(1, "before it " + changed + " after", "x"), (2, " ".join(w[:6]) + " and no more", "x"), (3, None, "x"), (None, some, "x"), (1, "before it " + changed + " after", "x")], "doc_id long, text string, item string")
    assert {r.doc_id for r in decontam.overlaps(planted, bench).collect()} == {1, None}
    assert {r.doc_id for r in decontam.decontaminate(planted, bench).collect()} == {2, 3}
    assert decontam.overlaps(odd.limit(0), bench).count() == 0 and decontam.overlaps(odd, bench.limit(0)).count() == 0
    assert decontam.decontaminate(odd, bench).columns == odd.columns


def test_short_items(spark):
    """Items of 1 to 14 words, in documents with every set of up to 3 words changed: short ones, repeated ones and those without an id."""
    items = {n: " ".join(f"i{n}w{k}" for k in range(n)) for n in range(1, 15)}
    by, at = {}, 0
    for n, t in items.items():
        for k in range(min(4, n)):
            for places in itertools.combinations(range(n), k):
                by[at] = f"some words {' '.join('other' if p in places else x for p, x in enumerate(t.split()))} more"
                at += 1
    bench = spark.createDataFrame([*items.items(), (3, items[3]), (None, "no id"), (77, None), (78, " .")], "item_id long, text string")
    docs = spark.createDataFrame([*by.items(), (at, "this has no id either")], "doc_id long, text string")
    found = [(r.doc_id, r.item_id) for r in decontam.overlaps(docs, bench).collect()]
    assert sorted(x for x in found if x[1]) == sorted(overlapped(by, items)) and [x for x in found if x[1] is None] == [(at, None)]


def test_license_scan(spark, docs, odd):
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    one = odd.filter("doc_id is not null").dropDuplicates(["doc_id"])
    for df, rows in ((docs, queries.op10_license_scan(spark, DIR).collect()), (one, license_scan.scan(one).collect())):
        by = texts(df)
        for r in rows:
            w = letters(by[r.doc_id])
            at = [(k, label) for p, label in phrases.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
            assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(at), ",".join(sorted({x for _, x in at})))
            assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert "apache-2.0" in {r.doc_id: r.labels for r in license_scan.scan(one).collect()}[11]
    assert license_scan.scan(odd).count() == odd.count() and license_scan.scan(odd.limit(0)).count() == 0
    notice = license_scan.TEMPLATES[2][1].split()
    bent = " ".join(notice[:9] + ["inserted"] + notice[9:])
    got = license_scan.scan(spark.createDataFrame([(1, "so " + bent), (2, " ".join(notice[:8]))], "doc_id long, text string")).collect()
    assert {r.doc_id: r.labels for r in got} == {1: "mit", 2: ""}


KEY = hashlib.blake2b(b"k", digest_size=32).digest()


def test_pii(spark, docs, odd):
    plain = "Write to Anna.Li7@mail3.example.com or anna.li7@mail3.example.com, call +1 (487) 555-7209 or 487-555-7209 from 10.1.2.3 or 8.8.8.8, card 4111 1111 1111 1111, Frau Anna Weber; token 04dbebab91ab85687d33eeaaf9ac699e1188f962."
    new, found = pii.replace(plain, KEY)
    by = collections.defaultdict(list)
    for k, a, b in found:
        by[k].append((a, b))
        assert a not in new and len(re.sub(r"\D", "", a)) == len(re.sub(r"\D", "", b)) or k in ("secret", "ip")
    assert by["email"][0][1].lower() == by["email"][1][1].lower() and by["email"][0][1] != by["email"][1][1]
    assert re.sub(r"\D", "", by["phone"][0][1])[-10:] == re.sub(r"\D", "", by["phone"][1][1])
    assert by["ip"][0][1].startswith("10.") and not by["ip"][1][1].startswith("10.") and pii.luhn(re.sub(r"\D", "", by["card"][0][1]))
    assert re.fullmatch("[0-9a-f]{40}", by["secret"][0][1]) and by["name"][0][1].split()[1].lower() in pii.GIVEN[1][1]
    assert len({pii.surrogate("card", f"{n:016d}", KEY) for n in range(3000)}) == 3000 and len({pii._ip(f"10.0.{n // 250}.{n % 250}", KEY) for n in range(2000)}) == 2000
    assert pii.collisions(docs, "k").count() == 0
    rows = {r.doc_id: r for r in queries.op3_pii(spark, DIR).collect()}
    for i, t in texts(docs).items():
        assert not [x for x in pii.FINDER.findall(t) if x[0] and x[0] in rows[i].text] and (rows[i].n_entities or rows[i].text == t)
    got = pii.replace_in(odd, "k")
    assert got.columns == odd.columns and got.count() == odd.count() and pii.pseudonymise(odd.limit(0), "k").count() == 0
    assert [r.text for r in got.filter("doc_id = 4").collect()] == [None]


def valid_iban(x):
    x = x.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def test_accounts_and_telephones():
    """One account or number in two spellings has one surrogate; country, check digits and form stay."""
    new = dict((a, b) for _, a, b in pii.replace("DE89 3704 0044 0532 0130 00 or DE89370400440532013000, GB29 NWBK 6016 1331 9268 19 and FR76 3000 6000 0112 3456 7890 189", KEY)[1])
    a, b, gb, fr = new.values()
    assert a.replace(" ", "") == b and all(map(valid_iban, (a, gb, fr))) and (a[:2], gb[:2], fr[:2]) == ("DE", "GB", "FR") and re.fullmatch(r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d", gb)
    bodies = [f"{n:018d}" for n in range(2000)]
    made = {pii.surrogate("iban", f"DE{pii._check_digits('DE', x):02d}{x}", KEY) for x in bodies}
    assert len(made) == 2000 and all(map(valid_iban, made))
    said = "+49 30 1234567, 030 1234567, 030/1234567, 06 12 34 56 78, +33 6 12 34 56 78, +33 (0)6 12 34 56 78"
    digits = [re.sub(r"\D", "", b) for _, _, b in pii.replace(said, KEY)[1]]
    assert len(digits) == 6 and digits[0][2:] == digits[1][1:] == digits[2][1:] and digits[0][:2] == "49" and digits[3][1:] == digits[4][2:] == digits[5][3:]
    assert digits[1] != "0301234567" and digits[1][0] == "0" and pii.replace("on 030 12 of 2030 12345 items, 1.030 1234567", KEY)[1] == []


def test_names():
    """No given name stays, the list is no shift of itself, and a name that a title gave away is found without it."""
    for _, group in pii.GIVEN:
        for seed in range(20):
            key = hashlib.blake2b(str(seed).encode(), digest_size=32).digest()
            new = [pii._one_name(x, key).lower() for x in group]
            assert sorted(new) == sorted(group) and all(a != b for a, b in zip(group, new, strict=True))
    group = pii.GIVEN[0][1]
    steps = {(group.index(pii._one_name(x, KEY).lower()) - k) % len(group) for k, x in enumerate(group)}
    assert len(steps) > 5
    new, found = pii.replace("Frau Anna Weber met Anna Weber; then Weber left, and Ms. Er Er went. er saw Webers.", KEY)
    assert "Anna" not in new and not re.search(r"\bWeber\b", new) and "Webers" in new and [k for k, *_ in found].count("name") == 4
    full = {b.split(" ", 1)[1] if b.startswith(("Frau", "Ms")) else b for k, a, b in found if "Anna" in a}
    assert len(full) == 1 and full.pop().split()[1] == next(b for _, a, b in found if a == "Weber")


def test_collisions_are_refused(spark, docs, monkeypatch):
    monkeypatch.setattr(pii, "_one_name", lambda word, key: "Same")
    rows = spark.createDataFrame([(1, "Mr Miller"), (2, "Mr Smith")], "doc_id long, text string").coalesce(1)
    key = KEY
    names = {pii.identity("name", b) for t in ("Mr Miller", "Mr Smith") for _, _, b in pii.replace(t, key)[1]}
    assert len(names) == 1  # in this process; workers have the true function, so the table is clean there
    assert pii.checked(rows, "k") == key
    monkeypatch.setattr(pii, "collisions", lambda docs, secret: rows.limit(1))
    with pytest.raises(ValueError):
        pii.pseudonymise(rows, "k")


def test_langid(spark, docs, odd):
    rows = {r.doc_id: r for r in queries.op6_langid(spark, "/root/testdata/sf0.01").collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in rows.items() if r.held_out} == set(held) and sum(rows[i].lang_pred == lang[i] for i in held) > 0.95 * len(held)
    got = langid.identify(odd).collect()
    assert len(got) == odd.count() and {r.lang_pred for r in got if r.doc_id in (4, 5, 6, 9)} == {"und"} and all(0 <= r.score <= 1 for r in got)
    assert langid.identify(odd.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_toxicity(spark, odd, labels):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in queries.op2_toxicity(spark, sf).collect()}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [i for i in truth if rows[i].held_out]
    hit = [rows[i].predicted for i in held if truth[i] == 1]
    wrong = [rows[i].predicted for i in held if truth[i] == 0]
    assert np.mean(hit) > 0.85 and np.mean(wrong) < 0.06
    got = toxicity.score(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert toxicity.score(odd.limit(0), labels).count() == 0 and toxicity.score(odd, labels.limit(0)).count() == odd.count()


def test_unseen_misspelling():
    clean = [(f"the quiet garden number {i} has tall trees and {w} paths".encode(), 0) for i, w in enumerate(["wide", "narrow", "green", "stony"] * 15)]
    toxic = [(f"the quiet garden number {i} has tall idiots and worthless paths".encode(), 1) for i in range(60)]
    table, bias = toxicity.train(clean + toxic, 8)

    def logit(t):
        from tessera.llm.common import slices

        s = next(slices(memoryview(t), np.array([0, len(t)])))
        bucket, run, _ = toxicity.grams(s, 8)
        return bias + max(table[bucket[run == r]].mean() for r in set(run.tolist()))

    assert logit(b"the tall idiotts walk") > logit(b"the tall walkers walk")


def test_importance(spark, docs, odd, labels):
    rows = queries.op9_importance(spark, DIR).collect()
    k = round(len(rows) * np.mean([r.quality for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()]))
    assert sorted(r.doc_id for r in rows if r.kept) == sorted(r.doc_id for r in sorted(rows, key=lambda r: -r.gumbel_key)[:k])
    numbers = spark.range(30_000).select(F.col("id").alias("doc_id"), (F.col("id") * 7919 % 10_007).cast("double").alias("x"))
    got = importance.top_k(numbers, "x", 777, ("doc_id",), bins=16, last=50)
    want = sorted(((-(i * 7919 % 10_007), i) for i in range(30_000)))[:777]
    assert {r.doc_id for r in got.filter("kept").collect()} == {i for _, i in want} and got.count() == 30_000
    all_ = importance.resample(odd, labels).collect()
    assert len(all_) == odd.count() and {r.log_weight for r in all_ if r.doc_id in (4, 5, 6)} == {0.0}
    assert not importance.resample(odd, labels.withColumn("quality", F.lit(0))).filter("kept").count()
    ties = spark.range(500).select((F.col("id") % 50).alias("doc_id"), F.lit(1.0).alias("x")).repartition(3).cache()
    for k in (0, 7, 33, 120, 500):
        got = collections.Counter(r.doc_id for r in importance.top_k(ties, "x", k, ("doc_id",), bins=4, last=5).filter("kept").collect())
        assert got == collections.Counter(sorted(i % 50 for i in range(500))[:k])
    assert importance.resample(odd.limit(0), labels).count() == 0 and importance.resample(odd, labels.limit(0)).count() == odd.count()


def test_log_weights(spark, docs):
    """Weights against plain counting: an n-gram's bucket is what it gets alone, all else is counted here."""
    from tessera.llm.common import slices

    def bucket(gram):
        found = importance.ngrams(next(slices(memoryview(gram.encode()), np.array([0, len(gram.encode())]))))[0]
        return int(found[-1])  # words come before pairs

    some = [r for r in docs.filter("length(text) between 1 and 600").limit(60).collect()]
    target = {r.doc_id for r in some[::3]}
    raw, own = np.ones(importance.BUCKETS), np.ones(importance.BUCKETS)
    grams = {}
    for r in some:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), r.text)
        w = SPACE.findall(w)
        grams[r.doc_id] = [bucket(x) for x in w] + [bucket(f"{a} {b}") for a, b in itertools.pairwise(w)]
        np.add.at(raw, grams[r.doc_id], 1)
        if r.doc_id in target:
            np.add.at(own, grams[r.doc_id], 1)
    ratio = np.log(own / own.sum()) - np.log(raw / raw.sum())
    frame = spark.createDataFrame([(r.doc_id, r.text) for r in some], "doc_id long, text string")
    labelled = spark.createDataFrame([(r.doc_id, int(r.doc_id in target)) for r in some], "doc_id long, quality int")
    for r in importance.resample(frame, labelled).collect():
        assert r.log_weight == pytest.approx(ratio[grams[r.doc_id]].sum(), abs=1e-6)


def test_every_template_is_found(spark):
    """Each notice as it stands, with a word put in, with its last word gone, and cut to half: all but the last are found."""
    rows, want = [], {}
    for k, (label, text) in enumerate(license_scan.TEMPLATES):
        w = letters(text)
        forms = [w, w[: len(w) // 2] + ["inserted"] + w[len(w) // 2 :], w[:-1], w[: len(w) // 2]]
        for f, words in enumerate(forms):
            rows.append((10 * k + f, "Some words before it. " + " ".join(words).upper() + ". And after it, more."))
            covered = {p + j for p in range(len(w) - 2) if any(words[q : q + 3] == w[p : p + 3] for q in range(len(words))) for j in range(3)}
            want[10 * k + f] = (label, len(covered) >= 0.8 * len(w))
    got = {r.doc_id: r.labels.split(",") for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    base = {"cc-by", "gpl", "reserved"}
    for i, (label, found) in want.items():
        assert (label in got[i]) == found or (label in base and label in got[i]), (i, label, got[i])
    assert all(want[10 * k][1] for k in range(len(license_scan.TEMPLATES))) and not any(want[10 * k + 3][1] for k in range(len(license_scan.TEMPLATES)))
