"""Near copies against brute force over all pairs."""

import random

import pytest

from tessera.llm import jaccard, simhash


def shingles(text, size=5):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def alike(a, b):
    return a == b or 10 * len(a & b) >= 8 * len(a | b)


def brute_force(rows):
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}
    near = [(i, j) for i in sets for j in sets if i < j and alike(sets[i], sets[j])]
    for _ in range(len(sets)):
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
    return label


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(4000)}"
    out = []
    for _ in range(25):  # copies of one text with up to 6 words of 60 to 200 changed: on either side of 0.8
        base = [word() for _ in range(rng.randrange(60, 200))]
        for _ in range(6):
            w = list(base)
            for _ in range(rng.randrange(7)):
                w[rng.randrange(len(w))] = word()
            out.append(" ".join(w))
    base = [word() for _ in range(150)]
    for k in range(60):  # a large group that hangs together by its first text
        w = list(base)
        for p in rng.sample(range(150), 0 if k == 0 else 3):
            w[p] = word()
        out.append(" ".join(w))
    passage = " ".join(word() for _ in range(60))
    out += [passage + " " + " ".join(word() for _ in range(20)) for _ in range(40)]  # much in common, but under 0.8
    out += ["", None, " \n", "one two", "One  two", "one two three", *(" ".join(word() for _ in range(80)) for _ in range(60))]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("part_rows", [4, 512])
def test_all_pairs_and_no_others(spark, rows, part_rows):
    want = brute_force(rows)
    found = jaccard.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), part_rows=part_rows).collect()
    assert {r.doc_id: r.component_id for r in found} == want
    assert len(set(want.values())) < len(rows) - 60


def test_deduplicate(spark, rows):
    want = brute_force(rows)
    twice = [*rows, (None, rows[0][1]), (rows[0][0], "a text of its own under an id that is there already")]
    left = simhash.deduplicate(spark.createDataFrame(twice, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in left if r.doc_id is not None) == sorted([*(i for i in want if want[i] == i), rows[0][0]])
    assert sum(r.doc_id is None for r in left) == 1
