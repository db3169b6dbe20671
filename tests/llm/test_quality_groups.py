"""Bounds follow the group: what is odd in one (lang, source) is usual in another."""

import random

import numpy as np

from tessera.llm import quality


def test_odd_for_its_group_only(spark):
    rng = random.Random(5)

    def text(symbols, copies=0):
        words = [f"w{rng.randrange(10**6)}" + "#" * (k < symbols) for k in range(100)]
        lines = [" ".join(words[k : k + 5]) for k in range(0, 100, 5)]
        return "\n".join(lines + ["a line"] * copies)

    rows = [(k, text(rng.randrange(2)), "en", "prose") for k in range(400)] + [(1000 + k, text(rng.randrange(12, 22), 6), "en", "code") for k in range(400)]
    rows += [(2000, text(15), "en", "prose"), (2001, text(15, 6), "en", "code"), (2002, text(0, 6), "en", "prose"), (2003, text(15), "xx", "few")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in quality.score(docs).collect()}
    assert (found[2000].broken_rule, found[2002].broken_rule) == ("symbol_rate", "dup_line_rate")
    assert found[2001].kept and found[2003].kept
    assert sum(r.kept for r in found.values()) >= 0.97 * len(rows)
    limits = {r.source: r.bound["symbol_rate"] for r in quality.bounds(quality.features(docs)).collect()}
    assert limits["prose"].middle + 6 * limits["prose"].spread < 0.1 < limits["code"].middle


def test_bounds_against_exact_quantiles(spark):
    """Middles and spreads of all four rates are those of exact quantiles, within the sketches' rank error, in every group, and each verdict follows from them."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(4)
    rows = quality.features(docs).toPandas()
    good = rows[~((rows.n_words < 50) | (100 * rows.n_repeat_words > 50 * rows.n_words))]
    found = {(r.lang, r.source): r.bound for r in quality.bounds(quality.features(docs)).collect()}
    judged = {r.doc_id: r for r in quality.score(docs).collect()}
    by_lang, own = good.groupby("lang").groups, good.groupby(["lang", "source"]).groups
    for name, (of, per, step, tail) in quality.RATES.items():
        rate = good[of] / good[per].clip(lower=1)
        for (lang, source), index in own.items():
            index = index if len(index) >= 200 else by_lang[lang]
            x, sizes = np.sort(rate[index].to_numpy()), np.sort(good[per][index].to_numpy())
            at = lambda q, d, x=x: float(x[int(np.clip((q + d) * len(x), 0, len(x) - 1))])
            alike, log = {0.8: 1.2478, 0.97: 2.7885}[tail], {0.8: 0.22314, 0.97: 0.03046}[tail]
            spread = lambda d: max(at(0.75, d) - at(0.5, -d), (at(tail, d) - at(0.5, -d)) / alike, step * log / at(0.5, -d, sizes))
            b = found[lang, source][name]
            assert at(0.5, -0.01) - 1e-9 <= b.middle <= at(0.5, 0.01) + 1e-9 and spread(-0.01) - 1e-4 <= b.spread <= spread(0.01) + 1e-4, (name, lang, source)
    differ = 0
    for r in rows.itertuples():
        over = False
        for name, (of, per, step, _) in quality.RATES.items():
            b, n = found[r.lang, r.source][name], max(getattr(r, per), 1)
            over |= r.n_words > 0 and getattr(r, of) / n > b.middle + 6 * (b.spread**2 + step * (b.middle + b.spread) / n) ** 0.5
        base = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        differ += judged[r.doc_id].kept != (not base and not over)
    assert differ <= 5  # two sketches of one table may differ by a few ranks
    junk = [r for r in judged.values() if not r.base_failed and r.n_symbols > 0.3 * r.n_words]
    assert len(junk) > 500 and not any(r.kept for r in junk)
    plain = [r for r in judged.values() if not r.base_failed and r.n_symbols == 0 and r.n_dup_lines == 0 and r.n_repeat_words == 0 and r.word_chars < 6 * r.n_words]
    assert len(plain) > 5000 and sum(r.kept for r in plain) >= 0.999 * len(plain)
    symbols = {(b["symbol_rate"].middle, b["symbol_rate"].spread) for b in found.values()}
    assert len(symbols) >= 5  # no constant decides


def test_rates_that_most_texts_lack(spark):
    """Where nearly no text has a symbol, one or two in a text are chance, and ten times as many are not; a longer text may have more."""
    rng = random.Random(7)

    def text(n, symbols):
        words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        return " ".join(w + "#" * (k < symbols) for k, w in enumerate(words))

    rows = [(k, text(rng.randrange(80, 300), int(k % 40 == 0)), "en", "prose") for k in range(600)]
    rows += [(1000, text(60, 1), "en", "prose"), (1001, text(60, 20), "en", "prose"), (1002, text(2000, 8), "en", "prose"), (1003, text(2000, 400), "en", "prose")]
    found = {r.doc_id: r.kept for r in quality.score(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [found[k] for k in (1000, 1001, 1002, 1003)] == [True, False, True, False] and sum(found.values()) >= 600
