"""URL filters: rules by host and path, and for what no rule names a multinomial naive Bayes over segmented host and path words.

Three passes over the pages. The first counts the words between the pages' tags: a unigram model. The second judges urls by the
rules and counts the tokens of those that a rule fits, by verdict. The third scores every url. A name of a host or path (its runs of
ASCII letters, lower-cased) is split into words by Viterbi over the unigram model, so "cheappills" and "cheap-pills" have the same
tokens. Digits are a token of their number. Tokens of host and path are told apart.

A word or token has a probability of its own if it is at least ``min_share`` of all that were counted, so a model has 1 / min_share
entries at most whatever the corpus; all rarer ones share one. That is what tasks are sent. A letter run that is no such word costs as
much as a word never seen, and more for each letter.

A null url, and one without "://", has an empty host and path and is judged by the classes' shares alone. Long hosts and paths are read whole.
Repeated rows each get a row and count each. Without ruled urls all are allowed; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, ship
from tessera.llm.native import LOWER, UPPER

#: (host, path, verdict): a rule fits its host and all subdomains where the url's path starts with the rule's.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: Longest word of the unigram model, in letters.
LONGEST = 24
#: Names that a worker keeps split; a full table is emptied.
CACHE_NAMES = 200_000
_RUNS = re.compile(r"[a-z]+|[0-9]+")
_TAG = "<[^<>]*>"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path of a url; both empty where there is no "://"."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.expr("substring(url, instr(url, '://') + 3)"), "#", 1)).otherwise("")
    rest = F.substring_index(F.coalesce(rest, F.lit("")), "?", 1)
    slash = F.instr(rest, "/")
    host = F.when(slash > 0, F.substring_index(rest, "/", 1)).otherwise(rest)
    return F.translate(host, UPPER, LOWER), F.substr(rest, F.length(host) + 1)


def parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path."""
    host, path = host_and_path(F.col("url"))
    return pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))


class Rules:
    """Rules by host: the fitting one of the longest host and path decides."""

    def __init__(self, rules: tuple[tuple[str, str, str], ...]) -> None:
        self.by_host: dict[str, list[tuple[str, str]]] = {}
        for host, path, verdict in rules:
            self.by_host.setdefault(host, []).append((path, verdict))
        self.labels = max((h.count(".") + 1 for h in self.by_host), default=0)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule's text and its verdict."""
        best, at = None, len(host)
        for _ in range(self.labels):
            at = host.rfind(".", 0, max(at, 0))
            own = host[at + 1 :]
            for start, verdict in self.by_host.get(own, ()):
                if path.startswith(start) and (best is None or len(own + start) > len(best[0])):
                    best = own + start, verdict
            if at < 0:
                break
        return best


class Words:
    """A unigram model of words, and the most likely split of a run of letters under it.

    A known word costs its negative log probability; an unknown stretch, that of a word never seen, and ten times less likely with every letter.
    """

    def __init__(self, counts: dict[str, int], total: int) -> None:
        self.cost = {w: math.log(total) - math.log(n) for w, n in counts.items()}
        self.unseen = math.log(total + 1) + math.log(10)
        self.longest = max(map(len, counts), default=1)
        self.known: dict[str, tuple[str, ...]] = {}

    def split(self, name: str) -> tuple[str, ...]:
        """The split of least cost; of equal ones that with the longest last word. A stretch of unknown letters stays one piece."""
        if (got := self.known.get(name)) is not None:
            return got
        n, far = len(name), math.log(10)
        best, back = [0.0] + [math.inf] * n, [0] * (n + 1)
        unknown, since = math.inf, 0  # the least cost of ending in an unseen piece, and where that begins
        for end in range(1, n + 1):
            if best[end - 1] + self.unseen < unknown:
                unknown, since = best[end - 1] + self.unseen, end - 1
            unknown += far
            best[end], back[end] = unknown, since
            for start in range(max(0, end - self.longest), end):
                cost = self.cost.get(name[start:end])
                if cost is not None and best[start] + cost < best[end]:
                    best[end], back[end] = best[start] + cost, start
        pieces, end = [], n
        while end:
            pieces.append(name[back[end] : end])
            end = back[end]
        if len(self.known) > CACHE_NAMES:
            self.known.clear()
        out = tuple(reversed(pieces))
        if n <= 255:
            self.known[name] = out
        return out

    def tokens(self, field: str, text: str) -> list[str]:
        """The tokens of a host or path: its words, and for a number how many digits it has."""
        out = []
        for run in _RUNS.findall(text.lower()):
            out.extend([f"{field}#{len(run)}"] if run[0].isdigit() else [f"{field}{w}" for w in self.split(run)])
        return out


def common(counts: DataFrame, key: str, min_share: float) -> tuple[DataFrame, int]:
    """The rows of counts (key, n and more) that hold min_share of all of n, 1 / min_share rows at most, and the sum of all n."""
    total = counts.agg(F.sum("n")).collect()[0][0] or 0
    return counts.filter(F.col("n") >= F.lit(min_share) * F.lit(total)), total


def unigrams(pages: DataFrame, min_share: float = 4e-6) -> tuple[dict[str, int], int]:
    """Counts of the words (ASCII letter runs) between the pages' tags, and of all words."""
    text = F.regexp_replace(F.coalesce("html", F.lit("")), _TAG, " ")
    shown = pages.select(F.translate(text, UPPER, LOWER).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        word = re.compile(rf"(?<![a-z])[a-z]{{1,{LONGEST}}}(?![a-z])")
        for batch in batches:
            for t in batch.column("text").to_pylist():
                counts.update(word.findall(t))
            if len(counts) > CACHE_NAMES:
                yield _counted(counts, "word")
                counts = Counter()
        yield _counted(counts, "word")

    found = cut(shown.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    kept, total = common(found, "word", min_share)
    return {r["word"]: r["n"] for r in kept.collect()}, total


def _counted(counts: Counter, name: str) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], [name, "n"])


def token_counts(urls: DataFrame, rules: Rules, words: Words) -> DataFrame:
    """token, block, allow: how often each token stands in the urls that a rule blocks and allows; the token "" counts the urls themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {"block": Counter(), "allow": Counter()}

        def rows() -> pa.RecordBatch:
            every = list(counts["block"] | counts["allow"])
            return pa.record_batch([pa.array(every, pa.string()), *(pa.array([counts[v][t] for t in every], pa.int64()) for v in counts)], ["token", "block", "allow"])

        for batch in batches:
            for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True):
                if (found := rules.find(host, path)) is not None:
                    counts[found[1]].update(["", *words.tokens("h:", host), *words.tokens("p:", path)])
            if len(counts["block"]) + len(counts["allow"]) > CACHE_NAMES:
                yield rows()
                counts["block"].clear(), counts["allow"].clear()
        yield rows()

    counted = urls.mapInArrow(run, "token string, block long, allow long")
    return counted.groupBy("token").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"))


class Bayes:
    """Multinomial naive Bayes with add-one smoothing: log odds of block against allow."""

    def __init__(self, counts: list[tuple[str, int, int]], rest: tuple[int, int], urls: tuple[int, int]) -> None:
        size = len(counts) + 1
        block, allow = (sum(c[i] for c in counts) + rest[i - 1] for i in (1, 2))
        odds = lambda b, a: math.log((b + 1) / (block + size)) - math.log((a + 1) / (allow + size))
        self.odds = {t: odds(b, a) for t, b, a in counts}
        self.rest = odds(*rest)
        self.prior = math.log(urls[0] + 1) - math.log(urls[1] + 1)

    def score(self, tokens: list[str]) -> float:
        """The probability of block."""
        x = math.fsum([self.prior, *(self.odds.get(t, self.rest) for t in tokens)])
        return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def fit(urls: DataFrame, rules: Rules, words: Words, min_share: float = 4e-6) -> Bayes:
    counts = cut(token_counts(urls, rules, words).withColumn("n", F.col("block") + F.col("allow")))
    ruled = counts.filter("token = ''").collect()
    counts = counts.filter("token != ''")
    kept, _ = common(counts, "token", min_share)
    rows = sorted((r["token"], r["block"], r["allow"]) for r in kept.collect())
    of_all = counts.agg(F.sum("block"), F.sum("allow")).collect()[0]
    rest = tuple((of_all[i] or 0) - sum(r[i + 1] for r in rows) for i in (0, 1))
    return Bayes(rows, rest, (ruled[0]["block"], ruled[0]["allow"]) if ruled else (0, 0))


def judge(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, min_share: float = 4e-6) -> DataFrame:
    """page_id, host, path, rule, verdict, the probability of block by the words alone, and those words, for each page."""
    spark = pages.sparkSession
    ship(spark)
    urls, lookup = parts(pages), Rules(rules)
    words = Words(*unigrams(pages, min_share))
    model = fit(urls, lookup, words, min_share)
    sent = spark.sparkContext.broadcast((words, model))  # 1 / min_share entries each at most
    kind = urls.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = sent.value
        for batch in batches:
            rows = []
            for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True):
                in_host = words.tokens("h:", host)
                score = model.score(in_host + words.tokens("p:", path))
                rule, verdict = lookup.find(host, path) or (None, "block" if score > 0.5 else "allow")
                rows.append((rule, verdict, score, " ".join(t[2:] for t in in_host)))
            own = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.float64(), pa.string()))]
            yield pa.record_batch([*(batch.column(c) for c in ("page_id", "host", "path")), *own], ["page_id", "host", "path", "rule", "verdict", "score", "host_words"])

    return urls.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string, score double, host_words string")
