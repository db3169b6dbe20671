"""Personal data: detected entities are replaced by keyed surrogates of their own type, script, case and format.

A surrogate comes from a keyed permutation of the strings of one format: each character stays in its class (digit, letter of a script,
vowel or consonant in names), and a balanced mixing of the two halves of the character vector under the key is undone by no one
without it. As it is a permutation, one entity always gets one surrogate, wherever it occurs, and two entities never share
one. Entities are brought to one form first: cards and bank accounts without separators, e-mail addresses without regard to case,
telephone numbers without their country code or the zero before an area code, addresses as four numbers. What is taken off is put back, as are
separators. Walking on along the permutation's cycle keeps what must hold of a type: a card number that passes its check
digit still does, an address stays public or private. A bank account keeps its country, and its check digits are made anew. A known
given name becomes the next one of its gender and script in an order of the key's own, so none stays as it is. A name that a title
gives away is replaced wherever else the text has it, with or without a title.

No surrogate is used unchecked: pseudonymise() and replace_in() first count originals for each surrogate over the whole table and
raise an error if two share one.

Names are found by a title before them (in Latin, Cyrillic or Arabic script) or an honorific behind (Chinese), with particles kept.
What is found is bounded in length and a text is read in linear time, however long its unbroken runs are.

Null texts stay null and have no entities. Texts without entities are unchanged. Every row is kept, repeated and
null-id rows too; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship

_VOWELS, _CONSONANTS = ("aeiou", "аеёиоуыэюя"), ("bcdfghjklmnpqrstvwxyz", "бвгджзйклмнпрстфхцчшщ")
_ACCENTED = "àáâäåãæçèéêëìíîïñòóôöõøùúûüýÿœß"
#: Letters of other scripts, and ideographs, by the code points of their ranges.
_RANGES = ((0x0430, 0x044F), (0x03B1, 0x03C9), (0x05D0, 0x05EA), (0x0621, 0x063A), (0x0641, 0x064A), (0x0905, 0x0939), (0x3041, 0x3096), (0x30A1, 0x30FA), (0xAC00, 0xD7A3), (0x4E00, 0x9FA5))
#: Given names by gender and script.
GIVEN = (
    ("m", "james john robert michael william david richard joseph thomas charles daniel matthew anthony mark steven paul andrew peter hans klaus jürgen pierre jean luc carlos josé miguel juan".split()),
    ("f", "mary patricia jennifer linda elizabeth barbara susan jessica sarah karen nancy lisa margaret sandra ashley emily anna marie claire sophie ingrid ursula heike maría carmen ana lucía isabel".split()),
    ("m", "иван алексей дмитрий сергей андрей михаил николай павел".split()),
    ("f", "анна мария елена ольга наталья ирина светлана татьяна".split()),
)
_LISTS = {name: names for _, names in GIVEN for name in names}
_TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Mlle|Señor|Señora|Sr|Sra|г-н|г-жа|господин|госпожа|доктор|профессор|السيد|السيدة|الدكتور|الدكتورة|الأستاذ|الأستاذة"
#: Parts of a name that stay as they are.
_PARTICLES = "de|la|las|los|del|della|di|da|dos|du|le|van|von|der|den|ten|zu|bin|ibn|bint|al|el"
#: Chinese family names and what follows a name in place of a title.
_FAMILIES = "王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕"
_HONORIFICS = "先生|女士|小姐|太太|教授|医生"
_LABEL = "[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
_NAME_WORD = r"(?:[A-ZÀ-Þ]['’])?(?:[A-ZÀ-ÞЀ-Я][^\W\d_]{1,40}|[\u0621-\u064A]{2,40})(?![^\W\d_])"
#: Every pattern is bounded, or starts at the beginning of a run alone, so a long unbroken run is read in linear time.
_FINDERS = (
    ("email", rf"(?<![^\W_])[^\W_][\w.+%-]{{0,63}}+@{_LABEL}(?:\.{_LABEL}){{1,8}}"),
    ("secret", r"\b(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|AKIA[0-9A-Z]{16}|sk-[A-Za-z0-9]{20,200}|gh[pousr]_[A-Za-z0-9]{36})\b"),
    ("ip", r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"),
    ("ip6", r"(?<![\w:])(?=[A-Fa-f]{0,3}\d)[0-9A-Fa-f]{3,4}(?:(?::[0-9A-Fa-f]{1,4}){7}|(?::[0-9A-Fa-f]{1,4}){0,5}:(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])|(?<=SSN )\d{9}(?!\d)|(?<=SSN: )\d{9}(?!\d)"),
    ("phone", r"(?<!\d)0\d(?:[ .]\d\d){4}(?![ .]?\d)|(?<![\d.,-])0\d{1,4}[ /-]\d{3,8}(?:[ -]\d{2,4})?(?![ .,-]?\d)|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,5}(?!\d)|\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("card", r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)"),
    ("name", rf"\b(?:{_TITLES})\.? (?:(?:{_PARTICLES})[ -]){{0,3}}{_NAME_WORD}(?:[ -](?:(?:{_PARTICLES})[ -]){{0,3}}{_NAME_WORD})?|[{_FAMILIES}][\u4E00-\u9FA5]{{1,2}}?(?={_HONORIFICS})"),
)
_WORD = re.compile(r"[^\W\d_]+")
FINDER = re.compile("|".join(f"(?P<{k}>{p})" for k, p in _FINDERS))
#: Country codes of two digits; those from 1 and 7 have one, all others three.
_TWO = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_MAYBE = re.compile(rf"[@\d]|\b(?:{_TITLES})\b|{_HONORIFICS}|:[0-9A-Fa-f]")
_TITLE = re.compile(rf"(?:{_TITLES})\.? ")
_KEPT = set(_PARTICLES.split("|"))


def _alphabet(c: str, pronounced: bool) -> tuple[int, int, str | int] | None:
    """A lower-case character's place in its class, the class's size, and its letters or first code point; None if it stands for itself."""
    if "0" <= c <= "9":
        return ord(c) - 48, 10, 48
    if pronounced:
        for letters in (*_VOWELS, *_CONSONANTS):
            if c in letters:
                return letters.index(c), len(letters), letters
        if c in "ьъ":
            return None
    if "a" <= c <= "z":
        return ord(c) - 97, 26, 97
    if c in _ACCENTED:
        return _ACCENTED.index(c), len(_ACCENTED), _ACCENTED
    return next(((ord(c) - a, b - a + 1, a) for a, b in _RANGES if a <= ord(c) <= b), None)


def permute(values: list[int], sizes: list[int], key: bytes, rounds: int = 8) -> list[int]:
    """A keyed permutation of the vectors with values[i] < sizes[i]: halves are added to in turn by a keyed hash of the other."""
    half = len(values) // 2
    if not half:
        half = len(values)
    parts = [(0, half), (half, len(values))]

    def number(a: int, b: int) -> tuple[int, int]:
        n, span = 0, 1
        for v, s in zip(values[a:b], sizes[a:b], strict=True):
            n, span = n * s + v, span * s
        return n, span

    for r in range(rounds):
        a, b = parts[r % 2]
        if a == b:
            continue
        n, span = number(a, b)
        other = repr((r, sizes, number(*parts[1 - r % 2])[0])).encode()
        digest = hashlib.blake2b(other, key=key, digest_size=32).digest()
        n = (n + int.from_bytes(digest, "big")) % span
        for i in range(b - 1, a - 1, -1):
            n, values[i] = divmod(n, sizes[i])
    return values


def disguise(text: str, key: bytes, kind: str, pronounced: bool = False) -> str:
    """text with every classed character permuted; case and all other characters stay."""
    low = [c.lower() if len(c.lower()) == 1 else c for c in text]
    there = [(i, _alphabet(c, pronounced)) for i, c in enumerate(low)]
    there = [(i, x) for i, x in there if x]
    form = "".join("\x00" if _alphabet(c, pronounced) else c for c in low)
    own = hashlib.blake2b(f"{kind}|{form}".encode(), key=key, digest_size=32).digest()
    out = list(text)
    for (i, (_, _, letters)), v in zip(there, permute([x[0] for _, x in there], [x[1] for _, x in there], own), strict=True):
        c = letters[v] if isinstance(letters, str) else chr(letters + v)
        out[i] = c.upper() if text[i] != low[i] and len(c.upper()) == 1 else c
    return "".join(out)


def _refill(text: str, digits: str, skip: int = 0) -> str:
    """text with its digits after the first skip ones replaced in order."""
    new = iter(digits)
    seen = 0
    out = []
    for c in text:
        if c.isdigit():
            seen += 1
            out.append(c if seen <= skip else next(new))
        else:
            out.append(c)
    return "".join(out)


def _walk(x: str, step: Callable[[str], str], alike: Callable[[str], object]) -> str:
    """The next string on x's cycle of which the same holds as of x."""
    want, y = alike(x), step(x)
    while alike(y) != want:
        y = step(y)
    return y


def luhn(digits: str) -> bool:
    return sum(sum(divmod(int(d) * 2, 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def _network(ip: str) -> str:
    a, b, *_ = map(int, ip.split("."))
    if a == 10 or (a, b) == (192, 168) or a == 172 and 16 <= b <= 31:
        return f"private {a}"
    return "reserved" if a in (0, 127) or a >= 224 else "public"


def _ip(text: str, key: bytes) -> str:
    def step(x: str) -> str:
        return ".".join(map(str, permute([int(v) for v in x.split(".")], [256] * 4, key)))

    new = _walk(".".join(str(int(v)) for v in text.split(".")), step, _network)
    return ".".join(n.zfill(len(v)) if v[0] == "0" and len(v) > 1 else n for n, v in zip(new.split("."), text.split("."), strict=True))


def _ip6(text: str, key: bytes) -> str | None:
    """Another address under the same first group, written in full if text is."""
    try:
        plain = ipaddress.IPv6Address(text).exploded
    except ValueError:
        return None
    digits = permute([int(c, 16) for c in plain[5:].replace(":", "")], [16] * 28, key)
    groups = [plain[:4], *("".join(f"{v:x}" for v in digits[i : i + 4]) for i in range(0, 28, 4))]
    new = ipaddress.IPv6Address(":".join(groups))
    new = str(new) if "::" in text else ":".join(f"{int(g, 16):x}" for g in groups)
    return new.upper() if text != text.lower() else new


@functools.lru_cache(100_000)
def _one_name(word: str, key: bytes) -> str:
    """A word of a name: a known given name's next in the key's order of its list, others by their letters."""
    low = word.lower()
    if names := _LISTS.get(low):
        group = next(g for _, g in GIVEN if low in g)
        order = sorted(group, key=lambda x: hashlib.blake2b(f"given|{names[0]}|{x}".encode(), key=key).digest())
        new = order[(order.index(low) + 1) % len(order)]
        return new.upper() if word.isupper() else new if word == low else new.title()
    return _walk(word, lambda x: disguise(x, key, "name", True), lambda x: x.lower() in _LISTS)


def _names(text: str, key: bytes) -> str:
    return _WORD.sub(lambda m: m[0] if m[0] in _KEPT else _one_name(m[0], key), text)


def _national(text: str, digits: str) -> int:
    """How many of a telephone number's first digits stay: its country code and the zero before its area code."""
    kept = 0
    if text.startswith("+"):
        kept = 1 if digits[0] in "17" else 2 if digits[:2] in _TWO else 3
    return kept + (digits[kept : kept + 1] == "0")


def _check_digits(country: str, body: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _iban(text: str, key: bytes) -> str:
    plain = text.replace(" ", "")
    country, own, body = plain[:2], int(plain[2:4]), plain[4:]
    new = disguise(body, key, f"iban {country}")
    check = (_check_digits(country, new) + own - _check_digits(country, body)) % 100  # right ones stay right
    chars = iter(f"{country}{check:02d}{new}")
    return "".join(c if c == " " else next(chars) for c in text)


def _bare(name: str) -> str:
    """A name without its title."""
    m = _TITLE.match(name)
    return name[m.end() :] if m else name


def identity(kind: str, text: str) -> str:
    """What two spellings of one entity have in common, and no two entities."""
    if kind == "ip":
        return ".".join(str(int(v)) for v in text.split("."))
    if kind == "phone":
        return "+" * text.startswith("+") + re.sub(r"\D", "", text)
    if kind == "card":
        return re.sub(r"\D", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    if kind == "email":
        return text.lower()
    if kind == "ip6":
        return ipaddress.IPv6Address(text).exploded
    if kind == "name":
        return " ".join(_WORD.findall(_bare(text).lower()))
    return text


def surrogate(kind: str, text: str, key: bytes) -> str | None:
    """What stands for an entity; None if it isn't one after all."""
    digits = re.sub(r"\D", "", text)
    if kind == "ip":
        return _ip(text, key) if all(int(v) < 256 for v in text.split(".")) else None
    if kind == "card":
        return _refill(text, _walk(digits, lambda x: disguise(x, key, "card"), luhn))
    if kind == "phone":
        lead = _national(text, digits)
        return _refill(text, _walk(digits[lead:], lambda x: disguise(x, key, "phone"), lambda x: x[0] == "0"), lead) if len(digits) - lead >= 6 else None
    if kind == "email":
        local, _, domain = text.partition("@")
        host, _, top = domain.rpartition(".")
        return disguise(f"{local}@{host}", key, "email") + f".{top}.example"
    if kind == "name":
        rest = _bare(text)
        return text[: len(text) - len(rest)] + _names(rest, key)
    if kind == "ip6":
        return _ip6(text, key)
    if kind == "iban":
        return _iban(text, key)
    if kind == "secret" and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text):
        own = hashlib.blake2b(f"hex|{len(text)}".encode(), key=key, digest_size=32).digest()
        return "".join(f"{v:x}" if text == text.lower() else f"{v:X}" for v in permute([int(c, 16) for c in text], [16] * len(text), own))
    return disguise(text, key, kind)


def _mentions(text: str, names: set[str]) -> tuple[set[str], int]:
    """Names in full, those of their words of four letters or more that the text never has in lower case, and how many words they have at most."""
    words = {w for n in names for w in _WORD.findall(n) if len(w) > 3}
    plain = set(_WORD.findall(text)) if words else set()
    every = {n for n in names if len(_WORD.findall(n)) > 1 or not n.isascii()} | {w for w in words if w.lower() not in plain}
    return every, max((len(_WORD.findall(n)) for n in every), default=0)


def _again(text: str, names: set[str], longest: int, swap: Callable[[str], str]) -> str:
    """text with the names in it swapped, longest first, where neither letter nor digit adjoins; each word is looked up, whatever the number of names."""
    words, out, at, i = list(_WORD.finditer(text)), [], 0, 0
    while i < len(words):
        start, step = words[i].start(), 1
        for n in range(min(longest, len(words) - i), 0, -1):
            end = words[i + n - 1].end()
            if end - start <= 200 and text[start:end] in names and not text[max(start - 1, 0) : start].isalnum() and not text[end : end + 1].isalnum():
                out += [text[at:start], swap(text[start:end])]
                at, step = end, n
                break
        i += step
    return "".join(out) + text[at:]


def replace(text: str, key: bytes) -> tuple[str, list[tuple[str, str, str]]]:
    """The text with surrogates, and (kind, original, surrogate) of each place."""
    found: list[tuple[str, str, str]] = []
    if not _MAYBE.search(text):
        return text, found
    places = [(m, new) for m in FINDER.finditer(text) if (new := surrogate(m.lastgroup, m[0], key)) is not None]
    names, longest = _mentions(text, {_bare(m[0]) for m, _ in places if m.lastgroup == "name"})

    def swap(name: str) -> str:
        new = _names(name, key)
        found.append(("name", name, new))
        return new

    out, at = [], 0
    for m, new in places:
        out.append(_again(text[at : m.start()], names, longest, swap) if names else text[at : m.start()])
        found.append((m.lastgroup, m[0], new))
        out.append(new)
        at = m.end()
    out.append(_again(text[at:], names, longest, swap) if names else text[at:])
    return "".join(out), found


def pseudonymise(docs: DataFrame, secret: str, with_entities: bool = False) -> DataFrame:
    """doc_id, text with surrogates, n_entities and kinds of each row; with_entities adds (kind, original, surrogate)."""
    key = checked(docs, secret)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entity = pa.list_(pa.struct([("kind", pa.string()), ("original", pa.string()), ("surrogate", pa.string())]))
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text in batch.column("text").to_pylist():
                new, found = (None, []) if text is None else replace(text, key)
                rows = [dict(zip(("kind", "original", "surrogate"), x, strict=True)) for x in found] if with_entities else None
                for held, v in zip(out, (new, len(found), ",".join(sorted({k for k, _, _ in found})), rows), strict=True):
                    held.append(v)
            yield pa.record_batch([batch.column("doc_id"), pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], entity)], ["doc_id", "text", "n_entities", "kinds", "entities"])

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, text string, n_entities long, kinds string, entities array<struct<kind: string, original: string, surrogate: string>>")
    return found if with_entities else found.drop("entities")


def collisions(docs: DataFrame, secret: str) -> DataFrame:
    """kind, surrogate and how many different originals it stands for, where that is more than one."""
    ship(docs.sparkSession)
    key = hashlib.blake2b(secret.encode(), digest_size=32).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = sorted({(k, identity(k, a), identity(k, b)) for t in batch.column("text").to_pylist() if t for k, a, b in replace(t, key)[1]})
            yield pa.record_batch([pa.array([r[c] for r in rows], pa.string()) for c in range(3)], ["kind", "original", "surrogate"])

    pairs = docs.select("text").mapInArrow(run, "kind string, original string, surrogate string").distinct()
    return pairs.groupBy("kind", "surrogate").agg(F.count("*").alias("originals")).filter("originals > 1")


def checked(docs: DataFrame, secret: str) -> bytes:
    """The key, once no two entities of docs share a surrogate under it."""
    if shared := collisions(docs, secret).limit(5).collect():
        raise ValueError(f"two entities share a surrogate: {shared}")
    return hashlib.blake2b(secret.encode(), digest_size=32).digest()


def replace_in(docs: DataFrame, secret: str) -> DataFrame:
    """docs with surrogates in text, and n_chars, where there is such a column, as it then is."""
    key = checked(docs, secret)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = pa.array([None if t is None else replace(t, key)[0] for t in batch.column("text").to_pylist()], pa.string())
            yield batch.set_column(batch.schema.get_field_index("text"), "text", new)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
