"""Words of a text as DataFrame expressions, shared by the operators that use no Python on their main path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = "\t\n\x0b\x0c\r"
#: ASCII that belongs to no word of letters and digits, once A-Z is lower-cased.
BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def plain_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WHITE, " " * len(WHITE))
    return F.array_remove(F.split(spaced, " "), "")


def letter_words(text: Column) -> Column:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased; null has none."""
    flat = F.translate(F.coalesce(text, F.lit("")), UPPER + BETWEEN, LOWER + " " * len(BETWEEN))
    return F.array_remove(F.split(flat, " "), "")


def bit_table(bits: dict[int, int], size: int) -> Column:
    """A table of size bits as one constant array of longs: bits holds, for each used long, its value."""
    return F.split(F.lit(",".join(str(bits.get(i, 0)) for i in range(size // 64))), ",").cast("array<bigint>")


def bucket(h: Column, size: int) -> Column:
    return F.pmod(h, F.lit(size)).cast("int")


def in_table(table: Column, h: Column, size: int) -> Column:
    """Whether the bit that the hash h falls on is set."""
    at = bucket(h, size)
    return F.getbit(F.get(table, F.shiftright(at, 6)), at.bitwiseAND(F.lit(63))) == 1
