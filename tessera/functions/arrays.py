"""Helpers for array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """body(value), with value computed once a row: it is bound to a lambda's variable."""
    return F.transform(F.array(value), body)[0]


def pieces(text: Column, size: int) -> Column:
    """All substrings of size of an ASCII text, cut from its bytes: each in constant time, however long the text."""

    def cut(b: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.octet_length(b) - size + 1), lambda i: F.substring(b, i, F.lit(size)).cast("string"))

    return F.when(F.length(text) >= size, let(text.cast("binary"), cut))
