"""Scalar rules: text to number, rounding, windows of days, hashes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, functions as F

OTHER_LETTERS = "[A-DF-Za-df-z]"


def to_number(text: Column) -> Column:
    """Decimal text, blanks around it allowed, as double; anything else is NULL.

    Whole numbers, nearly all of them, take the short way. A cast to double also reads
    words and suffixes (``NaN``, ``1d``), which are no numbers here.
    """
    whole = text.try_cast("long").cast("double")
    return F.coalesce(whole, F.when(~text.rlike(OTHER_LETTERS), text.try_cast("double")))


def without_first(text: Column, mark: str) -> Column:
    """``text`` without the first ``mark`` (one character)."""
    return F.when(text.contains(mark), F.overlay(text, F.lit(""), F.locate(mark, text), F.lit(1))).otherwise(text)


def half_even(value: Column) -> Column:
    """Nearest whole number, ties to the even one."""
    return F.rint(value)


def half_up(value: Column, digits: int = 0) -> Column:
    """Rounded to ``digits``, ties away from zero."""
    return F.round(value, digits)


def within(day: Column, as_of: date, first: int, last: int) -> Column:
    """Days from ``as_of - first`` to ``as_of - last``, both included.

    Written on the bare column, so that a scan can prune on it; a time of day on the
    last day is still inside.
    """
    start, end = as_of - timedelta(days=first), as_of - timedelta(days=last - 1)
    return (day >= F.lit(start)) & (day < F.lit(end))


def key_hash(seed: int | str, key: Sequence[str]) -> Column:
    """Hex md5 of seed and key columns: a repeatable random order of the rows."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def hash_number(hashed: Column, digits: int) -> Column:
    """The first ``digits`` hex digits as a number; it sorts like the hash."""
    return F.conv(F.substring(hashed, 1, digits), 16, 10).cast("long")
