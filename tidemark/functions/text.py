"""Small text helpers, all built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def metric_table(key: str | Column) -> Column:
    """The part of a metric key before its first dot."""
    return F.split(_column(key), r"\.", 2)[0]


def metric_name(key: str | Column) -> Column:
    """The part after the first dot; NULL when the key has none."""
    return F.get(F.split(_column(key), r"\.", 2), F.lit(1))


def to_number(value: str | Column) -> Column:
    """Text to double; NULL when it is not a number."""
    return _column(value).try_cast("double")


def parse_list(text: str | Column) -> Column:
    """Split on commas, trim each item, drop blanks."""
    return F.filter(
        F.transform(F.split(_column(text), ","), lambda item: F.trim(item)),
        lambda item: item != "",
    )


def parse_timestamp(text: str | Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to timestamp; NULL when it does not match the pattern."""
    return F.try_to_timestamp(_column(text), F.lit(pattern))


def letter(number: str | Column) -> Column:
    """0 -> A … 25 -> Z, then around again."""
    return F.char(F.lit(65) + F.pmod(_column(number), F.lit(26)))
