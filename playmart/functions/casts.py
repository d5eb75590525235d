"""Typed views of staged text. Bad text becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the pattern that decides whether a coordinate counts as recorded.
NUMERIC_PATTERN = r"^(([-+]?[0-9]+(\.[0-9]+)?)|([-+]?\.[0-9]+))$"


def to_int(c: str | Column) -> Column:
    return _col(c).try_cast("int")


def to_long(c: str | Column) -> Column:
    return _col(c).try_cast("bigint")


def to_decimal(c: str | Column, precision: int, scale: int) -> Column:
    """Blank text is kept from the decimal parser, which is slow at refusing it."""
    filled = F.when(F.trim(_col(c)) != "", _col(c))
    return filled.try_cast(f"decimal({precision},{scale})")


def numeric_score(c: str | Column) -> Column:
    """1 when the text looks like a plain number, else 0 (NULL scores 0)."""
    return F.when(_col(c).rlike(NUMERIC_PATTERN), 1).otherwise(0)


def text_score(c: str | Column) -> Column:
    """1 when the text is neither NULL nor blank, else 0."""
    return F.when(F.trim(_col(c)) != "", 1).otherwise(0)


def present_score(c: str | Column) -> Column:
    """1 when the value is not NULL, else 0."""
    return _col(c).isNotNull().cast("int")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
