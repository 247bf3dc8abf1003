"""Symbol text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_symbol(col) -> Column:
    """Trimmed, upper-case symbol."""
    return F.upper(F.trim(_c(col)))


def dot_to_dash(col) -> Column:
    return F.replace(_c(col), F.lit("."), F.lit("-"))


def dash_to_dot(col) -> Column:
    return F.replace(_c(col), F.lit("-"), F.lit("."))


def symbol_forms(col) -> Column:
    """[raw, '.'->'-', '-'->'.'] in the reference's order of preference."""
    s = clean_symbol(col)
    return F.array(s, dot_to_dash(s), dash_to_dot(s))


def empty_to_null(col) -> Column:
    """'' or blanks to null, other text trimmed (F16)."""
    return F.nullif(F.trim(_c(col)), F.lit(""))


def not_blank(col) -> Column:
    """True for a symbol with visible characters."""
    return F.coalesce(F.trim(_c(col)) != F.lit(""), F.lit(False))
