"""Numeric column expressions (PRJ-9, PRJ-13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_float(col: str | Column, type_name: str = "float") -> Column:
    """PRJ-9: numeric coercion where junk becomes NULL (ANSI-safe ``try_cast``)."""
    return _c(col).try_cast(type_name)


def scale_sentiment(col: str | Column) -> Column:
    """PRJ-13: polarity in [-1, 1] to the star scale [0, 5]; NULL stays NULL."""
    return (_c(col) + F.lit(1.0)) * F.lit(2.5)


def round6(col: str | Column) -> Column:
    """Round doubles for order-insensitive comparisons with other engines.

    ``+ 0.0`` turns a rounded ``-0.0`` (a sum that cancels to a tiny negative
    in one summation order) into ``0.0``.
    """
    return F.round(_c(col).cast("double"), 6) + F.lit(0.0)
