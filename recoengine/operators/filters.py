"""Row filters (FLT-1..4).  Plain predicates, so Catalyst pushes the ones on
stored columns into the Parquet scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine.operators.texts import text_length


def valid_ratings(df: DataFrame, col: str = "rating", lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """FLT-1: rating present and in [lo, hi].  NaN fails ``<= hi`` and is dropped."""
    c = F.col(col)
    return df.filter(c.isNotNull() & (c >= lo) & (c <= hi))


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT-2: drop rows with a NULL in any essential column."""
    return df.na.drop(subset=[c for c in cols])


def min_text_length(df: DataFrame, col: str = "review_text", n: int = 10) -> DataFrame:
    """FLT-3: keep texts of at least ``n`` characters."""
    return df.filter(text_length(df, col) >= n)


def find_title(df: DataFrame, title: str, col: str = "book_title", negate: bool = False) -> DataFrame:
    """FLT-4: case-insensitive exact title lookup (or its complement)."""
    cond = F.lower(F.col(col)) == F.lower(F.lit(title))
    return df.filter(~cond if negate else cond)
