"""Schema handling and column rewrites (PRJ-1..5, PRJ-9..12, PRJ-15).

All rewrites are narrow projections: Catalyst collapses them into the scan's
projection, so none adds a stage.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine.functions.constants import (
    AUTHOR_JUNK_PATTERN,
    BRACKET_CHARS_PATTERN,
    CATEGORY_JUNK_PATTERN,
    SENTINELS,
)
from recoengine.functions.numeric import to_float
from recoengine.operators.texts import is_one_of


class MissingColumnsError(ValueError):
    """Raised when a stage is given a frame without its required columns."""


# Column aliases seen in review dumps, mapped to canonical names.
# Column names of the raw dumps and what they are called here.
REVIEW_ALIASES = {
    "User_id": "user_id",
    "user": "user_id",
    "Title": "book_title",
    "title": "book_title",
    "review/score": "rating",
    "review_score": "rating",
    "review/text": "review_text",
    "review/summary": "review_summary",
    "review/time": "review_time",
    "review/helpfulness": "review_helpfulness",
    "profileName": "profile_name",
}
BOOK_ALIASES = {
    "Title": "book_title",
    "Descripe": "description",
    "Description": "description",
}


def normalize_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """PRJ-1: rename aliases to canonical names, matching names case-insensitively.

    Two source columns that land on one target raise instead of silently
    shadowing each other.
    """
    lowered = {k.lower(): v for k, v in mapping.items()}
    final = {name: lowered.get(name.lower(), name) for name in df.columns}
    seen: dict[str, str] = {}
    for name, new in final.items():
        key = new.lower()  # Spark resolves names case-insensitively
        if key in seen:
            raise ValueError(f"columns {seen[key]!r} and {name!r} both map to {new!r}")
        seen[key] = name
    renames = {name: new for name, new in final.items() if new != name}
    return df.withColumnsRenamed(renames) if renames else df


def require_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """PRJ-2: fail early, on the driver, if required columns are missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing columns {missing}; have {df.columns}")
    return df


def choose_label(df: DataFrame, out: str = "label_rating") -> DataFrame:
    """PRJ-3: the label is ``final_rating`` if present, else ``rating``
    (a frame that already has ``out`` is returned as it is)."""
    if out in df.columns:
        return df
    for name in ("final_rating", "rating"):
        if name in df.columns:
            return df.withColumnRenamed(name, out)
    raise MissingColumnsError("neither 'final_rating' nor 'rating' present")


def select_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PRJ-4: project the wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in cols if c in df.columns])


def null_sentinels(df: DataFrame, cols: Sequence[str], sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """PRJ-5: exact, case-sensitive, untrimmed sentinel strings become NULL."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns(
        {c: F.when(is_one_of(df, c, sentinels), F.lit(None)).otherwise(F.col(c)) for c in present}
    )


def coerce_float(df: DataFrame, col: str, type_name: str = "float") -> DataFrame:
    """PRJ-9 on a frame: junk strings become NULL instead of raising under ANSI."""
    return df.withColumn(col, to_float(col, type_name))


def scrub_metadata(df: DataFrame, col: str, max_len: int, pattern: str) -> DataFrame:
    """PRJ-10/11: keep a value (trimmed) only if shorter than ``max_len`` and not
    matching the junk ``pattern``; otherwise NULL."""
    if col not in df.columns:
        return df
    c = F.col(col)
    keep = c.isNotNull() & (F.length(c) < max_len) & ~c.rlike(pattern)
    return df.withColumn(col, F.when(keep, F.trim(c)))


def scrub_authors(df: DataFrame, col: str = "authors") -> DataFrame:
    """PRJ-10 with its defaults (length < 150, review-like words)."""
    return scrub_metadata(df, col, 150, AUTHOR_JUNK_PATTERN)


def scrub_categories(df: DataFrame, col: str = "categories") -> DataFrame:
    """PRJ-11 with its defaults (length < 100, shorter word list)."""
    return scrub_metadata(df, col, 100, CATEGORY_JUNK_PATTERN)


def unbracket(df: DataFrame, col: str, max_len: int, out: str | None = None) -> DataFrame:
    """PRJ-12: strip ``[ ] ' "``, then NULL if blank or longer than ``max_len``
    (length of the *untrimmed* stripped value), else trim."""
    if col not in df.columns:
        return df
    stripped = F.regexp_replace(F.col(col), BRACKET_CHARS_PATTERN, "")
    value = F.when((F.length(F.trim(stripped)) == 0) | (F.length(stripped) > max_len), F.lit(None)).otherwise(
        F.trim(stripped)
    )
    df = df.withColumn(col, value)
    if out and out != col:
        df = df.withColumnRenamed(col, out)
    return df


def description_or_title(df: DataFrame, desc: str = "description", title: str = "book_title", min_len: int = 20) -> DataFrame:
    """PRJ-15: NULL or shorter-than-``min_len`` descriptions fall back to the title."""
    d = F.col(desc)
    return df.withColumn(desc, F.when(d.isNull() | (F.length(d) < min_len), F.col(title)).otherwise(d))
