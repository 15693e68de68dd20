"""Deduplication and thinning (WIN-1, SET-2, THN-1, JOI-2, AGG-10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoengine.operators.profile import StepCounts
from recoengine.operators.ranking import first_per_key
from recoengine.operators.skew import split_join
from recoengine.sources.io import stored


def latest_order(df: DataFrame, time_col: str = "review_time", rating_col: str = "rating", tie_breakers: Sequence[str] = ()) -> list[Column]:
    """WIN-1's order: latest time first (if the column exists), then highest
    rating, then the caller's tie-breakers ascending (G5: total order)."""
    order: list[Column] = []
    if time_col in df.columns:
        order.append(F.col(time_col).desc_nulls_last())
    order.append(F.col(rating_col).desc_nulls_last())
    order.extend(F.col(c).asc_nulls_last() for c in tie_breakers)
    return order


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str] = ("user_id", "book_title"),
    order: Sequence[Column] | None = None,
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """WIN-1: one row per (user, book): latest review, then highest rating.

    ``row_number() == 1`` plans as a partial ``WindowGroupLimit`` before the
    exchange, so a (user, book) pair repeated a million times costs one row per
    map task in the shuffle.
    """
    if order is None:
        order = latest_order(df, tie_breakers=tie_breakers)
    return first_per_key(df, list(keys), list(order))


def dedup_thinned(
    df: DataFrame,
    columns: Sequence[str],
    min_user: int = 3,
    min_item: int = 3,
    keys: Sequence[str] = ("user_id", "book_title"),
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """WIN-1, then THN-1, and of the rows ``columns`` (with the keys).

    Both counts and the filters read the deduplicated rows, and differently
    pruned branches of a plan share no shuffle; so WIN-1 (an action) runs once
    and stores its rows, with nothing but the columns asked for.
    """
    keys = list(keys)
    rows = dedup_latest(df, keys, tie_breakers=tie_breakers).select(*keys, *[c for c in columns if c not in keys])
    return thin_sparse(stored(rows, "deduped"), min_user, min_item, *keys).select(*columns)


def thin_sparse(
    df: DataFrame,
    min_user: int = 3,
    min_item: int = 3,
    user_col: str = "user_id",
    item_col: str = "book_title",
    counts: StepCounts | None = None,
) -> DataFrame:
    """THN-1: users with at least ``min_user`` rows, then items with at least
    ``min_item`` rows counted *after* the user filter.  One pass, not a
    fixpoint, so a user may end below ``min_user``.

    Counts are partial (map-side) aggregates over the two id columns, and the
    filters are semi-joins that AQE can split on a user or item holding a
    large share of the rows (:func:`recoengine.operators.skew.split_join`).
    Full rows are joined once per filter and never counted or persisted.
    ``counts`` takes the number of rows after the user filter on the way.
    """
    by_user = thinned_users(df.select(user_col, item_col), min_user, user_col)
    if counts:
        by_user = counts.after(by_user, "thin_users")
    items = by_user.groupBy(item_col).count().filter(F.col("count") >= min_item).select(item_col)
    return split_join(thinned_users(df, min_user, user_col), items, [item_col], "left_semi")


def thinned_users(df: DataFrame, min_user: int, user_col: str = "user_id") -> DataFrame:
    """The first half of THN-1: rows of users with at least ``min_user`` rows."""
    users = df.groupBy(user_col).count().filter(F.col("count") >= min_user).select(user_col)
    return split_join(df, users, [user_col], "left_semi")
