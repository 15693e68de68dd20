"""Registered queries: one per SURVEY §2 inventory row (or group of rows).

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver's tables
(through :mod:`recoengine.plans.roles`), paired where possible with DuckDB
SQL over the same tables (:mod:`recoengine.plans.oracle`).  Computed columns
are aliased identically on both sides; doubles are rounded to 6 digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from recoengine.plans.oracle import with_roles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_roles(sql, *uses)
        return fn

    return deco


# Import the query modules for their registrations.
from recoengine.plans import q_clean, q_curation, q_recommend  # noqa: E402,F401
