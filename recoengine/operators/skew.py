"""Hot keys: join a big frame to one row per key when a key may hold a large
share of the rows.

AQE splits a skewed partition only when both inputs of a sort-merge join are
plain shuffles made for that join.  The right side here is an aggregate or a
window on the same key, whose partitioning Spark would reuse, and a key that
holds a third of all rows would land in one task.  Joining on a wrapped key
(a struct of the key columns) makes Spark shuffle both sides for the join, so
AQE can split the big side's hot partitions (also those of rows whose key is
NULL); the right side, one thin row per key, is shuffled once more.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_join(big: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``big.join(right, keys, how)`` that AQE can split on hot keys; ``how``
    is ``left_semi``, ``left_anti``, ``left`` or ``inner``."""
    keys = list(keys)
    present = functools.reduce(operator.and_, [F.col(k).isNotNull() for k in keys])
    wrapped = F.when(present, F.struct(*[F.col(k) for k in keys]))
    r = right.select(wrapped.alias("__split_key"), *[c for c in right.columns if c not in keys])
    if how not in ("inner", "left_semi"):
        return big.withColumn("__split_key", wrapped).join(r, "__split_key", how).drop("__split_key")
    # rows without a key are dropped here, so the key columns travel in the struct alone
    joined = big.select(wrapped.alias("__split_key"), *[f"`{c}`" for c in big.columns if c not in keys]).join(r, "__split_key", how)
    kept = [F.col("__split_key")[c].alias(c) if c in keys else F.col(f"`{c}`") for c in big.columns]
    return joined.select(*kept, *[f"`{c}`" for c in r.columns if how == "inner" and c != "__split_key"])
