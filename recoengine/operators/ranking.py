"""Ordering helpers shared by several operators: top-k per group and dense
global indexes.

``top_n_per_group`` filters ``row_number() <= n``; Catalyst inserts a partial
``WindowGroupLimit`` before the shuffle, so a hot group sends at most ``n``
rows per map task across the network.

``dense_index`` replaces ``StringIndexer`` (which collects every label on the
driver) by a distributed, range-partitioned sort plus per-partition offsets:
only one row per partition reaches the driver-side planner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recoengine.session import ensure_checkpoint_dir


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows of every group under a total ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    tmp = rank_col or "_rn"
    out = df.withColumn(tmp, F.row_number().over(w)).filter(F.col(tmp) <= n)
    if rank_col:
        return out.withColumn(rank_col, F.col(rank_col).cast("long"))
    return out.drop(tmp)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """SET-2: one row per key, the first under a stated total ``order``."""
    return top_n_per_group(df, keys, order, 1)


def dense_index(df: DataFrame, order: Sequence[Column], out: str = "idx") -> DataFrame:
    """Attach a dense 0-based position of every row under a total ``order``.

    Plan: range-partitioned sort (distributed), then ``spark_partition_id`` and
    ``monotonically_increasing_id`` tag each row; the tagged frame is
    checkpointed to the cluster's shared ``spark.checkpoint.dir`` so partition
    boundaries stay fixed if executors are lost; the per-partition row counts
    (one row per partition: a proven bound) are turned into offsets and
    broadcast back.  Nothing proportional to the data passes the driver.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    tagged = (
        df.orderBy(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    offsets = sizes.withColumn(
        "_off", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    ).select("_pid", F.coalesce(F.col("_off"), F.lit(0)).alias("_off"), "_m0")
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_m0")).cast("long"))
        .drop("_pid", "_mid", "_off", "_m0")
    )
