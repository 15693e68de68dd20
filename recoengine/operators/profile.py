"""Profiling and metrics (AGG-1..11).

Every metric is one aggregate pass instead of a chain of ``count()`` actions.
Distinct counts share one ``Expand``; percentiles are exact by default
(Spark's ``percentile`` keeps a value -> frequency map, so its memory is
bounded by the number of *distinct* values, e.g. text lengths or per-user
counts) and approximate with ``approx=True`` for high-cardinality doubles.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType

from recoengine.functions.numeric import round6
from recoengine.session import literal_rows


def dataset_stats(df: DataFrame, user_col: str = "user_id", item_col: str = "book_title") -> DataFrame:
    """AGG-1 + AGG-2: rows, distinct users, distinct items and sparsity %.

    Sparsity divides by ``max(1, users * items)`` (G10).
    """
    stats = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(user_col).alias("n_users"),
        F.countDistinct(item_col).alias("n_items"),
    )
    denom = F.greatest(F.lit(1.0), F.col("n_users").cast("double") * F.col("n_items").cast("double"))
    return stats.select(
        "n_rows",
        "n_users",
        "n_items",
        round6((F.lit(1.0) - F.col("n_rows") / denom) * F.lit(100.0)).alias("sparsity_pct"),
    )


def rating_histogram(df: DataFrame, col: str = "rating") -> DataFrame:
    """AGG-3: rows per rating value, ordered by value (NULLs first)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col(col).asc_nulls_first())


def coverage(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-4: non-NULL count and percentage per column, in one pass.

    Output: one row per column ``(column, non_null, total, pct)``.
    """
    aggs = [F.count(F.lit(1)).alias("_total")] + [F.count(F.col(c)).alias(f"_nn_{i}") for i, c in enumerate(cols)]
    row = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', _nn_{i}" for i, c in enumerate(cols))
    out = row.selectExpr("_total", f"stack({len(cols)}, {pairs}) as (`column`, non_null)")
    return out.select(
        "column",
        F.col("non_null").cast("long").alias("non_null"),
        F.col("_total").cast("long").alias("total"),
        round6(F.when(F.col("_total") > 0, F.col("non_null") * 100.0 / F.col("_total"))).alias("pct"),
    )


def numeric_summary(df: DataFrame, expr: Column, approx: bool = False, accuracy: int = 10000, method: str | None = None) -> DataFrame:
    """AGG-5/6: count, mean, sample stddev, min, quartiles, max of ``expr``.

    Quartiles interpolate linearly (SQL ``percentile_cont``).  ``method``:

    * ``"exact"`` (default for integers): Spark's ``percentile``, whose buffer is a
      value -> count map, i.e. bounded by the number of *distinct* values
      (right for lengths, counts, star ratings);
    * ``"distributed"`` (default for floats, whose distinct values have no
      bound): exact for high-cardinality doubles too: values are
      ranked by a distributed range sort (per-partition offsets, see
      :func:`recoengine.operators.ranking.dense_index`) and only the rows at
      the interpolation positions are read back;
    * ``"approx"`` (or ``approx=True``): ``percentile_approx``.
    """
    if method is None:
        fractional = isinstance(df.select(expr).schema[0].dataType, (FractionalType, DecimalType))
        method = "approx" if approx else "distributed" if fractional else "exact"
    x = expr.cast("double")
    moments = [
        F.count(x).alias("count"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("stddev"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    ]
    if method == "distributed":
        from recoengine.operators.ranking import dense_index

        vals = df.select(x.alias("v")).filter(F.col("v").isNotNull())
        # A salt after the value spreads a hot value (a third of all rows
        # equal) over several range partitions; equal values are
        # interchangeable, so the quartiles do not depend on it.
        salt = F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id())
        ranked = dense_index(vals.withColumn("_salt", salt), [F.col("v").asc(), F.col("_salt").asc()], "pos")
        n = vals.select(F.count(F.lit(1))).scalar()
        picks = []
        for q in (0.25, 0.5, 0.75):
            h = (n - F.lit(1)) * F.lit(q)
            lo, hi = F.floor(h), F.ceil(h)
            v_lo = F.max(F.when(F.col("pos") == lo, F.col("v")))
            v_hi = F.max(F.when(F.col("pos") == hi, F.col("v")))
            picks.append(v_lo + (h - lo) * (v_hi - v_lo))
        quartiles = ranked.agg(F.array(*picks).alias("q")).scalar()
        row = df.agg(*moments).withColumn("_q", quartiles)
    else:
        if method == "approx":
            q = F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy)
        elif method == "exact":
            q = F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
        else:
            raise ValueError(f"unknown method {method!r}")
        row = df.agg(*moments, q.alias("_q"))
    return row.select(
        F.col("count").cast("long").alias("count"),
        round6("mean").alias("mean"),
        round6("stddev").alias("stddev"),
        round6("min").alias("min"),
        round6(F.col("_q")[0]).alias("q25"),
        round6(F.col("_q")[1]).alias("q50"),
        round6(F.col("_q")[2]).alias("q75"),
        round6("max").alias("max"),
    )


def group_size_summary(df: DataFrame, key: str, approx: bool = False) -> DataFrame:
    """AGG-6: summary of rows-per-key (per user, per book)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return numeric_summary(counts, F.col("_n"), approx=approx)


def funnel(steps: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """AGG-7: rows before and after each cleaning step.

    ``steps`` is ``[(name, frame_after_step), ...]`` with the input first under
    any name.  Each count is an aggregate branch of one union plan, so the
    whole funnel is a single job; Spark reuses shared exchanges between
    branches.
    """
    if len(steps) < 2:
        raise ValueError("funnel needs the input and at least one step")
    counts = [
        frame.agg(F.count(F.lit(1)).cast("long").alias("rows")).select(
            F.lit(i).cast("int").alias("seq"), F.lit(name).alias("step"), "rows"
        )
        for i, (name, frame) in enumerate(steps)
    ]
    allc = counts[0]
    for c in counts[1:]:
        allc = allc.unionByName(c)
    prev = allc.select((F.col("seq") + 1).alias("seq"), F.col("rows").alias("rows_in"))
    return (
        allc.filter(F.col("seq") > 0)
        .join(prev, "seq")
        .select(
            "seq",
            "step",
            "rows_in",
            F.col("rows").alias("rows_out"),
            (F.col("rows_in") - F.col("rows")).alias("removed"),
        )
    )


def row_funnel(df: DataFrame, steps: Sequence[tuple[str, Column]], input_name: str = "input") -> DataFrame:
    """AGG-7 for row-wise steps in ONE pass: ``steps`` are ``(name,
    keep_predicate)`` applied cumulatively; each count is a conditional sum of
    the running conjunction.  Returns ``(seq, step, rows)`` with the input as
    seq 0, ready for :func:`funnel_from_counts`."""
    cond = F.lit(True)
    aggs = [F.count(F.lit(1)).alias("_c0")]
    for i, (_, pred) in enumerate(steps, start=1):
        cond = cond & F.coalesce(pred, F.lit(False))
        aggs.append(F.sum(F.when(cond, 1).otherwise(0)).alias(f"_c{i}"))
    row = df.agg(*aggs)
    names = [input_name] + [n for n, _ in steps]
    pairs = ", ".join(f"{i}, '{n}', CAST(coalesce(_c{i}, 0) AS BIGINT)" for i, n in enumerate(names))
    return row.selectExpr(f"stack({len(names)}, {pairs}) as (seq, step, rows)").select(
        F.col("seq").cast("int").alias("seq"), "step", "rows"
    )


def step_count(df: DataFrame, seq: int, name: str) -> DataFrame:
    """One ``(seq, step, rows)`` row for a step that is not row-wise (dedup, thinning)."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("rows")).select(
        F.lit(seq).cast("int").alias("seq"), F.lit(name).alias("step"), "rows"
    )


def funnel_from_counts(counts: DataFrame) -> DataFrame:
    """``(seq, step, rows)`` to ``(seq, step, rows_in, rows_out, removed)``."""
    prev = counts.select((F.col("seq") + 1).alias("seq"), F.col("rows").alias("rows_in"))
    return (
        counts.filter(F.col("seq") > 0)
        .join(prev, "seq")
        .select("seq", "step", "rows_in", F.col("rows").alias("rows_out"), (F.col("rows_in") - F.col("rows")).alias("removed"))
    )


class StepCounts:
    """AGG-7 on the way: rows after each step, counted while the frame is written.

    ``after`` puts an :class:`~pyspark.sql.Observation` behind a step; the action
    that writes the frame fills all of them, so nothing is evaluated a second time, and
    ``funnel`` gives the table of :func:`funnel` afterwards.  Only one number a
    step reaches the driver.  Observe frames whose rows are all read, that is before a shuffle,
    an aggregate or the write itself.  Where the optimiser finds a part of the plan to be
    empty and leaves it out, the counts in it are missing and those steps are
    counted by a query each.  A map task repeated after a lost executor
    counts its rows again; where that matters, use
    :func:`recoengine.plans.stages.stage_funnel`, a query of its own.
    """

    def __init__(self) -> None:
        self.steps: list[tuple[str, Observation, DataFrame]] = []

    def after(self, df: DataFrame, name: str) -> DataFrame:
        seen = Observation()
        self.steps.append((name, seen, df))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def funnel(self, spark: SparkSession) -> DataFrame:
        """Waits for the action on the observed frame."""
        rows = [(i, name, self._rows(seen, df)) for i, (name, seen, df) in enumerate(self.steps)]
        counts = literal_rows(spark, rows, ["seq", "step", "rows"])
        return funnel_from_counts(counts.select(F.col("seq").cast("int").alias("seq"), "step", F.col("rows").cast("long").alias("rows")))


    @staticmethod
    def _rows(seen: Observation, df: DataFrame) -> int:
        try:
            return int(seen.get["rows"])
        except (KeyError, Py4JJavaError):  # left out of the plan that ran
            return df.count()


def nulled_counts(before: DataFrame, after: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-7 companion: how many values a row-wise scrub turned into NULL.

    The scrub is row-wise, so both frames hold the same rows: the answer is
    the difference of non-NULL counts, one aggregate pass over each.
    """
    b = before.agg(*[F.count(F.col(c)).alias(c) for c in cols])
    a = after.agg(*[F.count(F.col(c)).alias(c) for c in cols])
    pairs_b = ", ".join(f"'{c}', `{c}`" for c in cols)
    sb = b.selectExpr(f"stack({len(cols)}, {pairs_b}) as (`column`, nn_before)")
    sa = a.selectExpr(f"stack({len(cols)}, {pairs_b}) as (`column`, nn_after)")
    return sb.join(sa, "column").select(
        "column", (F.col("nn_before") - F.col("nn_after")).cast("long").alias("nulled")
    )


def popularity(df: DataFrame, item_col: str = "book_title", rating_col: str = "rating") -> DataFrame:
    """AGG-8: review count and mean rating per item (partial aggregation)."""
    return df.groupBy(item_col).agg(
        F.count(F.lit(1)).alias("review_count"), F.avg(F.col(rating_col).cast("double")).alias("avg_rating")
    )


def user_activity(df: DataFrame, user_col: str = "user_id", label_col: str = "label_rating") -> DataFrame:
    """AGG-9: interactions and mean label per user."""
    return df.groupBy(user_col).agg(
        F.count(F.lit(1)).alias("cnt"), F.avg(F.col(label_col).cast("double")).alias("avg_r")
    )


def distinct_values(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """AGG-11: the first ``n`` distinct non-NULL values in sorted order.

    The limit is the feature (a sample report); ``distinct`` is a partial
    aggregate and the ordered limit a ``TakeOrderedAndProject``.
    """
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col).limit(n)
