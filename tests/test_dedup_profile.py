from pyspark.sql import functions as F

from recoengine.operators import dedup, profile
from recoengine.operators.ranking import dense_index


def _pre(spark):
    data = [
        ("u1", "b1", 3.0, 100, "x"),
        ("u1", "b1", 5.0, 100, "y"),   # same time, higher rating wins
        ("u1", "b2", 5.0, None, "z"),
        ("u1", "b2", 1.0, 50, "w"),    # a time beats a NULL time
        ("u2", "b1", 2.0, 10, "a"),
        ("u2", "b1", 2.0, 10, "a"),    # fully tied
    ]
    return spark.createDataFrame(data, "user_id string, book_title string, rating float, review_time long, review_text string")


def test_dedup_latest(spark):
    out = dedup.dedup_latest(_pre(spark), tie_breakers=["review_text"])
    got = {(r.user_id, r.book_title): (r.rating, r.review_text) for r in out.collect()}
    assert got == {("u1", "b1"): (5.0, "y"), ("u1", "b2"): (1.0, "w"), ("u2", "b1"): (2.0, "a")}


def test_dedup_properties_partition_independent(spark):
    df = spark.range(2000).select(
        (F.col("id") % 37).cast("string").alias("user_id"),
        (F.col("id") % 11).cast("string").alias("book_title"),
        (F.col("id") % 5 + 1).cast("float").alias("rating"),
        (F.col("id") % 7).alias("review_time"),
        F.col("id").cast("string").alias("review_text"),
    )
    a = dedup.dedup_latest(df.repartition(1), tie_breakers=["review_text"])
    b = dedup.dedup_latest(df.repartition(16), tie_breakers=["review_text"])
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.count() == a.select("user_id", "book_title").distinct().count()
    assert a.join(df, a.columns, "left_anti").count() == 0


def test_thin_sparse_one_pass(spark):
    # u3 has 3 rows but two are on books that fail the item threshold: it ends
    # with 1 row, proving the pass is not repeated to a fixpoint.
    data = [("u1", "b1"), ("u1", "b2"), ("u1", "b3"), ("u2", "b1"), ("u2", "b2"), ("u2", "b3"),
            ("u3", "b1"), ("u3", "b4"), ("u3", "b5"), ("u4", "b1")]
    df = spark.createDataFrame(data, "user_id string, book_title string")
    out = dedup.thin_sparse(df, 3, 3)
    got = sorted(tuple(r) for r in out.select("user_id", "book_title").collect())
    assert ("u3", "b1") in got and ("u4", "b1") not in got
    assert all(b != "b4" for _, b in got)
    counts = out.groupBy("book_title").count().collect()
    assert all(r["count"] >= 3 for r in counts)


def test_dense_index_matches_frequency_order(spark):
    df = spark.createDataFrame([(k, c) for k, c in [("b", 5), ("a", 5), ("c", 9), ("d", 1)]], "k string, c long").repartition(3)
    out = dense_index(df, [F.col("c").desc(), F.col("k").asc()], "idx")
    assert sorted((r.idx, r.k) for r in out.collect()) == [(0, "c"), (1, "a"), (2, "b"), (3, "d")]


def test_profile_aggregates(spark):
    import numpy as np

    vals = [1.0, 2.0, 2.0, 7.0, 10.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    s = profile.numeric_summary(df, F.col("x")).first()
    arr = np.array([v for v in vals if v is not None])
    assert s["count"] == 5
    assert s.q25 == np.percentile(arr, 25) and s.q50 == np.percentile(arr, 50) and s.q75 == np.percentile(arr, 75)
    cov = {r.column: (r.non_null, r.total) for r in profile.coverage(df, ["x"]).collect()}
    assert cov == {"x": (5, 6)}
    st = profile.dataset_stats(spark.createDataFrame([], "user_id string, book_title string")).first()
    assert st.n_rows == 0 and st.sparsity_pct == 100.0


def test_funnel(spark):
    df = spark.range(10)
    f = profile.funnel([("in", df), ("even", df.filter("id % 2 = 0")), ("small", df.filter("id % 2 = 0 and id < 4"))])
    assert [(r.step, r.rows_in, r.rows_out, r.removed) for r in f.orderBy("seq").collect()] == [
        ("even", 10, 5, 5),
        ("small", 5, 2, 3),
    ]


def test_row_funnel_one_pass(spark):
    df = spark.range(10).withColumn("v", F.when(F.col("id") == 3, None).otherwise(F.col("id")))
    counts = profile.row_funnel(df, [("not_null", F.col("v").isNotNull()), ("even", F.col("v") % 2 == 0)])
    out = profile.funnel_from_counts(counts).orderBy("seq").collect()
    assert [(r.step, r.rows_in, r.rows_out, r.removed) for r in out] == [("not_null", 10, 9, 1), ("even", 9, 5, 4)]


def test_distributed_quantiles_equal_exact(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    vals = [float(v) for v in rng.normal(size=997)] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(5)
    a = profile.numeric_summary(df, F.col("x")).first()
    b = profile.numeric_summary(df, F.col("x"), method="distributed").first()
    assert a == b
    arr = np.array([v for v in vals if v is not None])
    assert abs(b.q50 - round(float(np.percentile(arr, 50)), 6)) < 1e-9


def test_distributed_quantiles_with_a_hot_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id").cast("double")).alias("x"))
    a = profile.numeric_summary(df, F.col("x")).first()
    b = profile.numeric_summary(df, F.col("x"), method="distributed").first()
    assert a == b


def test_dedup_thinned_runs_the_dedup_once(spark):
    import datetime as dt

    rows = [(u, b, float(1 + (i + j) % 5), dt.datetime(2020, 1, 1 + j), i) for i, (u, b) in enumerate((u, b) for u in ("u1", "u2", "u3", "u4", None) for b in ("a", "b", "c", None)) for j in range(2)]
    rows += [("u5", "a", 3.0, dt.datetime(2020, 1, 1), 99), ("u6", None, 3.0, dt.datetime(2020, 1, 1), 100), ("u6", "a", 3.0, dt.datetime(2020, 1, 1), 101), ("u6", "b", 3.0, dt.datetime(2020, 1, 1), 102)]
    df = spark.createDataFrame(rows, "user_id string, book_title string, rating double, review_time timestamp, n int")
    got = dedup.dedup_thinned(df, ["user_id", "book_title", "n", "rating"], 3, 5, tie_breakers=["n"])
    plain = dedup.thin_sparse(dedup.dedup_latest(df, tie_breakers=["n"]), 3, 5).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    assert got.filter("book_title = 'a'").count() == 5 and got.filter("book_title = 'c'").count() == 0
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
