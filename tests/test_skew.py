"""A key holding a third of all rows: AQE splits it and results do not change."""

import contextlib

import pytest
from pyspark.sql import functions as F

from recoengine.operators import cf, content, dedup, merge
from recoengine.operators.sentiment import score_sentiment
from recoengine.operators.skew import split_join

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
N = 30000


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def joined_evenly(df, times=2.0):
    """Rows per task after the last join: the largest below ``times`` the mean
    of a hash partition.  The payload is read, so that rows have their weight
    (AQE goes by the bytes of a partition)."""
    counts = [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max("payload")).collect()]
    assert sum(counts) == N, counts
    return max(counts) < times * N / 8, counts


def hot(col, *others):
    """A third of the rows with one value, the others spread."""
    return F.when(F.col("id") % 3 == 0, F.lit(col)).otherwise(F.concat(F.lit(others[0] if others else "k"), (F.col("id") % 997).cast("string")))


@pytest.fixture
def rows(spark):
    # read in many map tasks, which is what a skewed partition is split by
    return spark.range(0, N, 1, 16).withColumn("payload", F.md5(F.col("id").cast("string")))


def test_split_join_keeps_plain_semantics(spark, rows):
    big = rows.withColumn("key", F.when(F.col("id") % 5 != 0, hot("hot")))
    right = big.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 25")
    for how in ("left", "inner", "left_semi", "left_anti"):
        with conf(spark, SKEW_CONF):
            got = sorted(map(repr, split_join(big, right, ["key"], how).collect()))
        plain = sorted(map(repr, big.join(right, "key", how).select("id", "payload", "key", *(["n"] if "semi" not in how and "anti" not in how else [])).collect()))
        assert got == plain, how


def test_hot_title_and_missing_titles_in_the_merge(spark, rows):
    reviews = rows.withColumn("book_title", F.when(F.col("id") % 3 == 1, F.lit("!!")).otherwise(hot("Hot Title")))
    books = spark.createDataFrame([("hot title", "d"), ("HOT title", "longer"), ("k1", "x")], "book_title string, description string")
    with conf(spark, SKEW_CONF):
        out = merge.merge_reviews(reviews, books)
        even, counts = joined_evenly(out)
        assert even, counts
        assert out.filter("description = 'longer'").count() == N // 3


def test_hot_user_in_thinning(spark, rows):
    df = rows.select(hot("hot").alias("user_id"), (F.col("id") % 50).cast("string").alias("book_title"), "payload")
    with conf(spark, SKEW_CONF):
        even, counts = joined_evenly(dedup.thinned_users(df, 3))
        assert even, counts
        got = dedup.thin_sparse(df, 3, 3).groupBy("user_id").count().collect()
    plain = dedup.thin_sparse(df, 3, 3).groupBy("user_id").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain))


@pytest.mark.parametrize("text", ["good good", "nothing here", "", None])
def test_hot_text_in_sentiment(spark, rows, text):
    lexicon = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "token string, valence double")
    df = rows.select("id", "payload", F.when(F.col("id") % 3 != 0, F.concat(F.lit("bad "), F.col("id").cast("string"))).otherwise(F.lit(text)).alias("review_text"))
    with conf(spark, SKEW_CONF):
        scored = score_sentiment(df, lexicon, keys=None)
        even, counts = joined_evenly(scored)
        assert even, counts
        got = sorted((r.id, r.sentiment_score) for r in scored.collect())
    assert got == sorted((r.id, r.sentiment_score) for r in score_sentiment(df, lexicon, keys=["id"]).collect())


def test_hot_term_in_tfidf(spark, rows):
    tf = rows.select(F.col("id").cast("string").alias("book_title"), hot("hot").alias("term"), F.lit(1).alias("tf"), "payload")
    with conf(spark, SKEW_CONF):
        weights = content.tfidf(tf, tf.select("book_title")).withColumn("payload", F.md5("book_title"))
        even, counts = joined_evenly(weights)
        assert even, counts


def test_hot_item_among_candidates(spark, rows):
    cands = rows.select(F.col("id").cast("string").alias("user_id"), hot("hot").alias("book_title"), F.lit(1.0).alias("cf_score"), "payload")
    seen = spark.createDataFrame([("u", "hot", 5.0, "a"), ("u", "k1", 5.0, "b")], "user_id string, book_title string, label_rating double, author string")
    meta = cf.item_metadata(seen)
    with conf(spark, SKEW_CONF):
        even, counts = joined_evenly(split_join(cands, meta, ["book_title"], "left"))
        assert even, counts
        assert cf.boosted_candidates(cands, seen, meta).filter("author = 'a'").count() == N // 3
