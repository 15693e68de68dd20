"""Texts kept out of shuffles: marks behave as their texts do, and the flows give the same rows."""

import hashlib

from pyspark.sql import functions as F

from tests.conftest import rows
from recoengine.operators import texts as T
from recoengine.operators.columns import null_sentinels
from recoengine.operators.filters import drop_missing, min_text_length
from recoengine.plans import roles as R
from recoengine.plans.stages import curate, merge_stage, preprocess_stage

TEXTS = ["zebra was here", "Zebra was here", "", "N/A", "null", None, "short", "été was good and", "zebra was here", "with great great things"]


def test_marks_are_ordered_filtered_and_digested_as_their_texts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string").repartition(3)
    marked, dictionary = T.text_marks(df, "t")
    assert dictionary.count() == len({t for t in TEXTS if t is not None})
    assert T.is_marked(marked, "t") and not T.is_marked(df, "t")
    both = marked.withColumnRenamed("t", "m").join(df, "id")
    # equal exactly where the texts are, and in their order
    pairs = both.alias("a").crossJoin(both.alias("b"))
    assert pairs.filter(~((F.col("a.m") < F.col("b.m")).eqNullSafe(F.col("a.t") < F.col("b.t")))).count() == 0
    assert pairs.filter(~(F.col("a.m").eqNullSafe(F.col("b.m")) == F.col("a.t").eqNullSafe(F.col("b.t")))).count() == 0
    for f in (lambda x: null_sentinels(x, ["t"]), lambda x: drop_missing(x, ["t"]), lambda x: min_text_length(x, "t", 10)):
        one, other = f(df), f(marked)
        assert rows(one.select("id", T.text_md5(one, "t"))) == rows(other.select("id", T.text_md5(other, "t")))
    assert rows(marked.select(T.text_md5(marked, "t").alias("h")).na.drop()) == sorted((hashlib.md5(t.encode()).hexdigest(),) for t in TEXTS if t is not None)


def test_curation_with_marks_gives_the_rows_of_texts(spark, tmp_path):
    """Documents whose ids repeat or are null, reviews that tie but for their text."""
    d, docs = str(tmp_path), [(i, f"{'the with was good and ' * (i % 4)}text {i % 3}") for i in range(8)] + [(1, "with another text"), (None, "of no id"), (2, "N/A"), (3, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    orders = [(o, o % 4, "1996-01-02") for o in range(40)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate string").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).write.parquet(f"{d}/orders.parquet")
    lines = [(o, (o * 7 + n) % 9, 1, n, float(5 + (o + n) % 40), 10.0) for o in range(40) for n in range(1, 4)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double").write.parquet(f"{d}/lineitem.parquet")
    parts = [(p, f"name {p}", f"Brand#{p}", f"TYPE {p % 3}", 40 + p, 9.5) for p in range(9)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{d}/part.parquet")
    marked, texts = R.marked_reviews(spark, d)
    plain, books = R.reviews_raw(spark, d), R.books_raw(spark, d)

    def out(df):
        return rows(df.withColumn("review_text", T.text_md5(df, "review_text")))

    assert out(merge_stage(marked, books)) == out(merge_stage(plain, books))
    assert T.is_marked(preprocess_stage(merge_stage(marked, books)), "review_text")  # no text travels
    pre = out(preprocess_stage(merge_stage(plain, books)))
    assert pre and out(preprocess_stage(merge_stage(marked, books))) == pre
    lexicon, rules = R.fixture_lexicon(spark), R.fixture_rules()
    assert rows(curate(marked, books, lexicon, sentiment_rules=rules, texts=texts)) == rows(curate(plain, books, lexicon, sentiment_rules=rules))
