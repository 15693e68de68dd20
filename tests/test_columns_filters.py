import math

import pytest
from pyspark.sql import functions as F

from recoengine.functions.constants import ENGLISH_STOP_WORDS
from recoengine.functions.text import similarity_text, title_key, title_key_strict, word_tokens
from recoengine.operators import columns as C
from recoengine.operators import filters
from tests.conftest import rows


def test_stop_words_equal_spark_default(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert tuple(StopWordsRemover.loadDefaultStopWords("english")) == ENGLISH_STOP_WORDS


def test_title_keys(spark):
    df = spark.createDataFrame([("Café: L'été!",), ("\ta  b\n",), ("...",), (None,)], "t string")
    out = df.select(title_key("t").alias("k"), title_key_strict("t").alias("s")).collect()
    assert [r.k for r in out] == ["caf lt", "\ta  b\n", "", None]
    assert [r.s for r in out] == ["caf lt", "a b", "", None]
    assert df.select(title_key("t", unicode=True).alias("k")).first().k == "café lété"


def test_similarity_text_and_tokens(spark):
    df = spark.createDataFrame([("A  B-c!", "Title 1", "  Don't -- stop!! é x ")], "d string, t string, w string")
    r = df.select(similarity_text("d", "t").alias("x"), word_tokens("w").alias("w")).first()
    assert r.x == "a b c title 1"
    assert r.w == ["don't", "stop", "x"]


def test_normalize_columns_case_insensitive_and_clash(spark):
    df = spark.createDataFrame([(1, 2)], "`USER_ID` int, `Review/Score` int")
    assert C.normalize_columns(df, C.REVIEW_ALIASES).columns == ["user_id", "rating"]
    clash = spark.createDataFrame([(1, 2)], "profileName int, ProfileName2 int").withColumnRenamed("ProfileName2", "PROFILENAME")
    with pytest.raises(Exception):
        C.normalize_columns(clash, C.REVIEW_ALIASES).columns


def test_require_choose_select(spark):
    df = spark.createDataFrame([(1, 2.0)], "user_id int, rating float")
    with pytest.raises(C.MissingColumnsError):
        C.require_columns(df, ["user_id", "book_title"])
    assert "label_rating" in C.choose_label(df).columns
    both = df.withColumn("final_rating", F.lit(3.0))
    assert C.choose_label(both).select("label_rating").first()[0] == 3.0
    with pytest.raises(C.MissingColumnsError):
        C.choose_label(df.drop("rating"))
    assert C.select_existing(df, ["rating", "nope", "user_id"]).columns == ["rating", "user_id"]


def test_sentinels_exact(spark):
    df = spark.createDataFrame([("",), ("N/A",), ("null",), ("NULL",), (" N/A",), ("x",), (None,)], "a string")
    assert [r.a for r in C.null_sentinels(df, ["a", "missing"]).collect()] == [None, None, None, "NULL", " N/A", "x", None]


def test_to_float_and_valid_ratings(spark):
    df = spark.createDataFrame([("abc",), (None,), ("0",), ("6",), ("NaN",), ("1",), ("5.0",), ("3.5",)], "s string")
    f = C.coerce_float(df, "s")
    vals = [r.s for r in f.collect()]
    assert vals[:2] == [None, None] and math.isnan(vals[4])
    kept = sorted(r.s for r in filters.valid_ratings(f, "s").collect())
    assert kept == [1.0, 3.5, 5.0]


def test_scrub_boundaries(spark):
    df = spark.createDataFrame(
        [("a" * 149,), ("a" * 150,), ("a" * 151,), ("  Bob  ",), ("An Amazon page",), ("I bought it",), (None,)], "authors string"
    )
    out = [r.authors for r in C.scrub_authors(df).collect()]
    assert out == ["a" * 149, None, None, "Bob", None, None, None]
    cats = spark.createDataFrame([("c" * 99,), ("c" * 100,), ("bought",)], "categories string")
    assert [r.categories for r in C.scrub_categories(cats).collect()] == ["c" * 99, None, "bought"]


def test_unbracket_boundaries(spark):
    df = spark.createDataFrame(
        [("['A', 'B']",), ("[]",), ("  ",), ("a" * 150,), ("a" * 151,), ("['" + "a" * 150 + "']",), (None,)], "authors string"
    )
    out = [r.author for r in C.unbracket(df, "authors", 150, out="author").collect()]
    assert out == ["A, B", None, None, "a" * 150, None, "a" * 150, None]


def test_description_or_title(spark):
    df = spark.createDataFrame([("t1", None), ("t2", "x" * 19), ("t3", "x" * 20)], "book_title string, description string")
    assert [r.description for r in C.description_or_title(df).collect()] == ["t1", "t2", "x" * 20]


def test_min_length_and_find_title(spark):
    df = spark.createDataFrame([("a" * 9, "Doc A"), ("a" * 10, "doc a"), ("a" * 11, "Doc B")], "review_text string, book_title string")
    assert filters.min_text_length(df).count() == 2
    assert rows(filters.find_title(df, "DOC A"), "book_title") == [("Doc A",), ("doc a",)]
    assert rows(filters.find_title(df, "DOC A", negate=True), "book_title") == [("Doc B",)]
    assert filters.drop_missing(df.union(spark.createDataFrame([(None, "x")], df.schema)), ["review_text"]).count() == 3


def test_normalize_columns_rejects_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "user_id int, user int")
    with pytest.raises(ValueError):
        C.normalize_columns(df, C.REVIEW_ALIASES)
    ok = spark.createDataFrame([(1, 2)], "user_id int, Title int")
    assert C.normalize_columns(ok, C.REVIEW_ALIASES).columns == ["user_id", "book_title"]
