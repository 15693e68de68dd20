import math

import pytest
from pyspark.sql import functions as F

from recoengine.operators.label import blend_rating
from recoengine.operators.merge import merge_reviews
from recoengine.operators.sentiment import score_sentiment


def test_blend_rating_rules(spark):
    df = spark.createDataFrame(
        [(1, 1.0, -1.0), (2, 5.0, 1.0), (3, 4.0, None), (4, None, 0.5), (5, 3.0, 0.0)],
        "id int, rating float, sentiment_score float",
    )
    got = {r.id: r.final_rating for r in blend_rating(df).collect()}
    assert got[1] == 1.0            # 0.7 clamped up
    assert got[2] == 5.0
    assert got[3] == 4.0            # rating alone without sentiment
    assert got[4] is None
    assert got[5] == pytest.approx(3.0 * 0.7 + 2.5 * 0.3)
    assert dict(blend_rating(df).dtypes)["final_rating"] == "float"


def _lex(spark):
    return spark.createDataFrame([("good", 1.9), ("bad", -2.5), ("okay", 0.0), ("Good", 1.9)], "token string, valence double")


def _norm(s):
    return s / math.sqrt(s * s + 15)


def test_sentiment_hand_worked(spark):
    texts = [
        (1, None), (2, ""), (3, "zzz qqq"), (4, "Good!"), (5, "bad"),
        (6, "not good"), (7, "very good"), (8, "not very good"), (9, "good and bad"),
        (10, "never a very bad thing"), (11, "barely good"), (12, "okay"), (13, "very nice good"),
    ]
    df = spark.createDataFrame(texts, "id long, review_text string")
    got = {r.id: r.sentiment_score for r in score_sentiment(df, _lex(spark)).collect()}
    assert got[1] == 0.0 and got[2] == 0.0 and got[3] == 0.0 and got[12] == 0.0
    assert got[4] == pytest.approx(_norm(1.9))
    assert got[5] == pytest.approx(_norm(-2.5))
    assert got[6] == pytest.approx(_norm(1.9 * -0.74))
    assert got[7] == pytest.approx(_norm(1.9 + 0.293))
    assert got[8] == pytest.approx(_norm((1.9 + 0.293) * -0.74))
    assert got[9] == pytest.approx(_norm(1.9 - 2.5))
    # booster right before pushes the negative word further down; the negator
    # three tokens back still flips it
    assert got[10] == pytest.approx(_norm((-2.5 - 0.293) * -0.74))
    assert got[11] == pytest.approx(_norm(1.9 - 0.293))
    assert got[13] == pytest.approx(_norm(1.9 + 0.293 * 0.95))   # booster two tokens back
    assert all(-1 <= v <= 1 for v in got.values())


def test_sentiment_keeps_columns_and_types(spark):
    df = spark.createDataFrame([(1, "good", 4.5)], "id long, review_text string, rating float")
    out = score_sentiment(df, _lex(spark))
    assert out.dtypes[:3] == df.dtypes and out.columns[-1] == "sentiment_score"


def _books(spark):
    data = [
        ("Part 1.", "short", "A"),
        ("PART 1", "a much longer description", "B"),
        ("...", "punct", "C"),
        ("!!!", "punct2", "D"),
        (None, "no title", "E"),
    ]
    return spark.createDataFrame(data, "book_title string, description string, authors string")


def test_merge_parity_fans_out(spark):
    reviews = spark.createDataFrame([("r1", "part 1"), ("r2", "?"), ("r3", None)], "rid string, book_title string")
    out = merge_reviews(reviews, _books(spark), dedupe="none")
    by = {}
    for r in out.collect():
        by.setdefault(r.rid, []).append(r.authors)
    assert sorted(by["r1"]) == ["A", "B"]          # two books share the key
    assert by["r2"] == [None]                      # the empty key never matches (no all-pairs group)
    assert by["r3"] == [None]                      # NULL key never matches


def test_merge_dedupe_longest(spark):
    reviews = spark.createDataFrame([("r1", "part 1"), ("r2", "?")], "rid string, book_title string")
    out = {r.rid: r.authors for r in merge_reviews(reviews, _books(spark)).collect()}
    assert out == {"r1": "B", "r2": None}


def test_sentiment_by_distinct_text(spark):
    texts = [(1, "good"), (2, "good"), (3, "not good"), (4, None), (5, "")]
    df = spark.createDataFrame(texts, "id long, review_text string")
    a = {r.id: r.sentiment_score for r in score_sentiment(df, _lex(spark)).collect()}
    out = score_sentiment(df.drop("id").withColumn("n", F.lit(1)), _lex(spark), keys=None)
    assert out.columns == ["review_text", "n", "sentiment_score"] and out.count() == 5
    by_text = {r.review_text: r.sentiment_score for r in out.collect()}
    assert by_text["good"] == a[1] and by_text["not good"] == a[3] and by_text[None] == 0.0 and by_text[""] == 0.0


def test_emphasis_rules_by_hand(spark):
    import math

    lex = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "token string, valence double")
    cases = {
        "good": 1.9,
        "GOOD": 1.9,  # all in capitals: no emphasis
        "GOOD book": 1.9 + 0.733,
        "BAD book": -2.5 - 0.733,
        "good but bad": 0.5 * 1.9 + 1.5 * -2.5,
        "but good": 1.5 * 1.9,
        "good!!": 1.9 + 2 * 0.292,
        "bad!!!!!!": -2.5 - 4 * 0.292,
        "good?": 1.9,
        "good??": 1.9 + 2 * 0.18,
        "good?????": 1.9 + 0.96,
        "nothing!!": 0.0,
        "": 0.0,
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)] + [(99, None)], "id long, review_text string")
    got = {r.review_text: r.sentiment_score for r in score_sentiment(df, lex, emphasis=True).collect()}
    for text, s in cases.items():
        assert abs(got[text] - s / math.sqrt(s * s + 15)) < 1e-9, text
    assert got[None] == 0.0
