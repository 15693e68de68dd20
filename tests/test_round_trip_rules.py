"""Phrases in SEN-2, indexes that grow (CF-1), counts on the way (AGG-7) and staged overwrites (SNK)."""

import math
import random

import pytest
from pyspark.sql import functions as F

from recoengine.operators import cf, profile
from recoengine.operators.phrases import merge_phrases
from recoengine.operators.sentiment import score_sentiment
from recoengine.plans.stages import preprocess_stage, stage_funnel
from recoengine.sources import io


def expected_merge(words, phrases):
    low = [w.lower() for w in words]
    found = [(i, len(p)) for p in phrases for i in range(len(words) - len(p) + 1) if low[i : i + len(p)] == list(p)]
    taken = dict((s, n) for s, n in found if not any(b < s + n and s < b + m and (m > n or (m == n and b < s)) for b, m in found))
    out, i = [], 0
    while i < len(words):
        n = taken.get(i, 1)
        out.append(" ".join(words[i : i + n]))
        i += n
    return out


def test_phrases_merge_like_brute_force(spark):
    rng = random.Random(2)
    phrases = [("a", "b"), ("b", "a"), ("a", "a"), ("a", "b", "c"), ("c", "a", "b", "a"), ("b", "b", "b"), ("c", "c")]
    texts = [(i, " ".join(rng.choices("abcABd", k=rng.randint(0, 40)))) for i in range(150)] + [(900, None), (901, ""), (902, "a b " * 3000)]
    df = spark.createDataFrame(texts, "id long, text string")
    table = spark.createDataFrame([(" ".join(p),) for p in phrases] + [("A  b",), ("d",), ("",), (None,)], "phrase string")
    got = {r.id: r["__raw"] for r in merge_phrases(df, ["id"], "text", table).collect()}
    assert got == {i: expected_merge((t or "").split(), phrases) for i, t in texts}
    none = merge_phrases(df, ["id"], "text", table.filter("phrase = 'd'"))
    assert {r.id: r["__raw"] for r in none.collect()} == {i: (t or "").split() for i, t in texts}


def test_phrase_rules_by_hand(spark):
    norm = lambda s: s / math.sqrt(s * s + 15)
    rows = [
        (1, "never so good", 1.9 + 0.293),
        (2, "never good", 1.9 * -0.74),
        (3, "Without doubt good", 1.9),
        (4, "without good", 1.9 * -0.74),
        (5, "kind of good!", 1.9 - 0.293),
        (6, "kind good", 1.9),
        (7, "the least good", 1.9 * -0.74),
        (8, "at least good", 1.9),
        (9, "a KISS of death", -1.5),
        (10, "kiss of a death", 0.0),
        (11, None, 0.0),
    ]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "id long, review_text string")
    lexicon = spark.createDataFrame([("good", 1.9), ("kiss of death", -1.5)], "token string, valence double")
    phrases = spark.createDataFrame([(p,) for p in ("never so", "without doubt", "kind of", "at least", "kiss of death")], "phrase string")
    scored = score_sentiment(df, lexicon, phrases=phrases, negators=("never", "without", "least"), boosters_up=("never so", "so"), boosters_down=("kind of",))
    got = {r.id: r.sentiment_score for r in scored.collect()}
    assert got == {i: pytest.approx(norm(s)) for i, _, s in rows}
    loud = score_sentiment(df, lexicon, phrases=phrases, emphasis=True, negators=("never", "without", "least"), boosters_up=("never so", "so"), boosters_down=("kind of",))
    assert {r.id: r.sentiment_score for r in loud.collect()}[5] == pytest.approx(norm(1.9 - 0.293 + 0.292))


def test_index_grows_and_keeps_its_numbers(spark):
    first = spark.createDataFrame([("b",), ("b",), ("a",), (None,), ("c",)], "user_id string")
    more = first.unionByName(spark.createDataFrame([("z",)] * 5 + [("y",), ("x",), ("a",), (None,)], "user_id string"))
    known = cf.index_ids(first, "user_id", "user_index")
    got = cf.extend_index(known, more, "user_id", "user_index")
    assert dict(got.collect()) == {"b": 0, "a": 1, "c": 2, "z": 3, "x": 4, "y": 5}
    assert got.dtypes == known.dtypes
    again = cf.extend_index(got, more, "user_id", "user_index")
    assert sorted(again.collect()) == sorted(got.collect())
    assert dict(cf.extend_index(known.limit(0), first, "user_id", "user_index").collect()) == dict(known.collect())


def test_model_takes_new_ratings_without_a_fit(spark, tmp_path):
    rng = random.Random(1)
    rows = sorted({(f"u{rng.randrange(12)}", f"t{rng.randrange(15)}") for _ in range(110)})
    df = spark.createDataFrame([(u, t, float(1 + (hash_of(u + t) % 5)), f"a{len(t)}", "c") for u, t in rows], "user_id string, book_title string, label_rating double, author string, categories string")
    model, _ = cf.fit_model(df, cf.AlsParams(rank=3, max_iter=2))
    user = rows[0][0]
    before = cf.recommend(model, n=3).filter(F.col("user_id") == user).orderBy(F.col("rank")).collect()
    best = before[0].book_title
    new = spark.createDataFrame([(user, best, 5.0, "a2", "c"), ("newcomer", best, 4.0, "a2", "c"), (user, "new title", 3.0, "zz", "c")], df.schema)
    grown = model.with_ratings(new)
    grown.save(str(tmp_path / "model"))
    grown = cf.FactorModel.load(spark, str(tmp_path / "model"))
    old_ids = dict(model.users.collect())
    assert {k: v for k, v in dict(grown.users.collect()).items() if k in old_ids} == old_ids
    assert dict(grown.users.collect())["newcomer"] == len(old_ids)
    assert grown.ratings.count() == model.ratings.count() + 3
    after = cf.recommend(grown, n=30).collect()
    assert (user, best) not in {(r.user_id, r.book_title) for r in after}
    assert not any(r.user_id == "newcomer" for r in after)
    assert model.with_ratings(new).with_ratings(new).ratings.count() == model.ratings.count() + 3


def hash_of(text):
    return sum(ord(c) * (i + 3) for i, c in enumerate(text))


def reviews(spark, n=400):
    rng = random.Random(5)
    rows = [(f"u{rng.randrange(25)}", f"b{rng.randrange(20)}", rng.choice(["1", "4.5", "9", "x", None]), rng.choice(["good enough text", "short", None]), f"2020-01-{1 + i % 28:02d}") for i in range(n)]
    return spark.createDataFrame(rows, "User_id string, Title string, `review/score` string, `review/text` string, `review/time` string")


@pytest.mark.parametrize("n", [400, 3])
def test_counts_on_the_way_equal_the_funnel(spark, tmp_path, n):
    raw = reviews(spark, n)
    counts = profile.StepCounts()
    plain = preprocess_stage(raw, 3, 3)
    preprocess_stage(raw, 3, 3, counts=counts).write.parquet(str(tmp_path / "out"))
    assert counts.funnel(spark).orderBy("seq").collect() == stage_funnel(raw, 3, 3).orderBy("seq").collect()
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(str, plain.collect()))


def test_staged_overwrite_keeps_old_data_until_the_new_is_whole(spark, tmp_path):
    path = str(tmp_path / "table")
    io.write_table(spark.range(10), path, staged=True)
    io.write_table(spark.read.parquet(path).filter("id < 4"), path, staged=True, files=2)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3]
    assert spark.read.parquet(path).select(F.input_file_name()).distinct().count() == 2
    broken = spark.range(5).withColumn("bad", F.raise_error(F.lit("stopped half way")))
    with pytest.raises(Exception, match="stopped half way"):
        io.write_table(broken, path, staged=True)

    def refuse(folder):
        raise ValueError(f"{spark.read.parquet(folder).count()} rows")

    with pytest.raises(ValueError, match="7 rows"):
        io.write_staged(spark, path, lambda folder: io.write_parquet(spark.range(7), folder), refuse)
    assert spark.read.parquet(path).count() == 4
    assert [p.name for p in tmp_path.iterdir()] == ["table"]
