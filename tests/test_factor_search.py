"""CF-6: the search over items by length against all products, and models that are stored."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from recoengine.operators import cf, factor_search


def plain(users, items, seen, k):
    out = {}
    for u, x in users.items():
        scores = sorted((-float(np.dot(np.float64(x), np.float64(y))), i) for i, y in items.items() if (u, i) not in seen)[:k]
        out[u] = [(i, -s) for s, i in scores]
    return {u: v for u, v in out.items() if v}


@pytest.mark.parametrize(("k", "block_items", "strip"), [(7, 200_000, 1024), (7, 60, 16), (3, 25, 10), (500, 90, 32), (7, 333, 7)])
def test_search_equals_all_products(spark, monkeypatch, k, block_items, strip):
    monkeypatch.setattr(factor_search, "STRIP", strip)  # the tasks' function takes it from here
    rng = random.Random(2)
    vector = lambda scale: [np.float32(rng.gauss(0, 1) * scale).item() for _ in range(5)]
    users = {u: vector(rng.choice((0.1, 1, 5))) for u in range(80)} | {90: [0.0] * 5}
    items = {i: vector(rng.choice((0.05, 0.3, 1, 3))) for i in range(330)} | {400: [0.0] * 5, 401: [0.0] * 5}
    items[333] = items[2]  # a tie
    seen = {(u, i) for u in users for i in rng.sample(sorted(items), rng.choice((0, 3, 40)))} | {(5, i) for i in items} | {(1, 999), (777, 1)}
    seen |= {(6, i) for i in sorted(items)[2:]}
    frame = lambda rows: spark.createDataFrame([(n, x) for n, x in rows.items()], "id int, features array<float>").repartition(3)
    pairs = spark.createDataFrame([*seen, (1, 2), (1, 2)], "user_index int, book_index int")
    seen.add((1, 2))
    got = defaultdict(list)
    for r in factor_search.best_unseen(frame(users), frame(items), pairs, k, block_items).collect():
        got[r.user_index].append((-r.cf_score, r.book_index))
    expected = plain(users, items, seen, k)
    assert sorted(got) == sorted(expected) and 5 not in got and len(got[6]) == min(k, 2)
    for u, rows in got.items():
        assert [i for _, i in sorted(rows)] == [i for i, _ in expected[u]]
        assert np.allclose([-s for s, _ in sorted(rows)], [s for _, s in expected[u]])


def test_nothing_to_search(spark):
    none = spark.createDataFrame([], "id int, features array<float>")
    some = spark.createDataFrame([(1, [1.0, 2.0])], "id int, features array<float>")
    seen = spark.createDataFrame([], "user_index int, book_index int")
    for users, items in ((none, some), (some, none), (none, none)):
        assert factor_search.best_unseen(users, items, seen, 3).count() == 0


@pytest.fixture(scope="module")
def ratings(spark):
    rng = random.Random(3)
    rows = [(f"u{u}", f"b{b}", float(1 + (u * b + rng.randrange(2)) % 5), f"a{b % 4}", f"c{b % 3}") for u in range(30) for b in range(40) if rng.random() < 0.4]
    return spark.createDataFrame(rows, "user_id string, book_title string, label_rating double, author string, categories string").repartition(3)


def test_same_as_the_model_recommends(spark, ratings):
    indexed, _, _ = cf.add_indexes(ratings)
    model = cf.train_als(indexed.select("user_index", "book_index", "label_rating"), cf.AlsParams(max_iter=4))
    nobody = indexed.select("user_index", "book_index").limit(0)
    got = {(r.user_index, r.book_index): r.cf_score for r in cf.unseen_candidates(model, nobody, None, 10).collect()}
    expected = {(r.user_index, r.book_index): r.cf_score for r in cf.candidates(model, None, 10).collect()}
    assert got.keys() == expected.keys() and all(abs(got[x] - expected[x]) < 1e-4 for x in got)


def test_a_stored_model_serves_what_the_fit_does(spark, ratings, tmp_path, monkeypatch):
    path = str(tmp_path / "model")
    model, _ = cf.fit_model(ratings, cf.AlsParams(max_iter=4))
    other, _ = cf.fit_model(ratings.filter("user_id <> 'u1'"), cf.AlsParams(max_iter=2))
    first, second = other.save(path), model.save(path)
    monkeypatch.setattr(cf, "train_als", None)  # no fit when serving
    loaded = cf.FactorModel.load(spark, path)
    rows = lambda df: sorted(map(tuple, df.select("user_id", "rank", "book_title", F.round("final_score", 9)).collect()))
    assert rows(cf.recommend(loaded, n=5)) == rows(cf.recommend(model, n=5))
    some = spark.createDataFrame([("u1",), ("u7",), ("nobody",)], "user_id string")
    assert rows(cf.recommend(loaded, some, n=5)) == [r for r in rows(cf.recommend(model, n=5)) if r[0] in ("u1", "u7")]
    assert cf.recommend(cf.FactorModel.load(spark, path, first), some, n=5).select("user_id").distinct().count() == 1
    assert first != second


def test_some_users_are_chosen_once(spark, ratings):
    """What chooses the users is not read again by each join of their recommendations."""
    model, _ = cf.fit_model(ratings, cf.AlsParams(max_iter=2))
    calls = spark.sparkContext.accumulator(0)

    def choose(rows):
        calls.add(1)
        yield from rows

    chosen = spark.createDataFrame([("u1",)], "user_id string").coalesce(1).rdd.mapPartitions(choose).toDF("user_id string")
    before = calls.value
    recs = cf.recommend(model, chosen, n=5)
    chosen_once = calls.value - before
    assert recs.count() == 5 and calls.value - before == chosen_once


def test_states_are_ranked_seldom(monkeypatch):
    """Users of a batch go through the strips in parts; a state is not ranked at every strip."""
    import pyarrow as pa

    rng, ranked = np.random.default_rng(1), []
    plain = factor_search.Search.rank
    monkeypatch.setattr(factor_search.Search, "rank", lambda self: (ranked.append(1), plain(self))[1])
    monkeypatch.setattr(factor_search, "STRIP", 16)
    factors = rng.random((3200, 4)) + 1
    factors = factors[np.argsort(-(factors**2).sum(axis=1))]
    vectors = (rng.random((50, 4)) - 0.5).astype(np.float32)
    none = pa.array([[]] * 50, pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(50), pa.int32()), pa.array(vectors.tolist(), pa.list_(pa.float32())), none, pa.array([[]] * 50, pa.list_(pa.float64())), none],
        ["user_index", "features", "items", "scores", "seen"],
    )
    (out,) = factor_search._search(5, factors, np.arange(3200), 0, -np.inf)([batch])
    products = vectors.astype(float) @ factors.T
    assert [sorted(r) for r in out.column("items").to_pylist()] == [sorted(np.argsort(-p)[:5].tolist()) for p in products]
    assert len(ranked) < 100  # of 200 strips


def test_products_that_agree_in_single_precision(spark):
    """Items that only double precision tells apart, also beyond the numbers of single precision."""
    small = 2.0**-26
    for scale in (1.0, 1e18):
        users = spark.createDataFrame([(1, [scale, scale * small]), (2, [scale, -scale * small])], "id int, features array<float>")
        items = spark.createDataFrame([(i, [scale, scale * float((7 * i) % 31)]) for i in range(31)], "id int, features array<float>")
        seen = spark.createDataFrame([(1, 3)], "user_index int, book_index int")
        got = defaultdict(list)
        for r in factor_search.best_unseen(users, items, seen, 4).collect():
            got[r.user_index].append((-r.cf_score, r.book_index))
        order = sorted(range(31), key=lambda i: (7 * i) % 31)
        assert [i for _, i in sorted(got[1])] == [i for i in order[::-1] if i != 3][:4]
        assert [i for _, i in sorted(got[2])] == order[:4]


def test_tasks_have_enough_to_do(spark):
    """3e8 products took 18 tasks, of which each read all items for a moment's work."""
    item = F.transform(F.array(*[F.lit(k) for k in range(3)]), lambda k: F.rand(3).cast("float"))
    users = spark.range(30_000).select(F.col("id").cast("int").alias("id"), item.alias("features"))
    items = spark.range(10_000).select(F.col("id").cast("int").alias("id"), item.alias("features"))
    seen = spark.createDataFrame([], "user_index int, book_index int")
    pairs = factor_search.best_unseen(users, items, seen, 1)
    assert pairs.rdd.getNumPartitions() <= max(2, spark.sparkContext.defaultParallelism)
