"""Collaborative filtering with content boosts (CF-1..10, JOI-5, JOI-6,
TOP-3, TOP-5, PRJ-16).

Everything works for any set of users at once: seen items are removed with a
``left_anti`` join, preferences and boosts are joins, and the top-N is a
per-user ``row_number``.  Ids are indexed by a distributed dense index
(:func:`recoengine.operators.ranking.dense_index`) instead of
``StringIndexer``, whose model holds every label on the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recoengine.operators.factor_search import best_unseen
from recoengine.operators.profile import user_activity
from recoengine.operators.ranking import dense_index, first_per_key, top_n_per_group
from recoengine.operators.skew import split_join
from recoengine.session import ensure_checkpoint_dir
from recoengine.sources.io import stored


def index_ids(df: DataFrame, col: str, out: str) -> DataFrame:
    """CF-1: ``(col, out)`` with ids numbered 0.. by frequency desc, then id
    (the StringIndexer order).  NULL ids are skipped."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_cnt"))
    idx = dense_index(counts, [F.col("_cnt").desc(), F.col(col).asc()], out)
    return idx.select(col, F.col(out).cast("int").alias(out))


def extend_index(known: DataFrame, df: DataFrame, col: str, out: str) -> DataFrame:
    """CF-1 when rows arrive: ``known`` ``(col, out)`` as it is, and the ids of ``df``
    that it lacks numbered on from its largest number, by frequency desc, then id.

    Ids are counted before they meet the index, so no hot id is joined.  One
    number, the largest, reaches the planner.  Rows of ``known`` keep their
    numbers for good: what was stored under them (factors) stays valid.
    """
    fresh = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_cnt")).join(known.select(col), col, "left_anti")
    first = known.agg(F.coalesce(F.max(out).cast("long") + 1, F.lit(0).cast("long"))).first()[0]
    added = dense_index(fresh, [F.col("_cnt").desc(), F.col(col).asc()], out)
    return known.select(col, F.col(out).cast("int").alias(out)).unionByName(added.select(col, (F.col(out) + F.lit(first)).cast("int").alias(out)))


def add_indexes(df: DataFrame, user_col: str = "user_id", item_col: str = "book_title") -> tuple[DataFrame, DataFrame, DataFrame]:
    """CF-1 on both ids: returns (indexed rows, user index, item index)."""
    users = index_ids(df, user_col, "user_index")
    items = index_ids(df, item_col, "book_index")
    return df.join(users, user_col).join(items, item_col), users, items


def bucket(cols: Sequence[str], seed: int = 42, buckets: int = 10000) -> Column:
    """A partition-independent pseudo-random bucket in [0, buckets) of the key
    columns: the first 32 bits of ``md5(key, seed)``."""
    key = F.concat_ws("\u0001", *[F.col(c).cast("string") for c in cols], F.lit(str(seed)))
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(buckets))


def split(df: DataFrame, fraction: float = 0.8, seed: int = 42, keys: Sequence[str] = ("user_id", "book_title")) -> tuple[DataFrame, DataFrame]:
    """CF-2: deterministic train/test split by hashed row key.

    Unlike ``randomSplit`` the membership of a row does not depend on
    partitioning or on recomputation after a lost executor.
    """
    b = bucket(keys, seed)
    cut = int(round(fraction * 10000))
    return df.filter(b < cut), df.filter(b >= cut)


def indexed_split(labeled: DataFrame, fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """CF-1 and CF-2: ``(user_index, book_index, label_rating)`` of the train and
    the test rows (actions: the labelled rows and the indexed ones are stored).

    Both indexes, the fit and every look at the hold-out read the ratings; what
    made them (joins, WIN-1's window) is run once, and not by each of those.
    """
    rows = stored(labeled.select("user_id", "book_title", "label_rating"), "labeled")
    indexed, _, _ = add_indexes(rows)
    indexed = indexed.withColumn("__bucket", bucket(("user_id", "book_title"), seed))
    indexed = stored(indexed.select("user_index", "book_index", "label_rating", "__bucket"), "indexed")
    cut = int(round(fraction * 10000))
    return indexed.filter(F.col("__bucket") < cut).drop("__bucket"), indexed.filter(F.col("__bucket") >= cut).drop("__bucket")


@dataclass(frozen=True)
class AlsParams:
    rank: int = 20
    max_iter: int = 12
    reg_param: float = 0.12
    nonnegative: bool = True
    seed: int = 42
    checkpoint_interval: int = 10
    cold_start: str = "drop"


def train_als(train: DataFrame, params: AlsParams = AlsParams(), label_col: str = "label_rating") -> ALSModel:
    """CF-3: explicit-feedback ALS on integer indexes (an action: fits the model).

    ALS checkpoints its factor lineage every ``checkpoint_interval`` iterations
    to the cluster's checkpoint folder when one is set.
    """
    als = ALS(
        rank=params.rank,
        maxIter=params.max_iter,
        regParam=params.reg_param,
        userCol="user_index",
        itemCol="book_index",
        ratingCol=label_col,
        coldStartStrategy=params.cold_start,
        nonnegative=params.nonnegative,
        seed=params.seed,
        checkpointInterval=params.checkpoint_interval,
    )
    return als.fit(train)


def predict(model: ALSModel, test: DataFrame) -> DataFrame:
    """CF-4: predictions for held-out rows; cold-start rows are dropped."""
    return model.transform(test)


def prediction_mismatches(model: ALSModel, pred: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """CF-4 checked: predictions, and how many of them differ from the dot
    product of the two factors."""
    u = model.userFactors.select(F.col("id").alias("user_index"), F.col("features").alias("uf"))
    i = model.itemFactors.select(F.col("id").alias("book_index"), F.col("features").alias("bf"))
    dot = F.aggregate(F.zip_with("uf", "bf", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    off = F.abs(dot - F.col("prediction")) > tolerance * (1 + F.abs(dot))
    return pred.join(u, "user_index").join(i, "book_index").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(off, 1)).alias("n_mismatch"))


def recommendation_checks(recs: DataFrame, seen: DataFrame) -> DataFrame:
    """CF-6..10 checked, one row per user: how many recommendations, how many
    of them were seen, whether ranks are 1..n in the order of the scores and
    every final score is the model's plus the boosts."""
    known = seen.select("user_id", "book_title", F.lit(1).alias("__seen")).distinct()
    rows = recs.join(known, ["user_id", "book_title"], "left")
    order = F.array_sort(F.collect_list(F.struct("rank", F.col("final_score").alias("score"))))
    checked = rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_recs"),
        F.count("__seen").alias("n_seen"),
        order.alias("__order"),
        F.min((F.abs(F.col("final_score") - F.col("cf_score") - F.col("author_hit") - F.col("genre_hit")) < 1e-9).cast("int")).alias("__sum"),
    )
    ranks = F.forall(F.transform("__order", lambda x, i: x["rank"] == i + 1), lambda x: x)
    falling = F.forall(F.transform("__order", lambda x, i: (i == 0) | (x["score"] <= F.element_at("__order", F.greatest(i, F.lit(1)))["score"])), lambda x: x)
    return checked.select("user_id", "n_recs", "n_seen", (ranks & falling).alias("ranks_ok"), (F.col("__sum") == 1).alias("scores_ok"))


def rating_errors(pred: DataFrame, label_col: str = "label_rating", pred_col: str = "prediction") -> DataFrame:
    """CF-5: RMSE and MAE in one pass."""
    err = F.col(pred_col).cast("double") - F.col(label_col).cast("double")
    return pred.agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae")
    )


def eligible_users(df: DataFrame, min_count: int = 5, min_avg: float = 2.5, user_col: str = "user_id", label_col: str = "label_rating") -> DataFrame:
    """TOP-5: users with at least ``min_count`` rows and mean label ≥ ``min_avg``."""
    act = user_activity(df, user_col, label_col)
    return act.filter((F.col("cnt") >= min_count) & (F.col("avg_r") >= min_avg))


def pick_user(df: DataFrame, seed: int = 42, min_count: int = 5, min_avg: float = 2.5, user_col: str = "user_id", label_col: str = "label_rating") -> DataFrame:
    """TOP-5: one eligible user in seeded-hash order, else the most active
    user.  One plan, one row (or none for an empty input)."""
    act = user_activity(df, user_col, label_col)
    ok = (F.col("cnt") >= min_count) & (F.col("avg_r") >= min_avg)
    h = F.md5(F.concat_ws(":", F.col(user_col).cast("string"), F.lit(str(seed))))
    ordered = act.select(
        user_col,
        "cnt",
        "avg_r",
        F.when(ok, F.lit(0)).otherwise(F.lit(1)).alias("_fallback"),
        F.when(ok, h).alias("_h"),
    ).orderBy("_fallback", "_h", F.col("cnt").desc(), F.col(user_col).asc())
    return ordered.limit(1).drop("_fallback", "_h")


def user_history(
    df: DataFrame,
    users: DataFrame | None = None,
    n: int = 15,
    user_col: str = "user_id",
    item_col: str = "book_title",
    label_col: str = "label_rating",
) -> DataFrame:
    """TOP-2: each user's ``n`` best-rated items (label desc, then item), for
    the users in ``users`` (a frame with ``user_col``) or for everyone."""
    rows = df if users is None else df.join(users.select(user_col).distinct(), user_col, "left_semi")
    order = [F.col(label_col).desc_nulls_last(), F.col(item_col).asc()]
    return top_n_per_group(rows, [user_col], order, n, rank_col="rank")


def preferences(df: DataFrame, col: str, min_label: float = 4.0, n: int = 5, user_col: str = "user_id", label_col: str = "label_rating") -> DataFrame:
    """CF-7: each user's top ``n`` values of ``col`` among items rated ≥
    ``min_label``: by count desc, mean desc, value (G5)."""
    liked = df.filter((F.col(label_col) >= min_label) & F.col(col).isNotNull())
    agg = liked.groupBy(user_col, col).agg(
        F.count(F.lit(1)).alias("cnt"), F.avg(F.col(label_col).cast("double")).alias("avg")
    )
    return top_n_per_group(agg, [user_col], [F.col("cnt").desc(), F.col("avg").desc(), F.col(col).asc()], n, rank_col="pref_rank")


def exclude_seen(recs: DataFrame, seen: DataFrame, keys: Sequence[str] = ("user_id", "book_title")) -> DataFrame:
    """JOI-6: drop (user, item) pairs already interacted with, for all users
    at once (a ``left_anti`` join on both keys: no hot single key)."""
    return recs.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def item_metadata(df: DataFrame, item_col: str = "book_title", cols: Sequence[str] = ("author", "categories")) -> DataFrame:
    """JOI-5's right side: one metadata row per item (smallest values: G5)."""
    present = [c for c in cols if c in df.columns]
    rows = df.select(item_col, *present).filter(F.col(item_col).isNotNull()).distinct()
    if not present:
        return rows
    return first_per_key(rows, [item_col], [F.col(c).asc_nulls_last() for c in present])


def rerank(
    cands: DataFrame,
    interactions: DataFrame,
    meta: DataFrame,
    author_boost: float = 1.0,
    genre_boost: float = 0.5,
    n: int = 20,
    min_label: float = 4.0,
    n_prefs: int = 5,
    user_col: str = "user_id",
    item_col: str = "book_title",
    label_col: str = "label_rating",
) -> DataFrame:
    """CF-8 (+TOP-3, JOI-5): unseen candidates only, ``+author_boost`` when the
    item's author is among the user's top authors, ``+genre_boost`` for
    categories; ``final_score = cf_score + boosts``; top ``n`` per user by
    final score, then cf score, then item.  NULL author/category scores 0.

    ``cands`` is ``(user, item, cf_score)``.  Output adds ``rank``,
    ``author_hit``, ``genre_hit``, ``author``, ``categories``.
    """
    scored = boosted_candidates(
        cands, interactions, meta, author_boost, genre_boost, min_label, n_prefs, user_col, item_col, label_col
    )
    order = [F.col("final_score").desc(), F.col("cf_score").desc(), F.col(item_col).asc()]
    return top_n_per_group(scored, [user_col], order, n, rank_col="rank")


def boosted_candidates(
    cands: DataFrame,
    interactions: DataFrame,
    meta: DataFrame,
    author_boost: float = 1.0,
    genre_boost: float = 0.5,
    min_label: float = 4.0,
    n_prefs: int = 5,
    user_col: str = "user_id",
    item_col: str = "book_title",
    label_col: str = "label_rating",
) -> DataFrame:
    """CF-8 before the top-N cut: every unseen candidate with its boosts."""
    unseen = exclude_seen(cands, interactions, (user_col, item_col))
    # an item that is a candidate for most users is split by AQE
    with_meta = split_join(unseen, meta, [item_col], "left")
    for col, boost, hit in (("author", author_boost, "author_hit"), ("categories", genre_boost, "genre_hit")):
        if col in meta.columns and col in interactions.columns:
            prefs = preferences(interactions, col, min_label, n_prefs, user_col, label_col).select(
                user_col, col, F.lit(float(boost)).alias(hit)
            )
            with_meta = with_meta.join(prefs, [user_col, col], "left").withColumn(hit, F.coalesce(F.col(hit), F.lit(0.0)))
        else:
            with_meta = with_meta.withColumn(hit, F.lit(0.0))
            if col not in with_meta.columns:
                with_meta = with_meta.withColumn(col, F.lit(None).cast("string"))
    return with_meta.withColumn("final_score", F.col("cf_score") + F.col("author_hit") + F.col("genre_hit"))


def boosted_counts(scored: DataFrame, user_col: str = "user_id") -> DataFrame:
    """CF-9: candidates per user and how many of them got a boost."""
    hit = (F.col("author_hit") > 0) | (F.col("genre_hit") > 0)
    return scored.groupBy(user_col).agg(
        F.count(F.lit(1)).alias("n_candidates"), F.sum(F.when(hit, 1).otherwise(0)).alias("n_boosted")
    )


def candidates(model: ALSModel, users: DataFrame | None = None, k: int = 100) -> DataFrame:
    """CF-6 (+PRJ-16): ``(user_index, book_index, cf_score)``, the top ``k``
    items per user from the model; all users when ``users`` is None.  No
    users means an empty frame, not an error."""
    recs = model.recommendForAllUsers(k) if users is None else model.recommendForUserSubset(users, k)
    return recs.select("user_index", F.inline("recommendations")).select(
        "user_index", "book_index", F.col("rating").cast("double").alias("cf_score")
    )


def unseen_candidates(model: FactorModel | ALSModel, history: DataFrame, users: DataFrame | None = None, k: int = 100) -> DataFrame:
    """CF-6 with JOI-6: each user's top ``k`` items among those not seen, in
    one search for all users (:mod:`recoengine.operators.factor_search`).
    ``history`` is ``(user_index, book_index)``."""
    factors = model.userFactors
    if users is not None:
        wanted = users.select(F.col("user_index").alias("id")).distinct()
        factors = factors.join(wanted, "id", "left_semi")
    return best_unseen(factors, model.itemFactors, history, k)


def prepare_labels(df: DataFrame) -> DataFrame:
    """CF-10 input cleaning: label choice (PRJ-3) as a number (junk is NULL,
    PRJ-9, so CSV input needs no schema), light metadata cleaning (PRJ-12),
    essentials (FLT-2)."""
    from recoengine.functions.numeric import to_float
    from recoengine.operators.columns import choose_label, unbracket

    out = choose_label(df)
    out = out.withColumn("label_rating", to_float("label_rating"))
    if "authors" in out.columns and "author" not in out.columns:
        out = out.withColumnRenamed("authors", "author")
    out = unbracket(out, "author", 150)
    out = unbracket(out, "categories", 100)
    return out.na.drop(subset=["user_id", "book_title", "label_rating"])


@dataclass
class FactorModel:
    """What serving needs, as tables: the factors ``(id, features)``, the id
    indexes, the indexed labelled ratings and one row of metadata per item."""

    userFactors: DataFrame
    itemFactors: DataFrame
    users: DataFrame  # user_id, user_index
    items: DataFrame  # book_title, book_index
    ratings: DataFrame  # user_index, book_index, label_rating and metadata
    meta: DataFrame

    TABLES = ("userFactors", "itemFactors", "users", "items", "ratings", "meta")

    def save(self, path: str) -> str:
        """Write all tables under a new version of ``path`` and name it in
        ``versions`` last, so that readers never meet half a model.  Returns the version."""
        spark = self.users.sparkSession
        version = uuid.uuid4().hex
        for name in self.TABLES:
            getattr(self, name).write.parquet(f"{path}/{version}/{name}")
        row = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("saved"))
        row.write.mode("append").parquet(f"{path}/versions")
        return version

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: str | None = None) -> FactorModel:
        """The tables of a version (the newest by default)."""
        if version is None:
            newest = spark.read.parquet(f"{path}/versions").orderBy(F.col("saved").desc(), "version").first()
            version = newest.version
        return cls(*[spark.read.parquet(f"{path}/{version}/{name}") for name in cls.TABLES])


    def with_ratings(self, df: DataFrame) -> FactorModel:
        """The model with further ratings (columns as for :func:`fit_model`)
        and without a fit: the factors stay, new ids are numbered on, new
        ratings count as seen and for the preferences.  A pair of user and item that
        the model has keeps the rating it has; within ``df`` a pair must
        not repeat.  Users and items of new ids have no factors until the next fit."""
        labeled = prepare_labels(df)
        wanted = [c for c in ("user_id", "book_title", "label_rating", "author", "categories") if c in labeled.columns]
        ensure_checkpoint_dir(df.sparkSession)
        labeled = labeled.select(*wanted).checkpoint(eager=True)
        users = extend_index(self.users, labeled, "user_id", "user_index")
        items = extend_index(self.items, labeled, "book_title", "book_index")
        fresh = labeled.join(users, "user_id").join(items, "book_title").drop("user_id", "book_title")
        fresh = fresh.join(self.ratings, ["user_index", "book_index"], "left_anti")
        ratings = self.ratings.unionByName(fresh.select(*[c for c in self.ratings.columns if c in fresh.columns]), allowMissingColumns=True)
        new_items = fresh.join(self.meta.select("book_index"), "book_index", "left_anti")
        meta = self.meta.unionByName(item_metadata(new_items, item_col="book_index"), allowMissingColumns=True)
        return FactorModel(self.userFactors, self.itemFactors, users, items, ratings, meta)


def fit_model(df: DataFrame, params: AlsParams = AlsParams(), train_fraction: float = 0.8) -> tuple[FactorModel, DataFrame]:
    """CF-1..5: ``(model, hold-out errors)``.  Checkpointing the labelled
    ratings, the two id indexes and fitting the model run jobs when this is called."""
    # The labelled ratings feed the indexes, the split, the metadata, the seen
    # set and both preference tables.  They are thin rows (ids, label,
    # author, category), so they are checkpointed to the shared folder: read
    # once per consumer, and the lineage is cut, so the model's many jobs
    # neither replan an upstream curation flow nor recompute it after a lost
    # executor.
    prepared = prepare_labels(df)
    wanted = [c for c in ("user_id", "book_title", "label_rating", "author", "categories") if c in prepared.columns]
    ensure_checkpoint_dir(df.sparkSession)
    labeled = prepared.select(*wanted).checkpoint(eager=True)
    indexed, user_idx, item_idx = add_indexes(labeled)
    # read by the model's jobs, the metadata, the seen set and both preference
    # tables; the files are removed with the frame (cleanCheckpoints)
    indexed = indexed.checkpoint(eager=True)
    train, test = split(indexed, train_fraction, params.seed)
    als = train_als(train.select("user_index", "book_index", "label_rating"), params)
    ratings = indexed.drop("user_id", "book_title")
    model = FactorModel(als.userFactors, als.itemFactors, user_idx, item_idx, ratings, item_metadata(ratings, item_col="book_index"))
    return model, rating_errors(predict(als, test))


def recommend(model: FactorModel, users: DataFrame | None = None, k: int = 100, n: int = 20, author_boost: float = 1.0, genre_boost: float = 0.5) -> DataFrame:
    """CF-6..10 from a model, fitted just now or loaded: the top ``n``
    re-ranked items of some users (``user_id``; all when None)."""
    subset = None if users is None else users.join(model.users, "user_id").select("user_index").distinct()
    if subset is not None:
        # read by each of the joins below: their plans must not choose the users again
        ensure_checkpoint_dir(subset.sparkSession)
        subset = subset.checkpoint(eager=True)
    # Re-rank in index space (integer keys for the seen set, metadata and
    # preferences), and map back to the string ids only after the top-n cut:
    # k/n times fewer rows go through the two id joins.  Exact score ties are
    # broken by item index (frequency order) here, not by title.
    # Seen items and preferences are per user: for a user subset, only the
    # subset's own ratings are needed (a semi-join AQE can broadcast), so
    # serving one user does not shuffle everyone's ratings.
    history = model.ratings if subset is None else model.ratings.join(subset, "user_index", "left_semi").checkpoint(eager=True)
    cands = unseen_candidates(model, history, subset, k)
    ranked = rerank(cands, history, model.meta, author_boost, genre_boost, n, user_col="user_index", item_col="book_index")
    return ranked.join(model.users, "user_index").join(model.items, "book_index").drop("user_index", "book_index")


def recommend_for_users(
    df: DataFrame,
    users: DataFrame | None = None,
    params: AlsParams = AlsParams(),
    k: int = 100,
    n: int = 20,
    train_fraction: float = 0.8,
    author_boost: float = 1.0,
    genre_boost: float = 0.5,
) -> tuple[DataFrame, DataFrame]:
    """CF-10: the whole flow for a set of users (all users when None).

    Returns ``(recommendations, errors)``: the top ``n`` re-ranked items per
    user and the hold-out RMSE/MAE (see :func:`fit_model` and :func:`recommend`)."""
    model, errors = fit_model(df, params, train_fraction)
    return recommend(model, users, k, n, author_boost, genre_boost), errors
