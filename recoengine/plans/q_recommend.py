"""Queries for content similarity, enrichment and collaborative filtering."""

from __future__ import annotations

from pyspark.sql import functions as F

from recoengine.functions.constants import ENGLISH_STOP_WORDS
from recoengine.functions.numeric import round6
from recoengine.operators import content
from recoengine.plans import roles as R
from recoengine.plans.queries import register
from recoengine.sources import io

_STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)

ITEMS_SQL = """
    items AS MATERIALIZED (
      SELECT book_title,
             trim(regexp_replace(regexp_replace(lower(concat_ws(' ', d, book_title)), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS text_clean
      FROM (SELECT book_title, CASE WHEN description IS NULL OR length(description) < 20 THEN book_title ELSE description END AS d
            FROM (SELECT *, row_number() OVER (PARTITION BY book_title
                        ORDER BY length(description) DESC NULLS LAST, description ASC NULLS LAST) AS rn
                  FROM (SELECT DISTINCT book_title, description FROM item_texts_src WHERE book_title IS NOT NULL))
            WHERE rn = 1))"""
TFIDF_SQL = ITEMS_SQL + f""",
    toks AS (SELECT book_title, unnest(string_split(text_clean, ' ')) AS term FROM items),
    tf AS MATERIALIZED (SELECT book_title, term, count(*) AS tf FROM toks WHERE lower(term) NOT IN ({_STOP_SQL}) GROUP BY book_title, term),
    nn AS (SELECT count(*) AS n FROM items),
    dfs AS MATERIALIZED (SELECT term, count(*) AS df FROM tf GROUP BY term),
    idf AS (SELECT term, ln((nn.n + 1.0) / (df + 1.0)) AS idf FROM dfs, nn),
    wt AS MATERIALIZED (SELECT tf.book_title, tf.term, tf.tf * idf.idf AS w FROM tf JOIN idf USING (term) WHERE idf.idf > 0)"""


def _items(spark, d):
    return content.item_texts(R.item_texts_src(spark, d))


@register("CON_1_item_texts", f"WITH {ITEMS_SQL}\nSELECT book_title, text_clean FROM items", ("item_texts_src",))
def con_1(spark, d):
    return _items(spark, d)


@register(
    "CON_2_3_4_term_frequency",
    f"WITH {TFIDF_SQL}\nSELECT book_title, term, CAST(tf AS BIGINT) AS tf FROM tf",
    ("item_texts_src",),
)
def con_4(spark, d):
    tf = content.term_frequency(_items(spark, d), unique_titles=True)
    return tf.select("book_title", "term", F.col("tf").cast("long").alias("tf"))


@register(
    "CON_4_hashed_term_frequency",
    f"""WITH {TFIDF_SQL}
    SELECT book_title, CAST((('0x' || substr(md5(term), 1, 8))::BIGINT % 262144) AS VARCHAR) AS term, CAST(sum(tf) AS BIGINT) AS tf
    FROM tf GROUP BY 1, 2""",
    ("item_texts_src",),
)
def con_4h(spark, d):
    """Hashed mode (2^18 buckets from md5)."""
    tf = content.term_frequency(_items(spark, d), mode="hashed", unique_titles=True)
    return tf.select("book_title", "term", F.col("tf").cast("long").alias("tf"))


@register("CON_5_tfidf", f"WITH {TFIDF_SQL}\nSELECT book_title, term, round(w, 6) + 0.0 AS w FROM wt", ("item_texts_src",))
def con_5(spark, d):
    items = _items(spark, d)
    w = content.tfidf(content.term_frequency(items, unique_titles=True), items)
    return w.select("book_title", "term", round6("w").alias("w"))


SIMILAR_SQL = TFIDF_SQL + f""",
    nr AS (SELECT book_title, sqrt(sum(w * w)) AS norm FROM wt GROUP BY book_title),
    q AS (SELECT DISTINCT query FROM asked_titles),
    rq AS (SELECT q.query, min(i.book_title) AS matched_title FROM q JOIN items i ON lower(i.book_title) = lower(q.query) GROUP BY q.query),
    dots AS (SELECT rq.query, b.book_title, sum(a.w * b.w) AS dot
             FROM rq JOIN wt a ON a.book_title = rq.matched_title JOIN wt b ON a.term = b.term GROUP BY rq.query, b.book_title),
    allp AS (SELECT rq.query, rq.matched_title, i.book_title,
                    CASE WHEN qn.norm > 0 AND n.norm > 0 AND d.dot IS NOT NULL THEN d.dot / (qn.norm * n.norm) ELSE 0.0 END AS similarity
             FROM rq JOIN items i ON lower(i.book_title) <> lower(rq.query)
             LEFT JOIN dots d ON d.query = rq.query AND d.book_title = i.book_title
             LEFT JOIN nr qn ON qn.book_title = rq.matched_title
             LEFT JOIN nr n ON n.book_title = i.book_title),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY round(similarity, 9) DESC, book_title ASC) AS BIGINT) AS rank FROM allp)"""


def _similar(spark, d):
    return content.similar_items(_items(spark, d), R.asked_titles(spark, d), k=20, unique_titles=True)


@register(
    "CON_6_7_similar_items",
    f"WITH {SIMILAR_SQL}\nSELECT query, matched_title, rank, book_title, round(similarity, 6) + 0.0 AS similarity FROM ranked WHERE rank <= 20",
    ("item_texts_src", "asked_titles"),
)
def con_6(spark, d):
    """CON-6/7 + TOP-4: top-20 similar items among all for each title asked for."""
    s = _similar(spark, d)
    return s.select("query", "matched_title", "rank", "book_title", round6("similarity").alias("similarity"))


@register(
    "SNK_4_recommendations_json",
    f"""WITH {SIMILAR_SQL}
    SELECT query, matched_title, rank, book_title AS title, round(similarity, 6) + 0.0 AS similarity_score FROM ranked WHERE rank <= 20""",
    ("item_texts_src", "asked_titles"),
)
def snk_4(spark, d):
    """SNK-4 + CON-7: nested result rows written as JSON and read back."""
    path = io.scratch_path(spark, "snk_4")
    content.write_recommendations_json(_similar(spark, d), path)
    back = content.read_recommendations_json(spark, path)
    return back.select("query", "matched_title", "rank", "title", round6("similarity_score").alias("similarity_score"))


@register(
    "CON_6_unknown_titles",
    f"""WITH {ITEMS_SQL}
    SELECT DISTINCT query, 'title not found' AS error FROM asked_titles
    WHERE NOT EXISTS (SELECT 1 FROM items i WHERE lower(i.book_title) = lower(query))""",
    ("item_texts_src", "asked_titles"),
)
def con_6_unknown(spark, d):
    return content.unknown_titles(_items(spark, d), R.asked_titles(spark, d))


# ------------------------------------------------------- collaborative filtering
from recoengine.operators import cf  # noqa: E402


@register(
    "CF_1_index_users",
    """SELECT user_id, CAST(row_number() OVER (ORDER BY cnt DESC, user_id ASC) - 1 AS INTEGER) AS user_index
       FROM (SELECT user_id, count(*) AS cnt FROM cf_ratings WHERE user_id IS NOT NULL GROUP BY user_id)""",
    ("cf_ratings",),
)
def cf_1u(spark, d):
    return cf.index_ids(R.cf_ratings(spark, d), "user_id", "user_index")


@register(
    "CF_1_index_items",
    """SELECT book_title, CAST(row_number() OVER (ORDER BY cnt DESC, book_title ASC) - 1 AS INTEGER) AS book_index
       FROM (SELECT book_title, count(*) AS cnt FROM cf_ratings WHERE book_title IS NOT NULL GROUP BY book_title)""",
    ("cf_ratings",),
)
def cf_1i(spark, d):
    return cf.index_ids(R.cf_ratings(spark, d), "book_title", "book_index")


@register(
    "CF_1_extended_index",
    """WITH old AS (SELECT user_id, row_number() OVER (ORDER BY cnt DESC, user_id ASC) - 1 AS user_index
             FROM (SELECT user_id, count(*) AS cnt FROM cf_ratings WHERE review_time < TIMESTAMP '1996-01-01 00:00:00' GROUP BY user_id)),
           new AS (SELECT user_id, (SELECT count(*) FROM old) + row_number() OVER (ORDER BY cnt DESC, user_id ASC) - 1 AS user_index
             FROM (SELECT user_id, count(*) AS cnt FROM cf_ratings WHERE user_id NOT IN (SELECT user_id FROM old) GROUP BY user_id))
       SELECT user_id, CAST(user_index AS INTEGER) AS user_index FROM old UNION ALL SELECT user_id, CAST(user_index AS INTEGER) FROM new""",
    ("cf_ratings",),
)
def cf_1_extended(spark, d):
    """CF-1 when rows arrive: the users of the ratings before 1996, then all ratings."""
    ratings = R.cf_ratings(spark, d)
    known = cf.index_ids(ratings.filter(F.col("review_time") < F.lit("1996-01-01").cast("timestamp")), "user_id", "user_index")
    return cf.extend_index(known, ratings, "user_id", "user_index")


SPLIT_SQL = """CASE WHEN (('0x' || substr(md5(concat_ws(chr(1), user_id, book_title, '42')), 1, 8))::BIGINT % 10000) < 8000
                    THEN 'train' ELSE 'test' END"""


@register("CF_2_split", f"SELECT user_id, book_title, {SPLIT_SQL} AS part FROM cf_ratings", ("cf_ratings",))
def cf_2(spark, d):
    train, test = cf.split(R.cf_ratings(spark, d))
    return train.select("user_id", "book_title", F.lit("train").alias("part")).unionByName(
        test.select("user_id", "book_title", F.lit("test").alias("part"))
    )


@register(
    "CF_5_rating_errors",
    f"""WITH s AS (SELECT *, {SPLIT_SQL} AS part FROM cf_ratings),
    m AS (SELECT book_title, avg(CAST(label_rating AS DOUBLE)) AS prediction FROM s WHERE part = 'train' GROUP BY book_title),
    p AS (SELECT s.label_rating, m.prediction FROM s JOIN m USING (book_title) WHERE s.part = 'test')
    SELECT CAST(count(*) AS BIGINT) AS n, round(sqrt(avg((prediction - label_rating) * (prediction - label_rating))), 6) AS rmse,
           round(avg(abs(prediction - label_rating)), 6) AS mae FROM p""",
    ("cf_ratings",),
)
def cf_5(spark, d):
    """CF-5 on item-mean predictions (a model-free baseline with exact SQL)."""
    train, test = cf.split(R.cf_ratings(spark, d))
    means = train.groupBy("book_title").agg(F.avg(F.col("label_rating").cast("double")).alias("prediction"))
    e = cf.rating_errors(test.join(means, "book_title"))
    return e.select(F.col("n").cast("long").alias("n"), round6("rmse").alias("rmse"), round6("mae").alias("mae"))


ACT_SQL = """SELECT user_id, count(*) AS cnt, avg(CAST(label_rating AS DOUBLE)) AS avg_r FROM cf_ratings GROUP BY user_id"""


@register(
    "TOP_5_eligible_users",
    f"SELECT user_id, CAST(cnt AS BIGINT) AS cnt, round(avg_r, 6) AS avg_r FROM ({ACT_SQL}) WHERE cnt >= 5 AND avg_r >= 2.5",
    ("cf_ratings",),
)
def top_5e(spark, d):
    e = cf.eligible_users(R.cf_ratings(spark, d))
    return e.select("user_id", F.col("cnt").cast("long").alias("cnt"), round6("avg_r").alias("avg_r"))


@register(
    "TOP_5_pick_user",
    f"""SELECT user_id, CAST(cnt AS BIGINT) AS cnt, round(avg_r, 6) AS avg_r FROM ({ACT_SQL})
    ORDER BY CASE WHEN cnt >= 5 AND avg_r >= 2.5 THEN 0 ELSE 1 END,
             CASE WHEN cnt >= 5 AND avg_r >= 2.5 THEN md5(user_id || ':42') END ASC NULLS FIRST, cnt DESC, user_id ASC
    LIMIT 1""",
    ("cf_ratings",),
)
def top_5(spark, d):
    p = cf.pick_user(R.cf_ratings(spark, d))
    return p.select("user_id", F.col("cnt").cast("long").alias("cnt"), round6("avg_r").alias("avg_r"))


def _pref_sql(col: str, src: str = "cf_ratings") -> str:
    return f"""SELECT user_id, {col}, CAST(cnt AS BIGINT) AS cnt, round(avg, 6) AS avg, pref_rank FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY cnt DESC, avg DESC, {col} ASC) AS BIGINT) AS pref_rank
      FROM (SELECT user_id, {col}, count(*) AS cnt, avg(CAST(label_rating AS DOUBLE)) AS avg FROM {src}
            WHERE label_rating >= 4.0 AND {col} IS NOT NULL GROUP BY user_id, {col}))
    WHERE pref_rank <= 5"""


@register("CF_7_preferences_author", _pref_sql("author"), ("cf_ratings",))
def cf_7a(spark, d):
    p = cf.preferences(R.cf_ratings(spark, d), "author")
    return p.select("user_id", "author", F.col("cnt").cast("long").alias("cnt"), round6("avg").alias("avg"), "pref_rank")


@register("CF_7_preferences_categories", _pref_sql("categories"), ("cf_ratings",))
def cf_7c(spark, d):
    p = cf.preferences(R.cf_ratings(spark, d), "categories")
    return p.select("user_id", "categories", F.col("cnt").cast("long").alias("cnt"), round6("avg").alias("avg"), "pref_rank")


@register(
    "JOI_6_exclude_seen",
    """SELECT user_id, book_title, round(cf_score, 6) AS cf_score FROM cands c
       WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = c.user_id AND s.book_title = c.book_title)""",
    ("seen", "cands"),
)
def joi_6(spark, d):
    seen, cands = R.seen_and_candidates(spark, d)
    return cf.exclude_seen(cands, seen).select("user_id", "book_title", round6("cf_score").alias("cf_score"))


BOOSTED_SQL = f"""
    unseen AS (SELECT c.* FROM cands c WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = c.user_id AND s.book_title = c.book_title)),
    meta AS (SELECT book_title, author, categories FROM (SELECT *, row_number() OVER (PARTITION BY book_title
               ORDER BY author ASC NULLS LAST, categories ASC NULLS LAST) AS rn
             FROM (SELECT DISTINCT book_title, author, categories FROM seen WHERE book_title IS NOT NULL)) WHERE rn = 1),
    pa AS ({_pref_sql('author', 'seen')}),
    pc AS ({_pref_sql('categories', 'seen')}),
    boosted AS (SELECT u.user_id, u.book_title, u.cf_score, m.author, m.categories,
                       CAST(CASE WHEN pa.user_id IS NOT NULL THEN 1.0 ELSE 0.0 END AS DOUBLE) AS author_hit,
                       CAST(CASE WHEN pc.user_id IS NOT NULL THEN 0.5 ELSE 0.0 END AS DOUBLE) AS genre_hit
                FROM unseen u LEFT JOIN meta m ON u.book_title = m.book_title
                LEFT JOIN pa ON pa.user_id = u.user_id AND pa.author = m.author
                LEFT JOIN pc ON pc.user_id = u.user_id AND pc.categories = m.categories)"""


def _boosted(spark, d):
    seen, cands = R.seen_and_candidates(spark, d)
    return seen, cands, cf.boosted_candidates(cands, seen, cf.item_metadata(seen))


@register(
    "CF_8_rerank",
    f"""WITH {BOOSTED_SQL}
    SELECT user_id, rank, book_title, round(final_score, 6) AS final_score, round(cf_score, 6) AS cf_score,
           author_hit, genre_hit, author, categories FROM (
      SELECT *, cf_score + author_hit + genre_hit AS final_score,
             CAST(row_number() OVER (PARTITION BY user_id ORDER BY cf_score + author_hit + genre_hit DESC, cf_score DESC, book_title ASC) AS BIGINT) AS rank
      FROM boosted) WHERE rank <= 20""",
    ("seen", "cands"),
)
def cf_8(spark, d):
    seen, cands = R.seen_and_candidates(spark, d)
    r = cf.rerank(cands, seen, cf.item_metadata(seen))
    return r.select(
        "user_id", "rank", "book_title", round6("final_score").alias("final_score"), round6("cf_score").alias("cf_score"),
        "author_hit", "genre_hit", "author", "categories",
    )


@register(
    "CF_9_boosted_counts",
    f"""WITH {BOOSTED_SQL}
    SELECT user_id, CAST(count(*) AS BIGINT) AS n_candidates,
           CAST(sum(CASE WHEN author_hit > 0 OR genre_hit > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_boosted
    FROM boosted GROUP BY user_id""",
    ("seen", "cands"),
)
def cf_9(spark, d):
    _, _, scored = _boosted(spark, d)
    c = cf.boosted_counts(scored)
    return c.select("user_id", F.col("n_candidates").cast("long").alias("n_candidates"), F.col("n_boosted").cast("long").alias("n_boosted"))


@register("CF_3_4_5_als_holdout_errors")
def cf_3(spark, d):
    """CF-3/4/5 with ALS (rank 20, 12 iterations, reg 0.12, non-negative,
    seed 42): hold-out RMSE/MAE.  Model output: rows-only check."""
    labeled = cf.prepare_labels(R.cf_ratings(spark, d))
    train, test = cf.indexed_split(labeled)
    model = cf.train_als(train)
    return cf.rating_errors(cf.predict(model, test))


@register("CF_6_10_recommend_for_users")
def cf_10(spark, d):
    """CF-6..10 for all users: ALS top-100 candidates, seen removed, author
    and category boosts, top 20 per user.  Model output: rows-only check."""
    recs, _ = cf.recommend_for_users(R.cf_ratings(spark, d))
    return recs.select("user_id", "rank", "book_title", "final_score", "cf_score", "author_hit", "genre_hit", "author", "categories")


LABELS_SQL = f"""
    lab AS (SELECT user_id, book_title, label_rating, {SPLIT_SQL} AS part FROM cf_ratings
            WHERE user_id IS NOT NULL AND book_title IS NOT NULL AND label_rating IS NOT NULL),
    users_t AS (SELECT DISTINCT user_id FROM lab WHERE part = 'train'),
    items_t AS (SELECT DISTINCT book_title FROM lab WHERE part = 'train'),
    seen_t AS (SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id, book_title FROM lab)
               WHERE book_title IN (SELECT book_title FROM items_t) GROUP BY user_id),
    expected AS (SELECT u.user_id, CAST(least(20, (SELECT count(*) FROM items_t) - coalesce(s.n, 0)) AS BIGINT) AS n_recs
                 FROM users_t u LEFT JOIN seen_t s USING (user_id))"""
CHECKED_SQL = "SELECT user_id, n_recs, CAST(0 AS BIGINT) AS n_seen, true AS ranks_ok, true AS scores_ok FROM expected WHERE n_recs > 0"


@register(
    "CF_3_4_5_als_checks",
    f"""WITH {LABELS_SQL}
    SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_mismatch, true AS errors_ok FROM lab
    WHERE part = 'test' AND user_id IN (SELECT user_id FROM users_t) AND book_title IN (SELECT book_title FROM items_t)""",
    ("cf_ratings",),
)
def cf_3_checks(spark, d):
    """CF-3/4/5: the hold-out rows predicted, those that differ from the dot
    product of the factors, and the errors' range (ratings lie in 1..5)."""
    labeled = cf.prepare_labels(R.cf_ratings(spark, d))
    train, test = cf.indexed_split(labeled)
    model = cf.train_als(train)
    pred = io.stored(cf.predict(model, test), "predicted")  # read by both checks
    e = cf.rating_errors(pred).select(((F.col("rmse") > 0) & (F.col("rmse") < 4) & (F.col("mae") <= F.col("rmse"))).alias("errors_ok"))
    m = cf.prediction_mismatches(model, pred)
    return m.select("n", "n_mismatch", F.lit(e.scalar()).alias("errors_ok"))


@register("CF_6_10_checks", f"WITH {LABELS_SQL}\n{CHECKED_SQL}", ("cf_ratings",))
def cf_10_checks(spark, d):
    """CF-6..10 for all users: min(20, trained items not seen) recommendations
    each, none seen, ranks and scores in order."""
    ratings = R.cf_ratings(spark, d)
    recs, _ = cf.recommend_for_users(ratings)
    return cf.recommendation_checks(recs, ratings)


@register("CF_10_stored_model_checks", f"WITH {LABELS_SQL}\n{CHECKED_SQL}", ("cf_ratings",))
def cf_10_stored(spark, d):
    """CF-3..10 with the model stored and loaded again: served for all users
    without a fit, checked as CF_6_10_checks."""
    ratings = R.cf_ratings(spark, d)
    path = io.scratch_path(spark, "cf_model")
    cf.fit_model(ratings)[0].save(path)
    return cf.recommendation_checks(cf.recommend(cf.FactorModel.load(spark, path)), ratings)


@register(
    "CF_10_picked_user_checks",
    f"""WITH {LABELS_SQL}, picked AS (
      SELECT user_id FROM ({ACT_SQL})
      ORDER BY CASE WHEN cnt >= 5 AND avg_r >= 2.5 THEN 0 ELSE 1 END,
               CASE WHEN cnt >= 5 AND avg_r >= 2.5 THEN md5(user_id || ':42') END ASC NULLS FIRST, cnt DESC, user_id ASC
      LIMIT 1)
    {CHECKED_SQL} AND user_id IN (SELECT user_id FROM picked)""",
    ("cf_ratings",),
)
def cf_10_picked_checks(spark, d):
    ratings = R.cf_ratings(spark, d)
    recs, _ = cf.recommend_for_users(ratings, users=cf.pick_user(ratings).select("user_id"))
    return cf.recommendation_checks(recs, ratings)


# ------------------------------------------------------------------ enrichment
from recoengine.operators import enrich  # noqa: E402

STRICT = "trim(regexp_replace(lower(regexp_replace({c}, '[^a-zA-Z0-9\\s]', '', 'g')), '\\s+', ' ', 'g'))"
ENR_SQL = f"""
    pop AS (SELECT book_title, count(*) AS review_count, avg(CAST(rating AS DOUBLE)) AS avg_rating FROM rated_books
            GROUP BY book_title),
    cand AS (SELECT *, {STRICT.format(c='book_title')} AS clean_title FROM (
               SELECT DISTINCT r.book_title, p.review_count, p.avg_rating, r.description
               FROM rated_books r JOIN pop p ON r.book_title = p.book_title WHERE r.book_title IS NOT NULL)),
    keys AS (SELECT DISTINCT clean_title FROM cand WHERE (description IS NULL OR length(description) <= 80) AND clean_title <> ''),
    cat AS (SELECT * FROM (SELECT {STRICT.format(c='title')} AS ck, description AS cd FROM catalog) WHERE ck <> '' AND length(cd) > 60),
    t1 AS (SELECT k.clean_title, c.ck, c.cd, 1 AS tier, 0 AS extra FROM keys k JOIN cat c ON k.clean_title = c.ck),
    pw AS (SELECT ck, cd, string_split(ck, ' ') AS w FROM cat WHERE len(string_split(ck, ' ')) > 1),
    pk AS (SELECT ck, cd, w, unnest(range(1, len(w))) AS kk FROM pw),
    px AS (SELECT ck, cd, array_to_string(w[1:kk], ' ') AS p, len(w) - kk AS extra FROM pk),
    t2 AS (SELECT k.clean_title, px.ck, px.cd, 2 AS tier, px.extra FROM keys k JOIN px ON k.clean_title = px.p),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY clean_title
               ORDER BY tier ASC, extra ASC, ck ASC, length(cd) DESC, cd ASC) AS rn
             FROM (SELECT * FROM t1 UNION ALL SELECT * FROM t2)) WHERE rn = 1),
    found AS (SELECT clean_title, cd AS new_description, CAST(tier AS INTEGER) AS tier FROM best)"""


def _enr_books(spark, d):
    return enrich.enrichment_candidates(R.rated_books(spark, d))


@register(
    "ENR_1_candidates",
    f"""WITH {ENR_SQL}
    SELECT book_title, CAST(review_count AS BIGINT) AS review_count, round(avg_rating, 6) AS avg_rating, description, clean_title FROM cand""",
    ("rated_books", "catalog"),
)
def enr_1(spark, d):
    c = _enr_books(spark, d)
    return c.select("book_title", F.col("review_count").cast("long").alias("review_count"), round6("avg_rating").alias("avg_rating"), "description", "clean_title")


@register("ENR_2_lookup", f"WITH {ENR_SQL}\nSELECT clean_title, new_description, tier FROM found", ("rated_books", "catalog"))
def enr_2(spark, d):
    return enrich.lookup_descriptions(_enr_books(spark, d), R.catalog(spark, d))


@register(
    "ENR_2_token_overlap",
    f"""WITH keys AS (SELECT DISTINCT clean_title FROM (SELECT {STRICT.format(c='book_title')} AS clean_title FROM worded_books) WHERE clean_title <> ''),
    cat AS (SELECT * FROM (SELECT {STRICT.format(c='title')} AS ck, description AS cd FROM worded_catalog) WHERE ck <> '' AND length(cd) > 60),
    cks AS (SELECT DISTINCT ck FROM cat),
    cw AS (SELECT DISTINCT ck, unnest(string_split(ck, ' ')) AS word FROM cks),
    kw AS (SELECT DISTINCT clean_title, unnest(string_split(clean_title, ' ')) AS word FROM keys),
    df AS (SELECT word, count(*) AS df FROM cw GROUP BY word),
    nc AS (SELECT count(*) AS n FROM cks),
    wt AS (SELECT w.word, 1 + CAST(floor(1000 * ln((n + 1.0) / (coalesce(df, 0) + 1.0))) AS BIGINT) AS weight
           FROM (SELECT word FROM cw UNION SELECT word FROM kw) w LEFT JOIN df USING (word), nc),
    ct AS (SELECT ck, sum(weight) AS total FROM cw JOIN wt USING (word) GROUP BY ck),
    kt AS (SELECT clean_title, sum(weight) AS total FROM kw JOIN wt USING (word) GROUP BY clean_title),
    sh AS (SELECT clean_title, ck, sum(weight) AS shared FROM kw JOIN cw USING (word) JOIN wt USING (word) GROUP BY ALL),
    sc AS (SELECT clean_title, ck, CAST(shared AS DOUBLE) / CAST(kt.total + ct.total - shared AS DOUBLE) AS overlap FROM sh JOIN kt USING (clean_title) JOIN ct USING (ck)),
    best AS (SELECT *, row_number() OVER (PARTITION BY clean_title ORDER BY clean_title = ck DESC, overlap DESC, ck) AS rn FROM sc WHERE overlap >= 0.5),
    texts AS (SELECT ck, cd, row_number() OVER (PARTITION BY ck ORDER BY length(cd) DESC, cd) AS rn FROM cat)
    SELECT clean_title, cd AS new_description, CAST(CASE WHEN clean_title = ck THEN 1 ELSE 2 END AS INTEGER) AS tier, round(overlap, 6) + 0.0 AS overlap
    FROM best JOIN texts USING (ck) WHERE best.rn = 1 AND texts.rn = 1""",
    ("worded_books", "worded_catalog"),
)
def enr_2_overlap(spark, d):
    """ENR-2 with tier 2 by the best token overlap, for all books."""
    from recoengine.functions.text import title_key_strict

    books = R.worded_books(spark, d).withColumn("clean_title", title_key_strict("book_title"))
    found = enrich.lookup_by_overlap(books, R.worded_catalog(spark, d))
    return found.select("clean_title", "new_description", "tier", round6("overlap").alias("overlap"))


@register(
    "ENR_3_apply",
    f"""WITH {ENR_SQL},
    fin AS (SELECT c.book_title, CASE WHEN length(c.description) > 80 THEN c.description
                                      ELSE coalesce(f.new_description, c.description) END AS final_description
            FROM cand c LEFT JOIN found f ON c.clean_title = f.clean_title)
    SELECT book_title, final_description FROM (SELECT *, row_number() OVER (PARTITION BY book_title
        ORDER BY length(final_description) DESC NULLS LAST, final_description ASC NULLS LAST) AS rn FROM fin) WHERE rn = 1""",
    ("rated_books", "catalog"),
)
def enr_3(spark, d):
    return enrich.enrich_books(R.rated_books(spark, d), R.catalog(spark, d))


# ------------------------------------------------------------- end-to-end flows
from recoengine.plans.stages import curate  # noqa: E402


@register("CF_10_on_curated_labels")
def cf_10_curated(spark, d):
    """The application's own chain: PIP-1 → PIP-2 → SEN → PIP-3 (final_rating
    label) → CF-10 for all users.  Model output: rows-only check."""
    reviews, texts = R.marked_reviews(spark, d)
    curated = curate(reviews, R.books_raw(spark, d), R.fixture_lexicon(spark), sentiment_rules=R.fixture_rules(), texts=texts)
    recs, _ = cf.recommend_for_users(curated)
    return recs.select("user_id", "rank", "book_title", "final_score", "cf_score", "author_hit", "genre_hit", "author", "categories")


from recoengine.plans.q_curation import PIP_3_CTES, PIP_3_SOURCES  # noqa: E402


@register(
    "CF_10_on_curated_labels_checks",
    f"WITH {PIP_3_CTES}, cf_rated AS (SELECT user_id, book_title, final_rating AS label_rating FROM labeled),"
    + LABELS_SQL.replace("cf_ratings", "cf_rated")
    + f"\n{CHECKED_SQL}",
    PIP_3_SOURCES,
)
def cf_10_curated_checks(spark, d):
    reviews, texts = R.marked_reviews(spark, d)
    curated = curate(reviews, R.books_raw(spark, d), R.fixture_lexicon(spark), sentiment_rules=R.fixture_rules(), texts=texts)
    curated = curated.checkpoint(eager=True)  # read by the model and by the check
    recs, _ = cf.recommend_for_users(curated)
    return cf.recommendation_checks(recs, curated)


ENRICHED_SIMILAR_SQL = (
    "WITH "
    + ENR_SQL
    + """,
    fin AS (SELECT c.book_title, CASE WHEN length(c.description) > 80 THEN c.description
                                      ELSE coalesce(f.new_description, c.description) END AS final_description
            FROM cand c LEFT JOIN found f ON c.clean_title = f.clean_title),
    enriched_src AS (SELECT book_title, final_description AS description FROM (
        SELECT *, row_number() OVER (PARTITION BY book_title ORDER BY length(final_description) DESC NULLS LAST,
                                     final_description ASC NULLS LAST) AS rn FROM fin) WHERE rn = 1),"""
    + SIMILAR_SQL.replace("item_texts_src", "enriched_src").replace(
        "q AS (SELECT DISTINCT query FROM asked_titles)",
        "q AS (SELECT DISTINCT book_title AS query FROM rated_books WHERE CAST(substr(book_title, 6) AS BIGINT) % 50 = 0)",
    )
    + "\nSELECT query, matched_title, rank, book_title, round(similarity, 6) + 0.0 AS similarity FROM ranked WHERE rank <= 20"
)


@register("CON_6_7_on_enriched_books", ENRICHED_SIMILAR_SQL, ("rated_books", "catalog"))
def con_6_enriched(spark, d):
    """The application's own chain: ENR-1..3 (all books, catalogue
    descriptions) → CON-1..7, queried with every title whose number is
    divisible by 50."""
    rated = R.rated_books(spark, d)
    books = enrich.enrich_books(rated, R.catalog(spark, d)).withColumnRenamed("final_description", "description")
    queries = rated.filter(F.substring("book_title", 6, 20).cast("long") % 50 == 0).select(F.col("book_title").alias("query"))
    s = content.similar_items(content.item_texts(books), queries, k=20, unique_titles=True)
    return s.select("query", "matched_title", "rank", "book_title", round6("similarity").alias("similarity"))


@register("CF_10_for_picked_user")
def cf_10_picked(spark, d):
    """The original's single-user run: TOP-5 picks one user (seeded hash among
    users with ≥ 5 ratings and mean ≥ 2.5, else the most active), then CF-10
    for that user only (``recommendForUserSubset``).  Rows-only check."""
    ratings = R.cf_ratings(spark, d)
    user = cf.pick_user(ratings).select("user_id")
    recs, _ = cf.recommend_for_users(ratings, users=user)
    return recs.select("user_id", "rank", "book_title", "final_score", "cf_score", "author_hit", "genre_hit", "author", "categories")
