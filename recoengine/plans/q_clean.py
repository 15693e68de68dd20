"""Queries for cleaning, dedup, thinning, profiling and top-k (PRJ, FLT,
WIN, SET, THN, AGG, TOP-1/2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recoengine.functions.numeric import round6
from recoengine.operators import dedup, filters, profile
from recoengine.operators.enrich import top_popular
from recoengine.plans import roles as R
from recoengine.plans.queries import register

WIN1_ORDER_SQL = (
    "review_time DESC NULLS LAST, rating DESC NULLS LAST, "
    "l_orderkey ASC NULLS LAST, l_linenumber ASC NULLS LAST, l_suppkey ASC NULLS LAST, l_extendedprice ASC NULLS LAST"
)


def deduped(spark, d):
    return dedup.dedup_latest(
        filters.valid_ratings(R.interactions(spark, d)), tie_breakers=R.INTERACTION_TIE_BREAKERS
    )


def thinned(spark, d, columns, min_user, min_item):
    rows = filters.valid_ratings(R.interactions(spark, d))
    return dedup.dedup_thinned(rows, columns, min_user, min_item, tie_breakers=R.INTERACTION_TIE_BREAKERS)


DEDUPED_SQL = f"""
    deduped AS (
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, book_title ORDER BY {WIN1_ORDER_SQL}) AS rn
        FROM interactions WHERE rating IS NOT NULL AND rating >= 1 AND rating <= 5)
      WHERE rn = 1)"""


@register(
    "TOP_1_top_popular",
    f"""WITH {DEDUPED_SQL},
    u AS (SELECT user_id FROM deduped GROUP BY user_id HAVING count(*) >= 3),
    t1 AS (SELECT * FROM deduped WHERE user_id IN (SELECT user_id FROM u)),
    b AS (SELECT book_title FROM t1 GROUP BY book_title HAVING count(*) >= 3),
    t2 AS (SELECT * FROM t1 WHERE book_title IN (SELECT book_title FROM b))
    SELECT book_title, CAST(count(*) AS BIGINT) AS review_count, round(avg(CAST(rating AS DOUBLE)), 6) AS avg_rating
    FROM t2 GROUP BY book_title
    ORDER BY review_count DESC, avg(CAST(rating AS DOUBLE)) DESC, book_title LIMIT 400""",
    ("interactions",),
)
def top_1(spark, d):
    """Flagship slice: FLT-1 → WIN-1 → THN-1 → AGG-8 → TOP-1."""
    top = top_popular(thinned(spark, d, ["book_title", "rating"], 3, 3), 400)
    return top.select("book_title", F.col("review_count").cast("long").alias("review_count"), round6("avg_rating").alias("avg_rating"))


@register(
    "WIN_1_dedup_latest",
    f"""WITH {DEDUPED_SQL}
    SELECT user_id, book_title, CAST(rating AS DOUBLE) AS rating, review_time, l_orderkey, l_linenumber FROM deduped""",
    ("interactions",),
)
def win_1(spark, d):
    return deduped(spark, d).select(
        "user_id", "book_title", F.col("rating").cast("double").alias("rating"), "review_time", "l_orderkey", "l_linenumber"
    )


def _thin_sql(mu: int, mi: int) -> str:
    return f"""WITH {DEDUPED_SQL},
    u AS (SELECT user_id FROM deduped GROUP BY user_id HAVING count(*) >= {mu}),
    t1 AS (SELECT * FROM deduped WHERE user_id IN (SELECT user_id FROM u)),
    b AS (SELECT book_title FROM t1 GROUP BY book_title HAVING count(*) >= {mi})
    SELECT user_id, book_title, l_orderkey, l_linenumber FROM t1 WHERE book_title IN (SELECT book_title FROM b)"""


@register("THN_1_thin_sparse_30_28", _thin_sql(30, 28), ("interactions",))
def thn_1(spark, d):
    """THN-1 with thresholds that bite on the driver data (FIXTURES.md)."""
    return thinned(spark, d, ["user_id", "book_title", "l_orderkey", "l_linenumber"], 30, 28)


@register("THN_1_thin_sparse_3_3", _thin_sql(3, 3), ("interactions",))
def thn_1_default(spark, d):
    return thinned(spark, d, ["user_id", "book_title", "l_orderkey", "l_linenumber"], 3, 3)


@register(
    "FLT_1_valid_ratings",
    """SELECT user_id, book_title, CAST(r AS DOUBLE) AS rating, l_orderkey, l_linenumber
       FROM (SELECT *, CAST(l_quantity / 10 AS FLOAT) AS r FROM interactions)
       WHERE r IS NOT NULL AND r >= 1 AND r <= 5""",
    ("interactions",),
)
def flt_1(spark, d):
    df = R.interactions(spark, d).withColumn("rating", (F.col("l_quantity") / 10).cast("float"))
    return filters.valid_ratings(df).select(
        "user_id", "book_title", F.col("rating").cast("double").alias("rating"), "l_orderkey", "l_linenumber"
    )


@register(
    "AGG_8_popularity",
    """SELECT book_title, CAST(count(*) AS BIGINT) AS review_count, round(avg(CAST(rating AS DOUBLE)), 6) AS avg_rating
       FROM interactions GROUP BY book_title""",
    ("interactions",),
)
def agg_8(spark, d):
    p = profile.popularity(R.interactions(spark, d))
    return p.select("book_title", F.col("review_count").cast("long").alias("review_count"), round6("avg_rating").alias("avg_rating"))


# ---------------------------------------------------------------- projections
from recoengine.functions.numeric import to_float  # noqa: E402
from recoengine.functions.text import similarity_text, title_key, title_key_strict  # noqa: E402
from recoengine.operators import columns as C  # noqa: E402
from recoengine.operators.cf import user_history  # noqa: E402
from recoengine.operators.ranking import first_per_key  # noqa: E402
from recoengine.plans.stages import preprocess_stage, stage_funnel  # noqa: E402


@register(
    "PRJ_1_4_normalize_select",
    """SELECT "User_id" AS user_id, "Title" AS book_title, "review/score" AS rating,
              "profileName" AS profile_name, "review/time" AS review_time,
              "review/helpfulness" AS review_helpfulness
       FROM reviews_raw""",
    ("reviews_raw",),
)
def prj_1(spark, d):
    df = C.normalize_columns(R.reviews_raw(spark, d), C.REVIEW_ALIASES)
    return C.select_existing(df, ["user_id", "book_title", "rating", "profile_name", "review_time", "review_helpfulness", "authors"])


@register(
    "PRJ_5_null_sentinels",
    """SELECT "Title",
              CASE WHEN authors IN ('', 'N/A', 'null') THEN NULL ELSE authors END AS authors,
              CASE WHEN categories IN ('', 'N/A', 'null') THEN NULL ELSE categories END AS categories,
              CASE WHEN description IN ('', 'N/A', 'null') THEN NULL ELSE description END AS description
       FROM books_raw""",
    ("books_raw",),
)
def prj_5(spark, d):
    df = C.null_sentinels(R.books_raw(spark, d), ["authors", "categories", "description"])
    return df.select("Title", "authors", "categories", "description")


@register(
    "PRJ_6_title_key",
    """SELECT "Title", lower(trim(regexp_replace("Title", '[^\\w\\s]', '', 'g'))) AS title_key FROM books_raw
       UNION ALL
       SELECT "Title", lower(trim(regexp_replace("Title", '[^\\w\\s]', '', 'g'))) FROM reviews_raw""",
    ("books_raw", "reviews_raw"),
)
def prj_6(spark, d):
    b = R.books_raw(spark, d).select("Title")
    r = R.reviews_raw(spark, d).select("Title")
    return b.unionByName(r).select("Title", title_key("Title").alias("title_key"))


@register(
    "PRJ_7_title_key_strict",
    """SELECT title, trim(regexp_replace(lower(regexp_replace(title, '[^a-zA-Z0-9\\s]', '', 'g')), '\\s+', ' ', 'g')) AS clean_title
       FROM (SELECT "Title" AS title FROM books_raw UNION ALL SELECT title FROM catalog)""",
    ("books_raw", "catalog"),
)
def prj_7(spark, d):
    t = R.books_raw(spark, d).select(F.col("Title").alias("title")).unionByName(R.catalog(spark, d).select("title"))
    return t.select("title", title_key_strict("title").alias("clean_title"))


@register(
    "PRJ_8_similarity_text",
    """SELECT book_title,
              trim(regexp_replace(regexp_replace(lower(concat_ws(' ', description, book_title)), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS text_clean
       FROM item_texts_src""",
    ("item_texts_src",),
)
def prj_8(spark, d):
    return R.item_texts_src(spark, d).select("book_title", similarity_text("description", "book_title").alias("text_clean"))


@register(
    "PRJ_9_to_float",
    """SELECT "review/score" AS raw_score, CAST(TRY_CAST("review/score" AS FLOAT) AS DOUBLE) AS rating FROM reviews_raw""",
    ("reviews_raw",),
)
def prj_9(spark, d):
    df = R.reviews_raw(spark, d)
    return df.select(F.col("review/score").alias("raw_score"), to_float("review/score").cast("double").alias("rating"))


@register(
    "PRJ_10_11_scrub_metadata",
    """SELECT "Title",
              CASE WHEN authors IS NOT NULL AND length(authors) < 150
                        AND NOT regexp_matches(authors, '(?i)(review|amazon|page|chapter|purchase|bought|read this)')
                   THEN trim(authors) END AS authors,
              CASE WHEN categories IS NOT NULL AND length(categories) < 100
                        AND NOT regexp_matches(categories, '(?i)(review|amazon|page|chapter|purchase)')
                   THEN trim(categories) END AS categories
       FROM books_raw""",
    ("books_raw",),
)
def prj_10(spark, d):
    df = C.scrub_categories(C.scrub_authors(R.books_raw(spark, d)))
    return df.select("Title", "authors", "categories")


@register(
    "PRJ_12_unbracket",
    """SELECT "Title",
              CASE WHEN length(trim(a)) = 0 OR length(a) > 150 THEN NULL ELSE trim(a) END AS author,
              CASE WHEN length(trim(c)) = 0 OR length(c) > 100 THEN NULL ELSE trim(c) END AS categories
       FROM (SELECT "Title", regexp_replace(authors, '[\\[\\]''"]', '', 'g') AS a,
                    regexp_replace(categories, '[\\[\\]''"]', '', 'g') AS c FROM books_raw)""",
    ("books_raw",),
)
def prj_12(spark, d):
    df = C.unbracket(R.books_raw(spark, d), "authors", 150, out="author")
    df = C.unbracket(df, "categories", 100)
    return df.select("Title", "author", "categories")


@register(
    "PRJ_15_description_or_title",
    """SELECT book_title, CASE WHEN description IS NULL OR length(description) < 20 THEN book_title ELSE description END AS description
       FROM part_descriptions""",
    ("part_descriptions",),
)
def prj_15(spark, d):
    return C.description_or_title(R.part_descriptions(spark, d)).select("book_title", "description")


# -------------------------------------------------------------------- filters
@register(
    "FLT_2_drop_missing",
    """SELECT "User_id" AS user_id, "Title" AS book_title, "review/time" AS review_time, "review/helpfulness" AS review_helpfulness
       FROM reviews_raw WHERE "User_id" IS NOT NULL AND "Title" IS NOT NULL AND "review/time" IS NOT NULL""",
    ("reviews_raw",),
)
def flt_2(spark, d):
    df = C.normalize_columns(R.reviews_raw(spark, d), C.REVIEW_ALIASES)
    return filters.drop_missing(df, ["user_id", "book_title", "review_time"]).select(
        "user_id", "book_title", "review_time", "review_helpfulness"
    )


@register(
    "FLT_3_min_text_length",
    """SELECT id, CAST(length(review_text) AS BIGINT) AS n_chars FROM review_texts WHERE length(review_text) >= 10""",
    ("review_texts",),
)
def flt_3(spark, d):
    df = filters.min_text_length(R.review_texts(spark, d), "review_text", 10)
    return df.select("id", F.length("review_text").cast("long").alias("n_chars"))


@register(
    "FLT_4_find_title",
    """SELECT book_title, CAST(length(description) AS BIGINT) AS n_chars FROM item_texts_src WHERE lower(book_title) = lower('DOC 7')""",
    ("item_texts_src",),
)
def flt_4(spark, d):
    df = filters.find_title(R.item_texts_src(spark, d), "DOC 7")
    return df.select("book_title", F.length("description").cast("long").alias("n_chars"))


@register(
    "FLT_4_find_title_complement",
    """SELECT book_title FROM item_texts_src WHERE lower(book_title) <> lower('DOC 7')""",
    ("item_texts_src",),
)
def flt_4n(spark, d):
    return filters.find_title(R.item_texts_src(spark, d), "DOC 7", negate=True).select("book_title")


# ----------------------------------------------------------------- set / top
@register(
    "SET_2_first_per_key",
    """SELECT title_key, "Title", description FROM (
         SELECT *, row_number() OVER (PARTITION BY title_key
                   ORDER BY length(description) DESC NULLS LAST, "Title" ASC NULLS LAST, description ASC NULLS LAST) AS rn
         FROM (SELECT lower(trim(regexp_replace("Title", '[^\\w\\s]', '', 'g'))) AS title_key, "Title", description FROM books_raw))
       WHERE rn = 1""",
    ("books_raw",),
)
def set_2(spark, d):
    df = R.books_raw(spark, d).select(title_key("Title").alias("title_key"), "Title", "description")
    order = [F.length("description").desc_nulls_last(), F.col("Title").asc_nulls_last(), F.col("description").asc_nulls_last()]
    return first_per_key(df, ["title_key"], order)


@register(
    "TOP_2_user_history",
    f"""WITH {DEDUPED_SQL}
    SELECT user_id, rnk, book_title, CAST(rating AS DOUBLE) AS rating FROM (
      SELECT user_id, book_title, rating,
             CAST(row_number() OVER (PARTITION BY user_id ORDER BY rating DESC NULLS LAST, book_title ASC) AS BIGINT) AS rnk
      FROM deduped) WHERE rnk <= 15""",
    ("interactions",),
)
def top_2(spark, d):
    df = deduped(spark, d)
    out = user_history(df, n=15, label_col="rating")
    return out.select("user_id", F.col("rank").alias("rnk"), "book_title", F.col("rating").cast("double").alias("rating"))


# ---------------------------------------------------------------- aggregates
@register(
    "AGG_1_2_dataset_stats",
    """SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
              CAST(count(DISTINCT book_title) AS BIGINT) AS n_items,
              round((1 - count(*) / greatest(1.0, CAST(count(DISTINCT user_id) AS DOUBLE) * count(DISTINCT book_title))) * 100.0, 6) AS sparsity_pct
       FROM interactions""",
    ("interactions",),
)
def agg_1(spark, d):
    return profile.dataset_stats(R.interactions(spark, d))


@register(
    "AGG_3_rating_histogram",
    """SELECT CAST(CAST(l_quantity / 10 AS FLOAT) AS DOUBLE) AS rating, CAST(count(*) AS BIGINT) AS n FROM interactions GROUP BY 1""",
    ("interactions",),
)
def agg_3(spark, d):
    df = R.interactions(spark, d).select((F.col("l_quantity") / 10).cast("float").cast("double").alias("rating"))
    h = profile.rating_histogram(df, "rating")
    return h.select("rating", F.col("n").cast("long").alias("n"))


@register(
    "AGG_4_coverage",
    """WITH b AS (SELECT CASE WHEN authors IN ('', 'N/A', 'null') THEN NULL ELSE authors END AS authors,
                         CASE WHEN categories IN ('', 'N/A', 'null') THEN NULL ELSE categories END AS categories,
                         CASE WHEN description IN ('', 'N/A', 'null') THEN NULL ELSE description END AS description
                  FROM books_raw)
       SELECT 'authors' AS "column", CAST(count(authors) AS BIGINT) AS non_null, CAST(count(*) AS BIGINT) AS total,
              round(count(authors) * 100.0 / count(*), 6) AS pct FROM b
       UNION ALL SELECT 'categories', count(categories), count(*), round(count(categories) * 100.0 / count(*), 6) FROM b
       UNION ALL SELECT 'description', count(description), count(*), round(count(description) * 100.0 / count(*), 6) FROM b""",
    ("books_raw",),
)
def agg_4(spark, d):
    df = C.null_sentinels(R.books_raw(spark, d), ["authors", "categories", "description"])
    return profile.coverage(df, ["authors", "categories", "description"])


SUMMARY_SQL = """SELECT CAST(count(x) AS BIGINT) AS count, round(avg(x), 6) + 0.0 AS mean, round(stddev_samp(x), 6) + 0.0 AS stddev,
       round(min(x), 6) + 0.0 AS min, round(quantile_cont(x, 0.25), 6) + 0.0 AS q25, round(quantile_cont(x, 0.5), 6) + 0.0 AS q50,
       round(quantile_cont(x, 0.75), 6) + 0.0 AS q75, round(max(x), 6) + 0.0 AS max FROM ({src})"""


@register(
    "AGG_5_text_length_summary",
    SUMMARY_SQL.format(src="SELECT CAST(length(review_text) AS DOUBLE) AS x FROM review_texts"),
    ("review_texts",),
)
def agg_5(spark, d):
    return profile.numeric_summary(R.review_texts(spark, d), F.length("review_text"))


@register(
    "AGG_6_user_count_summary",
    SUMMARY_SQL.format(src="SELECT CAST(count(*) AS DOUBLE) AS x FROM interactions GROUP BY user_id"),
    ("interactions",),
)
def agg_6u(spark, d):
    return profile.group_size_summary(R.interactions(spark, d), "user_id")


@register(
    "AGG_6_item_count_summary",
    SUMMARY_SQL.format(src="SELECT CAST(count(*) AS DOUBLE) AS x FROM interactions GROUP BY book_title"),
    ("interactions",),
)
def agg_6i(spark, d):
    return profile.group_size_summary(R.interactions(spark, d), "book_title")


@register(
    "AGG_6_label_summary",
    SUMMARY_SQL.format(src="SELECT CAST(label_rating AS DOUBLE) AS x FROM event_interactions"),
    ("event_interactions",),
)
def agg_6l(spark, d):
    """Label values are high-cardinality doubles: exact quartiles by distributed rank."""
    return profile.numeric_summary(R.event_interactions(spark, d), F.col("label_rating"), method="distributed")


FUNNEL_SQL = """WITH n AS (SELECT "User_id" AS user_id, "Title" AS book_title, TRY_CAST("review/score" AS FLOAT) AS rating,
                            "review/text" AS review_text, "review/time" AS review_time, "profileName" AS profile_name FROM reviews_raw),
  s1 AS (SELECT * FROM n WHERE rating IS NOT NULL AND rating >= 1 AND rating <= 5),
  s2 AS (SELECT * FROM s1 WHERE user_id IS NOT NULL AND book_title IS NOT NULL AND review_text IS NOT NULL AND rating IS NOT NULL),
  s3 AS (SELECT * FROM s2 WHERE length(review_text) >= 10),
  s4 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, book_title
           ORDER BY review_time DESC NULLS LAST, rating DESC NULLS LAST, review_text ASC NULLS LAST, profile_name ASC NULLS LAST) AS rn
         FROM s3) WHERE rn = 1),
  s5 AS (SELECT * FROM s4 WHERE user_id IN (SELECT user_id FROM s4 GROUP BY user_id HAVING count(*) >= 3)),
  s6 AS (SELECT * FROM s5 WHERE book_title IN (SELECT book_title FROM s5 GROUP BY book_title HAVING count(*) >= 3)),
  c AS (SELECT 0 AS seq, 'input' AS step, count(*) AS rows FROM n
        UNION ALL SELECT 1, 'valid_ratings', count(*) FROM s1
        UNION ALL SELECT 2, 'essentials', count(*) FROM s2
        UNION ALL SELECT 3, 'min_text_length', count(*) FROM s3
        UNION ALL SELECT 4, 'dedup', count(*) FROM s4
        UNION ALL SELECT 5, 'thin_users', count(*) FROM s5
        UNION ALL SELECT 6, 'thin_items', count(*) FROM s6)
SELECT CAST(a.seq AS INTEGER) AS seq, a.step, CAST(b.rows AS BIGINT) AS rows_in, CAST(a.rows AS BIGINT) AS rows_out,
       CAST(b.rows - a.rows AS BIGINT) AS removed
FROM c a JOIN c b ON a.seq = b.seq + 1"""


@register("AGG_7_funnel", FUNNEL_SQL, ("reviews_raw",))
def agg_7(spark, d):
    return stage_funnel(R.reviews_raw(spark, d), 3, 3)


@register("AGG_7_observed_funnel", FUNNEL_SQL, ("reviews_raw",))
def agg_7_observed(spark, d):
    """The same counts, taken while the stage's result is written: one execution."""
    counts = profile.StepCounts()
    reviews, texts = R.marked_reviews(spark, d)
    kept = preprocess_stage(reviews, 3, 3, counts=counts)
    path = io.scratch_path(spark, "observed-funnel")
    io.write_parquet(kept, f"{path}/rows")
    io.write_parquet(texts, f"{path}/texts")  # by place, each once
    return counts.funnel(spark)


@register(
    "AGG_9_user_activity",
    """SELECT user_id, CAST(count(*) AS BIGINT) AS cnt, round(avg(label_rating), 6) + 0.0 AS avg_r FROM event_interactions GROUP BY user_id""",
    ("event_interactions",),
)
def agg_9(spark, d):
    a = profile.user_activity(R.event_interactions(spark, d))
    return a.select("user_id", F.col("cnt").cast("long").alias("cnt"), round6("avg_r").alias("avg_r"))


@register(
    "AGG_11_distinct_values",
    """SELECT DISTINCT authors FROM (SELECT CASE WHEN authors IN ('', 'N/A', 'null') THEN NULL ELSE authors END AS authors FROM books_raw)
       WHERE authors IS NOT NULL ORDER BY authors LIMIT 10""",
    ("books_raw",),
)
def agg_11(spark, d):
    df = C.null_sentinels(R.books_raw(spark, d), ["authors"])
    return profile.distinct_values(df, "authors", 10)


# ------------------------------------------------------------ sources / sinks
from recoengine.sources import io  # noqa: E402

DOC_SCHEMA = "id long, review_text string, lang string"


@register(
    "SRC_1_SNK_1_csv_round_trip",
    """SELECT doc_id AS id, CASE WHEN doc_id % 50 = 7 THEN NULL ELSE text END AS review_text, lang FROM documents""",
)
def src_1(spark, d):
    """SNK-1 then SRC-1: texts with quotes, commas and line breaks survive a
    CSV round trip (multiLine, quote escaping, untrimmed values)."""
    docs = R.review_texts(spark, d).join(R.table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang"), "id")
    path = io.scratch_path(spark, "csv")
    io.write_csv(docs.select("id", "review_text", "lang"), path, balance=True)
    return io.read_csv(spark, path, DOC_SCHEMA)


@register(
    "SRC_2_SNK_2_parquet_round_trip",
    f"""WITH {DEDUPED_SQL} SELECT user_id, book_title, CAST(rating AS DOUBLE) AS rating, review_time FROM deduped""",
    ("interactions",),
)
def src_2(spark, d):
    """SNK-2 (partitioned by rating, rebalanced files) then SRC-2."""
    path = io.scratch_path(spark, "parquet")
    io.write_parquet(deduped(spark, d).select("user_id", "book_title", "rating", "review_time"), path, balance=True, partition_by=["rating"])
    back = io.read_parquet(spark, path)
    return back.select("user_id", "book_title", F.col("rating").cast("double").alias("rating"), "review_time")


@register(
    "SNK_2_staged_overwrite",
    f"""WITH {DEDUPED_SQL} SELECT user_id, book_title, CAST(rating AS DOUBLE) AS rating FROM deduped WHERE rating >= 3""",
    ("interactions",),
)
def snk_2_staged(spark, d):
    """SNK-2 over the path that the rows are read from: staged, counted, then switched."""
    path = io.scratch_path(spark, "overwritten")
    io.write_table(deduped(spark, d).select("user_id", "book_title", "rating"), path)
    liked = io.read_parquet(spark, path).filter("rating >= 3")
    io.write_table(liked, path, staged=True)
    return io.read_parquet(spark, path).select("user_id", "book_title", F.col("rating").cast("double").alias("rating"))


@register("SRC_3_read_first_available", "SELECT * FROM part")
def src_3(spark, d):
    """SRC-3: a missing Parquet path is skipped, the next source is read."""
    return io.read_first_available(spark, [("parquet", f"{d}/no_such_table.parquet"), ("parquet", f"{d}/part.parquet")])


@register(
    "SRC_4_cap_rows",
    """SELECT user_id, book_title, l_orderkey, l_linenumber, l_suppkey FROM interactions
       ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice, user_id, book_title LIMIT 1000""",
    ("interactions",),
)
def src_4(spark, d):
    """SRC-4: an ordered row cap (the cap is the feature)."""
    order = ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "user_id", "book_title")
    return io.cap_rows(R.interactions(spark, d), 1000, order).select("user_id", "book_title", "l_orderkey", "l_linenumber", "l_suppkey")


@register(
    "SRC_4_cap_rows_large",
    """SELECT user_id, book_title, l_orderkey, l_linenumber, l_suppkey FROM interactions
       ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice, user_id, book_title LIMIT 20000""",
    ("interactions",),
)
def src_4_large(spark, d):
    """SRC-4 with a larger cap: the same path."""
    order = ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "user_id", "book_title")
    return io.cap_rows(R.interactions(spark, d), 20000, order).select("user_id", "book_title", "l_orderkey", "l_linenumber", "l_suppkey")


@register(
    "AGG_7_nulled_counts",
    """SELECT 'authors' AS "column", CAST(count(authors) - count(CASE WHEN authors IS NOT NULL AND length(authors) < 150
              AND NOT regexp_matches(authors, '(?i)(review|amazon|page|chapter|purchase|bought|read this)') THEN 1 END) AS BIGINT) AS nulled
       FROM books_raw
       UNION ALL
       SELECT 'categories', CAST(count(categories) - count(CASE WHEN categories IS NOT NULL AND length(categories) < 100
              AND NOT regexp_matches(categories, '(?i)(review|amazon|page|chapter|purchase)') THEN 1 END) AS BIGINT)
       FROM books_raw""",
    ("books_raw",),
)
def agg_7_nulled(spark, d):
    """AGG-7 companion: values the PRJ-10/11 scrub turned into NULL, one pass each."""
    raw = R.books_raw(spark, d)
    return profile.nulled_counts(raw, C.scrub_categories(C.scrub_authors(raw)), ["authors", "categories"])
