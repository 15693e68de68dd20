"""Role views: the driver's tables mapped to the frames our operators take.

Each builder reads the given Parquet tables (or frames Spark derives from
them), so the work grows with the tables.  The same views are written as SQL
in :mod:`recoengine.plans.oracle` for the DuckDB oracle; keep both in step.

Mapping (FIXTURES.md):

* interactions: ``lineitem ⋈ orders``; user = ``o_custkey``, item =
  ``'part ' || l_partkey``, rating ``1 + floor((l_quantity - 1) / 10)``,
  review_time = ``o_orderdate``; tie-breakers carried along.
* reviews_raw: the same rows under the raw dump's column names, with junk
  scores, sentinel titles, NULL users and review text from ``documents``
  (doc_id = l_partkey).
* books_raw: ``part`` as a catalogue with noisy titles, sentinels and
  bracketed author/category lists; large parts appear twice (fan-out).
* item_texts_src: ``documents`` as items ``('doc ' || doc_id, text)``.
* catalog: ``documents`` as a description catalogue: odd ids under the exact
  title ``Part <id>``, even ids under ``part <id> collector edition``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        _s("o_custkey").alias("user_id"),
        F.concat(F.lit("part "), _s("l_partkey")).alias("book_title"),
        (F.lit(1) + F.floor((F.col("l_quantity") - 1) / 10)).cast("float").alias("rating"),
        F.col("o_orderdate").alias("review_time"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
        "l_partkey",
        "l_quantity",
    )


# WIN-1's total order on interactions (unique per (user, item), FIXTURES.md).
INTERACTION_TIE_BREAKERS = ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")


def part_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item metadata: author = brand, category = type, keyed like interactions."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("part "), _s("p_partkey")).alias("book_title"),
        F.col("p_brand").alias("author"),
        F.col("p_type").alias("categories"),
    )


def part_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Book descriptions for enrichment: missing, short or long by part key."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 5
    long_text = F.concat_ws(
        " ", F.col("p_name"), F.lit("is a"), F.lower("p_type"), F.lit("part of size"), _s("p_size"),
        F.lit("sold under"), F.col("p_brand"), F.lit("for a retail price of"), _s("p_retailprice"),
    )
    desc = F.when(k == 0, F.lit(None)).when(k == 1, F.col("p_name")).otherwise(long_text)
    return p.select(F.concat(F.lit("part "), _s("p_partkey")).alias("book_title"), desc.cast("string").alias("description"))


def rated_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings with their book description (input of ENR-1)."""
    return interactions(spark, sf_dir).select("book_title", "rating").join(
        part_descriptions(spark, sf_dir), "book_title", "left"
    )


def reviews_raw(spark: SparkSession, sf_dir: str, texts: DataFrame | None = None) -> DataFrame:
    """``texts``: the documents ``(doc_id, text)`` with marks as their texts."""
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text") if texts is None else texts
    pk = F.col("l_partkey")
    noisy = (
        F.when(pk % 3 == 0, F.concat(F.lit("Part "), _s(pk)))
        .when(pk % 3 == 1, F.concat(F.lit("PART "), _s(pk), F.lit("!")))
        .otherwise(F.concat(F.lit("part, "), _s(pk)))
    )
    title = F.when(pk % 97 == 0, F.lit("N/A")).when(pk % 89 == 0, F.lit("")).otherwise(noisy)
    q = F.col("l_quantity")
    score = (
        F.when(q > 48, F.lit("abc"))
        .when(q < 2, F.lit("0"))
        .when(q == 2, F.lit("NaN"))
        .otherwise(_s(F.lit(1) + F.floor((q - 1) / 10)))
    )
    days = F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("long")
    joined = li.join(od, li.l_orderkey == od.o_orderkey).join(docs, li.l_partkey == docs.doc_id, "left")
    return joined.select(
        F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(_s("o_custkey")).alias("User_id"),
        title.alias("Title"),
        F.concat(F.lit("Customer "), _s("o_custkey")).alias("profileName"),
        score.alias("review/score"),
        F.col("text").alias("review/text"),
        F.concat(F.lit("Order "), _s("l_orderkey")).alias("review/summary"),
        F.when((F.col("l_linenumber") == 3) & (pk % 2 == 0), F.lit(None)).otherwise(days).alias("review/time"),
        F.concat(_s("l_linenumber"), F.lit("/7")).alias("review/helpfulness"),
    )


def marked_reviews(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """:func:`reviews_raw` with marks as review texts, and the dictionary of
    the texts ``(place, review_text)``."""
    from recoengine.operators.texts import text_marks

    marks, dictionary = text_marks(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return reviews_raw(spark, sf_dir, marks), dictionary.withColumnRenamed("text", "review_text")


def books_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    title = (
        F.when(pk % 3 == 0, F.concat(F.lit("Part "), _s(pk), F.lit(".")))
        .when(pk % 3 == 1, F.concat(F.lit("part "), _s(pk)))
        .otherwise(F.concat(F.lit("PART: "), _s(pk)))
    )
    desc = (
        F.when(pk % 10 == 0, F.lit("N/A"))
        .when(pk % 10 == 1, F.lit(""))
        .when(pk % 10 == 2, F.lit(None))
        .otherwise(F.concat_ws(" ", F.col("p_name"), F.lit("is a"), F.lower("p_type"), F.lit("part of size"), _s("p_size")))
    )
    authors = (
        F.when(pk % 10 == 0, F.lit("N/A"))
        .when(pk % 11 == 0, F.concat(F.lit("['"), F.col("p_brand"), F.lit(" Review Team']")))
        .when(pk % 13 == 0, F.concat(F.lit("['"), F.repeat(F.col("p_brand"), 20), F.lit("']")))
        .otherwise(F.concat(F.lit("['"), F.col("p_brand"), F.lit("']")))
    )
    cats = F.when(pk % 17 == 0, F.lit("null")).otherwise(F.concat(F.lit("['"), F.col("p_type"), F.lit("']")))
    base = p.select(
        title.alias("Title"),
        desc.cast("string").alias("description"),
        authors.alias("authors"),
        cats.alias("categories"),
        F.concat(F.lit("Pub "), F.col("p_brand")).alias("publisher"),
        _s(F.lit(1990) + F.col("p_size") % 30).alias("publishedDate"),
        F.col("p_retailprice").alias("ratingsCount"),
    )
    twins = p.filter(F.col("p_size") > 45).select(
        F.upper(title).alias("Title"),
        F.concat_ws(" ", F.lit("Second edition of"), F.col("p_name")).alias("description"),
        F.concat(F.lit("['"), F.col("p_brand"), F.lit("', 'Editor']")).alias("authors"),
        F.concat(F.lit("['"), F.col("p_type"), F.lit("']")).alias("categories"),
        F.lit("Reprint House").alias("publisher"),
        F.lit("2001").alias("publishedDate"),
        F.col("p_retailprice").alias("ratingsCount"),
    )
    return base.unionByName(twins)


def item_texts_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.concat(F.lit("doc "), _s("doc_id")).alias("book_title"), F.col("text").alias("description"))


def asked_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that users ask for: the documents whose id is divisible by 50,
    in different case, some of them of no item."""
    d = table(spark, sf_dir, "documents").filter("doc_id % 50 = 0")
    case = F.when(F.col("doc_id") % 100 == 0, "DOC ").otherwise("doc ")
    return d.select(F.concat(case, _s("doc_id"), F.when(F.col("doc_id") % 350 == 50, " volume two").otherwise("")).alias("query"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    title = F.when(
        F.col("doc_id") % 2 == 1, F.concat(F.lit("Part "), _s("doc_id"))
    ).otherwise(F.concat(F.lit("part "), _s("doc_id"), F.lit(" collector edition")))
    return d.select(title.alias("title"), F.col("text").alias("description"))


def worded_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books without descriptions; a title is the first words of a document."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.array_join(F.slice(F.split("text", " "), 1, 8), " ").alias("book_title"), F.lit(None).cast("string").alias("description"))


def worded_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue whose titles are other words of the same documents."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.array_join(F.slice(F.split("text", " "), 3, 7), " ").alias("title"), F.col("text").alias("description"))


def review_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts to score: ``documents`` with NULL text planted on a rule."""
    d = table(spark, sf_dir, "documents")
    text = F.when(F.col("doc_id") % 50 == 7, F.lit(None)).otherwise(F.col("text"))
    return d.select(F.col("doc_id").alias("id"), text.cast("string").alias("review_text"))


def event_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second interaction source: events as (user, item, label)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        _s("user_id").alias("user_id"), F.col("event_type").alias("book_title"), F.col("value").alias("label_rating")
    )


# ---- fixed values: the fixture lexicon over frequent tokens of the driver's
# invented prose (our own list; the prose has no real sentiment words).
FIXTURE_LEXICON = (
    ("with", 1.9), ("was", -1.2), ("er", -0.8), ("and", 0.5), ("le", 1.1),
    ("de", -0.6), ("is", 0.7), ("the", 0.2), ("en", 1.4), ("good", 1.9),
    ("bad", -2.5), ("great", 3.1),
)
FIXTURE_NEGATORS = ("of", "by", "not", "la")
FIXTURE_BOOSTERS_UP = ("for", "on", "very")
FIXTURE_BOOSTERS_DOWN = ("this", "des")


# ---- fixed values: phrases of that prose.  Some are scored, some are rules of
# their own (PHRASE_*), the others only keep their words from counting.
FIXTURE_PHRASES = ("of the", "the and", "and attion to", "the the", "the the the", "de la", "is the", "in the", "by the")
PHRASE_LEXICON = (("the and", 0.8), ("and attion to", -1.4), ("the the", 0.3))
PHRASE_NEGATORS = ("is the",)
PHRASE_BOOSTERS_UP = ("of the",)
PHRASE_BOOSTERS_DOWN = ("the the the",)


def fixture_phrases(spark: SparkSession) -> DataFrame:
    from recoengine.session import literal_rows

    return literal_rows(spark, [(p,) for p in FIXTURE_PHRASES], ["phrase"])


def phrase_lexicon(spark: SparkSession) -> DataFrame:
    from recoengine.session import literal_rows

    return literal_rows(spark, [(t, float(v)) for t, v in FIXTURE_LEXICON + PHRASE_LEXICON], ["token", "valence"])


def phrase_rules() -> dict:
    return {
        "negators": FIXTURE_NEGATORS + PHRASE_NEGATORS,
        "boosters_up": FIXTURE_BOOSTERS_UP + PHRASE_BOOSTERS_UP,
        "boosters_down": FIXTURE_BOOSTERS_DOWN + PHRASE_BOOSTERS_DOWN,
    }


def fixture_lexicon(spark: SparkSession) -> DataFrame:
    from recoengine.session import literal_rows

    return literal_rows(spark, [(t, float(v)) for t, v in FIXTURE_LEXICON], ["token", "valence"])


def fixture_rules() -> dict:
    return {
        "negators": FIXTURE_NEGATORS,
        "boosters_up": FIXTURE_BOOSTERS_UP,
        "boosters_down": FIXTURE_BOOSTERS_DOWN,
    }


def cf_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model input: WIN-1-deduplicated interactions with item metadata,
    label = rating."""
    from recoengine.operators.dedup import dedup_latest
    from recoengine.operators.filters import valid_ratings

    d = dedup_latest(valid_ratings(interactions(spark, sf_dir)), tie_breakers=INTERACTION_TIE_BREAKERS)
    return d.join(part_meta(spark, sf_dir), "book_title", "left").select(
        "user_id", "book_title", F.col("rating").alias("label_rating"), "author", "categories", "review_time"
    )


SPLIT_DATE = "1999-01-01"


def seen_and_candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Re-rank inputs without a model: interactions before ``SPLIT_DATE`` are
    the seen history (with metadata and label); later purchases are the
    candidates, scored by quantity bought."""
    i = interactions(spark, sf_dir)
    before = F.col("review_time") < F.lit(SPLIT_DATE).cast("timestamp_ntz")
    seen = i.filter(before).join(part_meta(spark, sf_dir), "book_title", "left").select(
        "user_id", "book_title", F.col("rating").alias("label_rating"), "author", "categories"
    )
    cands = i.filter(~before).groupBy("user_id", "book_title").agg((F.sum("l_quantity") / 50.0).alias("cf_score"))
    return seen, cands
