"""The registered ``opN_*`` queries and the SQL of those that have one.

Each applies its operator with production parameters to the whole of its
table; the digest columns are derived from what the operator returns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoengine.llm import decontaminate, embed_dedup, html_extract, jaccard_join, language_id, lexical_search, line_dedup, packing, periodic_runs, substring_dedup, suffix_dedup, toxicity, warc
from recoengine.llm._util import prepare
from recoengine.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@register("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as sequences of at most 4,096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@register("op10_warc_dictionary_archive")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages to archives, read these back."""
    path = scratch(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op9_toxicity_bigru")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the labelled documents that are not held out, score all."""
    docs = table(spark, sf_dir, "documents")
    net = toxicity.trained_network(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, net)


@register("op2_html_crf")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


@register("op3_embedding_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at a cosine of 0.9."""
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@register("op1_benchmark_decontamination", decontaminate.ORACLE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overlaps of all documents with all benchmark items."""
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op8_line_template_dedup", line_dedup.ORACLE_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines of recurring templates."""
    out = line_dedup.drop_recurring_lines(table(spark, sf_dir, "documents"), counts=True)
    return out.select("doc_id", "n_lines", "n_removed", "text")


@register("op6_repeated_phrase_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 13-word windows of earlier documents."""
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@register("op7_suffix_array_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-byte strings of earlier documents."""
    out = suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register("op4_ngram_jaccard_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of all documents at a Jaccard similarity of 0.8."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@register("op11_language_bitmask_filters")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn the languages of the documents that are not held out, predict all."""
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.trained_filters(docs))


@register("op12_lexical_search", lexical_search.ORACLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; of every tenth document (by the CRC-32 of its id) the
    words from some place on repeat."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "")
    planted = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n = F.expr("nullif(cast(size(w) AS bigint), 0)")  # null: the text stays as it is
    cut_at = planted.withColumns({"n": n, "a": (F.col("g") % n).cast("int")})
    cut_at = cut_at.withColumn("rest", (F.col("n") - F.col("a")).cast("int")).withColumn("p", (1 + F.floor(F.col("rest") / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil(F.col("rest") / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), times)), F.lit(1), F.col("rest"))
    changed = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return cut_at.select("doc_id", F.when(F.col("n").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


@register("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of all documents, with the tails that the task plants."""
    out = periodic_runs.periodic_runs(with_periodic_tails(table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    digest = lambda c: F.sha2(c, 256)
    found = out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("x"), digest(listed.cast("binary")).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"))
    length = -F.col("x.less")
    return found.select(
        "doc_id", "n_runs", F.col("x.start").alias("start"), length.alias("length"), F.col("x.period").alias("period"),
        F.floor(F.expr("(-1000 * x.less) div x.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
