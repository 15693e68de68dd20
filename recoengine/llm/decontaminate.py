"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A seed covers ``window`` words of a text in four blocks of equal length; a
mask keeps two of the blocks and ignores the other two.  The six masks of two
blocks find every window that differs from a benchmark window by up to two
substituted words (two substitutions leave two blocks untouched).  Seeds of
all positions of the benchmark are hashed and joined to those of all positions
of the documents; every hit is verified by comparing all words of the two
windows, and windows with at most ``max_substitutions`` differences are
overlaps.

The benchmark's seeds and blocks are the broadcast sides, and document
positions are never shuffled: every position's block is looked up among the
benchmark's blocks inside one small generated stage (a mask can only hit where
its first block is known), and seeds are made at the places found.  The
broadcast is bounded by ``block_rows``: a larger benchmark is joined in
several blocks of its items, one after the other.  Overlaps are aggregated
map side first, so a passage that many documents share, or a document full of
passages, makes no hot task.

Words are runs of letters and digits, lower-cased.  Defined cases: texts or
items that are null, empty or shorter than a window overlap with nothing;
null ids of items are matched like others, documents with a null id are kept
by ``decontaminate`` and reported under null by ``overlaps``; equal items are
reported one by one; rows with equal document ids are reported together (and
dropped together); empty tables give an empty result or leave the documents
alone; further columns are not read, and kept by ``decontaminate``.
"""

from __future__ import annotations

import functools
import itertools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_A_WORD = r"[^\p{L}\p{N}]+"
BLOCKS = 4
MASKS = tuple(itertools.combinations(range(BLOCKS), 2))


def word_hashes(text: Column) -> Column:
    """The lower-cased words of a text as 64-bit hashes."""
    return F.transform(F.array_remove(F.split(F.lower(text), NOT_A_WORD), ""), lambda w: F.xxhash64(w))


def _block_key(i: Column, size: int) -> Column:
    """Hash of the block of words from place i on."""
    return F.xxhash64(*[F.col("h")[i + k] for k in range(size)])


def _item_seeds(items: DataFrame, window: int) -> DataFrame:
    """item_id, the window's words, and the seed of each mask, of all windows."""
    size = window // BLOCKS
    whole = items.filter(F.size("h") >= window).select("item_id", "h", F.explode(F.sequence(F.lit(0), F.size("h") - window)).alias("at"))
    words = whole.select("item_id", F.slice("h", F.col("at") + 1, window).alias("h"))
    seeds = F.array(*[F.xxhash64(F.lit(k), *[_block_key(F.lit(b * size), size) for b in mask]) for k, mask in enumerate(MASKS)])
    return words.select("item_id", F.col("h").alias("words"), F.explode(seeds).alias("seed"))


def _document_seeds(texts: DataFrame, blocks: DataFrame, window: int) -> DataFrame:
    """doc_id, the window's place and words, and its seeds.  A seed can only
    hit if its mask's first block is one of the benchmark's, so blocks are
    looked up at every place first; seeds are made where one is found."""
    size = window // BLOCKS
    back = (BLOCKS - 2) * size  # the farthest that a mask's first block lies from its window's beginning
    places = texts.filter(F.size("h") >= window).select("doc_id", "h", F.explode(F.sequence(F.lit(0), F.size("h") - size)).alias("i"))
    found = places.withColumn("block", _block_key(F.col("i"), size)).join(F.broadcast(blocks), "block", "left_semi")
    low = F.greatest(F.col("i") - back, F.lit(0))
    near = found.select("doc_id", "i", low.alias("low"), F.size("h").alias("n"), F.slice("h", low + 1, back + window).alias("h"))
    seeds = []
    for k, mask in enumerate(MASKS):
        at = F.col("i") - mask[0] * size
        own = at - F.col("low")
        seed = F.xxhash64(F.lit(k), *[_block_key(own + b * size, size) for b in mask])
        seeds.append(F.when((at >= 0) & (at + window <= F.col("n")), F.struct(at.alias("at"), F.slice("h", own + 1, window).alias("h"), seed.alias("seed"))))
    return near.select("doc_id", F.inline(F.filter(F.array(*seeds), lambda x: x.isNotNull())))


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 12, max_substitutions: int = 2, block_rows: int = 300_000) -> DataFrame:
    """One row per document and item that overlap: how many pairs of windows
    agree, the most agreeing words in one, and the words of the document from
    the first to the last such window."""
    if window % BLOCKS or max_substitutions > BLOCKS - 2:
        raise ValueError("a window has four equal blocks, and at most two substitutions are found for certain")
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("h"))
    # how much there is to broadcast decides the number of blocks
    rows = items.agg(F.sum(F.greatest(F.size("h") - window + 1, F.lit(0)) * len(MASKS))).first()[0] or 0
    blocks = max(1, -(-rows // block_rows))
    texts = docs.select("doc_id", word_hashes(F.col("text")).alias("h"))
    found = None
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "h"), F.lit(blocks)) == block) if blocks > 1 else items
        seeds = _item_seeds(part, window)
        first = part.filter(F.size("h") >= window).select("h", F.explode(F.sequence(F.lit(0), F.size("h") - window // BLOCKS)).alias("i"))
        keys = first.select(_block_key(F.col("i"), window // BLOCKS).alias("block")).distinct()
        hits = _document_seeds(texts, keys, window).join(F.broadcast(seeds), "seed")
        found = _verified(hits, window, max_substitutions) if found is None else found.unionByName(_verified(hits, window, max_substitutions))
    out = found.groupBy("doc_id", "item_id").agg(
        (F.sum("share") / len(MASKS)).cast("long").alias("n_windows"),
        F.max("n_same").cast("int").alias("best_matched"),
        F.min("at").cast("int").alias("first_word"),
        (F.max("at") + window).cast("int").alias("end_word"),
    )
    return out


def _verified(hits: DataFrame, window: int, max_substitutions: int) -> DataFrame:
    size = window // BLOCKS
    same = [F.col("h")[i] == F.col("words")[i] for i in range(window)]
    n_same = functools.reduce(operator.add, [x.cast("int") for x in same])
    whole = functools.reduce(operator.add, [functools.reduce(operator.and_, same[b * size : (b + 1) * size]).cast("int") for b in range(BLOCKS)])
    # a pair of windows is hit by as many masks as it has pairs of whole blocks; the shares of one pair add up to the number of masks
    share = (F.lit(2 * len(MASKS)) / (whole * (whole - 1))).cast("long")
    return hits.select("doc_id", "item_id", "at", n_same.alias("n_same"), whole.alias("whole"), share.alias("share")).filter(F.col("n_same") >= window - max_substitutions).filter("whole >= 2")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents that overlap with no benchmark item."""
    hit = overlaps(docs, benchmark, **settings).select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti").select(docs.columns)


#: The same overlaps in DuckDB SQL, by the words themselves.
ORACLE_SQL = """
WITH d AS (SELECT doc_id, [x for x in string_split_regex(lower(text), '[^\\p{L}\\p{N}]+') if x <> ''] AS w FROM documents),
b AS (SELECT item_id, [x for x in string_split_regex(lower(text), '[^\\p{L}\\p{N}]+') if x <> ''] AS w FROM benchmark),
dw AS (SELECT doc_id, pos, w[pos + 1:pos + 12] AS v FROM (SELECT doc_id, w, unnest(range(0, len(w) - 11)) AS pos FROM d WHERE len(w) >= 12)),
bw AS (SELECT item_id, pos, w[pos + 1:pos + 12] AS v FROM (SELECT item_id, w, unnest(range(0, len(w) - 11)) AS pos FROM b WHERE len(w) >= 12)),
m AS (SELECT * FROM (VALUES (0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)) AS t(x, y)),
dk AS (SELECT doc_id, pos, v, x, y, array_to_string(v[3 * x + 1:3 * x + 3] || v[3 * y + 1:3 * y + 3], ' ') AS k FROM dw, m),
bk AS (SELECT item_id, pos, v, x, y, array_to_string(v[3 * x + 1:3 * x + 3] || v[3 * y + 1:3 * y + 3], ' ') AS k FROM bw, m),
hits AS (SELECT DISTINCT dk.doc_id, bk.item_id, dk.pos AS dpos, bk.pos AS bpos, dk.v AS dv, bk.v AS bv FROM dk JOIN bk USING (x, y, k)),
same AS (SELECT doc_id, item_id, dpos, len([i for i in range(1, 13) if dv[i] = bv[i]]) AS n FROM hits)
SELECT doc_id, item_id, count(*) AS n_windows, CAST(max(n) AS INTEGER) AS best_matched,
       CAST(min(dpos) AS INTEGER) AS first_word, CAST(max(dpos) + 12 AS INTEGER) AS end_word
FROM same WHERE n >= 10 GROUP BY ALL
"""
