"""Ranked lexical search by an Aho-Corasick scan of the documents.

There is no index of the documents: the terms of all items (the queries) make
one automaton, which reads every whole text once and counts the terms it
meets.  Bytes that belong to no term become spaces, A-Z become a-z, and a key
of the automaton is a term between two spaces, so that only whole terms are
met; two neighbouring terms share the space between them.  An output of the
automaton is a term's number, and a table maps it to the items that hold the
term.  Two passes:

1. how many documents hold each of the items' terms (df), how many hold any term at
   all (N) and how many terms they have (L); one row per term and task is
   shuffled;
2. the scores.  A task keeps the best ``top`` documents of each item and gives
   only these on; the best of all tasks are found in two steps (salted by
   document, then by item).

Terms are the maximal stretches of ASCII letters, digits and characters beyond
ASCII.  A term's weight is w = floor(1000 * ln((2N + 2) / (2 df + 1))); a
document of n terms has m = 25 + (75 * n * N) div L, and its score is the sum
of w * ((1000000000 * tf) div (1000 * tf + 8 * m)) over an item's terms, repeats
included, in integers.

What is broadcast is bounded: items go in blocks of at most ``block_pairs``
(item, term) pairs, whose size is checked; each block is a pass.  Terms of more than
``LONG`` bytes are not in the automaton but looked up by their digests.  Of
items with more terms than an eighth of a block, the terms are spread over
blocks, and the partial scores of a document are summed by Spark.

Defined cases: null and empty texts have no terms and are found by nothing;
items without terms have no rows; rows with the same item id are separate
items, each with its own ranks; equal documents rank one by one; a null doc_id comes after all
others; no documents, no items: no rows; further columns are not read, so
their names cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recoengine.llm._util import cut, prepare, text_bytes, text_slices
from recoengine.llm._words import Words

SLICE_BYTES, PIECE_BYTES = 1 << 20, 4 << 20
#: (item, term) pairs of a block; bytes of a term in the automaton.
BLOCK_PAIRS, LONG = 200_000, 32
#: Cells of the table of scores (documents by items) made at once.
CELLS = 2_000_000
NULL_ID = np.iinfo(np.int64).max
NO_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SEPARATORS = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])
FOLD = bytes(32 if SEPARATORS[b] else b + 32 if 65 <= b <= 90 else b for b in range(256))


def terms(text: Column) -> Column:
    """The terms of a text, in order."""
    upper = "".join(map(chr, range(65, 91)))
    return F.array_remove(F.split(F.translate(text, upper, upper.lower()), NO_TERM), "")


def _digest(term: bytes) -> bytes:
    return hashlib.blake2b(term, digest_size=16).digest()


@dataclass
class Block:
    """Terms and which items hold them, how often."""

    terms: list[bytes]
    first: np.ndarray  # n + 1 offsets into the two below
    items: np.ndarray  # places in item_numbers
    times: np.ndarray
    item_numbers: np.ndarray
    key: str  # names the terms


def _block(pairs: DataFrame) -> Block:
    """From the rows (item, term, times) of one block."""
    found = pairs.select("item", F.col("term").cast("binary").alias("term"), "times").toArrow()
    numbers, item = np.unique(found.column("item").to_numpy(), return_inverse=True)
    coded = found.column("term").combine_chunks().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    words = [x.as_py() for x in coded.dictionary]
    code = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    first = np.searchsorted(code[order], np.arange(len(words) + 1))
    name = hashlib.blake2b(b" ".join(words), digest_size=16).hexdigest()
    return Block(words, first, item[order], found.column("times").to_numpy()[order].astype(np.int64), numbers, name)


class Scanner:
    """Counts a block's terms in texts."""

    def __init__(self, block_terms: list[bytes]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.long: dict[bytes, int] = {}
        for number, term in enumerate(block_terms):
            if len(term) > LONG:
                self.long[_digest(term)] = number
            else:
                self.automaton.add_word(f" {term.decode('latin-1')} ", number)
        self.automaton.make_automaton()
        self.some = len(self.automaton) > 0

    def _pieces(self, text: bytes) -> Iterator[str]:
        """The text between spaces, parted at spaces if it is long."""
        first = 0
        while len(text) - first > PIECE_BYTES:
            end = text.find(b" ", first + PIECE_BYTES)
            if end < 0:
                break
            yield f" {text[first:end].decode('latin-1')} "
            first = end + 1
        yield f" {text[first:].decode('latin-1')} "

    def count(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(how many terms each text has; text, term and times of the terms found)."""
        words = Words(buf, off, SEPARATORS)
        raw = buf.tobytes().translate(FOLD)
        counts: list[Counter] = []
        for a, z in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            own: Counter = Counter()
            if self.some and a < z:
                for piece in self._pieces(raw[a:z]):
                    own.update(map(itemgetter(1), self.automaton.iter(piece)))
            counts.append(own)
        if self.long:
            for w in np.flatnonzero(words.end - words.start > LONG).tolist():
                number = self.long.get(_digest(raw[words.start[w] : words.end[w]]))
                if number is not None:
                    counts[int(np.searchsorted(words.off, w, side="right")) - 1][number] += 1
        text = np.repeat(np.arange(len(counts)), [len(c) for c in counts])
        term = np.fromiter((t for c in counts for t in c), np.int64, len(text))
        times = np.fromiter((n for c in counts for n in c.values()), np.int64, len(text))
        return np.diff(words.off), text, term, times


#: Of this worker process: the automaton of the block it works on.
_SCANNER: dict[str, Scanner] = {}


def _scanner(block: Block) -> Scanner:
    if block.key not in _SCANNER:
        _SCANNER.clear()
        _SCANNER[block.key] = Scanner(block.terms)
    return _SCANNER[block.key]


@dataclass
class Statistics:
    documents: int  # with any term
    length: int  # terms of all documents
    weight: np.ndarray  # of each of a block's terms


def statistics(rows: DataFrame, block: Block) -> Statistics:
    """N, L and the weights of a block's terms, over all documents."""
    n_terms = len(block.terms)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(block)
        total = np.zeros(n_terms + 2, np.int64)
        for batch in batches:
            for first, end in text_slices(batch.column(1), SLICE_BYTES):
                n, _, term, _ = scanner.count(*text_bytes(batch.column(1).slice(first, end - first)))
                total[:n_terms] += np.bincount(term, minlength=n_terms)
                total[n_terms:] += np.count_nonzero(n), n.sum()
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], ["term", "n"])

    found = rows.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # two rows more than terms at most
    total = np.zeros(n_terms + 2, np.int64)
    total[found.column("term").to_numpy()] = found.column("n").to_numpy()
    documents, length = int(total[n_terms]), int(total[n_terms + 1])
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in total[:n_terms].tolist()]
    return Statistics(documents, length, np.array(weight, np.int64))


class Scores:
    """The scores of texts for a block's items."""

    def __init__(self, block: Block, known: Statistics):
        self.block, self.known, self.scanner = block, known, _scanner(block)

    def __call__(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """(texts, items) scores."""
        block, known = self.block, self.known
        n, text, term, times = self.scanner.count(buf, off)
        m = np.array([25 + 75 * x * known.documents // max(1, known.length) for x in n.tolist()], np.int64)
        gain = known.weight[term] * (1_000_000_000 * times // (1000 * times + 8 * m[text]))
        held = block.first[term + 1] - block.first[term]
        last = np.cumsum(held)
        at = np.arange(last[-1] if len(last) else 0) + np.repeat(block.first[term] - (last - held), held)
        width = len(block.item_numbers)
        out = np.zeros(len(n) * width, np.int64)
        np.add.at(out, np.repeat(text, held) * width + block.items[at], np.repeat(gain, held) * block.times[at])
        return out.reshape(len(n), width)

    def slices(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of the batch, their scores) a few texts at a time."""
        most = max(1, CELLS // max(1, len(self.block.item_numbers)))
        for first, end in text_slices(batch.column(1), SLICE_BYTES):
            for a in range(first, end, most):
                z = min(end, a + most)
                yield np.arange(a, z), self(*text_bytes(batch.column(1).slice(a, z - a)))


PARTIAL = "item long, doc_id long, score long"


def _best(rows: DataFrame, block: Block, known: Statistics, top: int) -> DataFrame:
    """The best documents of each task for each item of the block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(block, known)
        width = len(block.item_numbers)
        item, doc, score = (np.zeros(0, np.int64) for _ in range(3))
        bar = np.ones(width, np.int64)  # what a score must reach
        for batch in batches:
            ids = batch.column(0).fill_null(NULL_ID).to_numpy()
            for own, found in scores.slices(batch):
                which, of = np.nonzero(found >= bar)
                if not len(which):
                    continue
                item, doc, score = (np.concatenate(x) for x in ((item, of), (doc, ids[own[which]]), (score, found[which, of])))
                order = np.lexsort((doc, -score, item))
                item, doc, score = item[order], doc[order], score[order]
                begin = np.searchsorted(item, np.arange(width))
                rank = np.arange(len(item)) - begin[item]
                keep = rank < top
                full = rank == top - 1
                bar[item[full]] = score[full]
                item, doc, score = item[keep], doc[keep], score[keep]
        yield pa.RecordBatch.from_arrays([pa.array(block.item_numbers[item]), pa.array(doc, mask=doc == NULL_ID), pa.array(score)], ["item", "doc_id", "score"])

    return rows.mapInArrow(run, PARTIAL)


def _partial(rows: DataFrame, block: Block, known: Statistics, number: int) -> DataFrame:
    """All scores above 0 that a block of spread items gives, with the text's hash
    and the number of equal rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(block, known)
        for batch in batches:
            for own, found in scores.slices(batch):
                which, of = np.nonzero(found)
                at = pa.array(own[which])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.item_numbers[of]), batch.column(0).take(at), batch.column(2).take(at), pa.array(found[which, of])], ["item", "doc_id", "text_key", "score"]
                )

    keyed = rows.withColumn("text_key", F.xxhash64("text"))
    found = keyed.mapInArrow(run, "item long, doc_id long, text_key long, score long")
    return found.groupBy("item", "doc_id", "text_key").agg(F.max("score").alias("score"), F.count("*").alias("copies")).withColumn("block", F.lit(number))


def _blocks(pairs: DataFrame, key: Column, block_pairs: int) -> list[DataFrame]:
    """The pairs in parts of at most ``block_pairs``; pairs with equal keys stay together."""
    blocks = -(-2 * pairs.count() // block_pairs)
    while blocks:
        part = F.pmod(key, F.lit(blocks))
        if pairs.groupBy(part.alias("part")).count().agg(F.max("count")).first()[0] <= block_pairs:
            return [pairs.filter(part == b) for b in range(blocks)]
        blocks *= 2
    return []


def search(docs: DataFrame, items: DataFrame, top: int = 10, block_pairs: int = BLOCK_PAIRS, item_col: str = "item_id", item_text: str = "text", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """item_id, rank (int, from 1), doc_id and score of the ``top`` documents
    of each item; equal scores by ascending doc_id."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    numbered = cut(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("item_id"), F.array_distinct(terms(F.col(item_text))).alias("own"), terms(F.col(item_text)).alias("all")))
    wide = F.size("own") > block_pairs // 8
    pairs = lambda which: cut(which.select("item", F.explode("all").alias("term")).groupBy("item", "term").agg(F.count("*").alias("times")))
    narrow = pairs(numbered.filter(~wide))
    found = rows.select(F.lit(0).cast("long").alias("item"), "doc_id", F.lit(0).cast("long").alias("score")).filter("false")
    for part in _blocks(narrow, F.xxhash64("item"), block_pairs):
        block = _block(part)
        found = found.unionByName(_best(rows, block, statistics(rows, block), top))
    spread = pairs(numbered.filter(wide))
    parts = []
    for number, part in enumerate(_blocks(spread, F.xxhash64("item", "term"), block_pairs)):
        block = _block(part)
        parts.append(_partial(rows, block, statistics(rows, block), number))
    if parts:
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        sums = whole.groupBy("item", "doc_id", "text_key").agg(F.sum("score").alias("score"), F.max("copies").alias("copies")).filter("score > 0")
        found = found.unionByName(sums.select("item", "doc_id", "score", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(top)))).alias("_")).drop("_"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    few = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


#: The query's rows in DuckDB SQL.
ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
q AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(w) AS term FROM b) GROUP BY ALL),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
gain AS (SELECT r, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))) AS gain FROM tf JOIN w USING (term), s),
scores AS (SELECT i, item_id, r, doc_id, CAST(sum(gain * times) AS BIGINT) AS score FROM gain JOIN q USING (term) GROUP BY ALL HAVING sum(gain * times) > 0),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
