"""Language identification by bitmask filters of n-grams.

The model is one Bloom filter per language, bit-sliced: a row of the table
holds one bit for each language (64 languages to a word), so reading the
``HASHES`` rows of an n-gram and taking their common bits gives all languages
that contain it at once.  N-grams have three or four characters, letters within a word,
with a space for the word's beginning and end.  For a text the bits of
all its n-grams are counted by language.  A filter of fill f says yes to a share f**HASHES of the strangers,
which is taken off: of n n-grams, c hits stand for (c - n * f**HASHES) / (1 - f**HASHES).
What is left is compared with what texts of the language itself reach,
and the highest share decides; the score is that of the winner among all.

Learning: from each language's documents whose id is not held out a sample of at most
``SAMPLE`` documents (drawn by a hash; texts of at most
``SAMPLE_CHARS`` characters) is counted.  An n-gram belongs to a language if it
occurs there twice at least, and as often as ``OWN_SHARE`` of what it does in the
language where it is most frequent (by shares of all n-grams); of these each language keeps the
``GRAMS`` most frequent.  The filters are filled by Spark; the driver gets the
table, whose size follows from ``ROWS`` and the number of languages.

A text's language, source and id are no inputs of a prediction, and a text is
read whole, in pieces.

Defined cases: a text without a letter (or null, or empty) is ``und`` with score 0;
a text none of whose n-grams is known gets the language with the most documents
in the sample (ties: the first by name) with score 0; ties of the score go to the first by name; without
any labelled document all are ``und``; rows with a null lang are not learnt
from; a null id is in neither part by its number: it is held out; repeated rows are treated
alike; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recoengine.llm._util import cut, prepare, text_slices
from recoengine.llm._words import U, mix

HASHES, ROW_BITS = 3, 18
ROWS = 1 << ROW_BITS
SIZES = (3, 4)
SAMPLE, SAMPLE_CHARS = 1000, 20_000
GRAMS, OWN_SHARE, LEAST_COUNT = 30_000, 0.4, 2
FOLDS = 5
SLICE_BYTES, PIECE = 1 << 20, 1 << 20
UNKNOWN = "und"
#: Odd multipliers (random) of an n-gram's characters.
STEPS = np.random.default_rng(20240611).integers(1, 1 << 62, max(SIZES), dtype=np.uint64) * U(2) + U(1)

_LETTER: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Which code points are letters; made once per process."""
    if not _LETTER:
        table = np.zeros(0x110000, bool)
        table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        _LETTER.append(table)
    return _LETTER[0]


def code_points(text: str) -> np.ndarray:
    """The lower-cased characters, others than letters as 0."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letter_table()[points], points, 0).astype(np.uint32)


def grams(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place of the second character, hash) of the n-grams of each size.
    All characters but the first and the last are letters, so an n-gram lies
    within one word."""
    inside = points > 0
    wide = points.astype(np.uint64)
    for size in SIZES:
        n = len(points) - size + 1
        if n <= 0:
            continue
        ok = inside[1 : n + 1].copy()
        for k in range(2, size - 1):
            ok &= inside[k : n + k]
        at = np.flatnonzero(ok)
        h = np.full(len(at), size, np.uint64)
        for k in range(size):
            h += wide[at + k] * STEPS[k]
        yield at + 1, mix(h)


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' characters with a 0 before, between and after; where each begins."""
    parts, begin, at = [np.zeros(1, np.uint32)], [], 1
    for text in texts:
        begin.append(at)
        points = code_points(text or "")
        parts += [points, np.zeros(1, np.uint32)]
        at += len(points) + 1
    return np.concatenate(parts), np.array(begin, np.int64)


def text_pieces(points: np.ndarray, begin: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, hash) of all n-grams, a bounded stretch of characters at a time."""
    most = max(SIZES)
    for first in range(0, len(points), PIECE):
        # an n-gram counts in the piece that its first character is in
        for place, h in grams(points[first : first + PIECE + most - 1]):
            own = place <= PIECE
            place, h = place[own], h[own]
            fits = np.searchsorted(begin, place + first, side="right") - 1
            yield fits, h


def rows_of(h: np.ndarray) -> list[np.ndarray]:
    """The rows of the table that an n-gram of this hash sets."""
    return [((h >> U(ROW_BITS * k)) & U(ROWS - 1)).astype(np.int64) for k in range(HASHES)]


@dataclass
class Filters:
    languages: list[str]
    table: np.ndarray  # (words of 64 languages, ROWS)
    reach: np.ndarray  # share of a language's own n-grams that its filter holds
    common: int  # place of the most frequent language

    def __post_init__(self):
        bits = [np.count_nonzero((self.table[k >> 6] >> U(k & 63)) & U(1)) for k in range(len(self.languages))]
        self.wrong = (np.array(bits) / ROWS) ** HASHES

    def contained(self, h: np.ndarray) -> np.ndarray:
        """(words, n-grams): the bits of the languages that contain each n-gram."""
        places = rows_of(h)
        out = self.table[:, places[0]]
        for p in places[1:]:
            out &= self.table[:, p]
        return out

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(has a letter, number of n-grams, (texts, languages) hits)."""
        points, begin = joined(texts)
        n = len(texts)
        hits, total = np.zeros((n, len(self.languages)), np.int64), np.zeros(n, np.int64)
        for text, h in text_pieces(points, begin):
            total += np.bincount(text, minlength=n)
            bits = self.contained(h)
            for k in range(len(self.languages)):
                yes = (bits[k >> 6] >> U(k & 63)) & U(1)
                hits[:, k] += np.bincount(text[yes > 0], minlength=n)
        ends = np.append(begin[1:], len(points))
        letters = np.concatenate([[0], np.cumsum(points > 0)])
        return letters[ends] > letters[begin], total, hits

    def decide(self, letters: np.ndarray, total: np.ndarray, hits: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Predicted languages and scores."""
        if not self.languages:
            return [UNKNOWN] * len(total), np.zeros(len(total))
        n = total[:, None].astype(np.float64)
        true = np.maximum(0.0, (hits - n * self.wrong) / np.maximum(1e-9, 1 - self.wrong))
        share = true / np.maximum(1.0, n) / np.maximum(1e-9, self.reach)
        sums = share.sum(axis=1)
        best = np.where(sums > 0, share.argmax(axis=1), self.common)
        score = np.where(sums > 0, np.take_along_axis(share, best[:, None], axis=1)[:, 0] / np.where(sums > 0, sums, 1.0), 0.0)
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters.tolist(), strict=True)], np.where(letters, score, 0.0)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept for measuring (null ids are)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def _gram_counts(sample: DataFrame) -> DataFrame:
    """(lang, gram, n) of the sampled texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array(batch.column(0).to_pylist(), object)
            for own in sorted(set(lang)):
                texts = batch.column(1).filter(pa.array(lang == own))
                for first, end in text_slices(texts, SLICE_BYTES):
                    points, begin = joined(texts.slice(first, end - first).to_pylist())
                    values, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *[h for _, h in text_pieces(points, begin)]]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([own] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    counted = sample.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def trained_filters(docs: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS, n_grams: int = GRAMS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Filters:
    """Learn the filters from the documents that are not held out."""
    prepare(docs.sparkSession)
    known = docs.filter(~held_out(id_col)).select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    known = known.filter(F.col("lang").isNotNull() & (F.char_length("text") <= sample_chars))
    # twice the sample by chance, so that no task sorts a whole language; then the least of these
    sizes = cut(known.groupBy("lang").agg(F.count("*").alias("n")))  # one row per language, as the table has bits
    drawn = known.withColumn("chance", F.pmod(F.xxhash64(F.lit("sample"), "id", "text"), F.lit(1 << 31)))
    drawn = drawn.join(F.broadcast(sizes), "lang").filter(F.col("chance") * F.col("n") < 2.0 * sample * (1 << 31))
    ranked = drawn.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("chance")))
    counts = cut(_gram_counts(ranked.filter(F.col("rank") <= sample)))
    languages = [r for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").collect()]
    names = [r.lang for r in languages]
    if not names:
        return Filters([], np.zeros((0, ROWS), np.uint64), np.zeros(0), 0)
    share = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("lang")))
    most = share.withColumn("most", F.max("share").over(Window.partitionBy("gram")))
    fits = most.filter((F.col("n") >= LEAST_COUNT) & (F.col("share") >= OWN_SHARE * F.col("most")))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    place = F.transform(F.array(*[F.lit(x) for x in names]), lambda x: x)
    kept = cut(fits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_grams).withColumn("language", F.array_position(place, F.col("lang")).cast("int") - 1))
    reach = {r.lang: r.share for r in kept.groupBy("lang").agg(F.sum("share").alias("share")).collect()}

    rows = [F.shiftrightunsigned("gram", ROW_BITS * k).bitwiseAND(F.lit(ROWS - 1)).cast("int") for k in range(HASHES)]
    bits = kept.select((F.col("language") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, language % 64)").alias("bit"), F.explode(F.array(*rows)).alias("row"))
    filled = bits.groupBy("word", "row").agg(F.bit_or("bit").alias("bits")).toArrow()  # ROWS for each 64 languages at most
    table = np.zeros((-(-len(names) // 64), ROWS), np.uint64)
    table[filled.column("word").to_numpy(), filled.column("row").to_numpy()] = filled.column("bits").to_numpy().view(np.uint64)
    common = max(range(len(names)), key=lambda k: (languages[k].n, -k))
    return Filters(names, table, np.array([reach.get(x, 0.0) for x in names]), common)


def predict(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end in text_slices(batch.column(2), SLICE_BYTES):
                part = batch.slice(first, end - first)
                lang, score = filters.decide(*filters.counts(part.column(2).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
