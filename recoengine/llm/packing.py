"""Best-fit packing: documents as token sequences of at most ``capacity``.

``pack_documents`` tokenizes every whole text in the workers, cuts only the
documents longer than a sequence, and packs the pieces by best-fit decreasing.
A segment tree over the remaining capacities (0..capacity) finds the tightest
open bin that still takes a piece in log2(capacity) steps.

At scale the pieces are dealt by a hash into groups of about ``group_size``
documents and each group is packed on its own: a group's loss is at most its
last, part-filled bins (one sequence in some ten thousand), and no task sees
more than its group.  Token ids never leave the tokenizing task; a piece
carries its length and the CRC-32 of its ids.

Defined cases: null text is an empty one; an empty text is the end id alone
(one piece of length 1); equal documents are packed one by one; an empty
table gives an empty result; columns other than the id and the text are not
read, so their names cannot clash.  Rows with equal ids are separate documents
(each row gets its pieces).
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine.llm._util import prepare, text_slices, tidy

#: Entries of the word cache and the bytes of its words; a full cache is emptied, which bounds a worker's memory.
CACHE_WORDS, CACHE_BYTES = 400_000, 32 << 20
SLICE_BYTES = 1 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others for the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


class WordTokenizer:
    """Ids of texts by a `tokenizers` file, with a cache by word.

    The file's pre-tokenizer never joins characters across ASCII white space,
    so a text's ids are its words' ids in order.  A word of letters that the
    normaliser leaves as it is goes straight to the BPE model; every other new
    word goes through the whole tokenizer.  The strings of the file's added
    tokens are found in the text as it is, so a text that holds one, in any
    case, is not folded before it is split.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.cache: dict[bytes, bytes] = {}
        self.cache_words, self.cached_bytes = cache_words, 0
        self.wide = "<u4" if self.tokenizer.get_vocab_size() > 1 << 16 else "<u2"

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.wide).tobytes()

    def _learn(self, words: set[bytes]) -> None:
        cache, rest, tails = self.cache, [], {}
        self.cached_bytes += sum(map(len, words))
        for word in words:
            core = word[:-1]
            if word[-1:] in (b".", b",") and core.decode().isalpha():
                tails[word] = core
        for word in (words - tails.keys()) | (set(tails.values()) - cache.keys()):
            text = word.decode()
            if text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text):
                cache[word] = self._pack([t.id for t in self.model.tokenize(word.decode("latin-1").translate(self.letters))])
            else:
                rest.append((word, text))
        rest += [(b".", "."), (b",", ",")]
        for (word, _), found in zip(rest, self.tokenizer.encode_batch_fast([t for _, t in rest], add_special_tokens=False), strict=True):
            cache[word] = self._pack(found.ids)
        for word, core in tails.items():
            cache[word] = cache[core] + cache[word[-1:]]

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.cache) > self.cache_words or self.cached_bytes > CACHE_BYTES:
            self.cache.clear()
            self.cached_bytes = 0
        split = []
        for text in texts:
            raw = (text or "").encode()
            low = raw.lower()
            # ASCII case may be folded first unless a combining mark could compose with the letter.
            as_it_is = b"\xcc" in raw or b"\xcd" in raw or any(x in low for x in self.added)
            split.append((raw if as_it_is else low).split())
        new = set().union(*split).difference(self.cache)
        if new:
            self._learn(new)
        found = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(found, words)), self.wide) for words in split]


#: Of this worker process, by file: later tasks find the words of earlier ones.
_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece number, its first id's place in the
    document, its length and the CRC-32 of its ids (unsigned 32-bit, little
    endian)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer_path)
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for first, end in text_slices(batch.column(1), SLICE_BYTES):
                part = batch.slice(first, end - first)
                out: list[list[int]] = [[], [], [], [], []]
                for doc_id, ids in zip(part.column(0).to_pylist(), tok.ids(part.column(1).to_pylist()), strict=True):
                    full = np.append(ids.astype("<u4"), np.uint32(end_id))
                    for piece, start in enumerate(range(0, len(full), capacity)):
                        own = full[start : start + capacity]
                        for column, value in zip(out, (doc_id, piece, start, len(own), zlib.crc32(own.tobytes())), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), PIECES)


class CapacityTree:
    """A segment tree over remaining capacities 0..capacity: leaf r counts the
    open bins with r places left, an inner node the bins below it."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, by: int = 1) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1

    def tightest(self, need: int) -> int:
        """The least room >= need that an open bin has, or -1."""
        count, node = self.count, self.leaves + need
        if count[node]:
            return need
        while node > 1:  # up until a right neighbour holds bins
            if not node & 1 and count[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return -1
        while node < self.leaves:
            node = 2 * node if count[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; pieces go longest first (ties in the given
    order) into the tightest open bin, or into a new one."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree = CapacityTree(capacity)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by remaining room
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        room = tree.tightest(need)
        if room < 0:
            room, own, made = capacity, made, made + 1
        else:
            own = open_bins[room].pop()
            tree.add(room, -1)
        bins[i], offsets[i] = own, capacity - room
        if room > need:
            open_bins[room - need].append(own)
            tree.add(room - need)
    return bins, offsets


def pack_pieces(pieces: DataFrame, n_groups: int, capacity: int = 4096) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (columns of ``PIECES``).

    A piece's group is a hash of all its columns and of which of the equal
    rows in its partition it is, so a document of many pieces is spread, and
    so are rows that share an id or are equal throughout.  These numbers
    depend on the partition's rows, not on their order, so a task that runs
    again deals the same groups."""

    def pack(pdf):
        pdf = pdf.sort_values(["doc_id", "piece", "length", "ids_crc32"], kind="stable")
        bins, offsets = best_fit_decreasing(pdf["length"].to_numpy(np.int64), capacity)
        return pdf.assign(sequence_id=(pdf["pack_group"].to_numpy(np.int64) << 32) + bins, offset=offsets).drop(columns=["same", "pack_group"])

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            same = []
            for key in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "piece", "length", "ids_crc32")), strict=True):
                same.append(seen[key])
                seen[key] += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(same, pa.int64())], [*batch.schema.names, "same"])

    numbered = pieces.mapInArrow(number, f"{PIECES}, same long")
    key = F.xxhash64("doc_id", "piece", "length", "ids_crc32", "same", F.when(F.col("same") > 0, F.spark_partition_id()))
    grouped = numbered.withColumn("pack_group", F.pmod(key, F.lit(n_groups)).cast("int"))
    return grouped.groupBy("pack_group").applyInPandas(pack, PACKED)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, group_size: int = 32_768, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize and pack all documents; one row per piece (``PACKED``)."""
    prepare(docs.sparkSession)
    n_groups = max(1, -(-docs.select(id_col).count() // group_size))
    return pack_pieces(tokenized_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), n_groups, capacity)
