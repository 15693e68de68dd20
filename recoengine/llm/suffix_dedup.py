"""Suffix-array dedup of bytes: strings of ``length`` bytes that also start in
a document with a smaller id are removed.

A sparse suffix array serves: of every text the suffixes that winnowing over
``gram``-byte strings chooses, so that each string of ``length`` bytes holds
the beginning of a chosen suffix and all texts with that string choose it
alike.  Steps of one plan over the grouped texts
(:mod:`recoengine.llm._groups`):

1. The leading grams of the chosen suffixes meet in buckets by hash; suffixes whose gram
   no other text has are dropped there (nothing can match them).
2. The others go to buckets of the array by splitters that are sampled from the
   corpus: a suffix travels as its next ``length`` bytes and the bytes before
   it that a string around it can reach (read backwards).  They travel sorted and
   compressed; a bucket's share of the text grows with the root of the corpus from
   ``SORTED_BYTES`` to that of the buckets of keys.
3. A bucket sorts its suffixes by multikey quicksort (eight bytes are a
   letter), takes the longest common prefixes of
   neighbours, and finds for every number of bytes before a suffix the least
   id among those that share the whole string.  Runs that touch a bucket's
   end may go on in the next bucket: their strings are compared across the
   boundaries by their hashes, in further buckets, so that a run of any size
   is spread.
4. Each group gets its documents' strings back and removes their bytes.

Equal suffixes of one group travel once, with the least id.  The splitters come
from a bounded sample (``sample_docs`` documents); they only decide where the
buckets part.  Nothing else is collected.  Hashes have 64 bits.

Defined cases: null text is empty; texts shorter than ``length`` keep all
bytes; copies of a text lose all of them; rows with equal ids take nothing from each
other; a null id is larger than all others; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine.llm._groups import LAST_ID, Distinct, Grouped, Lookup, blobs, distinct_texts, from_blob, group_keys, group_texts, packed, recurring_keys, reduced, returned_keys, unpacked
from recoengine.llm._util import text_bytes, text_slices, tidy, tidy_pair
from recoengine.llm._words import BYTE_STEP, LETTERS, U, chosen, inside_texts, inverse, mix, powers, prefix_sums

#: Kinds of rows on their way back to the groups.
SUFFIXES, SETTLED, ACROSS = 0, 1, 2
#: Least text bytes whose chosen suffixes meet in a bucket of the array.
SORTED_BYTES = 32 << 20


def chosen_suffixes(buf: np.ndarray, off: np.ndarray, gram: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes of the leading grams) of the chosen suffixes."""
    n = len(buf) - gram + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = prefix_sums(LETTERS[buf], BYTE_STEP)
    hashes = (sums[gram:] - sums[:n]) * powers(inverse(BYTE_STEP), len(sums))[:n]
    order = (hashes * U(0x9E3779B97F4A7C15) >> U(32)).astype(np.uint32)
    at = np.flatnonzero(chosen(order, length - gram + 1) & inside_texts(off, n, gram))
    return at, mix(hashes[at])


def contexts(buf: np.ndarray, off: np.ndarray, at: np.ndarray, before: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes from each place on, followed by those before it backwards
    (zero beyond the text), and how many of either there are."""
    text = np.searchsorted(off, at, side="right") - 1
    left, right = np.minimum(at - off[text], before), np.minimum(off[text + 1] - at, length)
    out = np.zeros((len(at), length + before), np.uint8)
    for i in range(length):
        ok = i < right
        out[ok, i] = buf[at[ok] + i]
    for i in range(before):
        ok = i < left
        out[ok, length + i] = buf[at[ok] - 1 - i]
    return out, left, right


#: Segments of fewer rows are sorted by comparing the rows whole.
SMALL_SEGMENT = 400


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """The order of fixed-width byte strings by multikey quicksort with eight
    bytes as a letter: a segment whose rows agree before some letter is parted
    by this letter into rows below, at and above a pivot; the middle part goes
    on with the next letter, the others with the same."""
    n, width = rows.shape
    levels = -(-width // 8)
    wide = np.zeros((n, levels * 8), np.uint8)
    wide[:, :width] = rows
    keys = np.ascontiguousarray(wide.view(">u8").astype(np.uint64).T)
    order = np.arange(n)
    whole = wide.view(f"V{levels * 8}").ravel()
    stack = [(0, n, 0)]
    while stack:
        first, end, level = stack.pop()
        if end - first < 2 or level == levels:
            continue
        own = order[first:end]
        if end - first < SMALL_SEGMENT:
            text = [x.tobytes() for x in whole[own]]
            order[first:end] = own[sorted(range(len(text)), key=text.__getitem__)]
            continue
        letter = keys[level][own]
        # the median of nine rows spread over the segment
        pivot = np.sort(letter[np.linspace(0, len(own) - 1, 9).astype(np.int64)])[4]
        below, at = letter < pivot, letter == pivot
        low, mid = first + int(np.count_nonzero(below)), int(np.count_nonzero(at))
        order[first:end] = np.concatenate([own[below], own[at], own[~(below | at)]])
        stack += [(first, low, level), (low, low + mid, level + 1), (low + mid, end, level)]
    return order


def common_prefixes(rows: np.ndarray, most: int) -> np.ndarray:
    """How many leading bytes (up to ``most``) each row shares with the row before."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:, :most] != rows[:-1, :most]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), most)
    return out


def least_by(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each item the least doc among those with its key."""
    order = np.argsort(key, kind="stable")
    begin = np.flatnonzero(np.append(True, key[order[1:]] != key[order[:-1]]))
    least = np.minimum.reduceat(doc[order], begin)
    out = np.empty(len(key), np.int64)
    out[order] = np.repeat(least, np.diff(np.append(begin, len(key))))
    return out


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
KEPT = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def tie_numbers(own: Distinct) -> np.ndarray:
    """Each distinct text's number among those of the group with its id, by
    their bytes: with the id it names the text, whatever the order of the rows."""
    out = np.zeros(len(own.first), np.int64)
    begin = np.flatnonzero(np.append(True, own.first[1:] != own.first[:-1])) if len(out) else []
    for a, z in zip(begin, [*begin[1:], len(out)], strict=True):
        if z - a > 1:
            texts = [x.as_buffer().to_pybytes() for x in own.texts.slice(a, z - a)]
            out[a + np.array(sorted(range(len(texts)), key=texts.__getitem__))] = np.arange(len(texts))
    return out


#: A place travels with its text's tie number above it; a text has less than 2**31 bytes.
TIE_BITS = 32


def prefix_hashes(rows: np.ndarray):
    """A function that gives the hashes of the leading n bytes of the rows."""
    sums = np.zeros((rows.shape[1] + 1, len(rows)), np.uint64)
    for i in range(rows.shape[1]):
        sums[i + 1] = sums[i] * U(BYTE_STEP) + LETTERS[rows[:, i]]
    return lambda n: mix(sums[n] + U(n))


class Layout:
    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.before = length, gram, length - gram
        self.width = length + self.before

    def valid(self, left: np.ndarray, right: np.ndarray, b: int) -> np.ndarray:
        """Whose string with b bytes before the suffix lies within the text."""
        return (left >= b) & (right >= self.length - b)

    def mask_of_valid(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        out = np.zeros(len(left), np.uint64)
        for b in range(self.before + 1):
            out |= self.valid(left, right, b).astype(np.uint64) << U(b)
        return out


def _table(columns: list[tuple[int, int, int, int, bytes]]) -> pa.Table:
    own = list(zip(*columns, strict=True)) or [[]] * 5
    return pa.table({"route": pa.array(own[0], pa.int32()), "grp": pa.array(own[1], pa.int32()), "kind": pa.array(own[2], pa.int32()), "n": pa.array(own[3], pa.int32()), "data": pa.array(own[4], pa.binary())})


ROWS = "route int, grp int, kind int, n int, data binary"


def sampled_splitters(docs: DataFrame, n_docs: int, buckets: int, shape: Layout, sample_docs: int) -> np.ndarray:
    """buckets - 1 contexts that part the sampled chosen suffixes evenly."""
    part = max(1, n_docs // sample_docs)
    picked = docs.filter(F.pmod(F.xxhash64(F.lit("splitters"), "doc_id", F.octet_length("text")), F.lit(part)) == 0).limit(2 * sample_docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end in text_slices(batch.column(0), 1 << 20):
                buf, off = text_bytes(batch.column(0).slice(first, end - first))
                at, keys = chosen_suffixes(buf, off, shape.gram, shape.length)
                at = at[np.argsort(keys)[: 16 * (end - first)]]
                rows = contexts(buf, off, at, shape.before, shape.length)[0]
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary())], ["context"])

    found = sorted(bytes(r.context) for r in picked.select("text").mapInArrow(run, "context binary").collect())  # at most 32 * sample_docs short strings
    cuts = [found[len(found) * i // buckets] for i in range(1, buckets)] if found else []
    return np.array(sorted(set(cuts)), f"S{shape.width}")


def remove_repeated_bytes(docs: DataFrame, length: int = 50, gram: int = 24, sample_docs: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (the removed runs) and kept (the bytes that
    stay) of every document."""
    shape = Layout(length, gram)
    grouped: Grouped = group_texts(docs, id_col=id_col, text_col=text_col)
    buckets = grouped.n_buckets
    cells = max(buckets, -(-grouped.n_bytes // max(SORTED_BYTES, math.isqrt(grouped.n_bytes * SORTED_BYTES // 128))))
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    splitters = sampled_splitters(plain, plain.count(), cells, shape, sample_docs)

    def keys_of(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, keys = chosen_suffixes(buf, off, gram, length)
        text = np.searchsorted(off, at, side="right")
        order = np.lexsort((keys, text))
        text, keys = text[order], keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = (text[1:] != text[:-1]) | (keys[1:] != keys[:-1])
        return text[new], keys[new]

    def suffixes(texts: pa.Table, recurring: pa.Table) -> pa.Table:
        own = distinct_texts(texts)
        known = Lookup(returned_keys(recurring, buckets)[0])
        ties = tie_numbers(own)
        parts = []
        for first, buf, off in own.slices():
            at, keys = chosen_suffixes(buf, off, gram, length)
            at = at[known(reduced(keys, buckets))[0]]
            rows, left, right = contexts(buf, off, at, shape.before, length)
            text = np.searchsorted(off, at, side="right") - 1
            parts.append((rows, left, right, own.first[first + text], at - off[text] + (ties[first + text] << TIE_BITS)))
        if not parts or not sum(len(p[1]) for p in parts):
            return _table([])
        rows, left, right, doc, place = (np.concatenate([p[k] for p in parts]) for k in range(5))
        # equal contexts travel once; the others of the group share all strings with it
        whole = np.concatenate([rows, left[:, None].astype(np.uint8), right[:, None].astype(np.uint8)], axis=1)
        order = np.lexsort((place, doc))
        order = order[multikey_order(whole[order])]
        new = np.append(True, (whole[order[1:]] != whole[order[:-1]]).any(axis=1))
        lead = np.zeros(len(order), bool)
        lead[order] = new
        first_doc = np.empty(len(order), np.int64)
        first_doc[order] = np.repeat(doc[order[new]], np.diff(np.append(np.flatnonzero(new), len(order))))
        grp = texts.column("grp")[0].as_py()
        out = []
        rest = np.flatnonzero(~lead & (doc > first_doc))
        if len(rest):
            mask = shape.mask_of_valid(left[rest], right[rest])
            out.append((grp % cells, grp, SETTLED, len(rest), packed(doc[rest].tobytes() + place[rest].tobytes() + mask.tobytes())))
        # further places of the least document itself travel as well: they are as much in question
        sent = order[(lead | (doc == first_doc))[order]]
        route = np.searchsorted(splitters, np.ascontiguousarray(rows[sent]).view(f"S{shape.width}").ravel(), side="right") if len(splitters) else np.zeros(len(sent), np.int64)
        for bucket, n, data in blobs(route, rows[sent], left[sent].astype(np.uint8), right[sent].astype(np.uint8), doc[sent], place[sent]):
            out.append((bucket, grp, SUFFIXES, n, packed(data)))
        return _table(out)

    def sort_bucket(table: pa.Table) -> pa.Table:
        out, parts = [], []
        for grp, kind, n, data in zip(*(table.column(c).to_pylist() for c in ("grp", "kind", "n", "data")), strict=True):
            if kind == SETTLED:
                out.append((grp % cells, grp, SETTLED, n, data))
            else:
                rows, left, right, doc, place = from_blob(n, unpacked(data), f"V{shape.width}", "u1", "u1", "<i8", "<i8")
                parts.append((rows.view(np.uint8).reshape(n, shape.width), left, right, doc, place, np.full(n, grp, np.int64)))
        if not parts:
            return _table(out)
        rows, left, right, doc, place, grp = (np.concatenate([p[k] for p in parts]) for k in range(6))
        order = multikey_order(rows)
        rows, left, right, doc, place, grp = (x[order] for x in (rows, left, right, doc, place, grp))
        lcp = common_prefixes(rows, length)
        run = np.cumsum(lcp < gram) - 1
        several = np.bincount(run)[run] > 1
        edge = (run == 0) | (run == run[-1])
        mask = np.zeros(len(rows), np.uint64)
        across = []
        back = np.zeros(len(rows), np.uint64)  # hash of the b bytes before
        ahead = prefix_hashes(rows[:, :length]) if edge.any() else None
        for b in range(shape.before + 1):
            if b:
                back = (back + LETTERS[rows[:, length + b - 1]]) * U(BYTE_STEP)
            ok = shape.valid(left, right, b)
            inner = np.flatnonzero(ok & several & ~edge)
            if len(inner):
                shared = np.cumsum(lcp < length - b).astype(np.uint64)[inner]
                least = least_by(mix(back[inner]) + shared * U(0x9E3779B97F4A7C15), doc[inner])
                hit = inner[least < doc[inner]]
                mask[hit] |= U(1) << U(b)
            outer = np.flatnonzero(ok & edge)
            if len(outer):
                key = mix(mix(back[outer]) + ahead(length - b)[outer] + U(b))
                across.append((key, doc[outer], place[outer], grp[outer], np.full(len(outer), b, np.int64)))
        hit = np.flatnonzero(mask)
        for g, n, data in blobs(grp[hit], doc[hit], place[hit], mask[hit]):
            out.append((g % cells, g, SETTLED, n, packed(data)))
        if across:
            key, d, p, g, b = (np.concatenate([x[k] for x in across]) for k in range(5))
            for bucket, n, data in blobs((key % U(cells)).astype(np.int64), key, d, p, g, b.astype(np.uint8)):
                out.append((bucket, -1, ACROSS, n, packed(data)))
        return _table(out)

    def compare_across(table: pa.Table) -> pa.Table:
        out, parts = [], []
        for grp, kind, n, data in zip(*(table.column(c).to_pylist() for c in ("grp", "kind", "n", "data")), strict=True):
            if kind == SETTLED:
                out.append((0, grp, SETTLED, n, data))
            else:
                parts.append(from_blob(n, unpacked(data), "<u8", "<i8", "<i8", "<i8", "u1"))
        if parts:
            key, doc, place, grp, b = (np.concatenate([p[k] for p in parts]) for k in range(5))
            hit = np.flatnonzero(least_by(key, doc) < doc)
            for g, n, data in blobs(grp[hit], doc[hit], place[hit], U(1) << b[hit].astype(np.uint64)):
                out.append((0, g, SETTLED, n, packed(data)))
        return _table(out)

    def remove(texts: pa.Table, hits: pa.Table) -> pa.Table:
        own = distinct_texts(texts)
        found = [from_blob(n, unpacked(x), "<i8", "<i8", "<u8") for n, x in zip(hits.column("n").to_pylist(), hits.column("data").to_pylist(), strict=True)]
        doc, place = (np.concatenate([np.zeros(0, np.int64), *[c[k] for c in found]]) for k in range(2))
        mask = np.concatenate([np.zeros(0, np.uint64), *[c[2] for c in found]])
        # the text that a hit is meant for: the one of its number among those with its id
        by_tie = np.empty(len(own.first), np.int64)
        by_tie[np.searchsorted(own.first, own.first) + tie_numbers(own)] = np.arange(len(own.first))
        text = by_tie[np.searchsorted(own.first, doc) + (place >> TIE_BITS)]
        place &= (1 << TIE_BITS) - 1
        order = np.argsort(text, kind="stable")
        text, place, mask = text[order], place[order], mask[order]
        begin, end = (np.searchsorted(text, np.arange(len(own.first)), side=x) for x in ("left", "right"))
        raw = own.texts.cast(pa.binary())
        spans, kept = [], []
        for i in range(len(own.first)):
            if begin[i] == end[i]:
                spans.append([])
                kept.append(None)
                continue
            text = np.frombuffer(raw[i].as_buffer(), np.uint8)
            at, bits = place[begin[i] : end[i]], mask[begin[i] : end[i]]
            change = np.zeros(len(text) + 1, np.int64)
            for b in range(shape.before + 1):
                start = at[(bits >> U(b)) & U(1) == 1] - b
                np.add.at(change, start, 1)
                np.add.at(change, start + length, -1)
            gone = np.cumsum(change[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
            spans.append([{"start": a, "end": z} for a, z in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)])
            kept.append(text[~gone].tobytes())
        size = np.array([len(x.as_buffer()) for x in raw], np.int64)[own.rows] if len(raw) else np.zeros(0, np.int64)
        further = own.ids > own.first[own.rows]
        out_spans, out_kept = [], []
        for r, more, n in zip(own.rows.tolist(), further.tolist(), size.tolist(), strict=True):
            everything = more and n >= length
            out_spans.append([{"start": 0, "end": n}] if everything else [] if more else spans[r])
            out_kept.append(b"" if everything else raw[r].as_py() if more or kept[r] is None else kept[r])
        return pa.table({"doc_id": texts.column("doc_id"), "n_bytes": pa.array(size), "spans": pa.array(out_spans, SPANS), "kept": pa.array(out_kept, pa.binary())})

    def copies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [x.encode() for x in batch.column("text").to_pylist()]
            spans = [[{"start": 0, "end": len(x)}] if len(x) >= length else [] for x in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in raw], pa.int64()), pa.array(spans, SPANS), pa.array([b"" if s else x for x, s in zip(raw, spans, strict=True)], pa.binary())], ["doc_id", "n_bytes", "spans", "kept"]
            )

    recurring = recurring_keys(group_keys(grouped, keys_of, buckets))
    texts = grouped.texts.groupBy("grp")
    sent = texts.cogroup(recurring.groupBy("grp")).applyInArrow(tidy_pair(suffixes), ROWS)
    settled = sent.groupBy("route").applyInArrow(sort_bucket, ROWS).groupBy("route").applyInArrow(compare_across, ROWS)
    out = texts.cogroup(settled.groupBy("grp")).applyInArrow(tidy_pair(remove), KEPT)
    return out.unionByName(grouped.copies.mapInArrow(tidy(copies), KEPT))

