"""Repeated-phrase dedup: passages of ``window`` words that recur are removed
from all documents but the first.

Steps of one plan over the grouped texts (:mod:`recoengine.llm._groups`):

1. Every text chooses phrases of ``phrase`` words by winnowing, so that each
   passage of ``window`` words holds one that all documents with the passage
   choose.  Phrases chosen by two texts are confirmed as recurring by their hashes
   in buckets, each group's phrases once.
2. Each group is a shard: its recurring phrases are compiled into an
   Aho-Corasick automaton (pyahocorasick, over numbered words), and all texts of
   the group are streamed through it to locate every occurrence.
   A phrase goes to the shards that hold it and to no others, so the
   automata stay within a group's size however many passages the corpus has.
3. The windows around occurrences are checked exactly: their hashes go to
   buckets with the least id of the group, and come back where a smaller id
   than the group's largest has them.
4. Words covered by a window that also starts in a document with a smaller id
   are removed.

Nothing is collected, and a window of a third of all documents is one entry
per group.  Hashes have 64 bits.

Defined cases: null text has no words; texts shorter than a window keep all
words; copies of a text keep none (all of its windows start in the copy with
the least id); rows with equal ids take nothing from each other; a null id
is larger than all others; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recoengine.llm._groups import LAST_ID, Distinct, Lookup, blobs, distinct_texts, from_blob, group_keys, group_texts, recurring_keys, reduced, returned_keys
from recoengine.llm._util import tidy, tidy_pair
from recoengine.llm._words import LETTERS, Words, chosen, inside_texts, shingle_hashes

LETTERS_A_WORD = 2
KEPT = "doc_id long, n_words long, n_removed long, kept string"


def _order(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32)


def chosen_phrases(words: np.ndarray, off: np.ndarray, phrase: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the phrases that winnowing chooses."""
    hashes = shingle_hashes(words, phrase)
    at = np.flatnonzero(chosen(_order(hashes), window - phrase + 1) & inside_texts(off, len(hashes), phrase))
    return at, hashes[at]


def _once(text: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (text[1:] != text[:-1]) | (key[1:] != key[:-1])
    return text[new], key[new]


def _words_of(own: Distinct) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all distinct texts and the offsets of the texts."""
    hashes, off = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for _, buf, offsets in own.slices():
        words = Words(buf, offsets)
        hashes.append(words.hashes(LETTERS))
        off.append(words.off[1:] + off[-1][-1])
    return np.concatenate(hashes), np.concatenate(off)


def occurrences(words: np.ndarray, off: np.ndarray, starts: np.ndarray, phrase: int) -> np.ndarray:
    """The places of all occurrences of the phrases that begin at ``starts``,
    in all texts, by an Aho-Corasick automaton."""
    if not len(starts):
        return np.zeros(0, np.int64)
    import ahocorasick

    # Words of the phrases are numbered and written as LETTERS_A_WORD letters of disjoint
    # alphabets, so that the automaton's nodes have few branches; 0 is any other word.
    known = np.unique(words[starts[:, None] + np.arange(phrase)])
    place = np.minimum(np.searchsorted(known, words), len(known) - 1)
    number = np.where(known[place] == words, place + 1, 0)
    k = LETTERS_A_WORD
    base = math.ceil((len(known) + 1) ** (1 / k)) + 1
    letters = np.empty((len(words), k), "<u2")
    for i in range(k):
        letters[:, i] = 0x100 + i * base + number // base**i % base
    written = letters.tobytes().decode("utf-16-le")
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for p in (k * starts).tolist():
        automaton.add_word(written[p : p + k * phrase])
    automaton.make_automaton()
    found: list[int] = []
    for first, end in zip((k * off[:-1]).tolist(), (k * off[1:]).tolist(), strict=True):
        if end - first >= k * phrase:
            found += [last for last, _ in automaton.iter(written, first, end)]
    return (np.array(found, np.int64) + 1) // k - phrase


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in a stretch of ``length`` from one of the starts."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + length, n), -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, window: int = 13, phrase: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by one
    space) of every document."""
    grouped = group_texts(docs, id_col=id_col, text_col=text_col)
    buckets = grouped.n_buckets

    def keys_of(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = Words(buf, off)
        at, hashes = chosen_phrases(words.hashes(LETTERS), words.off, phrase, window)
        return _once(np.searchsorted(words.off, at, side="right"), hashes)

    def candidates(texts: pa.Table, recurring: pa.Table) -> pa.Table:
        own = distinct_texts(texts)
        words, off = _words_of(own)
        at, hashes = chosen_phrases(words, off, phrase, window)
        which, _ = Lookup(returned_keys(recurring, buckets)[0])(reduced(hashes, buckets))
        starts = at[which][np.unique(hashes[which], return_index=True)[1]] if len(which) else which
        found = occurrences(words, off, starts, phrase)
        n = max(0, len(words) - window + 1)
        reach = window - phrase + 1  # a window that holds the occurrence starts there or up to reach - 1 words before
        near = covered(np.maximum(found - reach + 1, 0), reach, len(words))
        wanted = np.flatnonzero(near[:n] & inside_texts(off, n, window))
        key = shingle_hashes(words, window)[wanted]
        doc = own.first[np.searchsorted(off, wanted, side="right") - 1]
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        least, most = (doc[begin], doc[np.append(begin[1:], len(key)) - 1]) if len(key) else (doc, doc)
        key = key[begin]
        cells = list(blobs((key % np.uint64(buckets)).astype(np.int64), key, least, most))
        grp = texts.column("grp")[0].as_py() if texts.num_rows else 0
        return pa.table(
            {"bucket": pa.array([c[0] for c in cells], pa.int32()), "grp": pa.array([grp] * len(cells), pa.int32()), "n": pa.array([c[1] for c in cells], pa.int32()), "data": pa.array([c[2] for c in cells], pa.binary())}
        )

    def earlier(table: pa.Table) -> pa.Table:
        """The windows that a document with a smaller id than a group's
        largest has, sent back to that group."""
        cells = [from_blob(n, x, "<u8", "<i8", "<i8") for n, x in zip(table.column("n").to_pylist(), table.column("data").to_pylist(), strict=True)]
        values, place = np.unique(np.concatenate([c[0] for c in cells]), return_inverse=True)
        first = np.full(len(values), LAST_ID, np.int64)
        np.minimum.at(first, place, np.concatenate([c[1] for c in cells]))
        out, at = [], 0
        for key, _, most in cells:
            least = first[place[at : at + len(key)]]
            at += len(key)
            hit = least < most
            out.append((int(hit.sum()), key[hit].tobytes() + least[hit].tobytes()))
        return pa.table({"grp": table.column("grp"), "n": pa.array([n for n, _ in out], pa.int32()), "data": pa.array([x for _, x in out], pa.binary())})

    def remove(texts: pa.Table, hits: pa.Table) -> pa.Table:
        own = distinct_texts(texts)
        words, off = _words_of(own)
        cells = [from_blob(n, x, "<u8", "<i8") for n, x in zip(hits.column("n").to_pylist(), hits.column("data").to_pylist(), strict=True)]
        key = np.concatenate([np.zeros(0, np.uint64), *[c[0] for c in cells]])
        first = np.concatenate([np.zeros(0, np.int64), *[c[1] for c in cells]])
        order = np.argsort(key)
        key, first = key[order], first[order]
        hashes = shingle_hashes(words, window)
        inside = inside_texts(off, len(hashes), window)
        which, place = Lookup(key)(hashes)
        keep = inside[which]
        which, place = which[keep], place[keep]
        doc = own.first[np.searchsorted(off, which, side="right") - 1]
        gone = covered(which[first[place] < doc], window, len(words))
        kept, removed = [], []
        for i, text in enumerate(own.texts):
            all_words, mask = text.as_py().encode().split(), gone[off[i] : off[i + 1]]
            n = int(mask.sum())
            removed.append(n)
            kept.append(b" ".join(itertools.compress(all_words, (~mask).tolist()) if n else all_words).decode())
        size, removed = np.diff(off), np.array(removed, np.int64)
        # a copy of a text whose first row has a smaller id loses everything that windows cover
        further = own.ids > own.first[own.rows]
        everything = further & (size[own.rows] >= window)
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "n_words": pa.array(size[own.rows]),
                "n_removed": pa.array(np.where(everything, size[own.rows], np.where(further, 0, removed[own.rows]))),
                "kept": pa.array(["" if e else kept[r] for e, r in zip(everything.tolist(), own.rows.tolist(), strict=True)], pa.string()),
            }
        )

    def copies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [x.encode().split() for x in batch.column("text").to_pylist()]
            long = [len(w) >= window for w in split]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(w) for w in split], pa.int64()), pa.array([len(w) if x else 0 for w, x in zip(split, long, strict=True)], pa.int64()), pa.array(["" if x else b" ".join(w).decode() for w, x in zip(split, long, strict=True)], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    recurring = recurring_keys(group_keys(grouped, keys_of, buckets))
    texts = grouped.texts.groupBy("grp")
    windows = texts.cogroup(recurring.groupBy("grp")).applyInArrow(tidy_pair(candidates), "bucket int, grp int, n int, data binary")
    hits = windows.groupBy("bucket").applyInArrow(earlier, "grp int, n int, data binary")
    out = texts.cogroup(hits.groupBy("grp")).applyInArrow(tidy_pair(remove), KEPT)
    return out.unionByName(grouped.copies.mapInArrow(tidy(copies), KEPT))
