"""Periodic runs of words: maximal repetitions of whole texts, found by suffix trees.

A run is a stretch of consecutive words with smallest period q that is
``max(least_length, 2 * q)`` words long or longer and that no neighbouring word
extends with period q.  Of every text that repeats anything:

1. Ukkonen's algorithm builds the suffix tree of the words and that of their
   reversal, in one pass each.
2. An Euler tour of a tree turns the lowest common ancestor of two leaves into
   the least depth between two places of the tour, which tables over blocks of
   the tour answer in constant time.  So the longest common extension (LCE) of
   any two places is known, to the right by the one tree, to the left by the other.
3. The longest Lyndon word that begins at a place is the root of a candidate;
   it ends before the next smaller suffix, by the order of the tree's leaves.
   Both orders of the alphabet are taken, so that every run has a root among
   the candidates.  Candidates are extended in both directions by LCE; those
   that are long enough are the runs.

Trees are built only over the words that can belong to a run.  In a run, words a period
apart agree for ``least_length / 2`` words or more, so each of its words
is covered by a string of that many words that the run holds twice.  So words
are kept that such strings cover, then those that strings cover which stand
twice in one stretch of kept words, until nothing changes.  The stretches of a
text are joined by symbols that occur once.  A document is one row of one pass without
a shuffle; a task holds a batch and the tree of one text, some 500 bytes per
covered word.

Words are the runs of bytes other than ASCII white space; two words are equal
if their bytes are (the search for covered words compares 64-bit hashes, which
can only cover more).

Defined cases: null text has no words, no runs and an empty collapsed text;
white space alone likewise; a null id stays null; equal rows are treated alike, each
on its own; a word in several runs goes if any of them drops it; an empty table gives an empty result; further
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine.llm._util import prepare, text_bytes, text_slices
from recoengine.llm._words import LETTERS, U, Words, inside_texts, mix, shingle_hashes

SLICE_BYTES = 1 << 20
RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
#: Places of an Euler tour to a block.
BLOCK_BITS = 4


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of numbers >= 0 and an end sign.

    Inner nodes are numbered from 0 (the root); the leaf of the suffix at j is
    ~j.  ``depth`` is an inner node's string depth and ``head`` a place where
    its string stands, so that the label of an edge from v to c begins at
    head(c) + depth(v)."""

    END = -1

    def __init__(self, symbols: list[int]):
        s = [*symbols, self.END]
        depth, head, link, kids = [0], [0], [0], [{}]
        node = length = edge = waiting = 0
        for i, x in enumerate(s):
            waiting += 1
            last = -1  # the node whose suffix link is due
            while waiting:
                if not length:
                    edge = i
                own = kids[node]
                first = s[edge]
                child = own.get(first)
                if child is None:
                    own[first] = ~(i - waiting + 1)
                    if last >= 0:
                        link[last] = node
                        last = -1
                else:
                    if child >= 0:
                        span = depth[child] - depth[node]
                        if length >= span:
                            edge += span
                            length -= span
                            node = child
                            continue
                        place = head[child]
                    else:
                        place = ~child
                    below = s[place + depth[node] + length]
                    if below == x:
                        length += 1
                        if last >= 0:
                            link[last] = node
                        break
                    made = len(depth)
                    depth.append(depth[node] + length)
                    head.append(place)
                    link.append(0)
                    kids.append({below: child, x: ~(i - waiting + 1)})
                    own[first] = made
                    if last >= 0:
                        link[last] = made
                    last = made
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self.n, self.depth, self.kids = len(s), depth, kids

    def tour(self) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """(depths along the Euler tour of the inner nodes, the place of each
        leaf's parent in it, the leaves in order)."""
        depth, kids, back = self.depth, self.kids, len(self.depth)
        depths, order, place = [], [], [0] * self.n
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:
                place[~v] = len(depths) - 1
                order.append(~v)
            elif v >= back:  # returned from a child
                depths.append(depth[v - back])
            else:
                depths.append(depth[v])
                for _, child in sorted(kids[v].items(), reverse=True):
                    if child >= 0:
                        stack.append(v + back)
                    stack.append(child)
        return np.array(depths, np.int64), np.array(place, np.int64), order

    def opposite_order(self) -> list[int]:
        """The leaves in the order of the reversed alphabet; the end sign
        remains the least."""
        order, stack, kids = [], [0], self.kids
        while stack:
            v = stack.pop()
            if v < 0:
                order.append(~v)
            else:
                own = sorted(kids[v].items())
                if own[0][0] == self.END:
                    own.append(own.pop(0))
                stack += [child for _, child in own]
        return order


class CommonExtension:
    """Longest common prefixes of any two suffixes of a tree, in constant time
    each: the least depth between two places of the Euler tour, from minima
    within blocks and a sparse table over the blocks."""

    def __init__(self, depths: np.ndarray, place: np.ndarray):
        size = 1 << BLOCK_BITS
        blocks = -(-len(depths) // size)
        padded = np.full(blocks * size, np.iinfo(np.int64).max)
        padded[: len(depths)] = depths
        grid = padded.reshape(blocks, size)
        self.depths, self.place = padded, place
        self.ahead = np.minimum.accumulate(grid, axis=1).ravel()
        self.behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [grid.min(axis=1)]
        while 2 << (len(self.levels) - 1) <= blocks:
            half, top = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(top[:-half], top[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = self.place[a], self.place[b]
        left, right = np.minimum(a, b), np.maximum(a, b)
        first, last = left >> BLOCK_BITS, right >> BLOCK_BITS
        out = np.minimum(self.behind[left], self.ahead[right])
        inner = last - first - 1
        own = np.flatnonzero(inner > 0)
        if len(own):
            level = np.frexp(inner[own].astype(np.float64))[1] - 1
            for k in np.unique(level).tolist():
                at = own[level == k]
                table = self.levels[k]
                out[at] = np.minimum(out[at], np.minimum(table[first[at] + 1], table[last[at] - (1 << k)]))
        same = np.flatnonzero(inner < 0)
        if len(same):
            low, high = left[same], right[same]
            least = self.depths[low]
            for step in range(1, 1 << BLOCK_BITS):
                least = np.minimum(least, self.depths[np.minimum(low + step, high)])
            out[same] = least
        return out


def next_smaller(order: list[int]) -> np.ndarray:
    """For each suffix but the end sign the next place whose suffix is smaller,
    from the suffixes in order."""
    rank = [0] * len(order)
    for r, i in enumerate(order):
        rank[i] = r
    out, open_places = [0] * (len(order) - 1), []
    for i, r in enumerate(rank):
        while open_places and rank[open_places[-1]] > r:
            out[open_places.pop()] = i
        open_places.append(i)
    return np.array(out, np.int64)


def runs_of(symbols: list[int], least_length: int = 12) -> np.ndarray:
    """(start, length, period) of the runs of a sequence of numbers >= 0,
    ordered by start and period."""
    n = len(symbols)
    if n < max(2, least_length):
        return np.zeros((0, 3), np.int64)
    tree = SuffixTree(symbols)
    depths, place, order = tree.tour()
    ahead = CommonExtension(depths, place)
    ends = [next_smaller(order), next_smaller(tree.opposite_order())]
    del tree
    back = CommonExtension(*SuffixTree(symbols[::-1]).tour()[:2])
    found = []
    start = np.arange(n)
    for end in ends:  # a Lyndon root is start..end
        right = ahead(start, end)  # the end sign's suffix shares nothing
        left = np.zeros(n, np.int64)
        left[1:] = back(n - start[1:], n - end[1:])  # place i - 1 is place n - i of the reversal
        begin, length, period = start - left, left + right + end - start, end - start
        ok = (length >= 2 * period) & (length >= least_length)
        found.append(np.stack([begin[ok], period[ok], length[ok]], axis=1))
    return np.unique(np.concatenate(found), axis=0)[:, [0, 2, 1]]


def covered_words(words: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """Which words (hashes; ``off`` parts the texts) are covered by a string
    of k words that stands twice in their stretch of covered words.  The first
    stretches are the texts; those that are found take their place until none
    gets shorter."""
    out = np.zeros(len(words), bool)
    grams = shingle_hashes(words, k)
    if not len(grams):
        return out
    at = np.flatnonzero(inside_texts(off, len(grams), k))
    grams, stretch = grams[at], np.searchsorted(off, at, side="right")
    while len(at):
        keys = mix(grams + stretch.astype(np.uint64) * U(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(at), bool)
        twice[order[1:]] = same
        twice[order[:-1]] |= same
        if twice.all():
            break
        at, grams, text = at[twice], grams[twice], np.searchsorted(off, at[twice], side="right")
        stretch = np.cumsum(np.append(True, (at[1:] > at[:-1] + k) | (text[1:] != text[:-1]))) if len(at) else text
    change = np.zeros(len(words) + 1, np.int32)
    np.add.at(change, at, 1)
    np.add.at(change, at + k, -1)
    return np.cumsum(change[:-1]) > 0


def text_runs(words: list[bytes], covered: np.ndarray, least_length: int = 12) -> np.ndarray:
    """The runs of a text's words, from trees over the covered ones."""
    at = np.flatnonzero(covered)
    breaks = np.flatnonzero(np.diff(at) > 1) + 1
    numbers: dict[bytes, int] = {}
    symbols: list[int] = []
    where: list[np.ndarray] = []
    for k, stretch in enumerate(np.split(at, breaks)):
        if k:
            numbers[b" %d" % k] = len(numbers)  # no word holds a space
            symbols.append(len(numbers) - 1)
            where.append(np.zeros(1, np.int64))
        first, end = int(stretch[0]), int(stretch[-1]) + 1
        symbols += [numbers.setdefault(w, len(numbers)) for w in words[first:end]]
        where.append(stretch)
    runs = runs_of(symbols, least_length)
    runs[:, 0] = np.concatenate(where)[runs[:, 0]]
    return runs


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those after a run's first period, joined by a space."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) <= 0).tolist()])


def _lists(parts: list[np.ndarray]) -> pa.Array:
    rows = np.concatenate([np.zeros((0, 3), np.int64), *parts])
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    fields = [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(3)]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))


def periodic_runs(docs: DataFrame, least_length: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (ordered by start and period) and collapsed (the
    words outside the runs' repetitions, UTF-8) of every document."""
    if least_length < 2:
        raise ValueError("a run has two words at least")
    prepare(docs.sparkSession)
    k = (least_length + 1) // 2
    none = np.zeros((0, 3), np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end in text_slices(batch.column(1), SLICE_BYTES):
                part = batch.slice(first, end - first)
                buf, off = text_bytes(part.column(1))
                words = Words(buf, off)
                covered = covered_words(words.hashes(LETTERS), words.off, k)
                raw, begin = buf.tobytes(), words.off.tolist()
                runs, collapsed = [], []
                for i, a in enumerate(off[:-1].tolist()):
                    own = raw[a : off[i + 1]].split()  # at ASCII white space, as the words are
                    mine = covered[begin[i] : begin[i + 1]]
                    runs.append(text_runs(own, mine, least_length) if mine.any() else none)
                    collapsed.append(collapse(own, runs[-1]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(words.off)), _lists(runs), pa.array(collapsed, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, RUNS)
