"""N-gram Jaccard join by T-occurrence search.

Two documents link when their sets of distinct ``shingle``-word shingles have a
Jaccard similarity of ``threshold_percent`` or more.  Steps:

1. Each distinct text sends a prefix of its set in the order of the hashes to
   buckets, once per group (:mod:`recoengine.llm._groups`); back come the
   shingles that other texts have in their prefixes, with the number of texts.  Linked
   texts share at least l of the shingles in their prefixes of
   ``size - ceil(t * size) + l``, and so one of the rarest of these (again a
   prefix, in the order of those numbers).  A text whose rarest prefix
   shingles nobody else has cannot link and is done; common passages are not
   among the rarest and join nothing.
2. Texts that share such a rare shingle are connected to blocks
   (:mod:`recoengine.llm._graph`, over texts and shingles, so no pair is made).
   Links never leave a block.
3. Each block searches for links by DivideSkip over inverted lists of the
   whole sets: a text's longest lists are set aside, the short ones are merged by a heap
   that skips ids which cannot reach the remaining threshold, and candidates
   are looked up in the long lists by binary search.  A candidate already
   connected to the text needs no look-up, and once a text is connected to
   all but a few of the block, these few are compared directly.
4. A block of more than ``tile_rows`` texts is dealt into tiles and each pair
   of tiles is searched on its own; the links found (a spanning forest for each) are
   joined to components.

The join returns one row per document with its class; copies stand under the
least id of their text and are never expanded to pairs.

Defined cases: null and empty texts and texts without words have an empty set
and link with nothing; with fewer than ``shingle`` words the whole sequence is
the only shingle; words are runs of characters other than ASCII white space, A-Z
lower-cased; rows with equal ids are one node and keep a row each; a null id
has a null component; an empty table gives an empty result; further columns
are not read, and kept by ``keep_one``.  Hashes of shingles have 64 bits.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine.llm._graph import connected_components
from recoengine.llm._groups import LAST_ID, SLICE_BYTES, Lookup, distinct_texts, group_keys, group_texts, recurring_keys, reduced, returned_keys
from recoengine.llm._util import cut, sorted_groups, text_bytes, text_slices, tidy, tidy_pair
from recoengine.llm._words import FOLDED, WORD_STEP, Words, inside_texts, mix, prefix_sums, shingle_hashes, stretches

#: Bit that tells shingles from documents among the nodes of the graph.
SHINGLE_NODE = 1 << 62
#: Of the DivideSkip rule for the number of long lists, as published.
MU = 0.0085
FEW = 32


def shingle_sets(buf: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted by hash, one text after the
    other, and n + 1 offsets."""
    words = Words(buf, off)
    hashes = words.hashes(FOLDED)
    all_k = shingle_hashes(hashes, k)
    inside = inside_texts(words.off, len(all_k), k)
    text = words.doc[: len(all_k)][inside]
    values = all_k[inside]
    count = np.diff(words.off)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        whole = mix(stretches(prefix_sums(hashes, WORD_STEP), WORD_STEP, words.off[short], words.off[short + 1]) + count[short].astype(np.uint64))
        text, values = np.concatenate([text, short]), np.concatenate([values, whole])
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (text[1:] != text[:-1]) | (values[1:] != values[:-1])
    return values[new], np.searchsorted(text[new], np.arange(len(off)))


class Rule:
    """Sizes that follow from the threshold in per cent."""

    def __init__(self, percent: int):
        self.percent = percent

    def least_overlap(self, size):
        """With any partner: ceil(t * size)."""
        return -(-self.percent * size // 100)

    def in_prefix(self, size):
        """l of a set: a tenth of it (rounded up)."""
        return -(-size // 10)

    def prefix(self, size):
        return np.minimum(size, size - self.least_overlap(size) + self.in_prefix(size))

    def rarest(self, size):
        """How many of the prefix's rarest shingles decide.  A partner may be
        smaller, and shares at least its own l with the prefix."""
        partner = self.least_overlap(size)
        return self.prefix(size) - np.minimum(self.in_prefix(partner), self.prefix(partner)) + 1

    def linked(self, overlap: int, a: int, b: int) -> bool:
        return 100 * overlap >= self.percent * (a + b - overlap)

    def needed(self, a: int, b: int) -> int:
        """The least overlap of sets of these sizes that link."""
        return -(-self.percent * (a + b) // (100 + self.percent))


class Block:
    """Inverted lists of the sets seen so far, and their components."""

    def __init__(self, n: int, rule: Rule):
        self.rule = rule
        self.lists: dict[int, list[int]] = {}
        self.parent = list(range(n))
        self.weight = [0] * n  # sets of the index in a root's component
        self.sets: list[list[int]] = [[] for _ in range(n)]
        self.indexed: list[int] = []

    def find(self, a: int) -> int:
        while self.parent[a] != a:
            self.parent[a] = self.parent[self.parent[a]]
            a = self.parent[a]
        return a

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            a, b = min(a, b), max(a, b)
            self.parent[b] = a
            self.weight[a] += self.weight[b]

    def add(self, i: int, tokens: list[int]) -> None:
        self.weight[self.find(i)] += 1
        self.indexed.append(i)
        self.sets[i] = tokens
        for t in tokens:
            self.lists.setdefault(t, []).append(i)

    def search(self, i: int, tokens: list[int], size: int, sizes: list[int]) -> None:
        """Join set i to every indexed set it links with (those in one
        component with it already are left out)."""
        need = self.rule.least_overlap(size)
        first = self.indexed[bisect_left(self.indexed, need, key=lambda j: sizes[j])] if self.indexed and sizes[self.indexed[-1]] >= need else None
        if first is None:
            return
        lists = [x for t in tokens if (x := self.lists.get(t)) and x[-1] >= first]
        if len(lists) < need:
            return
        lists.sort(key=len, reverse=True)
        n_long = min(need - 1, int(need / (MU * math.log(max(2, len(lists[0]))) + 1)))
        long, short, least = lists[:n_long], lists[n_long:], need - n_long
        # ids come in ascending order from a heap of (id, list)
        at = [bisect_left(x, first) for x in short]
        heap = [(x[p], k) for k, (x, p) in enumerate(zip(short, at, strict=True)) if p < len(x)]
        heapq.heapify(heap)
        while len(heap) >= least:
            top, popped = heap[0][0], []
            while heap and heap[0][0] == top:
                popped.append(heapq.heappop(heap)[1])
            if len(popped) >= least:
                if self.find(top) != self.find(i) and self._verified(top, len(popped), long, size, sizes[top]):
                    self.join(i, top)
                    if self._few_left(i, size, sizes, tokens):
                        return
                target = top + 1
            else:
                while heap and len(popped) < least - 1:
                    popped.append(heapq.heappop(heap)[1])
                if not heap:
                    return
                target = heap[0][0]
            for k in popped:
                at[k] = bisect_left(short[k], target, at[k])
                if at[k] < len(short[k]):
                    heapq.heappush(heap, (short[k][at[k]], k))

    def _verified(self, j: int, found: int, long: list[list[int]], size: int, other: int) -> bool:
        need, left = self.rule.needed(size, other), len(long)
        for x in long:
            if found >= need:
                return True
            if found + left < need:
                return False
            left -= 1
            p = bisect_left(x, j)
            found += p < len(x) and x[p] == j
        return found >= need

    def _few_left(self, i: int, size: int, sizes: list[int], tokens: list[int]) -> bool:
        """Whether nearly all indexed sets are connected to i; the others are
        then compared by looking their shingles up."""
        if len(self.indexed) - self.weight[self.find(i)] > FEW:
            return False
        if len(self.indexed) > self.weight[self.find(i)]:
            own = set(tokens)
            for j in self.indexed:
                if self.find(j) != self.find(i) and self.rule.linked(sum(t in own for t in self.sets[j]), size, sizes[j]):
                    self.join(i, j)
        return True


def link_block(sets: list[np.ndarray], sizes: list[int], side: list[int], both: bool, rule: Rule) -> list[int]:
    """The component (least item) of each set; the sets are in ascending
    order of size.  With ``both`` sets link only across the sides 0 and 1
    (links within a side are another task's)."""
    # shingles of one set alone can't count; the others get small numbers
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    off = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    n = len(sets)
    blocks = [Block(n, rule)]
    if both:
        blocks.append(Block(n, rule))
        blocks[1].parent = blocks[0].parent
        blocks[1].weight = [0] * n
        blocks[0].weight = [0] * n
    for i in range(n):
        own = place[off[i] : off[i + 1]]
        tokens = own[count[own] > 1].tolist()
        if both:
            blocks[1 - side[i]].search(i, tokens, sizes[i], sizes)
            blocks[side[i]].add(i, tokens)
        else:
            blocks[0].search(i, tokens, sizes[i], sizes)
            blocks[0].add(i, tokens)
    return [blocks[0].find(i) for i in range(n)]


SETS = "doc_id long, first long, n_shingles long, shingles array<long>, rare array<long>"


def _candidates(docs: DataFrame, shingle: int, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    """doc_id, the least id of the text and the size of the set of every row; of one row of
    each text that may link also the set and its rare prefix shingles."""
    grouped = group_texts(docs, id_col=id_col, text_col=text_col)
    buckets = grouped.n_buckets

    def prefixes(values: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.diff(off)
        keep = rule.prefix(size)
        text = np.repeat(np.arange(len(size)), keep)
        return text, np.repeat(off[:-1] - (np.cumsum(keep) - keep), keep) + np.arange(len(text))

    def keys_of(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values, ends = shingle_sets(buf, off, shingle)
        text, at = prefixes(values, ends)
        return text, values[at]

    def choose(texts: pa.Table, recurring: pa.Table) -> pa.Table:
        own = distinct_texts(texts)
        keys, counts = returned_keys(recurring, buckets)
        known = Lookup(keys)
        n = len(own.first)
        size, sets, rare = np.zeros(n, np.int64), [None] * n, [None] * n
        for first, buf, off in own.slices():
            values, ends = shingle_sets(buf, off, shingle)
            size[first : first + len(ends) - 1] = np.diff(ends)
            text, at = prefixes(values, ends)
            key = reduced(values[at], buckets)
            which, place = known(key)
            shared = np.bincount(text[which], minlength=len(ends) - 1)
            order = which[np.lexsort((key[which], counts[place], text[which]))]
            begin = np.concatenate([[0], np.cumsum(shared)])
            for i in np.flatnonzero(shared).tolist():
                s = int(ends[i + 1] - ends[i])
                # the shingles of this text alone are the rarest of all
                left = int(rule.rarest(s)) - (int(rule.prefix(s)) - int(shared[i]))
                if left > 0:
                    rare[first + i] = key[order[begin[i] : begin[i] + left]].astype(np.int64)
                    sets[first + i] = values[ends[i] : ends[i + 1]].view(np.int64)
        taken: set[int] = set()
        out_sets, out_rare = [], []
        for r, doc in zip(own.rows.tolist(), own.ids.tolist(), strict=True):
            lead = sets[r] is not None and doc == own.first[r] and doc != LAST_ID and r not in taken
            if lead:
                taken.add(r)
            out_sets.append(sets[r] if lead else None)
            out_rare.append(rare[r] if lead else None)
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "first": pa.array(np.where(own.first[own.rows] == LAST_ID, 0, own.first[own.rows]), mask=own.first[own.rows] == LAST_ID),
                "n_shingles": pa.array(size[own.rows]),
                "shingles": pa.array(out_sets, pa.list_(pa.int64())),
                "rare": pa.array(out_rare, pa.list_(pa.int64())),
            }
        )

    def copies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = [np.zeros(0, np.int64)]
            for first, end in text_slices(batch.column("text"), SLICE_BYTES):
                size.append(np.diff(shingle_sets(*text_bytes(batch.column("text").slice(first, end - first)), shingle)[1]))
            nothing = pa.nulls(batch.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("first"), pa.array(np.concatenate(size), pa.int64()), nothing, nothing], ["doc_id", "first", "n_shingles", "shingles", "rare"])

    recurring = recurring_keys(group_keys(grouped, keys_of, buckets))
    found = grouped.texts.groupBy("grp").cogroup(recurring.groupBy("grp")).applyInArrow(tidy_pair(choose), SETS)
    return found.unionByName(grouped.copies.mapInArrow(tidy(copies), SETS))


def _block_links(members: DataFrame, rule: Rule) -> DataFrame:
    """(node, root) of the sets in each block or pair of tiles.  ``members``:
    block, tiles (how many the block is dealt into), doc_id, n_shingles, shingles."""
    tiled = members.withColumn("tile", F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.select("block", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"), "n_shingles", "doc_id", "tile", "shingles")
    key = ["block", "tile_a", "tile_b"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, len(key)):
            if group.num_rows < 2:
                continue
            ids, tiles = group.column("doc_id").to_numpy(), group.column("tile").to_pylist()
            column = group.column("shingles").combine_chunks()
            values, off = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(np.diff(column.offsets.to_numpy()))])
            sets = [values[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            both = group.column("tile_a")[0].as_py() != group.column("tile_b")[0].as_py()
            roots = link_block(sets, group.column("n_shingles").to_pylist(), [int(t != tiles[0]) for t in tiles], both, rule)
            own = [i for i, r in enumerate(roots) if i != r]
            if own:
                yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(ids[[roots[i] for i in own]])], ["node", "root"])

    order = [*key, "n_shingles", "doc_id"]
    return tiled.repartition(*key).sortWithinPartitions(*order).mapInArrow(run, "node long, root long")


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold_percent: int = 80, tile_rows: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    rule = Rule(threshold_percent)
    found = cut(_candidates(docs, shingle, rule, id_col, text_col))
    sets = found.filter("shingles is not null")
    if not sets.groupBy("doc_id").count().filter("count > 1").isEmpty():
        # a text of very many rows that share its least id has a set in several groups
        sets = cut(sets.dropDuplicates(["doc_id", "shingles"]))
    edges = sets.select(F.col("doc_id").alias("a"), F.explode("rare").alias("token")).select("a", (F.col("token").bitwiseAND(SHINGLE_NODE - 1) + F.lit(SHINGLE_NODE)).alias("b"))
    blocks = connected_components(edges).filter(F.col("node") < SHINGLE_NODE)
    counted = blocks.groupBy("component").count().filter("count > 1")
    counted = cut(counted.select(F.col("component").alias("block"), F.ceil(F.col("count") / tile_rows).cast("int").alias("tiles")))
    blocks = blocks.join(counted, F.col("component") == F.col("block")).select("node", "block", "tiles")
    members = sets.join(blocks, F.col("doc_id") == F.col("node")).select("block", "tiles", "doc_id", "n_shingles", "shingles")
    links = _block_links(members, rule)
    components = connected_components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    rows = found.select("doc_id", "first", "n_shingles")
    known = rows.join(components, F.col("first") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(F.coalesce("component", "first"))
    return known.select("doc_id", "n_shingles", component.alias("component_id"))


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """The documents less those that link, directly or not, to one with a
    smaller id: of each class the document with the least id stays.  Rows with
    equal ids stay or go together; rows with a null id stay."""
    gone = near_duplicates(docs, **settings).filter("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
