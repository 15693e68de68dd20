"""Texts dealt into groups by content, and keys that recur across texts.

A group is a bounded share of the texts: its mean size grows with the root of
the corpus between 4 and 64 MiB (``group_bytes`` sets it), so that both the groups and
the cells that groups send to buckets stay few.  Several groups may share a partition.  Equal
texts fall into one group, where one of them stands for all; the further
copies of a text with very many of them are set apart before the shuffle.  Copies
that share the least id (or have none, all of them) are results of their own, the same
in every group: they are dealt by the partition they are read in, so a group holds
no more of them than its share, or one partition's.  The shuffled texts are used by several steps of one plan, which share the exchange.

Keys (64-bit hashes) go to buckets once per group, whatever the number of
texts that hold them there, so a key of a third of all texts costs as many
entries as there are groups.  Within a bucket 32 bits tell keys apart; two
keys taken for one only make a candidate more, and candidates are compared in
full afterwards.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine.llm._util import cut, prepare, text_bytes, text_slices, tidy

LEAST_GROUP, MOST_GROUP = 4 << 20, 64 << 20
MOST_PARTITIONS = 20_000
#: Text bytes whose keys a bucket compares, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS = 256 << 20, 48
SLICE_BYTES = 1 << 18
LAST_ID = np.iinfo(np.int64).max  # stands for a null id: larger than all others
MOST_HOT = 1000


@dataclass
class Grouped:
    texts: DataFrame  # grp, doc_id, text; dealt by grp
    copies: DataFrame  # doc_id, first, text: further copies of the texts with very many
    n_buckets: int
    n_bytes: int  # of all texts


def group_texts(docs: DataFrame, group_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> Grouped:
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    group_bytes = group_bytes or min(MOST_GROUP, max(LEAST_GROUP, math.isqrt(size << 14)))
    groups = max(1, -(-size // group_bytes))
    buckets = min(groups, max(LEAST_BUCKETS, -(-size // BUCKET_BYTES)))
    keyed = rows.withColumns({"k1": F.xxhash64("text"), "k2": F.hash("text"), "k3": F.octet_length("text")})
    # more than n / MOST_HOT copies each: at most MOST_HOT texts, whose numbers are broadcast
    hot = keyed.groupBy("k1", "k2", "k3").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).filter(F.col("n") > max(64, n // MOST_HOT))
    marked = keyed.join(F.broadcast(cut(hot.withColumn("hot", F.lit(True)).drop("n"))), ["k1", "k2", "k3"], "left")
    is_hot = F.coalesce("hot", F.lit(False))
    further = is_hot & ~F.col("doc_id").eqNullSafe(F.col("first"))
    dealt = F.when(is_hot, F.xxhash64("k1", F.spark_partition_id())).otherwise(F.col("k1"))
    texts = marked.filter(~further).select(F.pmod(dealt, F.lit(groups)).cast("int").alias("grp"), "doc_id", "text")
    return Grouped(texts.repartition(min(groups, MOST_PARTITIONS), "grp"), marked.filter(further).select("doc_id", "first", "text"), buckets, int(size))


@dataclass
class Distinct:
    """The distinct texts of a group in the order of their least ids."""

    first: np.ndarray  # the least id of each
    texts: pa.Array
    rows: np.ndarray  # each row's text
    ids: np.ndarray  # each row's id (LAST_ID for null)

    def slices(self, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of the first text, bytes, offsets) of slices of the texts."""
        for first, end in text_slices(self.texts, max_bytes):
            yield first, *text_bytes(self.texts.slice(first, end - first))


def distinct_texts(table: pa.Table) -> Distinct:
    ids = table.column("doc_id").fill_null(LAST_ID).to_numpy()
    order = np.argsort(ids, kind="stable")
    column = table.column("text").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    coded = column.take(pa.array(order)).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    first = np.full(len(coded.dictionary), LAST_ID, np.int64)
    np.minimum.at(first, code, ids[order])
    rows = np.empty(len(ids), np.int64)
    rows[order] = code
    return Distinct(first, coded.dictionary, rows, ids)


def packed(data: bytes) -> bytes:
    """Compressed, and the size before it in front."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def packed_rising(values: np.ndarray) -> bytes:
    """Rising 32-bit values as the steps between them, compressed byte by byte:
    of many values the upper bytes are hardly anything."""
    steps = np.diff(values.astype("<u4"), prepend=np.zeros(1, "<u4"))
    return packed(steps.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked_rising(data: bytes) -> np.ndarray:
    steps = np.frombuffer(unpacked(data), np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<u4").ravel(), dtype="<u4")


Keys = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def reduced(keys: np.ndarray, buckets: int) -> np.ndarray:
    """What is left of a key after it was dealt to its bucket and cut to 32 bits there."""
    b = np.uint64(buckets)
    return keys % b + b * ((keys // b) & np.uint64(0xFFFFFFFF))


def group_keys(grouped: Grouped, keys_of: Keys, buckets: int) -> DataFrame:
    """(bucket, grp, keys, counts): the keys of each group's distinct texts
    with the number of texts that have them (255 at most).  ``keys_of`` gives (text, key) of some
    texts, a key once per text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        seen: dict[int, set[bytes]] = {}
        found: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            groups = batch.column("grp").to_numpy()
            for grp in np.unique(groups).tolist():
                texts = batch.column("text").filter(pa.array(groups == grp))
                texts = texts.dictionary_encode().dictionary
                known = seen.setdefault(grp, set())
                digests = [hashlib.blake2b(x.as_buffer(), digest_size=16).digest() for x in texts]
                new = [i for i, x in enumerate(digests) if x not in known]
                known.update(digests)
                texts = texts.take(pa.array(new, pa.int64()))
                for first, end in text_slices(texts, SLICE_BYTES):
                    found.setdefault(grp, []).append(keys_of(*text_bytes(texts.slice(first, end - first)))[1])
        for grp, parts in found.items():
            keys, counts = np.unique(reduced(np.concatenate(parts), buckets), return_counts=True)
            bucket, rest = keys % np.uint64(buckets), (keys // np.uint64(buckets)).astype("<u4")
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rest, counts = rest[order], np.minimum(counts[order], 255).astype(np.uint8)
            own = [b for b in range(buckets) if ends[b] < ends[b + 1]]
            cells = [slice(ends[b], ends[b + 1]) for b in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int32()), pa.array([grp] * len(own), pa.int32()), pa.array([packed_rising(rest[c]) for c in cells], pa.binary()), pa.array([counts[c].tobytes() for c in cells], pa.binary())],
                ["bucket", "grp", "keys", "counts"],
            )

    return grouped.texts.mapInArrow(tidy(run), "bucket int, grp int, keys binary, counts binary")


def recurring_keys(keys: DataFrame) -> DataFrame:
    """(grp, bucket, keys, counts): of each group's keys those that further
    texts have, with the number of texts in all groups."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.num_rows
        parts = [unpacked_rising(x) for x in table.column("keys").to_pylist()]
        counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("counts")]).astype(np.int64)
        values, place = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(place, counts, len(values)).astype("<u4")
        off = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        own, out, sums = [], [], []
        for i in range(rows):
            at = place[off[i] : off[i + 1]]
            more = total[at] > 1
            if more.any():
                own.append(i)
                out.append(packed_rising(parts[i][more]))
                sums.append(total[at[more]].tobytes())
        picked = table.select(["grp", "bucket"]).take(pa.array(own, pa.int64()))
        return pa.table({"grp": picked.column("grp"), "bucket": picked.column("bucket"), "keys": pa.array(out, pa.binary()), "counts": pa.array(sums, pa.binary())})

    return keys.groupBy("bucket").applyInArrow(run, "grp int, bucket int, keys binary, counts binary")


def returned_keys(table: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The recurring keys that came back to a group (reduced, sorted) and
    the numbers of texts."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
    for bucket, k, c in zip(table.column("bucket").to_pylist(), table.column("keys").to_pylist(), table.column("counts"), strict=True):
        keys.append(unpacked_rising(k).astype(np.uint64) * np.uint64(buckets) + np.uint64(bucket))
        counts.append(np.frombuffer(c.as_buffer(), "<u4"))
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k)
    return k[order], c[order]


class Lookup:
    """Places of values in a sorted array, by way of a bit table that turns
    most strangers away."""

    BITS = 22

    def __init__(self, values: np.ndarray):
        self.values = values
        self.some = np.zeros(1 << self.BITS, bool)
        self.some[(values >> np.uint64(7)) & np.uint64((1 << self.BITS) - 1)] = True

    def __call__(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the wanted are there, their places)."""
        if not len(self.values):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        which = np.flatnonzero(self.some[(wanted >> np.uint64(7)) & np.uint64((1 << self.BITS) - 1)])
        place = np.minimum(np.searchsorted(self.values, wanted[which]), len(self.values) - 1)
        ok = self.values[place] == wanted[which]
        return which[ok], place[ok]


def blobs(buckets: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(bucket, rows, bytes of the columns one after the other) of each bucket."""
    if not len(buckets):
        return
    order = np.argsort(buckets, kind="stable")
    values, begin = np.unique(buckets[order], return_index=True)
    for value, own in zip(values.tolist(), np.split(order, begin[1:]), strict=True):
        yield value, len(own), b"".join(np.ascontiguousarray(c[own]).tobytes() for c in columns)


def from_blob(n: int, data: bytes, *kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = n * np.dtype(kind).itemsize
        out.append(np.frombuffer(data, kind, n, at))
        at += size
    return out
