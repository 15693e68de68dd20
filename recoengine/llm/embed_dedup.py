"""Near-duplicate embeddings by random-hyperplane signs in several tables.

Equal vectors are one class first (a partial aggregation, so a hot vector is
one row).  A class is signed by ``bits`` random hyperplanes in each of
``tables`` tables; classes that share a code in a table meet in that bucket,
where all pairs are compared by their exact cosine in double precision.  A
pair is counted in the first table in which it meets, so buckets return one
row per linked class (how many vectors it links to, and the bucket-local root
of its links) and never the pairs.  Roots are joined to components by
:func:`recoengine.llm._graph.connected_components`.

``bits`` grows with the logarithm of the number of classes, so that a bucket
holds about ``bucket_rows`` unrelated vectors at any size, and ``tables``
follows from the recall wanted at the threshold itself:
``1 - (1 - p**bits)**tables`` with p = 1 - arccos(threshold) / pi.  Closer
pairs are found with a higher chance.  Nothing is capped: a bucket of more
than ``tile_rows`` classes is dealt into tiles, and each pair of tiles is a
group of its own, so a task holds two tiles at most.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing (n_links 0, own component); vectors of different
lengths don't link; rows with equal ids are one node of the graph and keep a
row each; a null id has a null component; labels and further columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine.llm._graph import connected_components
from recoengine.llm._util import cut, prepare, sorted_groups

MAX_BITS = 30


def plan_tables(n: int, threshold: float, recall: float, bucket_rows: int) -> tuple[int, int]:
    """(bits, tables) for n classes."""
    bits = min(MAX_BITS, max(6, math.ceil(math.log2(max(1, n / bucket_rows)))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def hyperplanes(dim: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((count, dim))


def codes_of(vectors: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """(row, table) codes of the signs."""
    signs = vectors @ hyperplanes(vectors.shape[1], bits * tables, seed).T >= 0
    return (signs.reshape(len(vectors), tables, bits) @ (1 << np.arange(bits))).astype(np.int32)


def links_in(x: np.ndarray, y: np.ndarray, code_x: np.ndarray, code_y: np.ndarray, earlier: int, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with cosine >= threshold that share no earlier table's
    code; with ``same`` x and y are one set and each pair comes once."""
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    step = max(1, (1 << 20) // max(1, len(y)))
    for first in range(0, len(x), step):
        part = slice(first, first + step)
        near = (x[part] @ y.T) / nx[part, None] / ny >= threshold
        if same:
            near &= np.arange(len(y)) > np.arange(first, first + len(near))[:, None]
        i, j = np.nonzero(near)
        i += first
        for k in range(0, len(i), 1 << 18):
            a, b = i[k : k + (1 << 18)], j[k : k + (1 << 18)]
            new = ~(code_x[a, :earlier] == code_y[b, :earlier]).any(axis=1)
            yield a[new], b[new]


def local_roots(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least member of each item's component."""
    root = np.arange(n)
    while True:
        before = root.copy()
        for a, b in pairs:
            low = np.minimum(root[a], root[b])
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.9,
    recall: float = 0.99,
    bucket_rows: int = 64,
    tile_rows: int = 2048,
    seed: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = F.coalesce(F.col("vec_id").isNotNull() & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0), F.lit(False))
    classes = rows.filter(sound).groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    # scaled by the largest component, so that no square is infinite or vanishes
    classes = cut(classes.withColumn("largest", F.array_max(F.transform("vector", F.abs))))
    bits, tables = plan_tables(classes.count(), threshold, recall, bucket_rows)
    signed = cut(_signed(classes, bits, tables, seed))
    linked = cut(_linked(signed, tables, threshold, tile_rows))

    counts = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    components = connected_components(linked.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = cut(
        classes.join(counts, "rep", "left")
        .join(components, F.col("rep") == F.col("node"), "left")
        .select("vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    # the hot vector's rows are on the left of a join that Spark can split
    keyed = rows.withColumn("vector", F.when(sound, F.col("vector")))
    out = keyed.join(known, "vector", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def _signed(classes: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """rep, copies, vector (scaled) and codes of the classes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            off = lists.offsets.to_numpy()
            size = np.diff(off)
            values = lists.values.to_numpy(zero_copy_only=False)
            scale = batch.column("largest").to_numpy(zero_copy_only=False)
            codes = np.zeros((len(size), tables), np.int32)
            scaled = values[off[0] : off[-1]] / np.repeat(scale, size)
            for dim in np.unique(size).tolist():
                own = np.flatnonzero(size == dim)
                codes[own] = codes_of(scaled[(off[own] - off[0])[:, None] + np.arange(dim)], bits, tables, seed)
            flat = lambda x, o, t: pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(x, t))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("copies"), flat(scaled, off - off[0], pa.float64()), flat(codes.ravel(), np.arange(len(size) + 1) * tables, pa.int32())], ["rep", "copies", "vector", "codes"]
            )

    return classes.mapInArrow(run, "rep long, copies long, vector array<double>, codes array<int>")


def _linked(signed: DataFrame, tables: int, threshold: float, tile_rows: int) -> DataFrame:
    """(rep, links, root): of each class in each bucket where it has links
    not seen in an earlier table."""
    placed = signed.withColumn("dim", F.size("vector")).select("dim", F.posexplode("codes").alias("tbl", "code"), "rep", "copies", "vector", "codes")
    thin = signed.select(F.size("vector").alias("dim"), F.posexplode("codes").alias("tbl", "code"))
    large = cut(thin.groupBy("dim", "tbl", "code").count().filter(F.col("count") > tile_rows).withColumn("tiles", F.ceil(F.col("count") / tile_rows).cast("int")).drop("count"))
    placed = placed.join(large, ["dim", "tbl", "code"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    placed = placed.withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    key = ["dim", "tbl", "code", "tile_a", "tile_b"]
    placed = placed.select("dim", "tbl", "code", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"), "tile", "rep", "copies", "vector", "codes")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, len(key)):
            if group.num_rows < 2:
                continue
            dim, tbl, _, tile_a, tile_b = (group.column(k)[0].as_py() for k in range(5))
            tile, rep, copies = (group.column(k).to_numpy() for k in ("tile", "rep", "copies"))
            x = group.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dim)
            codes = group.column("codes").combine_chunks().flatten().to_numpy().reshape(-1, tables)
            a, b = np.flatnonzero(tile == tile_a), np.flatnonzero(tile == tile_b)
            links, pairs = np.zeros(len(rep), np.int64), []
            for i, j in links_in(x[a], x[b], codes[a], codes[b], tbl, threshold, tile_a == tile_b):
                i, j = a[i], b[j]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                pairs.append((i, j))
            some = np.flatnonzero(links)
            if len(some):
                root = local_roots(len(rep), pairs)
                yield pa.RecordBatch.from_arrays([pa.array(rep[some]), pa.array(links[some]), pa.array(rep[root[some]])], ["rep", "links", "root"])

    return placed.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "rep long, links long, root long")
