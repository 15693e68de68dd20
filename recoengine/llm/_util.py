"""Helpers shared by the operators: worker imports, lineage cuts, text slices."""

from __future__ import annotations

import contextlib
import gc
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from recoengine.session import ensure_checkpoint_dir

BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "2000"
PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder from the session's setting, and this package on the
    Python workers' path (a cluster that ships the package with
    ``--py-files`` needs no path)."""
    ensure_checkpoint_dir(spark)
    env = spark.sparkContext.environment
    if PACKAGE_ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (PACKAGE_ROOT, env.get("PYTHONPATH", "")) if x)
    # Whole texts make large rows: batches of Spark's default of 10,000 rows
    # would be held several times over (JVM, transfer, worker).
    if spark.conf.get(BATCH_CONF) == "10000":
        spark.conf.set(BATCH_CONF, BATCH_ROWS)


def cut(df: DataFrame) -> DataFrame:
    """Write the frame to the checkpoint folder (shared by all executors) and
    go on from the files: later reads survive lost executors and don't repeat
    the work above."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def release_memory() -> None:
    """Give memory that this worker process no longer uses back to the system:
    idle workers would keep it beside the JVM's."""
    import ctypes

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """A function over a task's batches that gives memory back when it ends."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return tidied


def tidy_pair(run):
    """A function over two cogrouped tables that gives memory back after each group."""

    def tidied(left, right):
        try:
            return run(left, right)
        finally:
            release_memory()

    return tidied


def text_slices(texts: pa.Array, max_bytes: int) -> Iterator[tuple[int, int]]:
    """(first, end) rows of consecutive slices holding about ``max_bytes`` of
    text each; a longer single text makes a slice of its own."""
    n = len(texts)
    if not n:
        return
    lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    total, first = 0, 0
    for i, size in enumerate(lengths.tolist()):
        if i > first and total + size > max_bytes:
            yield first, i
            first, total = i, 0
        total += size
    yield first, n


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and n + 1 offsets into it
    (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return buf, off - off[0]


def sorted_groups(batches, n_keys: int) -> Iterator[pa.Table]:
    """The groups of rows that agree in the first ``n_keys`` columns, from
    batches sorted by these; one group is held at a time."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n, bool)
        for k in range(n_keys):
            column = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= column[1:] != column[:-1]
        begin = [0, *np.flatnonzero(change).tolist(), n]
        for first, end in zip(begin[:-1], begin[1:], strict=True):
            key = tuple(batch.column(k)[first].as_py() for k in range(n_keys)) if first == 0 or end == n else None
            if held and (key is None or key != last):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(first, end - first))
            last = key
    if held:
        yield pa.Table.from_batches(held)
