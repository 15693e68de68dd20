"""Sources and sinks (SRC-1..4, SNK-1..3).

Readers always take an explicit schema for text formats (no inference pass,
stable types).  CSV is read with ``multiLine`` and RFC-4180 quote escaping so
quoted fields with commas, quotes or line breaks stay whole (G1).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"'}
# The CSV writer trims values unless told otherwise.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "quote": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def csv_options(multi_line: bool = True, mode: str = "PERMISSIVE") -> dict[str, str]:
    """Reader options.  ``multi_line`` keeps quoted line breaks whole, at the
    price of one task per file; files without such breaks (also those that
    :func:`write_csv` makes with ``multi_line=False``) can be split.  ``mode``
    is Spark's: ``PERMISSIVE`` keeps going over malformed records (missing
    fields are NULL), ``DROPMALFORMED`` drops them, ``FAILFAST`` stops."""
    return {**CSV_OPTIONS, "multiLine": str(multi_line).lower(), "mode": mode}


CORRUPT_COLUMN = "_corrupt_record"


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True, mode: str = "PERMISSIVE", keep_corrupt: bool = False
) -> DataFrame:
    """SRC-1: CSV with header and explicit schema.  With ``keep_corrupt`` the
    malformed records stand in ``_corrupt_record`` (NULL for good rows), where
    :func:`corrupt_count` counts them."""
    if keep_corrupt:
        schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        schema = StructType([*schema.fields, StructField(CORRUPT_COLUMN, StringType())])
    options = csv_options(multi_line, mode)
    if keep_corrupt:
        options["columnNameOfCorruptRecord"] = CORRUPT_COLUMN
    return spark.read.options(**options).schema(schema).csv(path)


def corrupt_count(df: DataFrame) -> DataFrame:
    """Rows read and malformed records among them, of a frame read with
    ``keep_corrupt``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(CORRUPT_COLUMN).alias("n_corrupt"))


def read_csv_strings(spark: SparkSession, path: str, multi_line: bool = True, mode: str = "PERMISSIVE") -> DataFrame:
    """SRC-1 for dumps of unknown layout: header names, every column a
    string (no inference pass over the data); stages cast what they use
    with ``try_cast``."""
    return spark.read.options(**csv_options(multi_line, mode)).csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", multi_line: bool = True) -> DataFrame:
    """Parquet, or header CSV as strings."""
    if fmt == "parquet":
        return read_parquet(spark, path)
    if fmt == "csv":
        return read_csv_strings(spark, path, multi_line)
    raise ValueError(f"unsupported format {fmt!r}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", balance: bool = True, files: int | None = None, staged: bool = False) -> None:
    """Parquet or CSV with header, file sizes left to AQE (REBALANCE) unless
    a file count is given; ``staged`` writes by :func:`write_staged`."""
    if staged:
        write_staged(df.sparkSession, path, lambda folder: write_table(df, folder, fmt, balance, files))
    elif fmt == "parquet":
        write_parquet(df, path, files=files, balance=balance)
    elif fmt == "csv":
        write_csv(df, path, files=files, balance=balance)
    else:
        raise ValueError(f"unsupported format {fmt!r}")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2."""
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of ``path`` (driver-side metadata call)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def read_first_available(
    spark: SparkSession, sources: Sequence[tuple[str, str]], schema: StructType | str | None = None
) -> DataFrame:
    """SRC-3: the first ``(format, path)`` that exists (e.g. Parquet, else CSV)."""
    for fmt, path in sources:
        if path_exists(spark, path):
            if fmt == "parquet":
                return read_parquet(spark, path)
            if fmt == "csv":
                if schema is None:
                    raise ValueError("CSV sources need an explicit schema")
                return read_csv(spark, path, schema)
            raise ValueError(f"unsupported format {fmt!r}")
    raise FileNotFoundError(f"none of {[p for _, p in sources]} exists")


def cap_rows(df: DataFrame, n: int | None, order: Sequence[str]) -> DataFrame:
    """SRC-4: keep the first ``n`` rows in ascending order of the columns
    ``order``, NULLs last (0/None = off).

    The cap is the feature (a bounded extract).  Only the ordering columns are
    ranked (a distributed range sort with per-partition offsets, whatever
    ``n``) to find the ``n``-th key; the rows below it are then kept by a plain
    filter, and of rows with that very key as many as are left to keep.  Finding
    the key runs a job when called and brings one row to the driver.
    """
    if not n:
        return df
    from recoengine.operators.ranking import dense_index

    keys = [F.struct(F.col(c).isNull().alias("empty"), F.col(c).alias("value")).alias(f"k{i}") for i, c in enumerate(order)]
    key = F.struct(*keys)
    ranked = dense_index(df.select(key.alias("key")), [F.col("key").asc()], "__pos")
    last = ranked.filter(F.col("__pos") == n - 1).select("key")
    below = ranked.filter(F.col("key") == last.scalar()).agg(F.min("__pos")).first()[0]
    if below is None:
        return df  # fewer than n rows
    ties = df.filter(key == last.scalar()).limit(int(n - below))
    return df.filter(key < last.scalar()).unionByName(ties)


def _layout(df: DataFrame, files: int | None, balance: bool, shuffle: bool = True) -> DataFrame:
    """SNK-3: control the output file count.

    ``files`` uses ``repartition`` (a round-robin shuffle, even file sizes),
    or ``coalesce`` with ``shuffle=False`` (no shuffle, merges partitions, at
    most ``files`` files); ``balance=True`` uses the ``REBALANCE`` hint so AQE
    picks sizes itself.
    """
    if files:
        return df.repartition(files) if shuffle else df.coalesce(files)
    if balance:
        return df.hint("rebalance")
    return df


def write_csv(df: DataFrame, path: str, files: int | None = None, balance: bool = False, shuffle: bool = True) -> None:
    """SNK-1: overwrite CSV with header (quotes escaped by doubling, values
    not trimmed).  Default dialect: NULL is an empty field, and an empty
    string reads back as NULL too (the sentinel rule PRJ-5 treats both alike)."""
    _layout(df, files, balance, shuffle).write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path)


def write_parquet(
    df: DataFrame,
    path: str,
    files: int | None = None,
    balance: bool = False,
    partition_by: Sequence[str] = (),
    shuffle: bool = True,
) -> None:
    """SNK-2: overwrite Parquet, optionally partitioned by columns."""
    writer = _layout(df, files, balance, shuffle).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_staged(spark: SparkSession, path: str, write: Callable[[str], None], check: Callable[[str], None] | None = None) -> None:
    """SNK-1/2: replace ``path`` only by data that is whole.

    ``write(folder)`` writes a staging folder beside ``path`` and ``check(folder)``
    may raise on what it finds there.  Then the old data steps aside, the staging folder takes
    its name, and the old data is deleted last.  When anything raises before the switch,
    ``path`` is as it was and the staging folder is deleted; when the switch itself
    fails, the old data gets its name back.  As the job ends before the switch, a frame
    that reads ``path`` may be written to it.  The switch is two renames: a
    reader in between finds no folder, and on stores without renames use versions
    (``FactorModel.save``) instead.
    """
    path = path.rstrip("/")
    token = uuid.uuid4().hex
    jvm = spark.sparkContext._jvm
    target, staging, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.staging-{token}", f"{path}.old-{token}"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def rename(a, b) -> None:
        if not fs.rename(a, b):
            raise OSError(f"cannot rename {a} to {b}")

    try:
        write(staging.toString())
        if check:
            check(staging.toString())
        had = fs.exists(target)
        if had:
            rename(target, old)
        try:
            rename(staging, target)
        except BaseException:
            if had:
                rename(old, target)
            raise
    except BaseException:
        fs.delete(staging, True)
        raise
    if had:
        fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a job's own intermediate output, under the shared
    ``spark.checkpoint.dir`` (never a machine-local folder on a cluster)."""
    from recoengine.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/recoengine-scratch/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to a fresh scratch folder, and read from
    there: for thin rows that several jobs read, at a few bytes a row where a
    checkpoint holds whole row objects and runs its last stage twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
