"""WARC archives of pages with a Zstandard dictionary, one frame per record.

``write_archive`` decides what is a response by two aggregations over digests
(of pages with equal payloads, the one with the largest id is the ``response``
and the others are ``revisit`` records that name it) and writes one file per
partition through Spark's text writer: every row is a part of the file, and
the line separator is an empty skippable frame, which Zstandard readers pass
over.  So archives go to any file system that Spark can write, under its
commit protocol, and a lost executor leaves no half file.  Each file begins
with a skippable frame holding the dictionary; ``read_archive`` takes the
dictionary from the file itself, so an archive needs nothing beside it.

The dictionary is built from a bounded sample of archived records
(``dictionary_sample`` records of at most ``sample_bytes`` each; a parameter
of the compression only: every record is written whole).  A hot payload (many
equal pages) is no hot task: only its digest and the largest id are
aggregated, map side first, and the join back to the pages' ids carries
neither payload nor url and is one that Spark splits.

Defined cases: null html is an empty payload; null urls are written as an
empty target; a null page id is written as such and is a response only where
no page with an id has its payload; rows with an equal page id and payload are
one record each, of the same type; an empty table gives an empty archive and
an empty result; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoengine.llm._util import cut, prepare

#: Fixed values of the formats: the magic number of a skippable frame, its
#: little-endian length, and that of a dictionary or frame inside.
SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
#: An empty skippable frame (magic number 0x184D2A50, length 0); all of its
#: bytes are ASCII, so it can be the text writer's line separator.
EMPTY_FRAME = "P*M\x18\0\0\0\0"
READ_BYTES = 1 << 16
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, payload binary"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int, uri: str, kind: str, digest: str, size: int, refers_to: int | None, date: str, payload: bytes) -> bytes:
    """One WARC record; ``payload`` is the HTTP body, empty for a revisit."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + payload
    head = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {date}",
        "WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"),
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of one record, with its payload checked against the
    digest of a response."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda x: None if x == "<urn:page:None>" else int(x.removeprefix("<urn:page:").removesuffix(">"))
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError("a payload does not match its digest")
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number(fields["WARC-Refers-To"]) if kind == "revisit" else None,
        "target_uri": fields["WARC-Target-URI"],
        "payload": payload if kind == "response" else None,
    }


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A Zstandard dictionary; too few or too small samples give none."""
    import zstandard

    if len(samples) < 8 or sum(map(len, samples)) < 8 * size // 4:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # the samples share too little
        return b""


def archive_bytes(records: Iterable[bytes], dictionary: bytes, level: int) -> Iterator[bytes]:
    """A file's parts: the skippable frame with the dictionary, then a frame for each record."""
    import zstandard

    yield struct.pack("<II", SKIPPABLE_MAGIC, len(dictionary)) + dictionary
    own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    compress = zstandard.ZstdCompressor(level=level, dict_data=own, write_content_size=True, write_checksum=True)
    for raw in records:
        yield compress.compress(raw)


def archive_records(data: bytes) -> Iterator[dict]:
    """The records of a file's bytes, by nothing but these."""
    import zstandard

    if not data:
        return
    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE_MAGIC:
        raise ValueError("no leading skippable frame")
    dictionary = data[8 : 8 + size]
    decompress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    view, at = memoryview(data), 8 + size
    while at < len(data):
        if data[at : at + 4] != FRAME_MAGIC:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]  # another skippable frame
            continue
        frame, parts = decompress.decompressobj(), []
        while not frame.eof:
            if at >= len(data):
                raise ValueError("a frame is cut short")
            parts.append(frame.decompress(view[at : at + READ_BYTES]))
            at = min(at + READ_BYTES, len(data))
        at -= len(frame.unused_data)
        yield parse_record(b"".join(parts))


def _keyed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    out = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("uri"), payload.alias("payload"))
    return out.withColumn("digest", F.sha1("payload"))


def _revisits(keyed: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that are revisits."""
    thin = keyed.filter(F.length("payload") >= min_revisit_bytes).select("page_id", "digest")
    responses = cut(thin.groupBy("digest").agg(F.max("page_id").alias("refers_to")).filter("refers_to is not null"))
    return thin.distinct().join(responses, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))


def write_archive(
    pages: DataFrame,
    path: str,
    min_revisit_bytes: int = 0,
    dictionary_sample: int = 256,
    sample_bytes: int = 16_384,
    dictionary_bytes: int = 65_536,
    level: int = 3,
    date: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> None:
    """Write one record per page to archive files under ``path`` (any store
    that Spark writes to)."""
    prepare(pages.sparkSession)
    keyed = _keyed(pages, id_col, url_col, html_col)
    revisits = _revisits(keyed, min_revisit_bytes)
    # the ids first: the texts of every task's candidates would grow with the number of tasks
    chosen = keyed.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(dictionary_sample)
    sample = keyed.select("page_id", "uri", F.substring("payload", 1, sample_bytes).alias("payload")).join(F.broadcast(chosen), "page_id").limit(dictionary_sample)
    samples = sorted(record_bytes(r.page_id, r.uri, "response", "", len(r.payload), None, date, bytes(r.payload)) for r in sample.collect())  # at most 4 MB by default
    dictionary = train_dictionary(samples, dictionary_bytes)

    def frames(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def raw() -> Iterator[bytes]:
            for batch in batches:
                for i in range(batch.num_rows):
                    page_id, uri, payload, refers_to = (batch.column(k)[i].as_py() for k in range(4))
                    kind = "response" if refers_to is None else "revisit"
                    yield record_bytes(page_id, uri, kind, payload_digest(payload), len(payload), refers_to, date, payload if refers_to is None else b"")

        parts, held = [], 0
        for part in archive_bytes(raw(), dictionary, level):
            parts.append(part)
            held += len(part)
            if held > READ_BYTES << 6:
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["value"])
                parts, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["value"])

    k, r = keyed.alias("k"), revisits.alias("r")
    same = F.col("k.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("k.digest") == F.col("r.digest"))
    rows = k.join(r, same, "left").select("k.page_id", "uri", "payload", "refers_to")
    rows.mapInArrow(frames, "value binary").select(F.col("value").cast("string")).write.option("lineSep", EMPTY_FRAME).text(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records (``RECORDS``) of all archive files under ``path``; payload
    is null for revisits."""
    prepare(spark)

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for i in range(batch.num_rows):
                held, size = [], 0
                for record in archive_records(batch.column(0)[i].as_py()):
                    held.append(record)
                    size += record["payload_bytes"] + 512
                    if size > READ_BYTES << 6:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content").mapInArrow(records, RECORDS)
