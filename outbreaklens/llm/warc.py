"""WARC archives written from and read back into chunked record tables.

A payload is cut into chunk rows (record, chunk number, bytes) that carry the running length and the running
SHA-1, so nothing downstream holds more than one chunk of a record. Each chunk row becomes one WARC record: the
first a `response`, the others `continuation` records of its segments, as the format defines them. A repeated
payload is a `revisit` record without a payload that names the first page with it.

The archives are gzip files that Spark's text writer puts out with the record end as line separator, and they are
read with the record start as line separator. A payload never holds that start inside one chunk, because chunks
are cut in the middle of it; a reader that misses a separator goes on by Content-Length. Digests and lengths
are computed anew from what was read and compared with the headers.

A null payload is empty. Rows without an id are responses. Rows that repeat the smallest id of a payload are all
responses; rows that repeat a later id are all revisits. An empty table writes and reads no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outbreaklens.session import checkpointed, ensure_checkpoint_dir

FORMAT = b"WARC/1.1"
VERSION = FORMAT + b"\r\n"
RECORD_END = b"\r\n\r\n"
RECORD_START = RECORD_END + VERSION
CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_BYTES = 8 << 20

CHUNK_SCHEMA = (
    "record string, page_id long, url string, record_type string, refers_to long, chunk_no int, data binary, "
    "total_bytes long, total_sha1 string, last boolean"
)
READ_SCHEMA = (
    "record string, page_id long, record_type string, refers_to long, chunk_no int, last boolean, "
    "payload_bytes long, payload_digest string, data binary"
)
PAGE_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def cuts(payload: bytes, size: int = CHUNK) -> list[int]:
    """Ends of the chunks: every `size` bytes, and inside each spelling of the format's name.

    So no chunk holds a record start, nor makes one up with the header before or the record end behind it.
    """
    inside = (m.start() + 1 for m in re.finditer(re.escape(FORMAT), payload))
    return sorted({*range(size, len(payload), size), *inside, len(payload)})


def _batches(rows: Iterator[tuple], schema: pa.Schema, weight) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= BATCH_BYTES or len(held) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([pa.field(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def marked(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): later pages with a payload of at least `least` bytes name the first one.

    Only ids and digests are grouped. Payloads are taken as equal when length, SHA-1 and SHA-256 are.
    """
    held = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        held.alias("payload"),
        F.concat(F.unhex(F.sha1(held)), F.unhex(F.sha2(held, 256))).alias("digest"),
    )
    keys = rows.where(F.octet_length("payload") >= least).select("page_id", "digest")
    firsts = keys.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("final"))
    # Payloads of one page alone leave before the join. A frequent payload is a skewed key, which AQE splits only
    # when no aggregation stands between the join and its exchanges: the groups are stored first.
    repeated = checkpointed(firsts.where("first < final").select("digest", "first"))
    revisits = (
        keys.join(repeated, "digest")
        .where("page_id > first")
        .groupBy("page_id", "digest")
        .agg(F.min("first").alias("refers_to"))
    )
    return rows.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "payload", "refers_to")


def chunk_table(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Chunk rows of (page_id, url, payload, refers_to) rows, with running length and SHA-1; revisits have one, empty.

    The totals of a revisit are those of the payload it leaves out.
    """
    schema = _schema(CHUNK_SCHEMA)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for page, url, payload, first in zip(*(column.to_pylist() for column in batch.columns)):
                record, n = f"urn:page:{'null' if page is None else page}:{part}-{n}", n + 1
                if first is not None:
                    digest = base32(hashlib.sha1(payload).digest())
                    yield record, page, url, "revisit", first, 1, b"", len(payload), digest, True
                    continue
                running, start = hashlib.sha1(), 0
                ends = cuts(payload, chunk)
                for number, end in enumerate(ends, 1):
                    data = payload[start:end]
                    running.update(data)
                    kind = "response" if number == 1 else "continuation"
                    yield record, page, url, kind, None, number, data, end, base32(running.digest()), number == len(ends)
                    start = end

    return records.select("page_id", "url", "payload", "refers_to").mapInArrow(
        lambda batches: _batches(rows(batches), schema, lambda row: len(row[6]) + 400), CHUNK_SCHEMA
    )


def record_text(chunks: DataFrame) -> DataFrame:
    """One WARC record per chunk row, without its end, as a text column of raw bytes."""

    def line(name: str, value, when=None):
        text = F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
        return F.coalesce(text if when is None else F.when(when, text), F.lit(""))

    first, single = F.col("chunk_no") == 1, F.col("last") & (F.col("chunk_no") == 1)
    revisit = F.col("record_type") == "revisit"
    segment = F.concat(F.lit("<"), F.col("record"), F.when(first, "").otherwise(F.concat(F.lit(":"), F.col("chunk_no"))), F.lit(">"))
    header = F.concat(
        F.lit(VERSION.decode()),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", segment),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20]", "%20")),
        line("Content-Type", F.lit("text/html; charset=utf-8"), first & ~revisit),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("total_sha1")), F.col("last")),
        line("WARC-Profile", F.lit(REVISIT_PROFILE), revisit),
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">")), revisit),
        line("X-Payload-Length", F.col("total_bytes").cast("string"), F.col("last")),
        line("WARC-Segment-Number", F.col("chunk_no").cast("string"), ~single),
        line("WARC-Segment-Origin-ID", F.concat(F.lit("<"), F.col("record"), F.lit(">")), ~first),
        line("WARC-Segment-Total-Length", F.col("total_bytes").cast("string"), F.col("last") & ~first),
        line("Content-Length", F.octet_length("data").cast("string")),
        F.lit("\r\n"),
    )
    return chunks.select(F.concat(header.cast("binary"), F.col("data")).cast("string").alias("value"))


def write(records: DataFrame, folder: str, chunk: int = CHUNK) -> None:
    """Write (page_id, url, payload, refers_to) rows as WARC files, one per partition."""
    text = record_text(chunk_table(records, chunk))
    text.write.option("lineSep", RECORD_END.decode()).option("compression", "gzip").text(folder)


def parse(piece: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of the record in a piece between two record starts, or of several if starts were missed."""
    while piece:
        piece = piece.removeprefix(VERSION)
        head, _, rest = piece.partition(RECORD_END)
        headers = dict(one.split(": ", 1) for one in head.decode("utf-8", "replace").split("\r\n") if ": " in one)
        length = int(headers["Content-Length"])
        if len(rest) < length:
            raise ValueError(f"record {headers.get('WARC-Record-ID')} is cut off")
        yield headers, rest[:length]
        piece = rest[length:].removeprefix(RECORD_END)


def _parsed(headers: dict[str, str], block: bytes) -> tuple:
    record = headers.get("WARC-Segment-Origin-ID", headers["WARC-Record-ID"]).strip("<>")
    page = record.split(":")[2]
    first = headers.get("WARC-Refers-To")
    digest = headers.get("WARC-Payload-Digest")
    return (
        record,
        None if page == "null" else int(page),
        headers["WARC-Type"],
        int(first.strip("<>").split(":")[2]) if first else None,
        int(headers.get("WARC-Segment-Number", "1")),
        digest is not None,
        int(headers["X-Payload-Length"]) if digest else None,
        digest.removeprefix("sha1:") if digest else None,
        block,
    )


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk rows of the archives in a folder."""
    schema = _schema(READ_SCHEMA)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for piece in batch.column(0).to_pylist():
                for headers, block in parse(piece):
                    yield _parsed(headers, block)

    pieces = spark.read.option("lineSep", RECORD_START.decode()).text(folder)
    return pieces.select(F.col("value").cast("binary")).mapInArrow(
        lambda batches: _batches(rows(batches), schema, lambda row: len(row[8]) + 200), READ_SCHEMA
    )


def assemble(chunks: Iterator[tuple]) -> Iterator[tuple]:
    """Pages of chunk rows in record and chunk order; holds one chunk and one running digest at a time."""
    current, page, running, size, last_no = None, None, hashlib.sha1(), 0, 0
    for record, page_id, kind, refers_to, number, last, length, digest, data in chunks:
        if record != current:
            if current is not None:
                raise ValueError(f"record {current} has no last segment")
            current, page, running, size, last_no = record, page_id, hashlib.sha1(), 0, 0
        if number != last_no + 1:
            raise ValueError(f"record {record} lacks segment {last_no + 1}")
        last_no = number
        running.update(data)
        size += len(data)
        if last:
            if kind != "revisit" and (size, base32(running.digest())) != (length, digest):
                raise ValueError(f"payload of {record} does not agree with its header")
            yield page, length, digest, "revisit" if kind == "revisit" else "response", refers_to
            current = None
    if current is not None:
        raise ValueError(f"record {current} has no last segment")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of the archives in a folder, with length and digest of the whole payload.

    Records of one segment are finished where they are read; segments of one record meet, sorted, in one task.
    """
    chunks = read_chunks(spark, folder)
    schema = _schema(PAGE_SCHEMA)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns))

    def pages(part: DataFrame) -> DataFrame:
        return part.mapInArrow(lambda batches: _batches(assemble(rows(batches)), schema, lambda _: 100), PAGE_SCHEMA)

    single = (F.col("chunk_no") == 1) & F.col("last")
    several = chunks.where(~single).repartition("record").sortWithinPartitions("record", "chunk_no")
    return pages(chunks.where(single)).unionByName(pages(several))


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def archived_pages(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Write every page to archives in `folder` (a new shared folder by default) and read them back."""
    spark = pages.sparkSession
    folder = folder or scratch_folder(spark, "warc")
    write(marked(pages, least=least), folder)
    return read(spark, folder)
