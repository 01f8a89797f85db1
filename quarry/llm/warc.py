"""WARC archives through a chunked record table.

Writing: a payload is cut into chunks of at most ``chunk_bytes``. Each chunk becomes one
WARC record: the first is the response, later ones are ``continuation`` records of
the same segmented record (WARC-Segment-Number). Spark's text writer puts the records
into gzip files of at most ``records_per_file`` chunks, with the CR LF CR LF that ends
a record as line separator. Of records with equal payloads, the one with the smallest
id is written, the others become ``revisit`` records that name it.

Reading: every file is decompressed as a stream and gives rows (record id, chunk
number, bytes). A record of one chunk is digested on the spot; the chunks of longer
ones are brought together in order and fed to an incremental SHA-1, one at a time.
No step holds more of a record than a chunk, beyond the row it came in.

Defined cases: a null payload is empty; a null url is left out; line breaks in a
url are percent-encoded; a row without an id is a response if all rows with its
payload lack one, and else a revisit; rows that repeat the smallest id of their payload are all responses;
empty tables give an archive without records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

CHUNK_BYTES = 1 << 16
RECORDS_PER_FILE = 512  # times a chunk: a file is 32 MB at most before compression
DATE = "1970-01-01T00:00:00Z"
END = "\r\n\r\n"
TABLE = ("record_id string, chunk int, whole boolean, page_id bigint, record_type string, refers_to bigint, "
         "declared_digest string, declared_bytes bigint, chunk_bytes bigint, digest string, data binary")


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _head(fields) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode() + b"\r\n"


def _records(number: int, row: int, page_id, url, payload: memoryview, first, chunk_bytes: int):
    """The WARC records of one payload, without the final CR LF CR LF."""
    sha = hashlib.sha1()
    for at in range(0, len(payload), chunk_bytes):
        sha.update(payload[at:at + chunk_bytes])
    digest = f"sha1:{base32_sha1(sha.digest())}"
    own = f"urn:page:{'-' if page_id is None else page_id}"
    name = f"<{own}:{number}.{row}>"
    if url is not None:
        url = url.replace("\r", "%0D").replace("\n", "%0A")
    about = [("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Payload-Digest", digest), ("WARC-Payload-Length", len(payload))]
    if first is not None and first != page_id:
        yield _head([("WARC-Type", "revisit"), ("WARC-Record-ID", name), *about, ("WARC-Refers-To", f"<urn:page:{first}>"),
                     ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("Content-Length", 0)])
        return
    segments = max(1, -(-len(payload) // chunk_bytes))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    for i in range(segments):
        part = payload[i * chunk_bytes:(i + 1) * chunk_bytes]
        block = http if i == 0 else b""
        last = i == segments - 1
        kind = [("WARC-Type", "response"), ("WARC-Record-ID", name), ("Content-Type", "application/http; msgtype=response")] if i == 0 else [
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}.{i + 1}>"), ("WARC-Segment-Origin-ID", name)]
        segment = [] if segments == 1 else [("WARC-Segment-Number", i + 1)] + [
            ("WARC-Segment-Total-Length", len(http) + len(payload))] * (last and i > 0)
        yield b"".join([_head([*kind, *about, *segment, ("Content-Length", len(block) + len(part))]), block, part])


def _writer(chunk_bytes: int, batch_bytes: int = 8 << 20):
    def write(batches):
        from pyspark import TaskContext

        number, row, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            ids, urls, firsts = (batch.column(i).to_pylist() for i in (0, 1, 3))
            html = batch.column(2)
            for i in range(batch.num_rows):
                payload = memoryview(html[i].as_buffer())
                for record in _records(number, row, ids[i], urls[i], payload, firsts[i], chunk_bytes):
                    held.append(record)
                    size += len(record)
                    if size >= batch_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])
                        held, size = [], 0
                row += 1
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["value"])
    return write


def write_warc(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, revisit_bytes: int = 0,
               records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files; payloads of at least ``revisit_bytes`` are written once."""
    rows = pages.select(pages["page_id"].cast("bigint").alias("page_id"), pages["url"].cast("string").alias("url"),
                        F.coalesce(pages["html"].cast("binary"), F.lit("").cast("binary")).alias("html"))
    rows = rows.withColumn("same", F.sha2("html", 256))
    copies = rows.where(F.octet_length("html") >= revisit_bytes).groupBy("same").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    marked = rows.join(copies, "same", "left").select("page_id", "url", "html", "first")
    records = marked.mapInArrow(_writer(chunk_bytes), "value binary").select(F.col("value").cast("string").alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def _page(uri: str | None):
    name = (uri or "").strip("<>").split(":")
    return int(name[2]) if len(name) > 2 and name[2] != "-" else None


def parse_warc(stream, chunk_bytes: int, keep_payload: bool = False):
    """Yield chunk rows of one decompressed archive; ``stream`` is read forward, a chunk at a time."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while line := stream.readline().rstrip(b"\r\n"):
            key, _, value = line.decode("utf-8").partition(":")
            fields[key.lower()] = value.strip()
        left = int(fields["content-length"])
        kind = fields["warc-type"]
        segment = int(fields.get("warc-segment-number", 1))
        if kind == "response":  # the payload begins after the HTTP header
            while left:
                line = stream.readline(left)
                left -= len(line)
                if not line.rstrip(b"\r\n"):
                    break
        whole = "warc-segment-number" not in fields
        sha, size, parts = hashlib.sha1(), left, []
        while left:
            part = stream.read(min(left, chunk_bytes))
            if not part:
                raise ValueError("the archive ends within a record")
            left -= len(part)
            sha.update(part)
            if keep_payload or not whole:
                parts.append(part)
        name = fields.get("warc-segment-origin-id") or fields["warc-record-id"]
        yield (name, segment, whole, _page(name), "response" if kind == "continuation" else kind, _page(fields.get("warc-refers-to")),
               fields.get("warc-payload-digest", "").removeprefix("sha1:"), int(fields.get("warc-payload-length", -1)), size,
               base32_sha1(sha.digest()) if whole else None, b"".join(parts) if parts else None)


def _table(rows) -> pa.RecordBatch:
    types = [pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in TABLE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _reader(chunk_bytes: int, keep_payload: bool):
    def read(batches):
        for batch in batches:
            for content in batch.column(0):
                stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(memoryview(content.as_buffer()))))
                held, size = [], 0
                for row in parse_warc(stream, chunk_bytes, keep_payload):
                    held.append(row)
                    size += 200 + len(row[-1] or b"")
                    if size >= 8 << 20:
                        yield _table(held)
                        held, size = [], 0
                if held:
                    yield _table(held)
    return read


def read_chunks(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES, keep_payload: bool = True) -> DataFrame:
    """The chunked record table of an archive: one row for each record id and chunk number.

    Without ``keep_payload`` only chunks of segmented records carry their bytes.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_reader(chunk_bytes, keep_payload), TABLE)


def _digest_chunks(batches):
    """One row for each record from its chunks in order, hashed as they come."""
    now, sha, size = None, None, 0

    def done(row):
        digest = row["digest"] if row["whole"] else base32_sha1(sha.digest())
        length = row["declared_bytes"] if row["record_type"] == "revisit" else size
        return {"page_id": row["page_id"], "payload_bytes": length,
                "payload_digest": row["declared_digest"] if row["record_type"] == "revisit" else digest,
                "record_type": row["record_type"], "refers_to": row["refers_to"],
                "intact": row["record_type"] == "revisit" or (digest == row["declared_digest"] and size == row["declared_bytes"])}

    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_())])
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if now is None or row["record_id"] != now["record_id"]:
                if now is not None:
                    out.append(done(now))
                now, sha, size = row, hashlib.sha1(), 0
            size += row["chunk_bytes"]
            if not row["whole"]:
                sha.update(row["data"] or b"")
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([done(now)], schema)


def records(chunks: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, intact of each record of a chunk table."""
    ordered = chunks.repartition("record_id").sortWithinPartitions("record_id", "chunk")
    return ordered.mapInArrow(_digest_chunks, "page_id bigint, payload_bytes bigint, payload_digest string, "
                                              "record_type string, refers_to bigint, intact boolean")


def round_trip(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write an archive of ``pages`` in the shared folder, and read it back."""
    spark = pages.sparkSession
    path = shared_path(spark, "llm", "warc")
    write_warc(pages, path, chunk_bytes)
    return records(read_chunks(spark, path, chunk_bytes, keep_payload=False))


ORACLE_SQL = r"""
WITH rows AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS origin FROM pages
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(h, (i // 8) * 10 + 1, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31) + 1)::INT, 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = origin THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = origin THEN NULL ELSE origin END AS refers_to, true AS intact
FROM rows
"""
