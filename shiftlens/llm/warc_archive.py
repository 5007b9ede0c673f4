"""WARC archives compressed record by record with a dictionary of their own.

Each archive (.warc.zst) starts with a skippable frame (magic 0x184D2A5D) that holds a
Zstandard dictionary built from archived records; every record follows
as a frame of its own, so a reader can start at any record. The dictionary is
trained once on heads of ``SAMPLES`` response records drawn across the whole table (those
with the smallest hashes), together at most ``sample_bytes`` of payload; where that is too little to train on
(below 32 records or 512 KB), the last 64 KB of their raw bytes serve
as the dictionary. It only affects sizes, never content.

Pages with equal payloads (SHA-1 of the html's UTF-8) are archived once: the
one with the largest page_id is a response record, the others are revisit records that
refer to it. Only the digests that occur more than once, found by a map-side
combined aggregate, are joined back: broadcast if their counted size is small,
else spread over ``SALTS`` salts, so that a payload shared by a third of all pages is
no hot key. The payloads themselves are not shuffled in the first case.

Archives go through pyarrow's file systems under a temporary name and are
renamed; a repeated task writes the same archive again.

Defined results: a null html is an empty payload; payloads shorter than
``least_bytes`` are all responses; repeated rows with the largest page_id of
their payload are all responses; a null page_id is smaller than any
other; a url is kept with control characters, spaces and non-ASCII characters
percent-encoded, a null url has no target header; other columns are ignored; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import pick, small, stored, table
from .token_files import BadFile, open_fs, publish

DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES, SAMPLE_BYTES, SAMPLES, SALTS = 64 << 10, 4 << 20, 512, 16
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the public URL namespace of RFC 4122
DATE = "2024-01-01T00:00:00Z"  # the pages table holds no time; one fixed date keeps archives reproducible
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def in_base32(digest: str) -> str:
    """The base-32 form of a digest in hex."""
    return base64.b32encode(bytes.fromhex(digest)).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}')}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP headers of the payload but not the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
            "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
            f"X-Page-ID: {'' if page_id is None else page_id}"]
    if url is not None:
        head.insert(4, f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}",
                 f"X-Refers-To-Page-ID: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers, HTTP headers and payload of one record; the block and a response's payload are verified."""
    head, found, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(headers["Content-Length"])
    if not found or version != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
        raise BadFile("not a WARC record")
    block = rest[:size]
    if headers["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise BadFile("a block does not match its digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != f"sha1:{base32_sha1(payload)}":
        raise BadFile("a payload does not match its digest")
    return {"headers": headers, "http": fields, "payload": payload}


def build_dictionary(samples: list[bytes]):
    """A trained dictionary, or the samples' own bytes where there is too little to train on."""
    import zstandard

    total = sum(map(len, samples))
    if len(samples) >= 32 and total >= 8 * DICTIONARY_BYTES:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
        except zstandard.ZstdError:  # e.g. samples without anything in common
            pass
    return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(out, records: Iterator[bytes], dictionary: bytes, level: int = 3) -> int:
    """Write the records as one archive; returns their number. Without a record nothing is written."""
    import zstandard

    comp = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
    n = 0
    for r in records:
        if not n:
            out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
        out.write(comp.compress(r))
        n += 1
    return n


def read_archive(f, chunk: int = 64 << 10) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    import zstandard

    head = f.read(8)
    if not head:
        return
    magic, size = struct.unpack("<II", head)
    if magic != DICTIONARY_MAGIC:
        raise BadFile("no dictionary frame")
    kept = zstandard.ZstdCompressionDict(f.read(size))
    plain = zstandard.ZstdDecompressor(dict_data=kept)
    data = f.read(chunk)
    while data:
        frame, parts = plain.decompressobj(), []
        while not frame.eof:
            if not data:
                raise BadFile("the last record is cut off")
            parts.append(frame.decompress(data))
            data = b"" if not frame.eof else frame.unused_data
            if not data:
                data = f.read(chunk)
        yield b"".join(parts)


def with_references(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, digest in hex, refers_to): refers_to is null for responses."""
    src = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    src = src.withColumn("digest", F.sha1("payload"))
    copies = (src.where(F.octet_length("payload") >= least_bytes).groupBy("digest")
              .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first"))
    copies = stored(copies, "warc-copies")
    if small(copies, row_bytes=100):
        joined = src.join(F.broadcast(copies), "digest", "left")
    else:
        salted = copies.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = (src.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
                  .join(salted, ["digest", "salt"], "left"))
    return joined.select("page_id", "url", "payload", "digest",
                         F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def sample_records(referenced: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> list[bytes]:
    """Heads of at most ``SAMPLES`` response records across all of ``with_references``' rows, of even size in the payload.

    The smallest hashes are merged by a task from eight bytes a row; only the rows up to the last of them come to the
    driver. Repeated rows count once and may leave fewer samples."""
    rows = (referenced.where("refers_to is null and octet_length(payload) > 0")
            .withColumn("at", F.xxhash64("digest", "page_id")))
    last = stored(rows.select("at").orderBy("at").limit(SAMPLES), "warc-sample").agg(F.max("at")).first()[0]
    if last is None:
        return []
    head = F.struct("page_id", F.substring("url", 1, 2048).alias("url"), "digest",
                    F.substring("payload", 1, max(1, sample_bytes // SAMPLES)).alias("payload"))
    held = rows.where(F.col("at") <= F.lit(last)).groupBy("at").agg(F.min(head).alias("r")).select("at", "r.*").collect()
    return [make_record(r["page_id"], r["url"], bytes(r["payload"]), in_base32(r["digest"]), None)
            for r in sorted(held, key=lambda r: r["at"])]


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                least_bytes: int = 0, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """Write archives ``path``/part-NNNNNN.warc.zst; returns their manifest (archive, file, records)."""
    src = pick(pages, page_id=id_col, url=url_col, html=html_col)
    src = with_references(src.withColumn("page_id", F.col("page_id").cast("bigint")), least_bytes)
    dictionary = build_dictionary(sample_records(src, sample_bytes)).as_bytes()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        def records():
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    for page_id, url, payload, digest, to in zip(*(c.to_pylist() for c in b.slice(at, 256).columns),
                                                                 strict=True):
                        yield make_record(page_id, url, payload, in_base32(digest), to)

        fs, base = open_fs(path)
        fs.create_dir(base, recursive=True)
        k, done = TaskContext.get().partitionId(), []
        name = f"part-{k:06d}.warc.zst"
        publish(fs, f"{base}/{name}", lambda out: done.append(write_archive(out, records(), dictionary)))
        if done[0]:
            yield pa.RecordBatch.from_pydict({"archive": [k], "file": [name], "records": [done[0]]})

    return stored(src.mapInArrow(run, "archive bigint, file string, records bigint"),
                  "warc-manifest")


def read_pages(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) from the archives;
    a revisit's payload is null."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                           ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                           ("payload", pa.binary())])
        fs, base = open_fs(path)
        for b in batches:
            for file in b.column(0).to_pylist():
                held, size = [], 0
                with fs.open_input_stream(f"{base}/{file}", compression=None) as f:
                    for data in read_archive(io.BufferedReader(f, 1 << 20)):
                        r = parse_record(data)
                        h, revisit = r["headers"], r["headers"]["WARC-Type"] == "revisit"
                        held.append({"page_id": int(h["X-Page-ID"]) if h["X-Page-ID"] else None,
                                     "url": h.get("WARC-Target-URI"), "payload_bytes": int(r["http"]["Content-Length"]),
                                     "payload_digest": h["WARC-Payload-Digest"].removeprefix("sha1:"),
                                     "record_type": h["WARC-Type"],
                                     "refers_to": int(h["X-Refers-To-Page-ID"]) if revisit else None,
                                     "payload": None if revisit else r["payload"]})
                        size += len(data)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, kinds)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, kinds)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file").repartition(n, "file").mapInArrow(
        run, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string,"
             " refers_to bigint, payload binary")


def op9_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    manifest = write_pages(table(spark, sf_dir, "pages"), path)
    return read_pages(spark, path, manifest).drop("payload", "url")


# SHA-1 in base32: five bits a character, from the hex digest; DuckDB has no SHA-1 digest in base32.
OP9_SQL = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages
), d AS (
  SELECT *, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST(((('0x' || substr(h || '00', CAST(i * 5 // 4 + 1 AS INT), 2))::BIGINT >> CAST(3 - i * 5 % 4 AS BIGINT)) & 31) + 1 AS INT), 1)),
      'string_agg', '') AS payload_digest,
    max(page_id) OVER (PARTITION BY h) AS first
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
