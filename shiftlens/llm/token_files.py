"""Token ids in independent zstandard frames with a trailing seek table.

A shard file is, in this order:
1. one zstandard frame per document: its ids, little-endian unsigned 32-bit, end id included;
2. a skippable frame (magic 0x184D2A50): the documents' ids as int64, in frame order;
3. the seek table of the public "zstd seekable format": a skippable frame
   (magic 0x184D2A5E) with, per frame of (1) and for frame (2), the compressed size,
   the decompressed size and a checksum (low 32 bits of XXH64 of the decompressed
   data), and the footer (number of frames, descriptor, 0x8F92EAB1).
A reader gets the table from the file's end and decompresses only the frames of
the documents it was asked for. Every zstandard tool can decompress a whole shard.

Documents go to shards by ranges of their id (ties by text hash, so that one
repeated id does not fill one task), and are written in ascending order.
Files are written under a temporary name and renamed; a repeated task writes
the same bytes under the same name. Files are reached through pyarrow's file
systems, so the shared folder may be on any store that those can open.

Defined results: a null or empty text is the end id alone; a null id comes
first and is stored as the smallest int64; repeated ids keep a frame each; an
empty table gives no shard and no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import pick, stored, table
from .encode import encoder

NULL_ID = -(1 << 63)
IDS_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
HAS_CHECKSUM = 0x80


class BadFile(ValueError):
    """A shard's structure or a checksum is wrong."""


def _check32(data: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(data, 0) & 0xFFFFFFFF


def open_fs(uri: str):
    """(file system, path) of a URI or an absolute path."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def publish(fs, path: str, write) -> None:
    """Write a file by ``write(stream)`` under a temporary name, then rename it."""
    import uuid

    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temp, compression=None) as out:
        write(out)
    fs.move(temp, path)


def write_shard(out, rows: Iterator[tuple[int | None, bytes]], level: int = 3) -> tuple[int, int]:
    """Write (id, ids bytes) rows as one shard; returns its documents and tokens."""
    import zstandard

    comp = zstandard.ZstdCompressor(level=level, write_checksum=False)
    table, names, tokens = bytearray(), bytearray(), 0
    for doc, ids in rows:
        frame = comp.compress(ids)
        out.write(frame)
        table += struct.pack("<III", len(frame), len(ids), _check32(ids))
        names += struct.pack("<q", NULL_ID if doc is None else doc)
        tokens += len(ids) // 4
    n = len(names) // 8
    out.write(struct.pack("<II", IDS_MAGIC, len(names)) + bytes(names))
    table += struct.pack("<III", len(names) + 8, 0, _check32(bytes(names)))
    out.write(struct.pack("<II", TABLE_MAGIC, len(table) + 9) + bytes(table))
    out.write(struct.pack("<IBI", n + 1, HAS_CHECKSUM, FOOTER_MAGIC))
    return n, tokens


class Shard:
    """Random access to one shard: ``ids``, and ``read(i)`` for the token bytes of its i-th document."""

    def __init__(self, f):
        import numpy as np
        import zstandard

        self._f, size = f, f.size()
        frames, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or not descriptor & HAS_CHECKSUM:
            raise BadFile("no seek table")
        rows = np.frombuffer(self._at(size - 9 - 12 * frames, 12 * frames), dtype="<u4").reshape(-1, 3)
        self._sizes = rows
        self._starts = np.concatenate([[0], np.cumsum(rows[:, 0].astype("int64"))])
        names = self._at(int(self._starts[-2]) + 8, int(rows[-1, 0]) - 8)
        if _check32(names) != rows[-1, 2]:
            raise BadFile("the documents' ids do not match their checksum")
        self.ids = np.frombuffer(names, dtype="<i8")
        self._plain = zstandard.ZstdDecompressor()

    def _at(self, start: int, n: int) -> bytes:
        self._f.seek(start)
        return self._f.read(n)

    def _decompress(self, i: int, frame: bytes) -> bytes:
        size, check = int(self._sizes[i, 1]), int(self._sizes[i, 2])
        data = self._plain.decompress(frame, max_output_size=max(size, 1))
        if len(data) != size or _check32(data) != check:
            raise BadFile(f"frame {i} does not match its checksum")
        return data

    def read(self, i: int) -> bytes:
        return self._decompress(i, self._at(int(self._starts[i]), int(self._sizes[i, 0])))

    def read_all(self, block: int = 8 << 20) -> Iterator[tuple[int, bytes]]:
        """(id, token bytes) of every document, reading about ``block`` bytes at a time."""
        i, n = 0, len(self.ids)
        while i < n:
            j = i + 1
            while j < n and self._starts[j + 1] - self._starts[i] <= block:
                j += 1
            raw = self._at(int(self._starts[i]), int(self._starts[j] - self._starts[i]))
            for k in range(i, j):
                a = int(self._starts[k] - self._starts[i])
                yield int(self.ids[k]), self._decompress(k, raw[a:a + int(self._sizes[k, 0])])
            i = j


def write_documents(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                    text_col: str = "text", shards: int | None = None) -> DataFrame:
    """Write shards ``path``/part-NNNNNN.zst and return their manifest, in document order:
    (shard, file, n_docs, n_tokens, first_token). One row per shard."""
    spark = docs.sparkSession
    src = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("bigint").alias("id"), "text")
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    ordered = src.repartitionByRange(n, "id", tie).sortWithinPartitions("id", tie)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        fs, base = open_fs(path)
        fs.create_dir(base, recursive=True)
        shard = TaskContext.get().partitionId()
        end, enc, done = struct.pack("<I", end_id), encoder(tokenizer), []

        def rows():
            for b in batches:
                for i in range(0, b.num_rows, 256):
                    doc_ids, texts = (c.to_pylist() for c in b.slice(i, 256).columns)
                    for doc, ids in zip(doc_ids, enc.ids(texts), strict=True):
                        yield doc, ids + end

        file = f"{base}/part-{shard:06d}.zst"
        publish(fs, file, lambda out: done.append(write_shard(out, rows())))
        if done[0][0]:
            yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [f"part-{shard:06d}.zst"],
                                              "n_docs": [done[0][0]], "n_tokens": [done[0][1]]})

    manifest = stored(ordered.mapInArrow(run, "shard bigint, file string, n_docs bigint, n_tokens bigint"),
                      "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return manifest.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_documents(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """(id, start, n_tokens, tokens) of every document, read from the shards; tokens are the ids' bytes."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("tokens", pa.binary())])
        fs, base = open_fs(path)
        for b in batches:
            for r in b.to_pylist():
                with fs.open_input_file(f"{base}/{r['file']}") as f:
                    start, held, size = r["first_token"], [], 0
                    for doc, data in Shard(f).read_all():
                        held.append({"id": None if doc == NULL_ID else doc, "start": start,
                                     "n_tokens": len(data) // 4, "tokens": data})
                        start, size = start + len(data) // 4, size + len(data)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    return manifest.repartition(n, "shard").mapInArrow(run, "id bigint, start bigint, n_tokens bigint, tokens binary")


def lookup(path: str, file: str, doc_ids: list[int]) -> dict[int, list[bytes]]:
    """Token bytes of some documents of one shard; only their frames are decompressed."""
    import numpy as np

    fs, base = open_fs(path)
    with fs.open_input_file(f"{base}/{file}") as f:
        shard = Shard(f)
        return {d: [shard.read(int(i)) for i in np.flatnonzero(shard.ids == d)] for d in doc_ids}


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_dir(spark, "token-files")
    manifest = write_documents(table(spark, sf_dir, "documents"), path,
                               public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return read_documents(spark, path, manifest).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))
