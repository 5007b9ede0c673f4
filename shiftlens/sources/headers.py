"""Raw files whose headers differ: checked per file, read by column name.

A CSV scan takes the columns from one file; a file with another column order
would be read into the wrong columns, so ``read_raw`` refuses it. Here every
file's header is looked at first. Only the head of each file is read, up to
``HEAD_BYTES``, by a pool of threads over Spark's own file-system interface
(so any store that Spark reads will do): that is work per file, like the listing of
the files that any scan makes on the driver, and no pass over the data.

Files with equal headers are then scanned together with that header as their schema, and the
scans are united by column name: one scan per distinct header, whatever the number of files.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import config as C
from .bronze import EmptySourceError, normalise_raw

HEAD_BYTES, THREADS = 1 << 16, 32


def data_files(spark: SparkSession, path: str, suffix: str = ".csv") -> list[str]:
    """The data files under ``path`` (hidden ones and markers left out), sorted."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    out, files = [], fs.listFiles(root, True)
    while files.hasNext():
        found = files.next().getPath()
        if not found.getName().startswith(("_", ".")) and found.getName().endswith(suffix):
            out.append(found.toString())
    return sorted(out)


def read_headers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """The columns that each file's first line names; none for an empty file."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def head(path: str) -> tuple[str, ...]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        stream = p.getFileSystem(conf).open(p)
        try:
            limited = jvm.org.apache.commons.io.input.BoundedInputStream(stream, HEAD_BYTES)
            text = jvm.org.apache.commons.io.IOUtils.toString(limited, "UTF-8")
        finally:
            stream.close()
        line, newline, _ = text.lstrip("﻿").partition("\n")
        if not newline and len(text) >= HEAD_BYTES:
            raise ValueError(f"no header line in the first {HEAD_BYTES} bytes of {path}")
        return tuple(next(csv.reader([line.rstrip("\r")]), ()))

    with ThreadPoolExecutor(THREADS) as pool:
        return dict(zip(paths, pool.map(head, paths)))


def schema_check(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    """(file, columns, missing, unknown, same_order, ok): one row per file under ``path``.

    ``missing``: required columns that its header lacks; ``unknown``: columns outside the known layout, both
    in lower case; ``same_order``: the known columns come in the order of the layout."""
    required = [c.lower() for c in required or C.REQUIRED_COLUMNS]
    known = [c.lower() for c in C.raw_columns()]
    rows = []
    for file, header in read_headers(spark, data_files(spark, path)).items():
        names = [c.strip().lower() for c in header]
        missing = [c for c in required if c not in names]
        at = [known.index(c) for c in names if c in known]
        rows.append((file, len(names), missing, sorted({c for c in names if c not in known}), at == sorted(at), not missing))
    return spark.createDataFrame(
        rows, "file string, columns int, missing array<string>, unknown array<string>, same_order boolean, ok boolean")


def read_raw_by_name(spark: SparkSession, path: str, skip_bad: bool = False) -> DataFrame:
    """``read_raw`` for files of differing headers: columns are matched by name (letter case ignored), a column that a
    file lacks is null in its rows. A file without a required column is an error that names file and
    columns, or with ``skip_bad`` left out."""
    headers = read_headers(spark, data_files(spark, path))
    required = [c.lower() for c in C.REQUIRED_COLUMNS]
    groups: dict[tuple[str, ...], list[str]] = {}
    bad = []
    for file, header in headers.items():
        missing = [c for c in required if c not in {h.strip().lower() for h in header}]
        if missing:
            bad.append(f"{file}: {missing}")
        else:
            groups.setdefault(header, []).append(file)
    if bad and not skip_bad:
        raise ValueError("Missing required columns: " + "; ".join(bad))
    layout = {c.lower(): c for c in C.raw_columns()}
    out = None
    for header, files in groups.items():
        names = [layout.get(h.strip().lower(), h.strip().lower()) for h in header]
        if len(set(names)) < len(names):
            raise ValueError(f"a column is named twice in {files[0]}")
        schema = StructType([StructField(n, StringType()) for n in names])
        part = normalise_raw(spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(files))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None or out.isEmpty():
        raise EmptySourceError(f"No records found in {path}")
    return out


def files_by_header(spark: SparkSession, path: str) -> DataFrame:
    """(header, files): how many files carry each header."""
    rows = [(list(h), f) for f, h in read_headers(spark, data_files(spark, path)).items()]
    return (spark.createDataFrame(rows, "header array<string>, file string").groupBy("header")
            .agg(F.count(F.lit(1)).alias("files")))
