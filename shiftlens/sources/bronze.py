"""Raw (bronze) zone: land staffing files, scan them back, route and inventory files.

Layout: ``<base>/raw/<category>/[cy_qtr=<Q>/]ingest_date=<D>/part-*.csv``.
The quarter folder is taken from the records' own ``CY_Qtr`` value (so a
misnamed file cannot relabel its rows); the raw CSV keeps every value as a
string.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from .sinks import observed


class EmptySourceError(ValueError):
    pass


def raw_category_path(base: str, category: str = C.QUARTERED_CATEGORY) -> str:
    return f"{base.rstrip('/')}/raw/{category}"


def land_raw(raw: DataFrame, base: str, ingest_date: str,
             category: str = C.QUARTERED_CATEGORY, file_name: str | None = None) -> int:
    """Write raw string records as header CSV under the bronze layout.

    The quarter folder comes from the records' ``CY_Qtr``; only when that
    column is missing is it taken from ``file_name`` (router rule), else the
    default quarter. Re-landing the same (quarter, ingest date) replaces only
    that folder (dynamic partition overwrite); other quarters and dates stay.
    Returns the number of records written."""
    qcol = next((c for c in raw.columns if c.lower() == "cy_qtr"), None)
    out = raw
    parts = ["ingest_date"]
    if category == C.QUARTERED_CATEGORY:
        if qcol:
            quarter = F.col(qcol)
        elif file_name:
            quarter = _quarter_from_name(F.lit(file_name))
        else:
            quarter = F.lit(C.DEFAULT_QUARTER)
        out = out.select(*[c for c in out.columns if c != qcol], quarter.alias("cy_qtr"))
        parts = ["cy_qtr", "ingest_date"]
    out, obs = observed(out.withColumn("ingest_date", F.lit(ingest_date)), f"land:{base}")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("header", True).partitionBy(*parts).csv(raw_category_path(base, category)))
    return int(obs.get.get("rows", 0))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV scan, every column a string, plus ``cy_qtr``, ``ingest_date``
    and ``source_file``. Raises if the folder holds no records.

    Folder names are not trusted over the data: a record's own ``CY_Qtr``
    wins, and the ``cy_qtr=`` folder only fills in when the file has no
    quarter column (files landed by :func:`land_raw`). Files whose header
    differs from the first file's fail the scan instead of being read
    positionally into the wrong columns."""
    try:
        df = (spark.read.option("header", True).option("inferSchema", False)
              .option("enforceSchema", False).option("recursiveFileLookup", True).csv(path))
    except AnalysisException as e:
        if e.getCondition() not in NO_FILES:  # permissions and storage faults are not an empty source
            raise
        raise EmptySourceError(f"No records found in {path}: {e}") from e
    df = normalise_raw(df)
    if df.isEmpty():
        raise EmptySourceError(f"No records found in {path}")
    return df


#: Error conditions of a missing folder, and of one without any file.
NO_FILES = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def normalise_raw(df: DataFrame) -> DataFrame:
    """Quarter, ingest date and file name for a CSV scan (batch or stream): see :func:`read_raw`."""
    fp = F.col("_metadata.file_path")
    path_quarter = F.nullif(F.regexp_extract(fp, r"cy_qtr=([^/]+)", 1), F.lit(""))
    ingest = F.nullif(F.regexp_extract(fp, r"ingest_date=([^/]+)", 1), F.lit(""))
    qcol = next((c for c in df.columns if c.lower() == "cy_qtr"), None)
    quarter = (F.coalesce(F.nullif(F.trim(F.col(qcol)), F.lit("")), path_quarter) if qcol else path_quarter)
    keep = [c for c in df.columns if c != qcol and c.lower() not in ("ingest_date", "source_file")]
    return df.select(*keep, quarter.alias("cy_qtr"), ingest.alias("ingest_date"), fp.alias("source_file"))


def _quarter_from_name(name: Column) -> Column:
    """First of Q1..Q4 in the name (else the default quarter); the year from the
    name when it carries one (else the default year)."""
    qn = None
    for i in range(1, 5):
        cond = name.contains(f"Q{i}")
        qn = F.when(cond, F.lit(str(i))) if qn is None else qn.when(cond, F.lit(str(i)))
    default_year, default_q = C.DEFAULT_QUARTER[:4], C.DEFAULT_QUARTER[-1]
    year = F.regexp_extract(name, r"(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", 1)
    year = F.when(year == "", F.lit(default_year)).otherwise(year)
    return F.concat(year, F.lit("Q"), qn.otherwise(F.lit(default_q)))


def route_files(files: DataFrame, name_col: str = "file_name", ingest_date: Column | str | None = None) -> DataFrame:
    """Add ``category``, ``cy_qtr`` and the bronze ``key`` for each file name.

    First matching pattern wins, else ``other``. The staffing file's quarter
    is the first of Q1..Q4 found in the name, else the default quarter; the
    year is taken from the name when it carries one, else the default year."""
    name = F.col(name_col)
    cat = None
    for pattern, category in C.FILE_CATEGORIES:
        cond = name.contains(pattern)
        cat = F.when(cond, F.lit(category)) if cat is None else cat.when(cond, F.lit(category))
    cat = cat.otherwise(F.lit(C.OTHER_CATEGORY))
    quarter = _quarter_from_name(name)
    quartered = cat == F.lit(C.QUARTERED_CATEGORY)
    d = F.col(ingest_date) if isinstance(ingest_date, str) else (
        ingest_date if ingest_date is not None else F.date_format(F.current_date(), "yyyy-MM-dd"))
    key = F.concat(F.lit("raw/"), cat, F.lit("/"),
                   F.when(quartered, F.concat(F.lit("cy_qtr="), quarter, F.lit("/"))).otherwise(F.lit("")),
                   F.lit("ingest_date="), d, F.lit("/"), name)
    return files.select("*", cat.alias("category"),
                        F.when(quartered, quarter).alias("cy_qtr"), key.alias("key"))


def raw_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the non-empty files under ``path``.

    Reads only file metadata: selecting ``path``/``length`` prunes the
    ``content`` column of the binaryFile source."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select("path", "length").where(F.col("length") > 0))


def raw_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Number and total size of the non-empty files under ``path``."""
    return raw_files(spark, path).agg(F.count(F.lit(1)).alias("file_count"),
                                      F.sum("length").cast("bigint").alias("total_bytes"))
