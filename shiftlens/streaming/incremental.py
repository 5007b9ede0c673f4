"""Incremental bronze -> silver: process only raw files not seen before.

The scheduled job upstream re-reads the raw folder on every run and keeps a
bookmark of processed files. In Spark that is a file-source stream run with
``trigger(availableNow=True)``: each run picks up the files that arrived
since the last one, and the checkpoint (in the shared checkpoint folder)
records progress, so a lost executor or a killed run resumes without
duplicates. The Parquet file sink commits through its own metadata log,
which makes the silver output exactly-once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from .. import config as C
from ..operators.silver import to_silver
from ..sources.bronze import NO_FILES, normalise_raw


def raw_stream_schema(spark: SparkSession, raw_path: str) -> StructType:
    """The header of the files that are there, every column a string; without any file, the landed layout."""
    try:
        return (spark.read.option("header", True).option("inferSchema", False)
                .option("recursiveFileLookup", True).csv(raw_path).schema)
    except AnalysisException as e:
        if e.getCondition() not in NO_FILES:
            raise
    return StructType([StructField(c, StringType()) for c in C.raw_columns() if c.lower() != "cy_qtr"])


def start_incremental_silver(spark: SparkSession, raw_path: str, silver_path: str,
                             checkpoint: str, max_files_per_trigger: int | None = None):
    """Columns are told by the files' header: a file whose header differs fails the run instead
    of being read by position. Quarter, ingest date and file name are those of the batch reader."""
    reader = (spark.readStream.schema(raw_stream_schema(spark, raw_path)).option("header", True)
              .option("enforceSchema", False).option("recursiveFileLookup", True))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    silver = to_silver(normalise_raw(reader.csv(raw_path)))
    return (silver.writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .partitionBy("cy_qtr", "state")
            .trigger(availableNow=True)
            .start(silver_path))


def run_incremental_silver(spark: SparkSession, raw_path: str, silver_path: str, checkpoint: str) -> DataFrame:
    """Process every raw file that arrived since the last run, then read silver."""
    q = start_incremental_silver(spark, raw_path, silver_path, checkpoint)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(silver_path)
