"""Rejected rows: bad input is kept and counted, not turned into nulls without a trace.

``to_silver`` types with ``try_cast``, so ``abc`` hours become null like a
blank. ``checked_silver`` adds two columns to the same records in the same projection:

* ``rescued``: a map from column to raw text of every value that was there but could not
  be typed (null if all could);
* ``reject_reasons``: why the record cannot enter the fact at all (null if it can): it has no
  provider, or no valid date. Bad hours or a bad census spoil one figure, not the record.

``write_checked`` writes both kinds in one job, each under its own ``outcome=``
folder, and counts records, rejects and rescued values on the way: read = good + rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import write_table
from .silver import lower_columns, to_silver

GOOD, REJECTED = "good", "rejected"
REASONS = ["no provider", "no date", "bad date"]


def _present(c: Column) -> Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


def checked_silver(raw: DataFrame, source_file: str | None = None) -> DataFrame:
    """``to_silver`` with ``rescued`` and ``reject_reasons``."""
    low = lower_columns(raw)
    typed = {"mdscensus": "int", **{c: "double" for c in low.columns if c.startswith("hrs_")}}
    raws = [c for c in ("workdate", *typed) if c in low.columns]
    date = F.try_to_date(F.col("workdate").cast("string"), "yyyyMMdd")
    bad = {c: _present(F.col(c)) & F.col(c).try_cast(t).isNull() for c, t in typed.items() if c in low.columns}
    bad["workdate"] = _present(F.col("workdate")) & date.isNull()
    entries = F.filter(F.array(*[F.when(bad[c], F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))) for c in raws]),
                       lambda x: x.isNotNull())
    reasons = F.filter(F.array(
        F.when(~_present(F.col("provnum")), F.lit(REASONS[0])),
        F.when(~_present(F.col("workdate")), F.lit(REASONS[1])),
        F.when(bad["workdate"], F.lit(REASONS[2]))), lambda x: x.isNotNull())
    marked = low.withColumns({
        "rescued": F.when(F.size(entries) > 0, F.map_from_entries(entries)),
        "reject_reasons": F.when(F.size(reasons) > 0, reasons)})
    return to_silver(marked, source_file)


def write_checked(df: DataFrame, path: str) -> dict[str, int]:
    """Write ``checked_silver`` records to ``path``/outcome=good and /outcome=rejected; the counts of the write.

    The whole table is replaced."""
    obs = Observation(f"checked:{path}")
    bad = F.col("reject_reasons").isNotNull()
    counts = [F.count(F.lit(1)).alias("read"), F.count_if(bad).alias("rejected"),
              F.count_if(F.col("rescued").isNotNull()).alias("rescued"),
              *[F.count_if(F.array_contains("reject_reasons", r)).alias(r) for r in REASONS]]
    marked = df.observe(obs, *counts).withColumn("outcome", F.when(bad, REJECTED).otherwise(GOOD))
    write_table(marked, path, ["outcome", "cy_qtr", "state"])
    return {k: int(v or 0) for k, v in obs.get.items()}


def good(spark: SparkSession, path: str) -> DataFrame:
    """The silver records (with ``rescued``): a partition filter on the outcome."""
    return spark.read.parquet(path).where(F.col("outcome") == GOOD).drop("outcome", "reject_reasons")


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """The rejected records with their reasons, the raw date, and what could not be typed."""
    return spark.read.parquet(path).where(F.col("outcome") == REJECTED).drop("outcome")


def rescue_counts(df: DataFrame) -> DataFrame:
    """(column, values): how many values of each column could not be typed."""
    return df.select(F.explode(F.map_keys("rescued")).alias("column")).groupBy("column").agg(F.count(F.lit(1)).alias("values"))
