"""Bronze -> silver: validate, type and enrich the raw staffing records.

One projection does all of it (no per-column ``withColumn`` chain), so the
analyzed plan stays flat and the whole transform is a single codegen stage
after the scan. Bad values never fail the job: casts are ``try_cast`` /
``try_to_date`` (ANSI mode stays on for everything else).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C


class SchemaError(ValueError):
    pass


def validate_schema(df: DataFrame, required: list[str] | None = None) -> None:
    """Raise listing every required column that is missing (case-insensitive)."""
    required = required or C.REQUIRED_COLUMNS
    present = {c.lower() for c in df.columns}
    missing = [c for c in required if c.lower() not in present]
    if missing:
        raise SchemaError(f"Missing required columns: {missing}")


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def to_silver(raw: DataFrame, source_file: str | None = None) -> DataFrame:
    """Typed silver records. ``raw`` carries string columns under any letter case.

    ``source_file``: lineage value when ``raw`` has no ``source_file`` column
    (file scans add it from the ``_metadata`` column in :func:`read_raw`).
    """
    validate_schema(raw)
    df = lower_columns(raw)
    hour_cols = [c for c in df.columns if c.startswith("hrs_")]
    keep = [c for c in df.columns if c not in hour_cols and c not in ("mdscensus", "state", "source_file")]

    hours = {c: F.col(c).try_cast("double") for c in hour_cols}
    census = F.col("mdscensus").try_cast("int")
    work_date = F.try_to_date(F.col("workdate").cast("string"), "yyyyMMdd")

    def total(suffix: str):
        names = [f"hrs_{r}{suffix}" for r in C.DIRECT_CARE_ROLES]
        exprs = [hours.get(n, F.lit(None).cast("double")) for n in names]
        out = F.coalesce(exprs[0], F.lit(0.0))
        for e in exprs[1:]:
            out = out + F.coalesce(e, F.lit(0.0))
        return out

    total_hours = total("")
    total_ctr = total("_ctr")
    if "source_file" in df.columns:
        src = F.col("source_file")
    else:
        src = F.lit(source_file).cast("string")

    return df.select(
        *keep,
        F.upper(F.trim(F.col("state"))).alias("state"),
        census.alias("mdscensus"),
        *[e.alias(c) for c, e in hours.items()],
        work_date.alias("work_date"),
        F.year(work_date).alias("work_year"),
        F.month(work_date).alias("work_month"),
        F.dayofweek(work_date).alias("work_day_of_week"),
        total_hours.alias("total_nursing_hours"),
        total("_emp").alias("total_employed_hours"),
        total_ctr.alias("total_contract_hours"),
        F.when(census > 0, total_hours / census).alias("nursing_hppd"),
        F.when(total_hours != 0, total_ctr / total_hours).alias("contract_ratio"),
        F.current_timestamp().alias("processed_at"),
        src.alias("source_file"),
    )


__all__ = ["SchemaError", "validate_schema", "lower_columns", "to_silver"]
