"""Batch jobs: bronze -> silver, silver -> gold, and the ordered pipeline.

Each gold table is one DataFrame evaluated straight into its writer. The
silver input is not cached: every builder reads only the Parquet columns it
needs (and the fact write streams through), which scales past executor
memory where a full-width cache of the silver layer would spill.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators.silver import to_silver, validate_schema
from ..sources.bronze import land_raw, raw_category_path, read_raw
from ..sources.panel import facility_days, render_raw
from ..sources.sinks import read_layer, write_silver, write_table
from .warehouse import GOLD_TABLES, build_gold_table

GOLD_PARTITIONS = {"facts": ["state"], "agg_provider_monthly": ["state"], "provider_monthly_summary": ["state"]}


def run_raw_to_silver(spark: SparkSession, raw_path: str, silver_path: str) -> int:
    """Read raw CSV -> validate -> type/enrich -> partitioned Parquet (cy_qtr, state)."""
    raw = read_raw(spark, raw_path)
    validate_schema(raw)
    return write_silver(to_silver(raw), silver_path)


def run_silver_to_gold(spark: SparkSession, silver_path: str, gold_dir: str,
                       snapshot_date: str = C.DEFAULT_SNAPSHOT_DATE,
                       tables: list[str] | None = None, concurrent_writes: int = 6) -> dict[str, int]:
    """Build and write every gold table. The tables are independent, so their
    write jobs are submitted together (Spark runs concurrent jobs of one
    application side by side); each still reads only its own silver columns."""
    silver = read_layer(spark, silver_path)
    names = tables or list(GOLD_TABLES)

    def one(name: str) -> tuple[str, int]:
        df = build_gold_table(name, silver, snapshot_date)
        # replaced in full: a partition that the new load lacks must not stay behind
        return name, write_table(df, f"{gold_dir.rstrip('/')}/{GOLD_TABLES[name]}", GOLD_PARTITIONS.get(name))

    if concurrent_writes <= 1:
        return dict(one(n) for n in names)
    with ThreadPoolExecutor(max_workers=concurrent_writes) as pool:
        return dict(pool.map(one, names))


MATERIALIZED_VIEWS = ["mv_staffing_summary", "mv_provider_rankings"]


def refresh_materialized_views(spark: SparkSession, gold_dir: str, silver_path: str | None = None) -> int:
    """Recompute both materialized views from the freshly written gold tables
    (a new version folder each; readers switch once it is complete)."""
    from . import serving as Q
    from ..sources.sinks import MaterializedView
    from .warehouse import Warehouse
    wh = Warehouse.from_gold(spark, gold_dir, silver_path)
    defs = {"mv_staffing_summary": Q.mv_staffing_summary, "mv_provider_rankings": Q.mv_provider_rankings}
    total = 0
    for name in MATERIALIZED_VIEWS:
        mv = MaterializedView(spark, f"{gold_dir.rstrip('/')}/serving/{name}", lambda f=defs[name]: f(wh))
        total += mv.refresh()
    return total


def land_panel(spark: SparkSession, sf_dir: str, base: str, ingest_date: str) -> int:
    """Land the derived staffing panel as raw CSV (the upload step); returns records landed."""
    return land_raw(render_raw(facility_days(spark, sf_dir)), base, ingest_date)


def run_pipeline(spark: SparkSession, sf_dir: str, base: str, ingest_date: str = "2024-07-01",
                 snapshot_date: str = C.DEFAULT_SNAPSHOT_DATE) -> DataFrame:
    """Land -> silver -> gold -> refresh materialized views, in order; stop at the first failure.

    Returns a run log with one row per stage (stage, status, rows, seconds, detail)."""
    base = base.rstrip("/")
    silver, gold = f"{base}/processed/nursing_staffing", f"{base}/curated"
    stages = [
        ("land_raw", lambda: land_panel(spark, sf_dir, base, ingest_date)),
        ("raw_to_silver", lambda: run_raw_to_silver(spark, raw_category_path(base), silver)),
        ("silver_to_gold", lambda: sum(run_silver_to_gold(spark, silver, gold, snapshot_date).values())),
        ("refresh_views", lambda: refresh_materialized_views(spark, gold, silver)),
    ]
    log = []
    failed = False
    for name, fn in stages:
        if failed:
            log.append((name, "SKIPPED", None, 0.0, "earlier stage failed"))
            continue
        t0 = time.time()
        try:
            rows = fn()
            log.append((name, "SUCCEEDED", None if rows is None else int(rows), time.time() - t0, ""))
        except Exception as e:  # noqa: BLE001 - the log records the failure
            failed = True
            log.append((name, "FAILED", None, time.time() - t0, f"{type(e).__name__}: {e}"))
    return spark.createDataFrame(log, "stage string, status string, rows long, seconds double, detail string")


def pipeline_paths(base: str) -> dict[str, str]:
    base = base.rstrip("/")
    return {"raw": raw_category_path(base), "silver": f"{base}/processed/nursing_staffing",
            "gold": f"{base}/curated"}


def silver_roundtrip(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """Land the panel, run the bronze->silver job, read the silver table back."""
    land_panel(spark, sf_dir, base, "2024-07-01")
    p = pipeline_paths(base)
    run_raw_to_silver(spark, p["raw"], p["silver"])
    return spark.read.parquet(p["silver"])


def raw_scan_counts(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """Records per (quarter, state) as scanned back from the landed CSV."""
    land_panel(spark, sf_dir, base, "2024-07-01")
    raw = read_raw(spark, raw_category_path(base))
    return raw.groupBy(F.col("cy_qtr"), F.upper(F.trim(F.col("STATE"))).alias("state")).agg(
        F.count(F.lit(1)).alias("record_count"))
