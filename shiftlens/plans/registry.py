"""Registered queries: key -> function(Warehouse) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from . import metrics as M
from . import serving as Q
from . import jobs as J
from . import quarter_state as T
from .catalog import register_views
from .warehouse import GOLD_TABLES, Warehouse
from ..operators import distinct, quarantine as QU
from ..operators.silver import to_silver
from ..session import scratch_dir
from ..sources.bronze import raw_files, raw_inventory, read_raw, route_files
from ..sources.headers import read_raw_by_name, schema_check
from ..sources.panel import NEXT_QUARTER, PANEL_QUARTER, facility_days, facility_sums, next_quarter, panel_of, render_raw
from ..sources.sinks import create_external_tables, materialize, register_tables, write_silver, write_table
from ..streaming.incremental import run_incremental_silver


def _pm(wh: Warehouse) -> DataFrame:
    return wh.provider_monthly()


def _silver_cols(*cols: str):
    return lambda wh: wh.silver.select(*cols)


def _provider_details_first_state(wh: Warehouse) -> DataFrame:
    """Provider page filtered to one state: the first in the state list."""
    pm = _pm(wh)
    first = pm.agg(F.min("state").alias("state"))  # one row
    rows = pm.join(F.broadcast(first), "state", "left_semi")
    return (rows.orderBy(F.col("avg_hppd").desc_nulls_last(), "provider_id", "year_month", "state")
            .limit(Q.PAGE_LIMIT))


WH_QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {
    # metric views
    "v_daily_metrics": lambda wh: wh.daily(),
    "v_kpi_summary": lambda wh: M.v_kpi_summary(wh.daily()),
    "v_provider_monthly": _pm,
    "v_state_monthly": lambda wh: wh.state_monthly(),
    "v_provider_rankings": lambda wh: M.v_provider_rankings(_pm(wh)),
    "v_staffing_alerts": lambda wh: M.v_staffing_alerts(_pm(wh)),
    "v_day_of_week_analysis": lambda wh: M.v_day_of_week_analysis(wh.daily()),
    "state_monthly_weighted": lambda wh: M.state_monthly_weighted(wh.daily()),
    "rn_benchmark": lambda wh: M.rn_benchmark(wh.daily()),
    "contract_bands": lambda wh: M.contract_bands(wh.daily()),
    "skill_mix_bands": lambda wh: M.skill_mix_bands(wh.daily()),
    # silver
    "silver_typed": _silver_cols("provnum", "provname", "city", "state", "county_name", "county_fips",
                                 "cy_qtr", "work_date", "mdscensus", *C.hour_columns()),
    "silver_metrics": _silver_cols("provnum", "work_date", "total_nursing_hours", "nursing_hppd"),
    "silver_contract": _silver_cols("provnum", "work_date", "total_employed_hours", "total_contract_hours",
                                    "contract_ratio"),
    "silver_calendar": _silver_cols("provnum", "work_date", "work_year", "work_month", "work_day_of_week"),
    # gold
    "fact_daily_staffing": lambda wh: wh.fact.drop("processed_at"),
    "dim_date": lambda wh: wh.table("dim_date"),
    "dim_provider": lambda wh: wh.table("dim_provider").drop("provider_sk"),
    "dim_provider_current": lambda wh: wh.table("dim_provider_current"),
    "dim_provider_history": lambda wh: wh.table("dim_provider_history"),
    "dim_state": lambda wh: wh.table("dim_state"),
    "agg_state_monthly_etl": lambda wh: wh.table("agg_state_monthly_etl"),
    "agg_provider_monthly": lambda wh: wh.table("agg_provider_monthly"),
    "agg_state_monthly": lambda wh: wh.table("agg_state_monthly"),
    "agg_overall_metrics": lambda wh: wh.table("agg_overall_metrics"),
    # warehouse access views and materialized-view definitions
    "v_daily_staffing": Q.v_daily_staffing,
    "v_provider": Q.v_provider,
    "v_provider_monthly_agg": Q.v_provider_monthly_agg,
    "v_state_monthly_agg": Q.v_state_monthly_agg,
    "mv_staffing_summary": Q.mv_staffing_summary,
    "mv_provider_rankings": Q.mv_provider_rankings,
    "mv_provider_rankings_current": lambda wh: Q.mv_provider_rankings(wh, current=True),
    "provider_asof_monthly": Q.provider_asof_monthly,
    "fact_asof_provider": Q.fact_asof_provider,
    # warehouse queries
    "kpi_overall": Q.kpi_overall,
    "state_comparison": Q.state_comparison,
    "monthly_trend": Q.monthly_trend,
    "low_hppd_facilities": Q.low_hppd_facilities,
    "low_hppd_facilities_current": lambda wh: Q.low_hppd_facilities(wh, current=True),
    "contract_trend": Q.contract_trend,
    "alert_level_counts": Q.alert_level_counts,
    # dashboard
    "kpi_cards": Q.kpi_cards,
    "state_monthly_ordered": Q.state_monthly_ordered,
    "state_summary": Q.state_summary,
    "state_list": Q.state_list,
    "provider_details": lambda wh: Q.provider_details(wh, limit=Q.PAGE_LIMIT),
    "provider_details_state": _provider_details_first_state,
    "provider_page_stats": Q.provider_page_stats,
    "provider_scatter": Q.provider_scatter,
    "alerts_top": Q.alerts_top,
    "alert_counts": Q.alert_counts,
    "alerts_filtered": Q.alerts_filtered,
    "daily_trends": Q.daily_trends,
    "hppd_distribution": Q.hppd_distribution,
    "staffing_mix": Q.staffing_mix,
    "state_trend_selected": Q.state_trend_preselected,
    "rankings_top10": Q.rankings_top10,
    "global_rank": Q.global_rank,
    "daily_ratio_rank": Q.daily_ratio_rank,
    "state_hours": Q.state_hours,
    "table_row_counts": Q.table_row_counts,
    "fk_violations": Q.fk_violations,
}


SILVER_TYPED = ["provnum", "provname", "city", "state", "county_name", "county_fips", "cy_qtr",
                "work_date", "mdscensus", *C.hour_columns()]


# -- queries that run the jobs (they write under the shared checkpoint folder) --

def _silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.silver_roundtrip(spark, sf_dir, scratch_dir(spark, "silver")).select(*SILVER_TYPED)


def _incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "incremental")
    J.land_panel(spark, sf_dir, base, "2024-07-01")
    p = J.pipeline_paths(base)
    out = run_incremental_silver(spark, p["raw"], f"{base}/silver_stream", f"{base}/_checkpoint")
    return out.select(*SILVER_TYPED)


def _run_pipeline_checked(spark: SparkSession, sf_dir: str, name: str) -> dict[str, str]:
    base = scratch_dir(spark, name)
    log = J.run_pipeline(spark, sf_dir, base)
    failed = log.where(F.col("status") != "SUCCEEDED").collect()  # at most one row per stage
    if failed:
        raise RuntimeError(f"pipeline failed: {failed}")
    return J.pipeline_paths(base)


def _gold_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    p = _run_pipeline_checked(spark, sf_dir, "gold")
    return Warehouse.from_gold(spark, p["gold"], p["silver"])


def _gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.table_row_counts(_gold_warehouse(spark, sf_dir))


def _kpi_from_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.v_kpi_summary(_gold_warehouse(spark, sf_dir).daily())


CATALOG_SQL = """
SELECT f.state, count(*) AS record_count, max(s.provider_count) AS provider_count
FROM fact_daily_staffing f JOIN dim_state s ON f.state = s.state
GROUP BY f.state
"""


def _catalog_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold folders registered as tables, queried with SQL text."""
    p = _run_pipeline_checked(spark, sf_dir, "catalog")
    register_tables(spark, p["gold"], GOLD_TABLES)
    return spark.sql(CATALOG_SQL)


SQL_OVER_VIEWS = """
SELECT s.state, SUM(s.provider_count) AS provider_months, SUM(s.total_patient_days) AS patient_days,
       MAX(a.alerts) AS alerts
FROM v_state_monthly s
LEFT JOIN (SELECT state, COUNT(*) AS alerts FROM v_staffing_alerts GROUP BY state) a ON a.state = s.state
GROUP BY s.state
"""


def _sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse-style SQL text over the registered metric views."""
    register_views(Warehouse.derived(spark, sf_dir), ["v_state_monthly", "v_staffing_alerts"])
    return spark.sql(SQL_OVER_VIEWS)


def _mv_stored(definition):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = Warehouse.derived(spark, sf_dir)
        return materialize(spark, scratch_dir(spark, "mv"), lambda: definition(wh))
    return run


def _raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "inventory")
    J.land_panel(spark, sf_dir, base, "2024-07-01")
    return raw_inventory(spark, f"{base}/raw")


# -- the raw zone: files landed from the panel --

def _once(build: Callable[[SparkSession, str], str]) -> Callable[[SparkSession, str], str]:
    """A folder that is built once per session and input; its users only read it."""
    made: dict[tuple[str, str], str] = {}

    def path(spark: SparkSession, sf_dir: str) -> str:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in made:
            made[key] = build(spark, sf_dir)
        return made[key]
    return path


@_once
def _landed(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_dir(spark, "landed")
    J.land_panel(spark, sf_dir, base, "2024-07-01")
    return base


def _land_raw_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What comes back from the landed layout, column by column, with quarter and ingest date from the folders."""
    raw = read_raw(spark, J.pipeline_paths(_landed(spark, sf_dir))["raw"])
    return raw.select("PROVNUM", "PROVNAME", F.trim("STATE").alias("STATE"), "WorkDate", "MDScensus",
                      *[F.col(c).cast("double").alias(c) for c in C.raw_hour_columns()], "cy_qtr", "ingest_date")


def _provider_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of files as facilities would upload them: a kind of file per facility, dealt by its number."""
    kinds = [k for k, _ in C.FILE_CATEGORIES] + ["readme"]
    number = F.col("provnum").cast("bigint")
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (number % len(kinds) + 1).cast("int"))
    quarter = F.when(number % 2 == 0, F.concat(F.lit("_"), F.substring("cy_qtr", 5, 2), F.lit("_"), F.substring("cy_qtr", 1, 4)))
    files = facility_days(spark, sf_dir).select("provnum", "cy_qtr").distinct()
    return files.select(F.concat(kind, F.coalesce(quarter, F.lit("")), F.lit("_"), "provnum", F.lit(".csv")).alias("file_name"))


def _route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_files(_provider_files(spark, sf_dir), ingest_date=F.lit("2024-07-01"))


@_once
def _mixed_files(spark: SparkSession, sf_dir: str) -> str:
    """The panel landed by state groups, each with a layout of its own: as published; columns in reverse order with
    lower-case names and a note; without the census."""
    base = scratch_dir(spark, "mixed")
    raw = render_raw(facility_days(spark, sf_dir))
    number = F.col("PROVNUM").cast("bigint") % 3
    plain = [c for c in raw.columns]
    for i, cols in enumerate((plain, [F.col(c).alias(c.lower()) for c in reversed(plain)] + [F.lit("n").alias("note")],
                              [c for c in plain if c != "MDScensus"])):
        (raw.where(number == i).select(*cols).write.mode("overwrite").option("header", True)
         .csv(f"{base}/raw/layout_{i}/ingest_date=2024-07-01"))
    return f"{base}/raw"


def _schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = schema_check(spark, _mixed_files(spark, sf_dir))
    folder = F.regexp_extract("file", "(layout_[0-9])", 1)
    return told.groupBy(folder.alias("layout")).agg(
        F.max("columns").alias("columns"), F.array_join(F.max("missing"), ",").alias("missing"),
        F.array_join(F.max("unknown"), ",").alias("unknown"), F.bool_and("same_order").alias("same_order"), F.bool_and("ok").alias("ok"))


def _mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver from files of two column orders; the files without a required column are left out."""
    raw = read_raw_by_name(spark, _mixed_files(spark, sf_dir), skip_bad=True)
    return to_silver(raw).select(*SILVER_TYPED)


def _spoilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with bad input: every 7th facility without some dates, every 5th with bad hours or census."""
    raw = render_raw(facility_days(spark, sf_dir))
    number, day = F.col("PROVNUM").cast("bigint"), F.substring("WorkDate", 7, 2)
    return raw.withColumns({
        "PROVNUM": F.when((number % 50 == 3) & (day == "11"), F.lit(" ")).otherwise(F.col("PROVNUM")),
        "WorkDate": F.when((number % 7 == 1) & (day == "05"), F.lit("20241301")).when(
            (number % 7 == 2) & (day == "06"), F.lit("")).otherwise(F.col("WorkDate")),
        "Hrs_RN": F.when((number % 5 == 0) & (day == "07"), F.lit("abc")).otherwise(F.col("Hrs_RN")),
        "MDScensus": F.when((number % 5 == 1) & (day == "08"), F.lit("12x")).otherwise(F.col("MDScensus"))})


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the write, and again from what was written."""
    path = scratch_dir(spark, "checked")
    told = QU.write_checked(QU.checked_silver(_spoilt(spark, sf_dir), f"{sf_dir}/lineitem.parquet"), path)
    good, bad = QU.good(spark, path), QU.quarantined(spark, path)
    n = F.count(F.lit(1)).alias("rows")
    parts = [spark.createDataFrame([(f"write: {k}", v) for k, v in told.items()], "fact string, rows bigint"),
             good.agg(n).select(F.lit("good").alias("fact"), "rows"), bad.agg(n).select(F.lit("quarantined").alias("fact"), "rows"),
             bad.select(F.explode("reject_reasons").alias("r")).groupBy("r").agg(n).select(F.concat(F.lit("reason: "), "r").alias("fact"), "rows"),
             QU.rescue_counts(good.select("rescued").union(bad.select("rescued"))).select(F.concat(F.lit("rescued: "), "column").alias("fact"), F.col("values").alias("rows"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "checked")
    QU.write_checked(QU.checked_silver(_spoilt(spark, sf_dir), f"{sf_dir}/lineitem.parquet"), path)
    return QU.good(spark, path).select("provnum", "work_date", "mdscensus", "hrs_rn", F.col("rescued")["hrs_rn"].alias("raw_hrs_rn"),
                                       F.col("rescued")["mdscensus"].alias("raw_census"))


def _external_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over stored catalog tables, from another session than the one that made them."""
    p = _run_pipeline_checked(spark, sf_dir, "external")
    database = f"staffing_{uuid.uuid4().hex[:8]}"
    create_external_tables(spark, database, p["gold"], GOLD_TABLES)
    other = spark.newSession()
    return other.sql(CATALOG_SQL.replace("FROM fact_daily_staffing", f"FROM {database}.facts").replace(
        "JOIN dim_state", f"JOIN {database}.dim_state"))


def _raw_inventory_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record bytes per landed folder: file sizes less one header line for each file, however many files Spark wrote."""
    files = raw_files(spark, f"{_landed(spark, sf_dir)}/raw")
    header = len(",".join(c for c in C.raw_columns() if c != "CY_Qtr")) + 1
    folder = F.regexp_extract("path", "raw/(.*)/[^/]*$", 1)
    return files.groupBy(folder.alias("folder")).agg(
        (F.sum("length") - F.count(F.lit(1)) * F.lit(header)).cast("bigint").alias("record_bytes"))


def _pipeline_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.run_pipeline(spark, sf_dir, scratch_dir(spark, "runlog")).select("stage", "status", "rows")


def _quarters_gold(spark: SparkSession, sf_dir: str) -> str:
    """Gold after two quarters were loaded one after the other; built once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _QUARTERS:
        base = scratch_dir(spark, "quarters")
        write_table(facility_sums(spark, sf_dir), f"{base}/panel")  # both quarters are made from it
        first = panel_of(spark.read.parquet(f"{base}/panel"))
        for panel, quarter in ((first, PANEL_QUARTER), (next_quarter(first), NEXT_QUARTER)):
            write_silver(to_silver(render_raw(panel), source_file=f"{sf_dir}/lineitem.parquet"), f"{base}/silver")
            T.load_quarter(spark, f"{base}/silver", f"{base}/gold", quarter)
        _QUARTERS[key] = f"{base}/gold"
    return _QUARTERS[key]


_QUARTERS: dict[tuple[str, str], str] = {}


def _after_quarters(query: Callable[[Warehouse], DataFrame]):
    return lambda spark, sf_dir: query(Warehouse.from_gold(spark, _quarters_gold(spark, sf_dir)))


def _reach(*keys: str):
    """Distinct providers over all months of a group, from the stored bitmaps."""
    return lambda spark, sf_dir: distinct.count_united(T.provider_sets(spark, _quarters_gold(spark, sf_dir)), list(keys))


def _sketch_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of all months of a state combined, held against the exact figures."""
    gold = _quarters_gold(spark, sf_dir)
    exact = distinct.count_united(T.provider_sets(spark, gold), ["state"])
    return distinct.check(T.read_state(spark, gold, "sketches"), T.read_state(spark, gold, "hppd_counts"), exact, "state",
                          "nursing_hppd")


QUARTER_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "quarters_provider_monthly": _after_quarters(lambda wh: wh.provider_monthly()),
    "quarters_state_monthly": _after_quarters(lambda wh: wh.state_monthly()),
    "quarters_kpi_summary": _after_quarters(lambda wh: M.v_kpi_summary(wh.daily())),
    "quarters_mv_staffing_summary": _after_quarters(lambda wh: wh.materialized("mv_staffing_summary")),
    "quarters_provider_asof_monthly": _after_quarters(Q.provider_asof_monthly),
    **{f"quarters_{t}": _after_quarters(lambda wh, t=t: wh.table(t)) for t in (
        "dim_date", "dim_provider_current", "dim_provider_history", "dim_state", "agg_provider_monthly", "agg_state_monthly",
        "agg_state_monthly_etl", "agg_overall_metrics")},
    "state_provider_reach": _reach("state"),
    "monthly_provider_reach": _reach("year", "month"),
    "sketch_accuracy": _sketch_check,
}


JOB_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "silver_roundtrip": _silver_roundtrip,
    "incremental_silver": _incremental_silver,
    "raw_scan_counts": lambda spark, sf: J.raw_scan_counts(spark, sf, scratch_dir(spark, "rawscan")),
    "gold_roundtrip": _gold_roundtrip,
    "kpi_from_gold": _kpi_from_gold,
    "catalog_sql_counts": _catalog_sql,
    "sql_over_views": _sql_over_views,
    "mv_staffing_summary_stored": _mv_stored(Q.mv_staffing_summary),
    "mv_provider_rankings_stored": _mv_stored(Q.mv_provider_rankings),
    "pipeline_run_log": _pipeline_run_log,
    "raw_inventory": _raw_inventory,
    "raw_inventory_bytes": _raw_inventory_bytes,
    "land_raw_roundtrip": _land_raw_roundtrip,
    "route_files": _route_files,
    "schema_check": _schema_check,
    "mixed_headers": _mixed_headers,
    "quarantine_counts": _quarantine,
    "quarantine_good": _quarantine_good,
    "external_tables": _external_tables,
}

# hash keys and processing times have no SQL value; what holds for them does
DERIVED_FACTS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "silver_lineage": lambda wh: wh.silver.select(
        "provnum", "work_date", F.col("processed_at").isNotNull().alias("has_processed_at"),
        F.col("source_file").isNotNull().alias("has_source_file")),
    "dim_provider_sk": lambda wh: wh.table("dim_provider").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("provider_sk").alias("distinct_keys"),
        F.count_if(F.col("provider_sk").isNull()).alias("null_keys")),
}


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(Warehouse.derived(spark, sf_dir))
    out = {k: bind(fn) for k, fn in WH_QUERIES.items()}
    out.update({k: bind(fn) for k, fn in DERIVED_FACTS.items()})
    out.update(JOB_QUERIES)
    out.update(QUARTER_QUERIES)
    return out
