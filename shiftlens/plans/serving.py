"""Warehouse access views, materialized views and the dashboard's queries.

All functions take a :class:`Warehouse` and return a lazy DataFrame. Top-k
queries sort on the requested key plus explicit tie-breakers, so the same
rows come back however the data is partitioned (``orderBy().limit()``
plans as a per-partition top-k merged in one small final step).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import staffing as S
from ..functions.rounding import SUM_TYPE, exact_avg, exact_sum, int_avg, pct_of_rows, stable_round
from ..operators.history import as_of
from ..operators.rank import add_ranks, with_ranks
from ..sources.sinks import to_serving
from . import metrics as M
from .warehouse import Warehouse

# Unrounded means upstream (plain AVG over unrounded ratios) are reported at
# this many places, which makes them engine- and order-independent.
MEAN_PLACES = 6


def _pm(wh: Warehouse) -> DataFrame:
    return wh.provider_monthly()


def _sm(wh: Warehouse) -> DataFrame:
    return wh.state_monthly()


def _alerts(wh: Warehouse) -> DataFrame:
    return M.v_staffing_alerts(_pm(wh))


def _dim_date(wh: Warehouse) -> DataFrame:
    # One row per calendar day present in the data: bounded, safe to broadcast.
    return F.broadcast(wh.table("dim_date"))


# -- access views ------------------------------------------------------------

def v_daily_staffing(wh: Warehouse) -> DataFrame:
    return wh.fact.select("provider_id", "date_key", "state", "cy_qtr", "work_date", "patient_census",
                          "hrs_rn", "hrs_lpn", "hrs_cna", "total_nursing_hours", "nursing_hppd",
                          "contract_ratio", "total_employed_hours", "total_contract_hours")


def v_provider(wh: Warehouse) -> DataFrame:
    return wh.table("dim_provider").select("provider_id", "provider_name", "city", "state",
                                           "county_name", "county_fips")


def v_provider_monthly_agg(wh: Warehouse) -> DataFrame:
    return wh.table("agg_provider_monthly").select(
        "provider_id", "provider_name", "state", "year", "month", "year_month", "avg_daily_census",
        "total_nursing_hours", "avg_nursing_hppd", "avg_contract_ratio", "days_reported")


def v_state_monthly_agg(wh: Warehouse) -> DataFrame:
    return wh.table("agg_state_monthly").select(
        "state", "year", "month", "year_month", "provider_count", "total_patient_days",
        "total_nursing_hours", "avg_nursing_hppd", "median_nursing_hppd", "avg_contract_ratio",
        "total_records")


# -- materialized views (definitions; materialize() stores them) -------------

def mv_staffing_summary(wh: Warehouse) -> DataFrame:
    f = wh.fact
    j = f.join(_dim_date(wh), "date_key")
    return j.groupBy("state", "year", "month", "year_month").agg(
        F.count_distinct("provider_id").alias("provider_count"),
        F.sum("patient_census").cast("bigint").alias("total_patient_days"),
        int_avg("patient_census").alias("avg_daily_census"),
        exact_sum("total_nursing_hours").alias("total_nursing_hours"),
        stable_round(F.avg("nursing_hppd"), MEAN_PLACES).alias("avg_nursing_hppd"),
        stable_round(F.avg("contract_ratio"), MEAN_PLACES).alias("avg_contract_ratio"),
        exact_sum("hrs_rn").alias("total_rn_hours"),
        exact_sum("hrs_lpn").alias("total_lpn_hours"),
        exact_sum("hrs_cna").alias("total_cna_hours"),
        F.count(F.lit(1)).alias("record_count"),
    )


def _provider_join(wh: Warehouse, current: bool = False) -> DataFrame:
    """dim_provider x agg_provider_monthly on provider_id. The faithful form fans
    out when a provider's attributes changed (as upstream); ``current`` joins
    the one-row-per-provider ``dim_provider_current`` instead."""
    dim = "dim_provider_current" if current else "dim_provider"
    p = wh.table(dim).select("provider_id", "provider_name", "city", "state")
    pm = wh.table("agg_provider_monthly").select(
        "provider_id", "year_month", "avg_nursing_hppd", "avg_daily_census", "total_nursing_hours",
        "avg_contract_ratio", "days_reported")
    return p.join(pm, "provider_id")


ASOF_COLUMNS = ["provider_name", "city", "state", "county_name", "county_fips"]


def provider_asof_monthly(wh: Warehouse) -> DataFrame:
    """``agg_provider_monthly`` with the provider attributes in force at the month's end: one row per
    provider-month, whatever changed since (unlike both forms of ``_provider_join``)."""
    pm = wh.table("agg_provider_monthly").select(
        "provider_id", "year_month", F.col("state").alias("reported_state"), "avg_nursing_hppd", "avg_daily_census",
        "total_nursing_hours", "avg_contract_ratio", "days_reported",
        F.last_day(F.make_date("year", "month", F.lit(1))).alias("_end"))
    j = as_of(pm, wh.table("dim_provider_history"), "provider_id", "_end", ASOF_COLUMNS)
    return j.select("provider_id", "as_of.provider_name", "as_of.city", "as_of.state", "year_month", "reported_state",
                    "avg_nursing_hppd", "avg_daily_census", "total_nursing_hours", "avg_contract_ratio", "days_reported")


def fact_asof_provider(wh: Warehouse) -> DataFrame:
    """Every facility-day with the provider attributes in force on that day."""
    rows = wh.fact.select("provider_id", "work_date", "patient_census", "total_nursing_hours")
    j = as_of(rows, wh.table("dim_provider_history"), "provider_id", "work_date", ASOF_COLUMNS)
    return j.select("provider_id", "work_date", "as_of.provider_name", "as_of.city", "as_of.state", "as_of.county_name",
                    "as_of.county_fips", "patient_census", "total_nursing_hours")


MV_RANK_COLUMNS = ["provider_id", "provider_name", "city", "state", "year_month", "avg_nursing_hppd",
                   "avg_daily_census", "total_nursing_hours", "avg_contract_ratio", "days_reported"]


def mv_provider_rankings(wh: Warehouse, current: bool = False, materialize: bool = True) -> DataFrame:
    j = _provider_join(wh, current)
    r = add_ranks(j, [
        dict(value="avg_nursing_hppd", partition_by=["state", "year_month"], rank_desc="state_rank_hppd"),
        dict(value="avg_nursing_hppd", partition_by=["year_month"], rank_desc="national_rank_hppd"),
    ], materialize=materialize)
    return r.select(*MV_RANK_COLUMNS, "state_rank_hppd", "national_rank_hppd")


# -- warehouse queries ---------------------------------------------------------

def kpi_overall(wh: Warehouse) -> DataFrame:
    f = v_daily_staffing(wh)
    return f.agg(
        F.count_distinct("provider_id").alias("total_providers"),
        F.count_distinct("state").alias("total_states"),
        F.sum("patient_census").cast("bigint").alias("total_patient_days"),
        exact_sum("total_nursing_hours").alias("total_nursing_hours"),
        stable_round(F.avg("nursing_hppd"), MEAN_PLACES).alias("avg_hppd"),
        stable_round(F.avg("contract_ratio") * F.lit(100.0), MEAN_PLACES).alias("avg_contract_pct"),
    )


def state_comparison(wh: Warehouse) -> DataFrame:
    f = v_daily_staffing(wh)
    return (f.groupBy("state").agg(
        F.count_distinct("provider_id").alias("providers"),
        stable_round(F.avg("nursing_hppd"), MEAN_PLACES).alias("avg_hppd"),
        stable_round(F.avg("contract_ratio") * F.lit(100.0), MEAN_PLACES).alias("contract_pct"),
        exact_sum("total_nursing_hours").alias("total_hours"))
        .orderBy(F.col("avg_hppd").desc_nulls_last(), "state"))


def monthly_trend(wh: Warehouse, summary: DataFrame | None = None) -> DataFrame:
    mv = summary if summary is not None else wh.materialized("mv_staffing_summary")
    return (mv.groupBy("year_month").agg(
        exact_sum("total_nursing_hours").alias("total_hours"),
        stable_round(F.avg("avg_nursing_hppd"), MEAN_PLACES).alias("avg_hppd"),
        F.sum("provider_count").cast("bigint").alias("providers_reporting"))
        .orderBy("year_month"))


def low_hppd_facilities(wh: Warehouse, limit: int = 100, current: bool = False) -> DataFrame:
    j = _provider_join(wh, current).where((F.col("avg_nursing_hppd") < C.LOW_HPPD_MAX)
                                 & (F.col("avg_daily_census") > C.LOW_HPPD_MIN_CENSUS))
    return (j.select("provider_id", "provider_name", "city", "state", "avg_nursing_hppd",
                     "avg_daily_census", "year_month")
            .orderBy(F.col("avg_nursing_hppd").asc_nulls_last(), "provider_id", "year_month",
                     "provider_name", "city", "state")
            .limit(limit))


def contract_trend(wh: Warehouse) -> DataFrame:
    f = wh.fact.join(_dim_date(wh).select("date_key", "year_month"), "date_key")
    agg = f.groupBy("state", "year_month").agg(
        exact_sum("total_employed_hours").alias("employed_hours"),
        exact_sum("total_contract_hours").alias("contract_hours"),
        exact_sum("total_nursing_hours").alias("_total"))
    return (agg.select("state", "year_month", "employed_hours", "contract_hours",
                       (F.try_divide(F.col("contract_hours"), F.nullif(F.col("_total"), F.lit(0.0)))
                        * F.lit(100.0)).alias("contract_pct"))
            .orderBy("state", "year_month"))


def alert_level_counts(wh: Warehouse) -> DataFrame:
    return _alerts(wh).groupBy("alert_level").agg(F.count(F.lit(1)).alias("alert_count"))


# -- dashboard ---------------------------------------------------------------

def kpi_cards(wh: Warehouse) -> DataFrame:
    k = M.v_kpi_summary(wh.daily())
    avg = F.col("overall_avg_hppd")
    return k.select("total_providers", "total_states", "total_records", "overall_avg_hppd",
                    stable_round(avg - F.lit(C.HPPD_BENCHMARK), 2).alias("hppd_vs_benchmark"),
                    stable_round((F.lit(C.HPPD_BENCHMARK) - avg) / F.lit(C.HPPD_BENCHMARK) * F.lit(100.0), 1)
                    .alias("benchmark_gap_pct"),
                    "overall_rn_mix_pct", "pct_meeting_benchmark", "pct_critical_understaffing")


def state_monthly_ordered(wh: Warehouse) -> DataFrame:
    return _sm(wh).orderBy("state", "year_month")


def state_summary(wh: Warehouse) -> DataFrame:
    sm = _sm(wh)
    return (sm.groupBy("state").agg(
        F.sum("provider_count").cast("bigint").alias("provider_count"),
        stable_round(exact_avg("avg_hppd"), 2).alias("avg_hppd"),
        stable_round(exact_avg("avg_rn_mix_pct"), 2).alias("avg_rn_mix_pct"),
        stable_round(exact_avg("pct_meeting_benchmark"), 1).alias("pct_meeting_benchmark"),
        stable_round(exact_avg("pct_critical"), 1).alias("pct_critical"),
        exact_sum("total_nursing_hours").alias("total_nursing_hours"))
        .orderBy(F.col("avg_hppd").desc_nulls_last(), "state"))


def state_list(wh: Warehouse) -> DataFrame:
    return _sm(wh).select("state").distinct().orderBy("state")


def provider_details(wh: Warehouse, state: str | None = None, limit: int = 100) -> DataFrame:
    pm = _provider_rows(wh, state)
    return pm.orderBy(F.col("avg_hppd").desc_nulls_last(), "provider_id", "year_month", "state").limit(limit)


PAGE_LIMIT = 200


def _provider_rows(wh: Warehouse, state: str | None) -> DataFrame:
    pm = _pm(wh)
    return pm if state is None else pm.where(F.col("state") == F.lit(state))


def provider_page_stats(wh: Warehouse, state: str | None = None) -> DataFrame:
    """Header figures of the provider page, over all provider-months (of the state),
    not only those that the page's list shows."""
    rows = _provider_rows(wh, state)
    return rows.agg(
        F.count(F.lit(1)).alias("providers"),
        stable_round(exact_avg("avg_hppd"), 2).alias("avg_hppd"),
        stable_round(exact_avg("avg_daily_census"), 1).alias("avg_census"),
        stable_round(pct_of_rows(F.col("avg_hppd") >= C.HPPD_BENCHMARK), 1).alias("pct_meeting_benchmark"),
    )


def provider_scatter(wh: Warehouse, state: str | None = None) -> DataFrame:
    return _provider_rows(wh, state).select(
        "provider_id", "state", "year_month", "avg_daily_census", "avg_hppd", "avg_rn_mix_pct",
        "days_reported")


def alerts_top(wh: Warehouse, limit: int = 100, levels: tuple[str, ...] | None = None) -> DataFrame:
    """The list of the most severe alerts; ``levels`` filters before the limit."""
    a = _alerts(wh)
    if levels is not None:
        a = a.where(F.col("alert_severity").isin(*levels))
    return a.orderBy(S.severity_order(F.col("alert_severity")), F.col("avg_hppd").asc_nulls_last(),
                     "provider_id", "year_month", "state").limit(limit)


def alert_counts(wh: Warehouse) -> DataFrame:
    """HIGH / MEDIUM / LOW counts over all alerts (zeros included)."""
    sev = F.col("alert_severity")
    return _alerts(wh).agg(
        F.count_if(sev == "HIGH").alias("high_alerts"),
        F.count_if(sev == "MEDIUM").alias("medium_alerts"),
        F.count_if(sev == "LOW").alias("low_alerts"))


def alerts_filtered(wh: Warehouse, levels: tuple[str, ...] = ("HIGH", "MEDIUM"), limit: int = 100) -> DataFrame:
    return alerts_top(wh, limit, levels)


def daily_trends(wh: Warehouse) -> DataFrame:
    d = wh.daily().where(F.col("patient_census") > 0)
    return (d.groupBy("work_date").agg(
        F.count_distinct("provider_id").alias("providers_reporting"),
        stable_round(exact_avg("nursing_hppd"), 2).alias("avg_hppd"),
        stable_round(exact_avg("rn_skill_mix_pct"), 2).alias("avg_rn_mix_pct"),
        F.sum("patient_census").cast("bigint").alias("total_census"),
        exact_sum("total_nursing_hours").alias("total_hours"))
        .orderBy("work_date"))


def hppd_distribution(wh: Warehouse) -> DataFrame:
    d = wh.daily().where((F.col("patient_census") > 0) & F.col("nursing_hppd").isNotNull())
    label, order = S.hppd_bin(F.col("nursing_hppd"))
    return (d.groupBy(label.alias("hppd_range"), order.alias("bin_order"))
            .agg(F.count(F.lit(1)).alias("record_count")).orderBy("bin_order"))


def staffing_mix(wh: Warehouse) -> DataFrame:
    d = wh.daily().where(F.col("patient_census") > 0)
    row = d.agg(*[F.sum(F.col(f"hrs_{r}").cast("decimal(20,6)")).alias(f"_{r}") for r in C.DIRECT_CARE_ROLES])
    tot = F.col("_rn") + F.col("_lpn") + F.col("_cna")
    out = [F.col(f"_{r}").cast("double").alias(f"{r}_hours") for r in C.DIRECT_CARE_ROLES]
    out += [stable_round(F.try_divide(F.col(f"_{r}").cast("double"), tot.cast("double")) * F.lit(100.0), 1)
            .alias(f"{r}_share_pct") for r in C.DIRECT_CARE_ROLES]
    return row.select(*out)


def state_trend_selected(wh: Warehouse, states: list[str] | None = None) -> DataFrame:
    """State-month rows for the selected states; by default all."""
    sm = _sm(wh)
    return sm.where(F.col("state").isin(*states)) if states else sm


def state_trend_preselected(wh: Warehouse, default_count: int = 5) -> DataFrame:
    """The page before a choice is made: the first five states of the listing (alphabetical)."""
    sm = _sm(wh)
    # At most ``default_count`` rows: a bounded broadcast for the semi-join.
    first = sm.select("state").distinct().orderBy("state").limit(default_count)
    return sm.join(F.broadcast(first), "state", "left_semi")


RANKING_ORDER = ["provider_id", "state", "days_reported", "avg_daily_census", "avg_rn_mix_pct", "avg_contract_pct",
                 "critical_days"]


def rankings_top10(wh: Warehouse, limit: int = 10) -> DataFrame:
    """The first rows of ``v_provider_rankings`` without ranking the others: the national rank falls with ``avg_hppd``,
    so the rows are a top-k of it; their ranks are counts of the rows above them, all in one further aggregate."""
    spark = wh.spark
    base = _pm(wh).where(F.col("days_reported") >= C.MIN_DAYS_RANKED).select(*M.RANKING_COLUMNS)
    top = base.orderBy(F.col("avg_hppd").desc_nulls_last(), *RANKING_ORDER).limit(limit).collect()  # ``limit`` rows

    def above(value: str, r, falling: bool, in_state: bool = True):
        """Rows that rank before row ``r``, in its state or in all; nulls come last."""
        c, v = F.col(value), r[value]
        hit = c.isNotNull() if v is None else (c > F.lit(v) if falling else c < F.lit(v))
        return F.count_if(hit & F.col("state").eqNullSafe(F.lit(r["state"])) if in_state else hit)

    counts = [F.count(F.lit(1)).alias("n")]
    for i, r in enumerate(top):
        counts += [above("avg_hppd", r, True).alias(f"a{i}"), above("avg_rn_mix_pct", r, True).alias(f"b{i}"),
                   above("avg_contract_pct", r, False).alias(f"c{i}"),
                   above("avg_hppd", r, True, in_state=False).alias(f"d{i}"),
                   above("avg_hppd", r, False, in_state=False).alias(f"e{i}")]
    found = base.agg(*counts)
    lines = [F.struct(*[F.lit(r[c]).cast(base.schema[c].dataType).alias(c) for c in M.RANKING_COLUMNS],
                      (F.col(f"a{i}") + 1).alias("state_rank_hppd"), (F.col(f"b{i}") + 1).alias("state_rank_rn_mix"),
                      (F.col(f"c{i}") + 1).alias("state_rank_stability"), (F.col(f"d{i}") + 1).alias("national_rank_hppd"),
                      F.when(F.col("n") > 1, stable_round(
                          F.col(f"e{i}").cast("double") / (F.col("n") - 1).cast("double") * F.lit(100.0), 1))
                      .otherwise(F.lit(0.0)).alias("hppd_percentile")) for i, r in enumerate(top)]
    if not lines:
        return M.v_provider_rankings(base, materialize=False)  # an empty table of the same columns
    return found.select(F.inline(F.array(*lines)))


def global_rank(wh: Warehouse) -> DataFrame:
    """National RANK/PERCENT_RANK of every provider-month by avg HPPD (scalable rank)."""
    pm = _pm(wh).select("provider_id", "state", "year_month", "avg_hppd")
    return with_ranks(pm, "avg_hppd", [], rank_desc="national_rank", percent_rank_asc="percent_rank")


def daily_ratio_rank(wh: Warehouse) -> DataFrame:
    """Every facility-day ranked nationally and in its state by the unrounded HPPD: values without a common grid."""
    rows = wh.fact.where(F.col("patient_census") > 0).select("provider_id", "state", "work_date", F.col("nursing_hppd").alias("ratio"))
    return add_ranks(rows, [dict(value="ratio", rank_desc="national_rank", percent_rank_asc="percent_rank"),
                            dict(value="ratio", partition_by=["state"], rank_desc="state_rank")], bucket_width=None)


COUNTED_TABLES = ["fact_daily_staffing", "dim_provider", "dim_date", "agg_provider_monthly",
                  "agg_state_monthly"]


def table_row_counts(wh: Warehouse) -> DataFrame:
    out = None
    for t in COUNTED_TABLES:
        c = wh.table(t).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(t).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


def fk_violations(wh: Warehouse) -> DataFrame:
    """Fact rows whose foreign key has no dimension row (expected: 0 each).

    Rows are counted per key value first (map-side combine, one column read per check), so what is
    shuffled and anti-joined is one row per distinct key, never the fact; a hot key is one row, too."""
    checks = [("date_key", "dim_date"), ("provider_id", "dim_provider"), ("state", "dim_state")]
    out = None
    for key, dim in checks:
        per_key = wh.fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        orphans = per_key.join(wh.table(dim).select(key).distinct(), key, "left_anti")
        one = orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("violations")).select(
            F.lit(f"fact.{key} -> {dim}").alias("check_name"), "violations")
        out = one if out is None else out.union(one)
    return out


def state_hours(wh: Warehouse) -> DataFrame:
    """Exact hour totals per state (decimals in the engine), fetched as the dashboard takes them: as doubles."""
    hours = ["total_nursing_hours", "total_employed_hours", "total_contract_hours"]
    return to_serving(wh.fact.groupBy("state").agg(*[F.sum(F.col(c).cast(SUM_TYPE)).alias(c) for c in hours]))
