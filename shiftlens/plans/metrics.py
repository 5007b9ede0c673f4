"""The seven metric views plus the documented extras (V1-V10).

Each view is a function DataFrame -> DataFrame and composes like the SQL
views do (``v_provider_rankings(v_provider_monthly(v_daily_metrics(fact)))``);
Catalyst inlines and prunes the whole chain. Every summary view keeps only
days with ``patient_census > 0``; that predicate is on a stored column, so
it reaches the Parquet scan of the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions import partials as P
from ..functions.rounding import exact_avg, exact_sum, int_avg, pct_of_rows, stable_round
from ..functions import staffing as S
from ..operators.rank import add_ranks

DAILY_HOURS = ["hrs_rn", "hrs_lpn", "hrs_cna", "hrs_rn_emp", "hrs_lpn_emp", "hrs_cna_emp",
               "hrs_rn_ctr", "hrs_lpn_ctr", "hrs_cna_ctr"]


def v_daily_metrics(fact: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """V1: null-safe hours, HPPD, RN HPPD, contract/RN/CNA shares and staffing band.
    ``extra``: further fact columns to carry along (for gold builders)."""
    census = F.col("patient_census")
    total = F.col("total_nursing_hours")
    contract = F.col("_contract")
    return fact.withColumn("_contract", S.null_safe_total(["hrs_rn_ctr", "hrs_lpn_ctr", "hrs_cna_ctr"])).select(
        "provider_id", "state", "cy_qtr", "work_date", "patient_census",
        *[S.nz(h).alias(h) for h in DAILY_HOURS],
        S.nz("total_nursing_hours").alias("total_nursing_hours"),
        S.per_census(total, census).alias("nursing_hppd"),
        S.per_census(S.nz("hrs_rn"), census).alias("rn_hppd"),
        S.share_pct(contract, total).alias("contract_staff_pct"),
        S.share_pct(S.nz("hrs_rn"), total).alias("rn_skill_mix_pct"),
        S.share_pct(S.nz("hrs_cna"), total).alias("cna_ratio_pct"),
        S.staffing_category(total, census).alias("staffing_level_category"),
        *extra,
    )


def _censused(daily: DataFrame) -> DataFrame:
    return daily.where(F.col("patient_census") > 0)


def _is(cat: str):
    return F.col("staffing_level_category") == cat


def v_provider_monthly(daily: DataFrame) -> DataFrame:
    """V2: provider x month summary."""
    month = F.trunc("work_date", "month")
    agg = _censused(daily).groupBy("provider_id", "state", month.alias("_month")).agg(
        F.count(F.lit(1)).alias("days_reported"),
        stable_round(int_avg("patient_census"), 1).alias("avg_daily_census"),
        F.sum("patient_census").cast("bigint").alias("total_patient_days"),
        exact_sum("total_nursing_hours").alias("total_nursing_hours"),
        exact_sum("hrs_rn").alias("total_rn_hours"),
        exact_sum("hrs_lpn").alias("total_lpn_hours"),
        exact_sum("hrs_cna").alias("total_cna_hours"),
        stable_round(exact_avg("nursing_hppd"), 2).alias("avg_hppd"),
        stable_round(F.min("nursing_hppd"), 2).alias("min_hppd"),
        stable_round(F.max("nursing_hppd"), 2).alias("max_hppd"),
        stable_round(F.stddev_samp("nursing_hppd"), 2).alias("stddev_hppd"),
        stable_round(exact_avg("rn_skill_mix_pct"), 2).alias("avg_rn_mix_pct"),
        stable_round(exact_avg("contract_staff_pct"), 2).alias("avg_contract_pct"),
        F.count_if(_is(C.CATEGORY_CRITICAL)).alias("critical_days"),
        F.count_if(_is(C.CATEGORY_MEETS)).alias("benchmark_met_days"),
    )
    return agg.select(
        "provider_id", "state",
        F.col("_month").cast("timestamp_ntz").alias("month_date"),
        F.date_format("_month", "yyyy-MM").alias("year_month"),
        *[c for c in agg.columns if c not in ("provider_id", "state", "_month")],
    )


def v_state_monthly(daily: DataFrame) -> DataFrame:
    """V3: state x month summary with exact interpolated quartiles of daily HPPD, from counts per
    distinct 2-place HPPD; sums and providers come from a provider-month aggregate."""
    keys = ["state", "_month"]
    hours, rates = ["total_nursing_hours", "hrs_rn", "hrs_lpn", "hrs_cna"], ["nursing_hppd", "rn_skill_mix_pct", "contract_staff_pct"]
    rows = _censused(daily).withColumn("_month", F.trunc("work_date", "month"))
    per = rows.groupBy(*keys, "provider_id").agg(
        *P.sums("patient_census", *hours, *rates), F.count(F.lit(1)).alias("_n"),
        F.count_if(_is(C.CATEGORY_MEETS)).alias("_meets"), F.count_if(_is(C.CATEGORY_CRITICAL)).alias("_critical"))
    agg = P.with_quartiles(per.groupBy(*keys).agg(
        F.count("provider_id").alias("provider_count"),
        P.whole("patient_census").alias("total_patient_days"),
        stable_round(P.mean("patient_census"), 1).alias("avg_daily_census"),
        *[P.total(h).alias(name) for h, name in zip(
            hours, ["total_nursing_hours", "total_rn_hours", "total_lpn_hours", "total_cna_hours"], strict=True)],
        stable_round(P.mean("nursing_hppd"), 2).alias("avg_hppd"),
        stable_round(P.mean("rn_skill_mix_pct"), 2).alias("avg_rn_mix_pct"),
        stable_round(P.mean("contract_staff_pct"), 2).alias("avg_contract_pct"),
        stable_round(P.share_pct("_meets", "_n"), 1).alias("pct_meeting_benchmark"),
        stable_round(P.share_pct("_critical", "_n"), 1).alias("pct_critical"),
    ), rows, keys, "nursing_hppd")
    q = F.col("_q")
    return agg.select(
        "state",
        F.col("_month").cast("timestamp_ntz").alias("month_date"),
        F.date_format("_month", "yyyy-MM").alias("year_month"),
        "provider_count", "total_patient_days", "avg_daily_census", "total_nursing_hours",
        "total_rn_hours", "total_lpn_hours", "total_cna_hours", "avg_hppd",
        stable_round(q[0], 2).alias("median_hppd"),
        stable_round(q[1], 2).alias("p25_hppd"),
        stable_round(q[2], 2).alias("p75_hppd"),
        "avg_rn_mix_pct", "avg_contract_pct", "pct_meeting_benchmark", "pct_critical",
    )


def v_kpi_summary(daily: DataFrame) -> DataFrame:
    """V4: one-row KPI header.

    The fact is aggregated by (provider, state) first, so that the distinct counts
    see one row per pair instead of copies of every fact row; days are counted
    from the dates alone. Both results are one row and meet on a constant."""
    c = _censused(daily)
    hours = ["total_nursing_hours", "hrs_rn", "hrs_lpn", "hrs_cna"]
    rates = ["nursing_hppd", "rn_skill_mix_pct", "contract_staff_pct"]
    per = c.groupBy("provider_id", "state").agg(
        F.min("work_date").alias("_first"), F.max("work_date").alias("_last"), F.count(F.lit(1)).alias("_n"),
        *P.sums("patient_census", *hours, *rates),
        F.count_if(_is(C.CATEGORY_MEETS)).alias("_meets"), F.count_if(_is(C.CATEGORY_CRITICAL)).alias("_critical"))
    total = per.agg(
        F.count_distinct("provider_id").alias("total_providers"),
        F.count_distinct("state").alias("total_states"),
        F.min("_first").alias("data_start_date"), F.max("_last").alias("data_end_date"),
        P.count("_n").alias("total_records"),
        P.whole("patient_census").alias("total_patient_days"),
        stable_round(P.mean("patient_census"), 1).alias("avg_daily_census"),
        *[stable_round(P.total(x), 0).alias(name) for x, name in zip(
            hours, ["total_nursing_hours", "total_rn_hours", "total_lpn_hours", "total_cna_hours"], strict=True)],
        *[stable_round(P.mean(x), n).alias(name) for x, n, name in zip(
            rates, [2, 1, 1], ["overall_avg_hppd", "overall_rn_mix_pct", "overall_contract_pct"], strict=True)],
        stable_round(P.share_pct("_meets", "_n"), 1).alias("pct_meeting_benchmark"),
        stable_round(P.share_pct("_critical", "_n"), 1).alias("pct_critical_understaffing"))
    days = c.select("work_date").distinct().agg(F.count("work_date").alias("total_days"))
    one = F.lit(0).alias("_one")
    return (total.select("*", one).join(F.broadcast(days.select("*", one)), "_one")  # one row each
            .select("total_providers", "total_states", "data_start_date", "data_end_date", "total_days",
                    "total_records", "total_patient_days", "avg_daily_census", "total_nursing_hours",
                    "total_rn_hours", "total_lpn_hours", "total_cna_hours", "overall_avg_hppd",
                    "overall_rn_mix_pct", "overall_contract_pct", "pct_meeting_benchmark",
                    "pct_critical_understaffing"))


RANKING_COLUMNS = ["provider_id", "state", "days_reported", "avg_daily_census", "avg_hppd",
                   "avg_rn_mix_pct", "avg_contract_pct", "critical_days"]


def v_provider_rankings(provider_monthly: DataFrame, min_days: int = C.MIN_DAYS_RANKED,
                        materialize: bool = True) -> DataFrame:
    """V5: in-state and national ranks of provider-months with >= ``min_days`` days.
    All months are ranked together, as upstream. Ranks come from the
    scalable rank operator (no single-task window over all rows)."""
    base = provider_monthly.where(F.col("days_reported") >= min_days).select(*RANKING_COLUMNS)
    r = add_ranks(base, [
        dict(value="avg_hppd", partition_by=["state"], rank_desc="state_rank_hppd"),
        dict(value="avg_rn_mix_pct", partition_by=["state"], rank_desc="state_rank_rn_mix"),
        dict(value="avg_contract_pct", partition_by=["state"], rank_asc="state_rank_stability"),
        dict(value="avg_hppd", rank_desc="national_rank_hppd", percent_rank_asc="_pr"),
    ], materialize=materialize)
    return r.select(*RANKING_COLUMNS, "state_rank_hppd", "state_rank_rn_mix", "state_rank_stability",
                    "national_rank_hppd",
                    stable_round(F.col("_pr") * F.lit(100.0), 1).alias("hppd_percentile"))


ALERT_COLUMNS = ["provider_id", "state", "year_month", "avg_daily_census", "avg_hppd",
                 "avg_rn_mix_pct", "avg_contract_pct", "critical_days", "days_reported"]


def v_staffing_alerts(provider_monthly: DataFrame) -> DataFrame:
    """V6: provider-months meeting any alert rule, with level and reasons.
    ``alert_severity`` is the leading word of the level (HIGH/MEDIUM/LOW)."""
    h, c, d = F.col("avg_hppd"), F.col("avg_contract_pct"), F.col("critical_days")
    cand = provider_monthly.where((h < C.ALERT_CANDIDATE_HPPD) | (c > C.ALERT_CANDIDATE_CONTRACT)
                                  | (d > C.ALERT_CANDIDATE_CRITICAL_DAYS))
    level = S.alert_level(h, F.col("avg_daily_census"), c, d)
    return cand.select(*ALERT_COLUMNS, level.alias("alert_level"),
                       S.hppd_alert(h).alias("hppd_alert"), S.contract_alert(c).alias("contract_alert"),
                       S.alert_severity(level).alias("alert_severity"))


def v_day_of_week_analysis(daily: DataFrame) -> DataFrame:
    """V7: state x day of week (0 = Sunday)."""
    agg = _censused(daily).groupBy("state", S.day_of_week0(F.col("work_date")).alias("day_of_week")).agg(
        F.count(F.lit(1)).alias("record_count"),
        stable_round(exact_avg("nursing_hppd"), 2).alias("avg_hppd"),
        stable_round(exact_avg("rn_skill_mix_pct"), 2).alias("avg_rn_mix_pct"),
        stable_round(exact_avg("contract_staff_pct"), 2).alias("avg_contract_pct"),
    )
    dow = F.col("day_of_week")
    return agg.select("state", "day_of_week", S.day_name_of(dow).alias("day_name"),
                      S.day_type_of(dow).alias("day_type"),
                      "record_count", "avg_hppd", "avg_rn_mix_pct", "avg_contract_pct")


def state_monthly_weighted(daily: DataFrame) -> DataFrame:
    """V8: census-weighted HPPD (sum of hours / sum of census) next to the plain mean."""
    agg = _censused(daily).groupBy("state", F.date_format("work_date", "yyyy-MM").alias("year_month")).agg(
        F.sum(F.col("total_nursing_hours").cast("decimal(20,6)")).alias("_hours"),
        F.sum("patient_census").cast("bigint").alias("total_patient_days"),
        stable_round(exact_avg("nursing_hppd"), 2).alias("avg_hppd"),
    )
    return agg.select("state", "year_month", F.col("_hours").cast("double").alias("total_nursing_hours"),
                      "total_patient_days",
                      stable_round(F.col("_hours").cast("double") / F.col("total_patient_days"), 2)
                      .alias("weighted_hppd"), "avg_hppd")


def rn_benchmark(daily: DataFrame) -> DataFrame:
    """V9: RN HPPD against the documented 0.75 benchmark, per state."""
    return _censused(daily).groupBy("state").agg(
        F.count(F.lit(1)).alias("record_count"),
        stable_round(exact_avg("rn_hppd"), 2).alias("avg_rn_hppd"),
        stable_round(pct_of_rows(F.col("rn_hppd") >= C.RN_HPPD_BENCHMARK), 1).alias("pct_meeting_rn_benchmark"),
    )


def _bands(daily: DataFrame, value: str, edges: tuple[float, float], labels: list[str]) -> DataFrame:
    v = F.col(value)
    lo, hi = edges
    label = F.when(v < lo, F.lit(labels[0])).when(v <= hi, F.lit(labels[1])).otherwise(F.lit(labels[2]))
    order = F.when(v < lo, 1).when(v <= hi, 2).otherwise(3).cast("bigint")
    agg = _censused(daily).groupBy(label.alias("band"), order.alias("band_order")).agg(
        F.count(F.lit(1)).alias("record_count"))
    # At most three rows: the share's denominator is a window over that tiny table.
    total = F.sum("record_count").over(Window.partitionBy())
    return agg.select("band", "band_order", "record_count",
                      stable_round(F.lit(100.0) * F.col("record_count") / total, 1).alias("pct_records"))


def contract_bands(daily: DataFrame) -> DataFrame:
    """V10: contract reliance bands (<15 typical, 15-30, >30 high reliance)."""
    return _bands(daily, "contract_staff_pct", (C.CONTRACT_TYPICAL_MAX, C.CONTRACT_HIGH_MIN),
                  ["Typical (<15%)", "Elevated (15-30%)", "High Reliance (>30%)"])


def skill_mix_bands(daily: DataFrame) -> DataFrame:
    """V10: RN skill-mix bands (<15 below typical, 15-25 typical, >25 above)."""
    return _bands(daily, "rn_skill_mix_pct", (C.RN_MIX_TYPICAL_MIN, C.RN_MIX_TYPICAL_MAX),
                  ["Below Typical (<15%)", "Typical (15-25%)", "Above Typical (>25%)"])
