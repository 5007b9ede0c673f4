"""Silver -> gold: star-schema dimensions, the facility-day fact and aggregates.

Every builder is a pure DataFrame function of the silver records, so the
job can evaluate each one straight into its writer (one pass per table,
reading only the columns it needs from Parquet).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import partials as P
from ..functions.rounding import int_avg, stable_round

FACT_HOURS = ["hrs_rn", "hrs_rn_emp", "hrs_rn_ctr", "hrs_lpn", "hrs_lpn_emp", "hrs_lpn_ctr",
              "hrs_cna", "hrs_cna_emp", "hrs_cna_ctr", "hrs_rndon", "hrs_rnadmin",
              "hrs_lpnadmin", "hrs_natrn", "hrs_medaide"]
PROVIDER_ATTRS = ["provname", "city", "state", "county_name", "county_fips"]


def date_key(d: Column) -> Column:
    """yyyyMMdd as int, computed arithmetically (no string formatting)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def build_fact(silver: DataFrame) -> DataFrame:
    return silver.select(
        F.col("provnum").alias("provider_id"),
        date_key(F.col("work_date")).alias("date_key"),
        "state", "cy_qtr", "work_date",
        F.col("mdscensus").alias("patient_census"),
        *FACT_HOURS,
        "total_nursing_hours", "total_employed_hours", "total_contract_hours",
        "nursing_hppd", "contract_ratio", "processed_at",
    )


def build_dim_date(silver: DataFrame) -> DataFrame:
    d = F.col("work_date")
    dow = F.dayofweek(d)
    return (silver.select("work_date").where(d.isNotNull()).distinct()
            .select(date_key(d).alias("date_key"),
                    d.alias("full_date"),
                    F.year(d).alias("year"),
                    F.quarter(d).alias("quarter"),
                    F.month(d).alias("month"),
                    F.dayofmonth(d).alias("day"),
                    F.weekofyear(d).alias("week_of_year"),
                    dow.alias("day_of_week"),
                    F.date_format(d, "EEEE").alias("day_name"),
                    dow.isin(1, 7).alias("is_weekend"),
                    year_month(d).alias("year_month"),
                    F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string")).alias("year_quarter")))


def build_dim_provider(silver: DataFrame) -> DataFrame:
    """Distinct provider attribute tuples. A provider whose name/city changed has
    several rows (as upstream). ``provider_sk`` is a hash of the natural columns,
    so it is stable across runs and recomputations (no monotonically_increasing_id).
    64 bits: n tuples hold an equal pair with probability about n * n / 2**65 (1e-9 for 200,000)."""
    cols = ["provnum"] + PROVIDER_ATTRS
    dp = silver.select(*cols).distinct()
    # the hash skips nulls, so each value goes in with a mark of whether it is there
    marked = [F.concat(F.lit("="), F.col(c).cast("string")) for c in cols]
    return dp.select(
        F.xxhash64(*[F.coalesce(m, F.lit("-")) for m in marked]).alias("provider_sk"),
        F.col("provnum").alias("provider_id"),
        F.col("provname").alias("provider_name"),
        "city", "state", "county_name", "county_fips",
    )


def build_dim_provider_current(silver: DataFrame) -> DataFrame:
    """Latest attribute tuple per provider: one row per provider, safe to join on.
    Two tuples on the same latest date resolve to the greater tuple (attribute order).
    The window sees a provider's distinct tuples, not its days."""
    seen = silver.groupBy("provnum", *PROVIDER_ATTRS).agg(F.max("work_date").alias("_last"))
    newest = Window.partitionBy("provnum").orderBy(*[F.col(c).desc_nulls_last() for c in ["_last", *PROVIDER_ATTRS]])
    return (seen.withColumn("_r", F.row_number().over(newest)).where("_r = 1")
            .select(F.col("provnum").alias("provider_id"), F.col("provname").alias("provider_name"),
                    "city", "state", "county_name", "county_fips"))


def build_dim_state(silver: DataFrame) -> DataFrame:
    per = silver.groupBy("state", "provnum", "county_fips", "city").agg(
        *P.sums("mdscensus"), *P.sums("nursing_hppd", exact=False))
    agg = per.groupBy("state").agg(
        F.count_distinct("provnum").alias("provider_count"),
        F.count_distinct("county_fips").alias("county_count"),
        F.count_distinct("city").alias("city_count"),
        P.whole("mdscensus").alias("total_patient_days"),
        stable_round(P.mean("nursing_hppd"), 2).alias("avg_hppd"),
    )
    # One row per state: this window sorts a table bounded by the number of states.
    w = Window.orderBy("state")
    return agg.select(F.row_number().over(w).cast("bigint").alias("state_sk"), "*")


def build_agg_state_monthly_etl(silver: DataFrame) -> DataFrame:
    """State-month aggregate exactly as the ETL job codes it (no census filter)."""
    return silver.groupBy("state", F.year("work_date").alias("year"),
                          F.month("work_date").alias("month")).agg(
        F.count_distinct("provnum").alias("provider_count"),
        stable_round(F.avg("nursing_hppd"), 2).alias("avg_hppd"),
        stable_round(int_avg("mdscensus"), 1).alias("avg_census"),
        F.count(F.lit(1)).alias("record_count"),
    )


def build_agg_provider_monthly(silver: DataFrame) -> DataFrame:
    """Provider x month aggregate (19 columns). The facility name is the one
    in force on the provider's last reported day of the month (no join against the
    provider dimension): days are aggregated per name by hash, then the windows add up the
    few names of a provider's month and pick the newest."""
    hours = ["hrs_rn", "hrs_lpn", "hrs_cna"]
    totals = ["total_nursing_hours", "total_employed_hours", "total_contract_hours"]
    keys = ["provnum", "state", "year", "month"]
    days = silver.select("*", F.year("work_date").alias("year"), F.month("work_date").alias("month"))
    per = days.fillna(0.0, hours).groupBy(*keys, "provname").agg(
        F.max("work_date").alias("_last"), F.count(F.lit(1)).alias("_n"),
        *P.sums("mdscensus", *hours, *totals), *P.sums("nursing_hppd", "contract_ratio", exact=False),
        F.min("nursing_hppd").alias("_min"), F.max("nursing_hppd").alias("_max"))
    month = Window.partitionBy(*keys)
    newest = month.orderBy(F.col("_last").desc_nulls_last(), F.col("provname").desc_nulls_last())
    added = [c for c in per.columns if c.startswith(("_s_", "_n"))]
    out = per.select(*keys, "provname", F.row_number().over(newest).alias("_r"),
                     *[F.sum(c).over(month).alias(c) for c in added],
                     F.min("_min").over(month).alias("_min"), F.max("_max").over(month).alias("_max")).where("_r = 1")

    def mean(c: str) -> Column:
        return F.try_divide(F.col(f"_s_{c}").cast("double"), F.col(f"_n_{c}").cast("double"))

    return out.select(
        F.col("provnum").alias("provider_id"), F.col("provname").alias("provider_name"), "state", "year", "month",
        F.format_string("%04d-%02d", "year", "month").alias("year_month"),
        stable_round(mean("mdscensus"), 1).alias("avg_daily_census"),
        F.col("_s_mdscensus").cast("bigint").alias("total_patient_days"),
        *[F.col(f"_s_{h}").cast("double").alias(name) for h, name in zip(
            hours, ["total_rn_hours", "total_lpn_hours", "total_cna_hours"], strict=True)],
        *[F.col(f"_s_{t}").cast("double").alias(t) for t in totals],
        stable_round(mean("nursing_hppd"), 2).alias("avg_nursing_hppd"),
        stable_round("_min", 2).alias("min_nursing_hppd"),
        stable_round("_max", 2).alias("max_nursing_hppd"),
        stable_round(mean("contract_ratio"), 4).alias("avg_contract_ratio"),
        F.col("_n").alias("days_reported"),
    )


def build_agg_state_monthly(daily: DataFrame) -> DataFrame:
    """Wide state-month aggregate (18 columns) over the daily metric rows
    (``v_daily_metrics`` shape plus ``contract_ratio``, all days). Percentiles are exact and run over
    counts per distinct 2-place daily HPPD; sums and providers come from a provider-month aggregate."""
    keys = ["state", "year", "month"]
    hours, rates = ["total_nursing_hours", "hrs_rn", "hrs_lpn", "hrs_cna"], ["nursing_hppd", "rn_skill_mix_pct", "contract_staff_pct"]
    rows = daily.select("*", F.year("work_date").alias("year"), F.month("work_date").alias("month"))
    per = rows.groupBy(*keys, "provider_id").agg(
        *P.sums("patient_census", *hours, *rates), *P.sums("contract_ratio", exact=False), F.count(F.lit(1)).alias("_n"))
    out = P.with_quartiles(per.groupBy(*keys).agg(
        F.count("provider_id").alias("provider_count"),
        P.whole("patient_census").alias("total_patient_days"),
        stable_round(P.mean("patient_census"), 1).alias("avg_daily_census"),
        *[P.total(h).alias(name) for h, name in zip(
            hours, ["total_nursing_hours", "total_rn_hours", "total_lpn_hours", "total_cna_hours"], strict=True)],
        stable_round(P.mean("nursing_hppd"), 2).alias("avg_nursing_hppd"),
        stable_round(P.mean("rn_skill_mix_pct"), 2).alias("avg_rn_mix_pct"),
        stable_round(P.mean("contract_staff_pct"), 2).alias("avg_contract_pct"),
        stable_round(P.mean("contract_ratio"), 4).alias("avg_contract_ratio"),
        P.count("_n").alias("total_records"),
    ), rows, keys, "nursing_hppd").withColumnRenamed("_q", "q")
    return out.select(
        "state", "year", "month",
        F.format_string("%04d-%02d", "year", "month").alias("year_month"),
        "provider_count", "total_patient_days", "avg_daily_census", "total_nursing_hours",
        "total_rn_hours", "total_lpn_hours", "total_cna_hours", "avg_nursing_hppd",
        stable_round(F.col("q")[0], 2).alias("median_nursing_hppd"),
        stable_round(F.col("q")[1], 2).alias("p25_hppd"),
        stable_round(F.col("q")[2], 2).alias("p75_hppd"),
        "avg_rn_mix_pct", "avg_contract_pct", "avg_contract_ratio", "total_records",
    )


def build_agg_overall_metrics(silver: DataFrame, snapshot_date: str) -> DataFrame:
    """One row of coverage and volume figures; ``snapshot_date`` is the as-of date."""
    per = silver.groupBy("provnum", "state").agg(
        *P.sums("mdscensus", "total_nursing_hours", "total_contract_hours"), *P.sums("nursing_hppd", exact=False),
        F.min("work_date").alias("_first"), F.max("work_date").alias("_last"), F.count(F.lit(1)).alias("_n"))
    row = per.agg(
        F.count_distinct("provnum").alias("total_providers"),
        F.count_distinct("state").alias("total_states"),
        P.whole("mdscensus").alias("total_patient_days"),
        P.total("total_nursing_hours").alias("_hours"),
        stable_round(P.mean("nursing_hppd"), 2).alias("overall_avg_hppd"),
        P.total("total_contract_hours").alias("_ctr"),
        F.min("_first").alias("data_start_date"),
        F.max("_last").alias("data_end_date"),
        P.count("_n").alias("total_records"),
    )
    return row.select(
        "total_providers", "total_states", "total_patient_days",
        F.col("_hours").alias("total_nursing_hours"),
        "overall_avg_hppd",
        stable_round(F.try_divide(F.col("_ctr"), F.col("_hours")), 4)
        .alias("overall_contract_ratio"),
        "data_start_date", "data_end_date",
        (F.datediff("data_end_date", "data_start_date") + 1).cast("bigint").alias("total_days"),
        "total_records",
        F.lit(snapshot_date).cast("date").alias("snapshot_date"),
    )
