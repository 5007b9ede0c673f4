"""Independent DuckDB SQL for every registered query.

The oracle derives the same facility-day panel straight from the driver
views (typed, no string round trip) and re-states each layer and view as a
CTE. ``query_sql(name)`` returns one self-contained statement: the CTEs the
body needs (in dependency order) followed by the body.
"""

from __future__ import annotations

import re

from .. import config as C
from ..sources import panel as P


# -- SQL helpers mirroring shiftlens.functions.rounding ----------------------

def R(x: str, n: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,10)), {n}) AS DOUBLE)"


def XSUM(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(20,6))) AS DOUBLE)"


def XAVG(x: str) -> str:
    return f"(CAST(sum(CAST({x} AS DECIMAL(20,6))) AS DOUBLE) / CAST(NULLIF(count({x}), 0) AS DOUBLE))"


def IAVG(x: str) -> str:
    return f"(CAST(sum({x}) AS DOUBLE) / CAST(NULLIF(count({x}), 0) AS DOUBLE))"


def PCT(cond: str) -> str:
    return f"(CAST(100 AS DOUBLE) * CAST(count_if({cond}) AS DOUBLE) / CAST(count(*) AS DOUBLE))"


def D(x: float) -> str:
    return f"CAST({x} AS DOUBLE)"


def ISUM(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


def _hours_cols() -> str:
    out = []
    for role in C.RAW_HOUR_ROLES:
        r = role.lower()
        if r in ("rn", "lpn", "cna"):
            total = f"s_{r} / k"
            if r == "rn":
                total = f"CASE WHEN (sk + dd) % {P.RN_NULL_MOD} = 0 THEN NULL ELSE s_rn / k END"
            out += [f"CAST({total} AS DOUBLE) AS hrs_{r}",
                    f"CAST((s_{r} - c_{r}) / k AS DOUBLE) AS hrs_{r}_emp",
                    f"CAST(c_{r} / k AS DOUBLE) AS hrs_{r}_ctr"]
        else:
            v = {
                "rndon": "CASE WHEN dayofweek(work_date) BETWEEN 1 AND 5 THEN 8.0 ELSE 0.0 END",
                "rnadmin": "CASE WHEN sk % 2 = 0 THEN 8.0 ELSE 0.0 END",
                "lpnadmin": "CASE WHEN sk % 3 = 0 THEN 4.0 ELSE 0.0 END",
                "natrn": "0.0",
                "medaide": "2.0",
            }[r]
            out += [f"CAST({v} AS DOUBLE) AS hrs_{r}", f"CAST({v} AS DOUBLE) AS hrs_{r}_emp",
                    f"CAST(0.0 AS DOUBLE) AS hrs_{r}_ctr"]
    return ",\n       ".join(out)


def _nz(c: str) -> str:
    return f"COALESCE({c}, 0.0)"


CTES: dict[str, str] = {}

CTES["li_units"] = f"""
SELECT sk, dd, q, c,
       q * (20 + 5 * d) * (70 + 10 * (sk % 7)) AS u_rn,
       q * (30 + 10 * t) * (70 + 10 * (sk % 7)) AS u_lpn,
       q * (100 + 25 * d) * (70 + 10 * (sk % 7)) AS u_cna
FROM (
  SELECT l_suppkey AS sk,
         CAST(floor(l_quantity) AS BIGINT) AS q,
         CAST(round(l_discount * 100) AS BIGINT) AS d,
         CAST(round(l_tax * 100) AS BIGINT) AS t,
         ((date_diff('day', DATE '{P.DAY_ZERO}', CAST(l_shipdate AS DATE)) % {P.DAYS_IN_QUARTER})
           + {P.DAYS_IN_QUARTER}) % {P.DAYS_IN_QUARTER} AS dd,
         CAST(CASE WHEN l_suppkey % 3 = 0 THEN 0 WHEN l_returnflag = 'R' THEN 1
                   WHEN l_suppkey % 5 = 0 AND l_returnflag = 'A' THEN 1 ELSE 0 END AS BIGINT) AS c
  FROM lineitem) x
"""

CTES["per_day"] = """
SELECT sk, dd, CAST(sum(q) AS BIGINT) AS sq,
       CAST(sum(u_rn) AS BIGINT) AS s_rn, CAST(sum(u_rn * c) AS BIGINT) AS c_rn,
       CAST(sum(u_lpn) AS BIGINT) AS s_lpn, CAST(sum(u_lpn * c) AS BIGINT) AS c_lpn,
       CAST(sum(u_cna) AS BIGINT) AS s_cna, CAST(sum(u_cna * c) AS BIGINT) AS c_cna
FROM li_units GROUP BY sk, dd
"""

CTES["panel"] = f"""
SELECT lpad(CAST(sk AS VARCHAR), 6, '0') AS provnum,
       s_name || CASE WHEN sk % {P.NAME_CHANGE_MOD} = 0 AND dd >= {P.NAME_CHANGE_DAY}
                      THEN '{P.NAME_SUFFIX}' ELSE '' END AS provname,
       'CITY_' || CAST(sk % 10 AS VARCHAR) AS city,
       n_name AS state,
       r_name AS county_name,
       CAST(n_nationkey * 10 + sk % 4 AS VARCHAR) AS county_fips,
       '{P.PANEL_QUARTER}' AS cy_qtr,
       work_date,
       CAST(CASE WHEN (sk + dd) % {P.CENSUS_NULL_MOD} = 0 THEN NULL
                 WHEN (sk + dd) % {P.CENSUS_ZERO_MOD} = 0 THEN 0
                 WHEN sk % {P.SMALL_FACILITY_MOD} = {P.SMALL_FACILITY_REM} THEN sq // 10
                 ELSE sq END AS INTEGER) AS mdscensus,
       {_hours_cols()}
FROM (
  SELECT pd.*, s_name, n_name, n_nationkey, r_name,
         CAST(DATE '{P.QUARTER_START}' + CAST(dd AS INTEGER) AS DATE) AS work_date,
         CASE WHEN sk % {P.SMALL_FACILITY_MOD} = {P.SMALL_FACILITY_REM}
              THEN {P.SMALL_DIVISOR} ELSE {P.LARGE_DIVISOR} END AS k
  FROM per_day pd
  JOIN supplier ON s_suppkey = sk
  JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey) y
"""

_TOTAL = " + ".join(_nz(f"hrs_{r}") for r in C.DIRECT_CARE_ROLES)
_EMP = " + ".join(_nz(f"hrs_{r}_emp") for r in C.DIRECT_CARE_ROLES)
_CTR = " + ".join(_nz(f"hrs_{r}_ctr") for r in C.DIRECT_CARE_ROLES)

CTES["silver"] = f"""
SELECT *,
       CAST(year(work_date) AS INTEGER) AS work_year,
       CAST(month(work_date) AS INTEGER) AS work_month,
       CAST(dayofweek(work_date) + 1 AS INTEGER) AS work_day_of_week,
       CASE WHEN mdscensus > 0 THEN total_nursing_hours / mdscensus END AS nursing_hppd,
       CASE WHEN total_nursing_hours <> 0 THEN total_contract_hours / total_nursing_hours END AS contract_ratio
FROM (SELECT *, {_TOTAL} AS total_nursing_hours, {_EMP} AS total_employed_hours,
             {_CTR} AS total_contract_hours FROM panel) s
"""

FACT_HOURS = ["hrs_rn", "hrs_rn_emp", "hrs_rn_ctr", "hrs_lpn", "hrs_lpn_emp", "hrs_lpn_ctr",
              "hrs_cna", "hrs_cna_emp", "hrs_cna_ctr", "hrs_rndon", "hrs_rnadmin",
              "hrs_lpnadmin", "hrs_natrn", "hrs_medaide"]

DATE_KEY = "CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"

CTES["facts"] = f"""
SELECT provnum AS provider_id, {DATE_KEY.format(d='work_date')} AS date_key, state, cy_qtr, work_date,
       mdscensus AS patient_census, {", ".join(FACT_HOURS)},
       total_nursing_hours, total_employed_hours, total_contract_hours, nursing_hppd, contract_ratio
FROM silver
"""


def _per_census(hours: str) -> str:
    return f"CASE WHEN patient_census > 0 THEN {R(R(hours, 2) + ' / patient_census', 2)} END"


def _share(part: str) -> str:
    return (f"CASE WHEN total_nursing_hours > 0 THEN "
            f"{R(R(part, 4) + ' / total_nursing_hours * ' + D(100), 2)} ELSE {D(0)} END")


_RATIO = "total_nursing_hours / NULLIF(patient_census, 0)"

CTES["v_daily_metrics"] = f"""
SELECT provider_id, state, cy_qtr, work_date, patient_census,
       {", ".join(f"{_nz(h)} AS {h}" for h in ["hrs_rn", "hrs_lpn", "hrs_cna", "hrs_rn_emp", "hrs_lpn_emp", "hrs_cna_emp", "hrs_rn_ctr", "hrs_lpn_ctr", "hrs_cna_ctr"])},
       {_nz("total_nursing_hours")} AS total_nursing_hours,
       {_per_census("total_nursing_hours")} AS nursing_hppd,
       {_per_census(_nz("hrs_rn"))} AS rn_hppd,
       {_share(_CTR)} AS contract_staff_pct,
       {_share(_nz("hrs_rn"))} AS rn_skill_mix_pct,
       {_share(_nz("hrs_cna"))} AS cna_ratio_pct,
       CASE WHEN patient_census = 0 THEN '{C.CATEGORY_NO_CENSUS}'
            WHEN {_RATIO} >= {D(C.HPPD_BENCHMARK)} THEN '{C.CATEGORY_MEETS}'
            WHEN {_RATIO} >= {D(C.HPPD_NEAR)} THEN '{C.CATEGORY_NEAR}'
            WHEN {_RATIO} >= {D(C.HPPD_BELOW)} THEN '{C.CATEGORY_BELOW}'
            ELSE '{C.CATEGORY_CRITICAL}' END AS staffing_level_category
FROM facts
"""

CTES["daily_c"] = "SELECT * FROM v_daily_metrics WHERE patient_census > 0"

_CAT = "staffing_level_category"

CTES["v_kpi_summary"] = f"""
SELECT count(DISTINCT provider_id) AS total_providers,
       count(DISTINCT state) AS total_states,
       min(work_date) AS data_start_date,
       max(work_date) AS data_end_date,
       count(DISTINCT work_date) AS total_days,
       count(*) AS total_records,
       {ISUM("patient_census")} AS total_patient_days,
       {R(IAVG("patient_census"), 1)} AS avg_daily_census,
       {R(XSUM("total_nursing_hours"), 0)} AS total_nursing_hours,
       {R(XSUM("hrs_rn"), 0)} AS total_rn_hours,
       {R(XSUM("hrs_lpn"), 0)} AS total_lpn_hours,
       {R(XSUM("hrs_cna"), 0)} AS total_cna_hours,
       {R(XAVG("nursing_hppd"), 2)} AS overall_avg_hppd,
       {R(XAVG("rn_skill_mix_pct"), 1)} AS overall_rn_mix_pct,
       {R(XAVG("contract_staff_pct"), 1)} AS overall_contract_pct,
       {R(PCT(f"{_CAT} = '{C.CATEGORY_MEETS}'"), 1)} AS pct_meeting_benchmark,
       {R(PCT(f"{_CAT} = '{C.CATEGORY_CRITICAL}'"), 1)} AS pct_critical_understaffing
FROM daily_c
"""


_MONTH_TS = "CAST(date_trunc('month', work_date) AS TIMESTAMP)"
_YM = "strftime(work_date, '%Y-%m')"
_IS = lambda cat: f"{_CAT} = '{cat}'"

CTES["v_provider_monthly"] = f"""
SELECT provider_id, state, {_MONTH_TS} AS month_date, {_YM} AS year_month,
       count(*) AS days_reported,
       {R(IAVG("patient_census"), 1)} AS avg_daily_census,
       {ISUM("patient_census")} AS total_patient_days,
       {XSUM("total_nursing_hours")} AS total_nursing_hours,
       {XSUM("hrs_rn")} AS total_rn_hours,
       {XSUM("hrs_lpn")} AS total_lpn_hours,
       {XSUM("hrs_cna")} AS total_cna_hours,
       {R(XAVG("nursing_hppd"), 2)} AS avg_hppd,
       {R("min(nursing_hppd)", 2)} AS min_hppd,
       {R("max(nursing_hppd)", 2)} AS max_hppd,
       {R("stddev_samp(nursing_hppd)", 2)} AS stddev_hppd,
       {R(XAVG("rn_skill_mix_pct"), 2)} AS avg_rn_mix_pct,
       {R(XAVG("contract_staff_pct"), 2)} AS avg_contract_pct,
       CAST(count_if({_IS(C.CATEGORY_CRITICAL)}) AS BIGINT) AS critical_days,
       CAST(count_if({_IS(C.CATEGORY_MEETS)}) AS BIGINT) AS benchmark_met_days
FROM daily_c
GROUP BY provider_id, state, {_MONTH_TS}, {_YM}
"""

CTES["v_state_monthly"] = f"""
SELECT state, {_MONTH_TS} AS month_date, {_YM} AS year_month,
       count(DISTINCT provider_id) AS provider_count,
       {ISUM("patient_census")} AS total_patient_days,
       {R(IAVG("patient_census"), 1)} AS avg_daily_census,
       {XSUM("total_nursing_hours")} AS total_nursing_hours,
       {XSUM("hrs_rn")} AS total_rn_hours,
       {XSUM("hrs_lpn")} AS total_lpn_hours,
       {XSUM("hrs_cna")} AS total_cna_hours,
       {R(XAVG("nursing_hppd"), 2)} AS avg_hppd,
       {R("quantile_cont(nursing_hppd, 0.5)", 2)} AS median_hppd,
       {R("quantile_cont(nursing_hppd, 0.25)", 2)} AS p25_hppd,
       {R("quantile_cont(nursing_hppd, 0.75)", 2)} AS p75_hppd,
       {R(XAVG("rn_skill_mix_pct"), 2)} AS avg_rn_mix_pct,
       {R(XAVG("contract_staff_pct"), 2)} AS avg_contract_pct,
       {R(PCT(_IS(C.CATEGORY_MEETS)), 1)} AS pct_meeting_benchmark,
       {R(PCT(_IS(C.CATEGORY_CRITICAL)), 1)} AS pct_critical
FROM daily_c
GROUP BY state, {_MONTH_TS}, {_YM}
"""

_RANKED = ("provider_id, state, days_reported, avg_daily_census, avg_hppd, avg_rn_mix_pct, "
           "avg_contract_pct, critical_days")

CTES["v_provider_rankings"] = f"""
SELECT {_RANKED},
       CAST(RANK() OVER (PARTITION BY state ORDER BY avg_hppd DESC NULLS LAST) AS BIGINT) AS state_rank_hppd,
       CAST(RANK() OVER (PARTITION BY state ORDER BY avg_rn_mix_pct DESC NULLS LAST) AS BIGINT) AS state_rank_rn_mix,
       CAST(RANK() OVER (PARTITION BY state ORDER BY avg_contract_pct ASC NULLS LAST) AS BIGINT) AS state_rank_stability,
       CAST(RANK() OVER (ORDER BY avg_hppd DESC NULLS LAST) AS BIGINT) AS national_rank_hppd,
       {R("PERCENT_RANK() OVER (ORDER BY avg_hppd ASC NULLS LAST) * " + D(100), 1)} AS hppd_percentile
FROM v_provider_monthly
WHERE days_reported >= {C.MIN_DAYS_RANKED}
"""

_LEVEL = f"""CASE WHEN avg_hppd < {D(C.ALERT_HIGH_HPPD)} AND avg_daily_census > {C.ALERT_MIN_CENSUS} THEN '{C.ALERT_LEVEL_HIGH}'
            WHEN avg_hppd < {D(C.ALERT_MEDIUM_HPPD)} AND avg_daily_census > {C.ALERT_MIN_CENSUS} THEN '{C.ALERT_LEVEL_BELOW_MIN}'
            WHEN avg_contract_pct > {C.ALERT_CONTRACT_HIGH} THEN '{C.ALERT_LEVEL_CONTRACT}'
            WHEN critical_days > {C.ALERT_CRITICAL_DAYS} THEN '{C.ALERT_LEVEL_FREQUENT}'
            ELSE '{C.ALERT_LEVEL_LOW}' END"""

CTES["v_staffing_alerts"] = f"""
SELECT provider_id, state, year_month, avg_daily_census, avg_hppd, avg_rn_mix_pct, avg_contract_pct,
       critical_days, days_reported,
       {_LEVEL} AS alert_level,
       CASE WHEN avg_hppd < {D(C.ALERT_HIGH_HPPD)} THEN '{C.HPPD_ALERT_BELOW_25}'
            WHEN avg_hppd < {D(C.ALERT_MEDIUM_HPPD)} THEN '{C.HPPD_ALERT_BELOW_30}' ELSE '' END AS hppd_alert,
       CASE WHEN avg_contract_pct > {C.ALERT_CONTRACT_HIGH} THEN '{C.CONTRACT_ALERT_50}'
            WHEN avg_contract_pct > {C.ALERT_CONTRACT_WATCH} THEN '{C.CONTRACT_ALERT_30}' ELSE '' END AS contract_alert,
       split_part({_LEVEL}, ' - ', 1) AS alert_severity
FROM v_provider_monthly
WHERE avg_hppd < {D(C.ALERT_CANDIDATE_HPPD)} OR avg_contract_pct > {C.ALERT_CANDIDATE_CONTRACT}
   OR critical_days > {C.ALERT_CANDIDATE_CRITICAL_DAYS}
"""

_DAYNAME = "CASE " + " ".join(f"WHEN dow = {i} THEN '{n}'" for i, n in enumerate(C.DAY_NAMES)) + " END"

CTES["v_day_of_week_analysis"] = f"""
SELECT state, dow AS day_of_week, {_DAYNAME} AS day_name,
       CASE WHEN dow IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       count(*) AS record_count,
       {R(XAVG("nursing_hppd"), 2)} AS avg_hppd,
       {R(XAVG("rn_skill_mix_pct"), 2)} AS avg_rn_mix_pct,
       {R(XAVG("contract_staff_pct"), 2)} AS avg_contract_pct
FROM (SELECT *, CAST(dayofweek(work_date) AS BIGINT) AS dow FROM daily_c) x
GROUP BY state, dow
"""

CTES["state_monthly_weighted"] = f"""
SELECT state, {_YM} AS year_month,
       {XSUM("total_nursing_hours")} AS total_nursing_hours,
       {ISUM("patient_census")} AS total_patient_days,
       {R(XSUM("total_nursing_hours") + " / " + ISUM("patient_census"), 2)} AS weighted_hppd,
       {R(XAVG("nursing_hppd"), 2)} AS avg_hppd
FROM daily_c GROUP BY state, {_YM}
"""

CTES["rn_benchmark"] = f"""
SELECT state, count(*) AS record_count,
       {R(XAVG("rn_hppd"), 2)} AS avg_rn_hppd,
       {R(PCT(f"rn_hppd >= {D(C.RN_HPPD_BENCHMARK)}"), 1)} AS pct_meeting_rn_benchmark
FROM daily_c GROUP BY state
"""


def _bands_sql(value: str, lo: float, hi: float, labels: list[str]) -> str:
    label = (f"CASE WHEN {value} < {lo} THEN '{labels[0]}' WHEN {value} <= {hi} THEN '{labels[1]}' "
             f"ELSE '{labels[2]}' END")
    order = f"CAST(CASE WHEN {value} < {lo} THEN 1 WHEN {value} <= {hi} THEN 2 ELSE 3 END AS BIGINT)"
    return f"""
SELECT band, band_order, record_count,
       {R(D(100) + " * record_count / sum(record_count) OVER ()", 1)} AS pct_records
FROM (SELECT {label} AS band, {order} AS band_order, count(*) AS record_count
      FROM daily_c GROUP BY 1, 2) b
"""


CTES["contract_bands"] = _bands_sql("contract_staff_pct", C.CONTRACT_TYPICAL_MAX, C.CONTRACT_HIGH_MIN,
                                    ["Typical (<15%)", "Elevated (15-30%)", "High Reliance (>30%)"])
CTES["skill_mix_bands"] = _bands_sql("rn_skill_mix_pct", C.RN_MIX_TYPICAL_MIN, C.RN_MIX_TYPICAL_MAX,
                                     ["Below Typical (<15%)", "Typical (15-25%)", "Above Typical (>25%)"])

# -- gold tables ---------------------------------------------------------------

_INT = lambda e: f"CAST({e} AS INTEGER)"

CTES["dim_date"] = f"""
SELECT {DATE_KEY.format(d='d')} AS date_key, d AS full_date,
       {_INT("year(d)")} AS year, {_INT("quarter(d)")} AS quarter, {_INT("month(d)")} AS month,
       {_INT("day(d)")} AS day, {_INT("weekofyear(d)")} AS week_of_year,
       {_INT("dayofweek(d) + 1")} AS day_of_week, dayname(d) AS day_name,
       dayofweek(d) IN (0, 6) AS is_weekend, strftime(d, '%Y-%m') AS year_month,
       CAST(year(d) AS VARCHAR) || 'Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter
FROM (SELECT DISTINCT work_date AS d FROM silver WHERE work_date IS NOT NULL) x
"""

CTES["dim_provider"] = """
SELECT DISTINCT provnum AS provider_id, provname AS provider_name, city, state, county_name, county_fips
FROM silver
"""

CTES["dim_provider_current"] = """
SELECT provider_id, provider_name, city, state, county_name, county_fips
FROM (SELECT provnum AS provider_id, provname AS provider_name, city, state, county_name, county_fips,
             ROW_NUMBER() OVER (PARTITION BY provnum ORDER BY work_date DESC, provname DESC, city DESC,
                                state DESC, county_name DESC, county_fips DESC) AS rn
      FROM silver) x
WHERE rn = 1
"""

CTES["provider_day"] = """
SELECT provnum, work_date, provname, city, state, county_name, county_fips,
       lag({'n': provname, 'c': city, 's': state, 'y': county_name, 'f': county_fips}) OVER (PARTITION BY provnum ORDER BY work_date) AS before
FROM (SELECT DISTINCT ON (provnum, work_date) * FROM silver
      ORDER BY provnum, work_date, provname DESC, city DESC, state DESC, county_name DESC, county_fips DESC) x
"""

CTES["dim_provider_history"] = """
SELECT provnum AS provider_id, provname AS provider_name, city, state, county_name, county_fips, work_date AS valid_from,
       CAST(next - 1 AS DATE) AS valid_to, next IS NULL AS is_current, last_reported
FROM (SELECT *, lead(work_date) OVER (PARTITION BY provnum ORDER BY work_date) AS next
      FROM provider_day
      WHERE before IS NULL OR before <> {'n': provname, 'c': city, 's': state, 'y': county_name, 'f': county_fips}) c
JOIN (SELECT provnum, max(work_date) AS last_reported FROM silver GROUP BY provnum) l USING (provnum)
"""

CTES["provider_asof_monthly"] = """
SELECT pm.provider_id, h.provider_name, h.city, h.state, pm.year_month, pm.state AS reported_state, pm.avg_nursing_hppd,
       pm.avg_daily_census, pm.total_nursing_hours, pm.avg_contract_ratio, pm.days_reported
FROM agg_provider_monthly pm LEFT JOIN dim_provider_history h ON h.provider_id = pm.provider_id
  AND last_day(make_date(pm.year, pm.month, 1)) BETWEEN h.valid_from AND coalesce(h.valid_to, DATE '9999-12-31')
"""

CTES["dim_state"] = f"""
SELECT ROW_NUMBER() OVER (ORDER BY state) AS state_sk, *
FROM (SELECT state, count(DISTINCT provnum) AS provider_count, count(DISTINCT county_fips) AS county_count,
             count(DISTINCT city) AS city_count, {ISUM("mdscensus")} AS total_patient_days,
             {R("avg(nursing_hppd)", 2)} AS avg_hppd
      FROM silver GROUP BY state) s
"""

CTES["agg_state_monthly_etl"] = f"""
SELECT state, {_INT("year(work_date)")} AS year, {_INT("month(work_date)")} AS month,
       count(DISTINCT provnum) AS provider_count,
       {R("avg(nursing_hppd)", 2)} AS avg_hppd,
       {R(IAVG("mdscensus"), 1)} AS avg_census,
       count(*) AS record_count
FROM silver GROUP BY 1, 2, 3
"""

CTES["agg_provider_monthly"] = f"""
SELECT provnum AS provider_id, max_by(provname, (work_date, provname)) AS provider_name, state,
       {_INT("year(work_date)")} AS year, {_INT("month(work_date)")} AS month,
       strftime(work_date, '%Y-%m') AS year_month,
       {R(IAVG("mdscensus"), 1)} AS avg_daily_census,
       {ISUM("mdscensus")} AS total_patient_days,
       {XSUM("COALESCE(hrs_rn, 0.0)")} AS total_rn_hours,
       {XSUM("COALESCE(hrs_lpn, 0.0)")} AS total_lpn_hours,
       {XSUM("COALESCE(hrs_cna, 0.0)")} AS total_cna_hours,
       {XSUM("total_nursing_hours")} AS total_nursing_hours,
       {XSUM("total_employed_hours")} AS total_employed_hours,
       {XSUM("total_contract_hours")} AS total_contract_hours,
       {R("avg(nursing_hppd)", 2)} AS avg_nursing_hppd,
       {R("min(nursing_hppd)", 2)} AS min_nursing_hppd,
       {R("max(nursing_hppd)", 2)} AS max_nursing_hppd,
       {R("avg(contract_ratio)", 4)} AS avg_contract_ratio,
       count(*) AS days_reported
FROM silver GROUP BY provnum, state, year(work_date), month(work_date), strftime(work_date, '%Y-%m')
"""

CTES["daily_x"] = "SELECT d.*, f.contract_ratio FROM v_daily_metrics d JOIN facts f USING (provider_id, work_date)"

CTES["agg_state_monthly"] = f"""
SELECT state, {_INT("year(work_date)")} AS year, {_INT("month(work_date)")} AS month,
       strftime(work_date, '%Y-%m') AS year_month,
       count(DISTINCT provider_id) AS provider_count,
       {ISUM("patient_census")} AS total_patient_days,
       {R(IAVG("patient_census"), 1)} AS avg_daily_census,
       {XSUM("total_nursing_hours")} AS total_nursing_hours,
       {XSUM("hrs_rn")} AS total_rn_hours,
       {XSUM("hrs_lpn")} AS total_lpn_hours,
       {XSUM("hrs_cna")} AS total_cna_hours,
       {R(XAVG("nursing_hppd"), 2)} AS avg_nursing_hppd,
       {R("quantile_cont(nursing_hppd, 0.5)", 2)} AS median_nursing_hppd,
       {R("quantile_cont(nursing_hppd, 0.25)", 2)} AS p25_hppd,
       {R("quantile_cont(nursing_hppd, 0.75)", 2)} AS p75_hppd,
       {R(XAVG("rn_skill_mix_pct"), 2)} AS avg_rn_mix_pct,
       {R(XAVG("contract_staff_pct"), 2)} AS avg_contract_pct,
       {R("avg(contract_ratio)", 4)} AS avg_contract_ratio,
       count(*) AS total_records
FROM daily_x GROUP BY 1, 2, 3, 4
"""

CTES["agg_overall_metrics"] = f"""
SELECT count(DISTINCT provnum) AS total_providers, count(DISTINCT state) AS total_states,
       {ISUM("mdscensus")} AS total_patient_days,
       {XSUM("total_nursing_hours")} AS total_nursing_hours,
       {R("avg(nursing_hppd)", 2)} AS overall_avg_hppd,
       {R(XSUM("total_contract_hours") + " / " + XSUM("total_nursing_hours"), 4)} AS overall_contract_ratio,
       min(work_date) AS data_start_date, max(work_date) AS data_end_date,
       CAST(date_diff('day', min(work_date), max(work_date)) + 1 AS BIGINT) AS total_days,
       count(*) AS total_records,
       DATE '{C.DEFAULT_SNAPSHOT_DATE}' AS snapshot_date
FROM silver
"""

# -- warehouse / dashboard -------------------------------------------------------

CTES["v_daily_staffing"] = """
SELECT provider_id, date_key, state, cy_qtr, work_date, patient_census, hrs_rn, hrs_lpn, hrs_cna,
       total_nursing_hours, nursing_hppd, contract_ratio, total_employed_hours, total_contract_hours
FROM facts
"""

CTES["mv_staffing_summary"] = f"""
SELECT f.state, d.year, d.month, d.year_month,
       count(DISTINCT f.provider_id) AS provider_count,
       {ISUM("f.patient_census")} AS total_patient_days,
       {IAVG("f.patient_census")} AS avg_daily_census,
       {XSUM("f.total_nursing_hours")} AS total_nursing_hours,
       {R("avg(f.nursing_hppd)", 6)} AS avg_nursing_hppd,
       {R("avg(f.contract_ratio)", 6)} AS avg_contract_ratio,
       {XSUM("f.hrs_rn")} AS total_rn_hours,
       {XSUM("f.hrs_lpn")} AS total_lpn_hours,
       {XSUM("f.hrs_cna")} AS total_cna_hours,
       count(*) AS record_count
FROM facts f JOIN dim_date d ON f.date_key = d.date_key
GROUP BY f.state, d.year, d.month, d.year_month
"""

CTES["provider_join"] = """
SELECT p.provider_id, p.provider_name, p.city, p.state, pm.year_month, pm.avg_nursing_hppd,
       pm.avg_daily_census, pm.total_nursing_hours, pm.avg_contract_ratio, pm.days_reported
FROM dim_provider p JOIN agg_provider_monthly pm ON p.provider_id = pm.provider_id
"""

CTES["provider_join_current"] = """
SELECT p.provider_id, p.provider_name, p.city, p.state, pm.year_month, pm.avg_nursing_hppd,
       pm.avg_daily_census, pm.total_nursing_hours, pm.avg_contract_ratio, pm.days_reported
FROM dim_provider_current p JOIN agg_provider_monthly pm ON p.provider_id = pm.provider_id
"""

CTES["mv_provider_rankings_current"] = """
SELECT *,
       CAST(RANK() OVER (PARTITION BY state, year_month ORDER BY avg_nursing_hppd DESC NULLS LAST) AS BIGINT) AS state_rank_hppd,
       CAST(RANK() OVER (PARTITION BY year_month ORDER BY avg_nursing_hppd DESC NULLS LAST) AS BIGINT) AS national_rank_hppd
FROM provider_join_current
"""

CTES["mv_provider_rankings"] = """
SELECT *,
       CAST(RANK() OVER (PARTITION BY state, year_month ORDER BY avg_nursing_hppd DESC NULLS LAST) AS BIGINT) AS state_rank_hppd,
       CAST(RANK() OVER (PARTITION BY year_month ORDER BY avg_nursing_hppd DESC NULLS LAST) AS BIGINT) AS national_rank_hppd
FROM provider_join
"""

CTES["alerts_top"] = """
SELECT * FROM v_staffing_alerts
ORDER BY CASE alert_severity WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END,
         avg_hppd ASC NULLS LAST, provider_id, year_month, state
LIMIT 100
"""

CTES["provider_details"] = """
SELECT * FROM v_provider_monthly
ORDER BY avg_hppd DESC NULLS LAST, provider_id, year_month, state LIMIT 200
"""

CTES["provider_details_state"] = """
SELECT * FROM v_provider_monthly WHERE state = (SELECT min(state) FROM v_provider_monthly)
ORDER BY avg_hppd DESC NULLS LAST, provider_id, year_month, state LIMIT 200
"""

CTES["v_state_monthly_first5"] = """
SELECT * FROM v_state_monthly
WHERE state IN (SELECT DISTINCT state FROM v_state_monthly ORDER BY state LIMIT 5)
"""

_HBIN = "CASE " + " ".join(
    f"WHEN nursing_hppd < {D(e)} THEN '{C.HPPD_BIN_LABELS[i]}'" for i, e in enumerate(C.HPPD_BIN_EDGES)
) + f" ELSE '{C.HPPD_BIN_LABELS[-1]}' END"
_HORD = "CAST(CASE " + " ".join(
    f"WHEN nursing_hppd < {D(e)} THEN {i + 1}" for i, e in enumerate(C.HPPD_BIN_EDGES)
) + f" ELSE {len(C.HPPD_BIN_LABELS)} END AS BIGINT)"

# Bodies of registered queries (each may reference any CTE above).
QUERIES: dict[str, str] = {
    "v_daily_metrics": "SELECT * FROM v_daily_metrics",
    "v_kpi_summary": "SELECT * FROM v_kpi_summary",
    "v_provider_monthly": "SELECT * FROM v_provider_monthly",
    "v_state_monthly": "SELECT * FROM v_state_monthly",
    "v_provider_rankings": "SELECT * FROM v_provider_rankings",
    "v_staffing_alerts": "SELECT * FROM v_staffing_alerts",
    "v_day_of_week_analysis": "SELECT * FROM v_day_of_week_analysis",
    "state_monthly_weighted": "SELECT * FROM state_monthly_weighted",
    "rn_benchmark": "SELECT * FROM rn_benchmark",
    "contract_bands": "SELECT * FROM contract_bands",
    "skill_mix_bands": "SELECT * FROM skill_mix_bands",
    "silver_typed": "SELECT provnum, provname, city, state, county_name, county_fips, cy_qtr, work_date, "
                    "mdscensus, " + ", ".join(C.hour_columns()) + " FROM silver",
    "silver_metrics": "SELECT provnum, work_date, total_nursing_hours, nursing_hppd FROM silver",
    "silver_contract": "SELECT provnum, work_date, total_employed_hours, total_contract_hours, contract_ratio FROM silver",
    "silver_calendar": "SELECT provnum, work_date, work_year, work_month, work_day_of_week FROM silver",
    "fact_daily_staffing": "SELECT * FROM facts",
    "dim_date": "SELECT * FROM dim_date",
    "dim_provider": "SELECT * FROM dim_provider",
    "dim_provider_current": "SELECT * FROM dim_provider_current",
    "dim_state": "SELECT * FROM dim_state",
    "agg_state_monthly_etl": "SELECT * FROM agg_state_monthly_etl",
    "agg_provider_monthly": "SELECT * FROM agg_provider_monthly",
    "agg_state_monthly": "SELECT * FROM agg_state_monthly",
    "agg_overall_metrics": "SELECT * FROM agg_overall_metrics",
    "v_daily_staffing": "SELECT * FROM v_daily_staffing",
    "v_provider": "SELECT * FROM dim_provider",
    "v_provider_monthly_agg": "SELECT provider_id, provider_name, state, year, month, year_month, avg_daily_census, "
                              "total_nursing_hours, avg_nursing_hppd, avg_contract_ratio, days_reported "
                              "FROM agg_provider_monthly",
    "v_state_monthly_agg": "SELECT state, year, month, year_month, provider_count, total_patient_days, "
                           "total_nursing_hours, avg_nursing_hppd, median_nursing_hppd, avg_contract_ratio, "
                           "total_records FROM agg_state_monthly",
    "mv_staffing_summary": "SELECT * FROM mv_staffing_summary",
    "mv_provider_rankings": "SELECT * FROM mv_provider_rankings",
    "kpi_overall": f"""SELECT count(DISTINCT provider_id) AS total_providers, count(DISTINCT state) AS total_states,
       {ISUM("patient_census")} AS total_patient_days, {XSUM("total_nursing_hours")} AS total_nursing_hours,
       {R("avg(nursing_hppd)", 6)} AS avg_hppd, {R("avg(contract_ratio) * " + D(100), 6)} AS avg_contract_pct
FROM v_daily_staffing""",
    "state_comparison": f"""SELECT state, count(DISTINCT provider_id) AS providers,
       {R("avg(nursing_hppd)", 6)} AS avg_hppd, {R("avg(contract_ratio) * " + D(100), 6)} AS contract_pct,
       {XSUM("total_nursing_hours")} AS total_hours
FROM v_daily_staffing GROUP BY state""",
    "monthly_trend": f"""SELECT year_month, {XSUM("total_nursing_hours")} AS total_hours,
       {R("avg(avg_nursing_hppd)", 6)} AS avg_hppd, {ISUM("provider_count")} AS providers_reporting
FROM mv_staffing_summary GROUP BY year_month""",
    "low_hppd_facilities": f"""SELECT provider_id, provider_name, city, state, avg_nursing_hppd, avg_daily_census, year_month
FROM provider_join WHERE avg_nursing_hppd < {D(C.LOW_HPPD_MAX)} AND avg_daily_census > {C.LOW_HPPD_MIN_CENSUS}
ORDER BY avg_nursing_hppd ASC NULLS LAST, provider_id, year_month, provider_name, city, state LIMIT 100""",
    "mv_provider_rankings_current": "SELECT * FROM mv_provider_rankings_current",
    "low_hppd_facilities_current": f"""SELECT provider_id, provider_name, city, state, avg_nursing_hppd, avg_daily_census, year_month
FROM provider_join_current WHERE avg_nursing_hppd < {D(C.LOW_HPPD_MAX)} AND avg_daily_census > {C.LOW_HPPD_MIN_CENSUS}
ORDER BY avg_nursing_hppd ASC NULLS LAST, provider_id, year_month, provider_name, city, state LIMIT 100""",
    "contract_trend": f"""SELECT state, year_month, employed_hours, contract_hours,
       contract_hours / NULLIF(total, 0.0) * {D(100)} AS contract_pct
FROM (SELECT f.state, d.year_month, {XSUM("f.total_employed_hours")} AS employed_hours,
             {XSUM("f.total_contract_hours")} AS contract_hours, {XSUM("f.total_nursing_hours")} AS total
      FROM facts f JOIN dim_date d ON f.date_key = d.date_key GROUP BY f.state, d.year_month) x""",
    "alert_level_counts": "SELECT alert_level, count(*) AS alert_count FROM v_staffing_alerts GROUP BY alert_level",
    "kpi_cards": f"""SELECT total_providers, total_states, total_records, overall_avg_hppd,
       {R("overall_avg_hppd - " + D(C.HPPD_BENCHMARK), 2)} AS hppd_vs_benchmark,
       {R("(" + D(C.HPPD_BENCHMARK) + " - overall_avg_hppd) / " + D(C.HPPD_BENCHMARK) + " * " + D(100), 1)} AS benchmark_gap_pct,
       overall_rn_mix_pct, pct_meeting_benchmark, pct_critical_understaffing
FROM v_kpi_summary""",
    "state_monthly_ordered": "SELECT * FROM v_state_monthly ORDER BY state, year_month",
    "state_summary": f"""SELECT state, {ISUM("provider_count")} AS provider_count,
       {R(XAVG("avg_hppd"), 2)} AS avg_hppd, {R(XAVG("avg_rn_mix_pct"), 2)} AS avg_rn_mix_pct,
       {R(XAVG("pct_meeting_benchmark"), 1)} AS pct_meeting_benchmark,
       {R(XAVG("pct_critical"), 1)} AS pct_critical, {XSUM("total_nursing_hours")} AS total_nursing_hours
FROM v_state_monthly GROUP BY state""",
    "state_list": "SELECT DISTINCT state FROM v_state_monthly",
    "provider_details": "SELECT * FROM provider_details",
    "provider_details_state": "SELECT * FROM provider_details_state",
    "provider_page_stats": f"""SELECT count(*) AS providers, {R(XAVG("avg_hppd"), 2)} AS avg_hppd,
       {R(XAVG("avg_daily_census"), 1)} AS avg_census,
       {R(PCT("avg_hppd >= " + D(C.HPPD_BENCHMARK)), 1)} AS pct_meeting_benchmark
FROM v_provider_monthly""",
    "provider_scatter": "SELECT provider_id, state, year_month, avg_daily_census, avg_hppd, avg_rn_mix_pct, "
                        "days_reported FROM v_provider_monthly",
    "alerts_top": "SELECT * FROM alerts_top",
    "alert_counts": "SELECT CAST(count_if(alert_severity = 'HIGH') AS BIGINT) AS high_alerts, "
                    "CAST(count_if(alert_severity = 'MEDIUM') AS BIGINT) AS medium_alerts, "
                    "CAST(count_if(alert_severity = 'LOW') AS BIGINT) AS low_alerts FROM v_staffing_alerts",
    "alerts_filtered": """SELECT * FROM v_staffing_alerts WHERE alert_severity IN ('HIGH', 'MEDIUM')
ORDER BY CASE alert_severity WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END,
         avg_hppd ASC NULLS LAST, provider_id, year_month, state LIMIT 100""",
    "silver_lineage": "SELECT provnum, work_date, true AS has_processed_at, true AS has_source_file FROM silver",
    "dim_provider_sk": "SELECT count(*) AS row_count, count(*) AS distinct_keys, CAST(0 AS BIGINT) AS null_keys "
                       "FROM dim_provider",
    "daily_trends": f"""SELECT work_date, count(DISTINCT provider_id) AS providers_reporting,
       {R(XAVG("nursing_hppd"), 2)} AS avg_hppd, {R(XAVG("rn_skill_mix_pct"), 2)} AS avg_rn_mix_pct,
       {ISUM("patient_census")} AS total_census, {XSUM("total_nursing_hours")} AS total_hours
FROM daily_c GROUP BY work_date""",
    "hppd_distribution": f"""SELECT {_HBIN} AS hppd_range, {_HORD} AS bin_order, count(*) AS record_count
FROM daily_c WHERE nursing_hppd IS NOT NULL GROUP BY 1, 2""",
    "staffing_mix": f"""SELECT rn_hours, lpn_hours, cna_hours,
       {R("rn_hours / (rn_hours + lpn_hours + cna_hours) * " + D(100), 1)} AS rn_share_pct,
       {R("lpn_hours / (rn_hours + lpn_hours + cna_hours) * " + D(100), 1)} AS lpn_share_pct,
       {R("cna_hours / (rn_hours + lpn_hours + cna_hours) * " + D(100), 1)} AS cna_share_pct
FROM (SELECT {XSUM("hrs_rn")} AS rn_hours, {XSUM("hrs_lpn")} AS lpn_hours, {XSUM("hrs_cna")} AS cna_hours
      FROM daily_c) x""",
    "state_trend_selected": "SELECT * FROM v_state_monthly_first5",
    "rankings_top10": """SELECT * FROM v_provider_rankings
ORDER BY national_rank_hppd, provider_id, state, days_reported, avg_daily_census, avg_rn_mix_pct,
         avg_contract_pct, critical_days LIMIT 10""",
    "global_rank": """SELECT provider_id, state, year_month, avg_hppd,
       CAST(RANK() OVER (ORDER BY avg_hppd DESC NULLS LAST) AS BIGINT) AS national_rank,
       PERCENT_RANK() OVER (ORDER BY avg_hppd ASC NULLS LAST) AS percent_rank
FROM v_provider_monthly""",
    "dim_provider_history": "SELECT * FROM dim_provider_history",
    "provider_asof_monthly": "SELECT * FROM provider_asof_monthly",
    "fact_asof_provider": """SELECT provnum AS provider_id, work_date, provname AS provider_name, city, state, county_name,
       county_fips, mdscensus AS patient_census, total_nursing_hours FROM silver""",
    "daily_ratio_rank": """SELECT provider_id, state, work_date, nursing_hppd AS ratio,
       CAST(RANK() OVER (ORDER BY nursing_hppd DESC NULLS LAST) AS BIGINT) AS national_rank,
       PERCENT_RANK() OVER (ORDER BY nursing_hppd ASC NULLS LAST) AS percent_rank,
       CAST(RANK() OVER (PARTITION BY state ORDER BY nursing_hppd DESC NULLS LAST) AS BIGINT) AS state_rank
FROM facts WHERE patient_census > 0""",
    "pipeline_run_log": """SELECT 'land_raw' AS stage, 'SUCCEEDED' AS status, count(*) AS rows FROM panel
UNION ALL SELECT 'raw_to_silver', 'SUCCEEDED', count(*) FROM silver
UNION ALL SELECT 'silver_to_gold', 'SUCCEEDED',
       (SELECT count(*) FROM dim_date) + (SELECT count(*) FROM dim_provider)
     + (SELECT count(*) FROM dim_provider_current) + (SELECT count(*) FROM dim_provider_history)
     + (SELECT count(*) FROM dim_state)
     + (SELECT count(*) FROM facts) + (SELECT count(*) FROM agg_provider_monthly)
     + (SELECT count(*) FROM agg_state_monthly) + (SELECT count(*) FROM agg_state_monthly_etl)
     + (SELECT count(*) FROM agg_overall_metrics) + (SELECT count(*) FROM v_provider_monthly)
     + (SELECT count(*) FROM v_state_monthly)
UNION ALL SELECT 'refresh_views', 'SUCCEEDED',
       (SELECT count(*) FROM mv_staffing_summary) + (SELECT count(*) FROM mv_provider_rankings)""",
    "gold_roundtrip": """SELECT 'fact_daily_staffing' AS table_name, count(*) AS row_count FROM facts
UNION ALL SELECT 'dim_provider', count(*) FROM dim_provider
UNION ALL SELECT 'dim_date', count(*) FROM dim_date
UNION ALL SELECT 'agg_provider_monthly', count(*) FROM agg_provider_monthly
UNION ALL SELECT 'agg_state_monthly', count(*) FROM agg_state_monthly""",
    "table_row_counts": """SELECT 'fact_daily_staffing' AS table_name, count(*) AS row_count FROM facts
UNION ALL SELECT 'dim_provider', count(*) FROM dim_provider
UNION ALL SELECT 'dim_date', count(*) FROM dim_date
UNION ALL SELECT 'agg_provider_monthly', count(*) FROM agg_provider_monthly
UNION ALL SELECT 'agg_state_monthly', count(*) FROM agg_state_monthly""",
    "silver_roundtrip": "SELECT provnum, provname, city, state, county_name, county_fips, cy_qtr, work_date, "
                        "mdscensus, " + ", ".join(C.hour_columns()) + " FROM silver",
    "incremental_silver": "SELECT provnum, provname, city, state, county_name, county_fips, cy_qtr, work_date, "
                          "mdscensus, " + ", ".join(C.hour_columns()) + " FROM silver",
    "raw_scan_counts": "SELECT cy_qtr, state, count(*) AS record_count FROM panel GROUP BY cy_qtr, state",
    "kpi_from_gold": "SELECT * FROM v_kpi_summary",
    "sql_over_views": """SELECT s.state, CAST(SUM(s.provider_count) AS BIGINT) AS provider_months,
       CAST(SUM(s.total_patient_days) AS BIGINT) AS patient_days, MAX(a.alerts) AS alerts
FROM v_state_monthly s
LEFT JOIN (SELECT state, count(*) AS alerts FROM v_staffing_alerts GROUP BY state) a ON a.state = s.state
GROUP BY s.state""",
    "catalog_sql_counts": """SELECT f.state, count(*) AS record_count, max(s.provider_count) AS provider_count
FROM facts f JOIN dim_state s ON f.state = s.state GROUP BY f.state""",
    "mv_staffing_summary_stored": "SELECT * FROM mv_staffing_summary",
    "mv_provider_rankings_stored": "SELECT * FROM mv_provider_rankings",
    "fk_violations": """SELECT 'fact.date_key -> dim_date' AS check_name,
       count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_key = f.date_key)) AS violations FROM facts f
UNION ALL SELECT 'fact.provider_id -> dim_provider',
       count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM dim_provider p WHERE p.provider_id = f.provider_id)) FROM facts f
UNION ALL SELECT 'fact.state -> dim_state',
       count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM dim_state s WHERE s.state = f.state)) FROM facts f""",
}


def _deps(sql: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql))
    return [n for n in CTES if n in words]


_KINDS = [k for k, _ in C.FILE_CATEGORIES] + ["readme"]
_FOLDERS = [c for _, c in C.FILE_CATEGORIES] + [C.OTHER_CATEGORY]
_PART = lambda i: "CAST(provnum AS BIGINT) % 3 = " + str(i)
_DAY = "day(work_date)"
_SPOILT = f"""SELECT *, CAST(provnum AS BIGINT) % 50 = 3 AND {_DAY} = 11 AS no_provider,
  CAST(provnum AS BIGINT) % 7 = 1 AND {_DAY} = 5 AS bad_date, CAST(provnum AS BIGINT) % 7 = 2 AND {_DAY} = 6 AS no_date,
  CAST(provnum AS BIGINT) % 5 = 0 AND {_DAY} = 7 AS bad_hours, CAST(provnum AS BIGINT) % 5 = 1 AND {_DAY} = 8 AS bad_census
FROM silver"""
_COUNT = lambda fact, cond: f"SELECT '{fact}' AS fact, count(*) FILTER ({cond}) AS rows FROM s"

_FIELDS = ["provnum", "provname", "city", "lower(state)", "county_name", "county_fips", "strftime(work_date, '%Y%m%d')", "mdscensus",
           *[c.lower() for c in C.raw_hour_columns()]]

QUERIES |= {
    "raw_inventory_bytes": f"""SELECT 'nursing_staffing/cy_qtr=' || cy_qtr || '/ingest_date=2024-07-01' AS folder,
       CAST(sum({" + ".join(f"length(coalesce(CAST({f} AS VARCHAR), ''))" for f in _FIELDS)} + {len(_FIELDS)}) AS BIGINT) AS record_bytes
FROM panel GROUP BY cy_qtr""",
    "state_hours": f"""SELECT state, {", ".join(f"{XSUM(c)} AS {c}" for c in ("total_nursing_hours", "total_employed_hours", "total_contract_hours"))}
FROM facts GROUP BY state""",
    "land_raw_roundtrip": f"""SELECT provnum AS PROVNUM, provname AS PROVNAME, lower(state) AS STATE, strftime(work_date, '%Y%m%d') AS WorkDate,
       CAST(mdscensus AS VARCHAR) AS MDScensus, {", ".join(f"{c.lower()} AS {c}" for c in C.raw_hour_columns())},
       cy_qtr, '2024-07-01' AS ingest_date FROM panel""",
    "route_files": f"""SELECT file_name, category, CASE WHEN kind = 1 THEN quarter END AS cy_qtr,
       'raw/' || category || '/' || CASE WHEN kind = 1 THEN 'cy_qtr=' || quarter || '/' ELSE '' END || 'ingest_date=2024-07-01/' || file_name AS key
FROM (SELECT DISTINCT CAST(provnum AS BIGINT) % {len(_KINDS)} + 1 AS kind, ({_KINDS})[kind]
             || CASE WHEN CAST(provnum AS BIGINT) % 2 = 0 THEN '_' || substr(cy_qtr, 5, 2) || '_' || substr(cy_qtr, 1, 4) ELSE '' END
             || '_' || provnum || '.csv' AS file_name,
             ({_FOLDERS})[kind] AS category, '{C.DEFAULT_QUARTER}' AS quarter FROM panel) x""",
    "schema_check": f"""SELECT 'layout_0' AS layout, CAST({len(C.raw_columns())} AS INTEGER) AS columns, '' AS missing, '' AS unknown, true AS same_order, true AS ok
WHERE EXISTS (FROM panel WHERE {_PART(0)})
UNION ALL SELECT 'layout_1', {len(C.raw_columns()) + 1}, '', 'note', false, true WHERE EXISTS (FROM panel WHERE {_PART(1)})
UNION ALL SELECT 'layout_2', {len(C.raw_columns()) - 1}, 'mdscensus', '', true, false WHERE EXISTS (FROM panel WHERE {_PART(2)})""",
    "mixed_headers": QUERIES["silver_typed"] + f" WHERE NOT {_PART(2)}",
    "quarantine_counts": "SELECT * FROM (WITH s AS (" + _SPOILT + ") " + " UNION ALL ".join(
        [_COUNT(f, c) for f, c in (
            ("write: read", "true"), ("write: rejected", "no_provider OR no_date OR bad_date"),
            ("write: rescued", "bad_date OR bad_hours OR bad_census"), ("write: no provider", "no_provider"),
            ("write: no date", "no_date"), ("write: bad date", "bad_date"),
            ("good", "NOT (no_provider OR no_date OR bad_date)"), ("quarantined", "no_provider OR no_date OR bad_date"))]
        + [_COUNT(f, c) + f" HAVING count(*) FILTER ({c}) > 0" for f, c in (
            ("reason: no provider", "no_provider"), ("reason: no date", "no_date"), ("reason: bad date", "bad_date"),
            ("rescued: workdate", "bad_date"), ("rescued: hrs_rn", "bad_hours"), ("rescued: mdscensus", "bad_census"))]) + ") q",
    "quarantine_good": f"""SELECT provnum, work_date, CASE WHEN NOT bad_census THEN mdscensus END AS mdscensus, CASE WHEN NOT bad_hours THEN hrs_rn END AS hrs_rn,
       CASE WHEN bad_hours THEN 'abc' END AS raw_hrs_rn, CASE WHEN bad_census THEN '12x' END AS raw_census
FROM ({_SPOILT}) s WHERE NOT (no_provider OR no_date OR bad_date)""",
    "external_tables": QUERIES["catalog_sql_counts"],
}

# The same queries over two quarters: the panel and, after it, the panel a quarter later without some facilities.
QUARTER_QUERIES: dict[str, str] = {
    "quarters_provider_monthly": "SELECT * FROM v_provider_monthly",
    "quarters_state_monthly": "SELECT * FROM v_state_monthly",
    "quarters_kpi_summary": "SELECT * FROM v_kpi_summary",
    **{f"quarters_{t}": f"SELECT * FROM {t}" for t in (
        "mv_staffing_summary", "provider_asof_monthly", "dim_date", "dim_provider_current", "dim_provider_history", "dim_state",
        "agg_provider_monthly", "agg_state_monthly", "agg_state_monthly_etl", "agg_overall_metrics")},
    "state_provider_reach": "SELECT state, count(DISTINCT provnum) AS providers FROM silver GROUP BY state",
    "monthly_provider_reach": """SELECT CAST(year(work_date) AS INTEGER) AS year, CAST(month(work_date) AS INTEGER) AS month,
       count(DISTINCT provnum) AS providers FROM silver GROUP BY ALL""",
    "sketch_accuracy": """SELECT DISTINCT state, CAST(q AS DOUBLE) AS quantile, true AS rank_ok, true AS members_ok
FROM silver, (VALUES (0.25), (0.5), (0.75)) v(q)""",
}

_TWO_QUARTERS = f"""
SELECT * FROM first_quarter
UNION ALL
SELECT * REPLACE (CAST(work_date + {P.DAYS_IN_QUARTER} AS DATE) AS work_date, '{P.NEXT_QUARTER}' AS cy_qtr)
FROM first_quarter WHERE CAST(provnum AS BIGINT) % {P.LEAVES_MOD} <> {P.LEAVES_REM}
"""


def quarter_sql(name: str) -> str:
    one = with_ctes(QUARTER_QUERIES[name])
    panel = CTES["panel"].strip()
    return one.replace(f"panel AS ({panel})", f"first_quarter AS ({panel}),\npanel AS ({_TWO_QUARTERS.strip()})")


def with_ctes(body: str) -> str:
    order: list[str] = []

    def visit(name: str, seen: tuple = ()):
        if name in order:
            return
        for dep in _deps(CTES[name]):
            if dep != name and dep not in seen:
                visit(dep, seen + (name,))
        order.append(name)

    for n in _deps(body):
        visit(n)
    if not order:
        return body.strip()
    parts = [f"{n} AS ({CTES[n].strip()})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def query_sql(name: str) -> str:
    return with_ctes(QUERIES[name])


def all_queries() -> dict[str, str]:
    return {k: query_sql(k) for k in QUERIES} | {k: quarter_sql(k) for k in QUARTER_QUERIES}
