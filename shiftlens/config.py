"""Thresholds, labels and layout names of the staffing metrics.

Everything in the FIXED VALUES block must equal the published metric
definitions for results to match; it is stated once here and imported
everywhere else (Spark code and oracle SQL alike).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (metric definitions; do not change)
# ---------------------------------------------------------------------------

# Total nursing hours per patient day: staffing level bands (half-open,
# evaluated on the unrounded ratio).
HPPD_BENCHMARK = 4.1
HPPD_NEAR = 3.5
HPPD_BELOW = 2.5

CATEGORY_NO_CENSUS = "No Census"
CATEGORY_MEETS = "Meets CMS Benchmark"
CATEGORY_NEAR = "Near Benchmark"
CATEGORY_BELOW = "Below Benchmark"
CATEGORY_CRITICAL = "Critical Understaffing"

# Provider-month alert rules.
ALERT_HIGH_HPPD = 2.5
ALERT_MEDIUM_HPPD = 3.0
ALERT_MIN_CENSUS = 20
ALERT_CONTRACT_HIGH = 50
ALERT_CONTRACT_WATCH = 30
ALERT_CRITICAL_DAYS = 10
# A provider-month becomes an alert candidate when any of these holds.
ALERT_CANDIDATE_HPPD = 3.5
ALERT_CANDIDATE_CONTRACT = 30
ALERT_CANDIDATE_CRITICAL_DAYS = 5

ALERT_LEVEL_HIGH = "HIGH - Critical Understaffing"
ALERT_LEVEL_BELOW_MIN = "MEDIUM - Below Minimum"
ALERT_LEVEL_CONTRACT = "MEDIUM - High Contract Reliance"
ALERT_LEVEL_FREQUENT = "MEDIUM - Frequent Critical Days"
ALERT_LEVEL_LOW = "LOW"

HPPD_ALERT_BELOW_25 = "HPPD below 2.5"
HPPD_ALERT_BELOW_30 = "HPPD below 3.0"
CONTRACT_ALERT_50 = "Contract staff >50%"
CONTRACT_ALERT_30 = "Contract staff >30%"

# Low-HPPD facility list (warehouse query).
LOW_HPPD_MAX = 3.0
LOW_HPPD_MIN_CENSUS = 20

# Rankings include only provider-months with at least this many days.
MIN_DAYS_RANKED = 30

# Documented (not coded upstream) benchmarks.
RN_HPPD_BENCHMARK = 0.75
CONTRACT_TYPICAL_MAX = 15
CONTRACT_HIGH_MIN = 30
RN_MIX_TYPICAL_MIN = 15
RN_MIX_TYPICAL_MAX = 25

# Day names by day of week, 0 = Sunday.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# HPPD histogram: lower bounds are inclusive; labels in display order.
HPPD_BIN_EDGES = [2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0]
HPPD_BIN_LABELS = ["< 2.0", "2.0 - 2.5", "2.5 - 3.0", "3.0 - 3.5", "3.5 - 4.0",
                   "4.0 - 4.5", "4.5 - 5.0", "5.0+"]

# Columns the raw staffing file must carry (matched case-insensitively).
REQUIRED_COLUMNS = ["provnum", "state", "workdate", "mdscensus", "hrs_rn", "hrs_lpn", "hrs_cna"]

# Raw staffing file header, in file order.
RAW_ID_COLUMNS = ["PROVNUM", "PROVNAME", "CITY", "STATE", "COUNTY_NAME", "COUNTY_FIPS",
                  "CY_Qtr", "WorkDate", "MDScensus"]
RAW_HOUR_ROLES = ["RNDON", "RNadmin", "RN", "LPNadmin", "LPN", "CNA", "NAtrn", "MedAide"]

# Raw-zone file routing: file-name substring -> category folder; first match
# wins, anything else goes to "other". Only the staffing file is split by
# quarter.
FILE_CATEGORIES = [
    ("PBJ_Daily_Nurse_Staffing", "nursing_staffing"),
    ("NH_ProviderInfo", "supporting/provider_info"),
    ("NH_QualityMsr_MDS", "supporting/quality_mds"),
    ("NH_QualityMsr_Claims", "supporting/quality_claims"),
    ("NH_HealthCitations", "supporting/health_citations"),
    ("NH_FireSafetyCitations", "supporting/fire_citations"),
    ("NH_Penalties", "supporting/penalties"),
    ("NH_Ownership", "supporting/ownership"),
    ("NH_StateUSAverages", "supporting/state_averages"),
    ("NH_SurveyInfo", "supporting/survey_info"),
    ("NH_InfectionControlViol", "supporting/infection_control"),
    ("NH_CovidVaxProvider", "supporting/covid_vax"),
]
QUARTERED_CATEGORY = "nursing_staffing"
DEFAULT_QUARTER = "2024Q2"
OTHER_CATEGORY = "other"

# As-of date stamped on the overall metrics table unless the job passes one.
DEFAULT_SNAPSHOT_DATE = "2024-07-01"

# ---------------------------------------------------------------------------
# End of fixed values
# ---------------------------------------------------------------------------


def raw_hour_columns() -> list[str]:
    """Raw hour headers: each role, then its employed and contract parts."""
    cols = []
    for role in RAW_HOUR_ROLES:
        cols += [f"Hrs_{role}", f"Hrs_{role}_emp", f"Hrs_{role}_ctr"]
    return cols


def raw_columns() -> list[str]:
    return RAW_ID_COLUMNS + raw_hour_columns()


def hour_columns() -> list[str]:
    """Silver (lower-case) names of every hour column."""
    return [c.lower() for c in raw_hour_columns()]


DIRECT_CARE_ROLES = ["rn", "lpn", "cna"]
