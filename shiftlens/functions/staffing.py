"""Column expressions for the staffing metrics (HPPD, mix, bands, alerts)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .rounding import round_ratio


def nz(name: str) -> Column:
    """Null hours count as zero."""
    return F.coalesce(F.col(name), F.lit(0.0))


def null_safe_total(names: list[str]) -> Column:
    out = nz(names[0])
    for n in names[1:]:
        out = out + nz(n)
    return out


def per_census(hours: Column, census: Column) -> Column:
    """hours / census rounded like the metric view: both to 2 places; null unless census > 0."""
    return F.when(census > 0, round_ratio(hours, 2, census))


def share_pct(part: Column, total: Column) -> Column:
    """part / total * 100 at 2 places (part pre-rounded to 4); 0 unless total > 0."""
    return F.when(total > 0, round_ratio(part, 4, total, percent=True)).otherwise(F.lit(0.0))


def staffing_category(total_hours: Column, census: Column) -> Column:
    """Band on the unrounded ratio. A null/negative census or null total is 'Critical'."""
    ratio = total_hours / F.nullif(census, F.lit(0))
    return (F.when(census == 0, F.lit(C.CATEGORY_NO_CENSUS))
            .when(ratio >= C.HPPD_BENCHMARK, F.lit(C.CATEGORY_MEETS))
            .when(ratio >= C.HPPD_NEAR, F.lit(C.CATEGORY_NEAR))
            .when(ratio >= C.HPPD_BELOW, F.lit(C.CATEGORY_BELOW))
            .otherwise(F.lit(C.CATEGORY_CRITICAL)))


def day_of_week0(d: Column) -> Column:
    """Day of week with 0 = Sunday, as bigint."""
    return (F.dayofweek(d) - 1).cast("bigint")


def day_name_of(dow0: Column) -> Column:
    expr = None
    for i, name in enumerate(C.DAY_NAMES):
        expr = (F.when(dow0 == i, F.lit(name)) if expr is None
                else expr.when(dow0 == i, F.lit(name)))
    return expr


def day_type_of(dow0: Column) -> Column:
    return F.when(dow0.isin(0, 6), F.lit("Weekend")).otherwise(F.lit("Weekday"))


def alert_level(avg_hppd: Column, avg_census: Column, avg_contract: Column, critical_days: Column) -> Column:
    return (F.when((avg_hppd < C.ALERT_HIGH_HPPD) & (avg_census > C.ALERT_MIN_CENSUS), F.lit(C.ALERT_LEVEL_HIGH))
            .when((avg_hppd < C.ALERT_MEDIUM_HPPD) & (avg_census > C.ALERT_MIN_CENSUS), F.lit(C.ALERT_LEVEL_BELOW_MIN))
            .when(avg_contract > C.ALERT_CONTRACT_HIGH, F.lit(C.ALERT_LEVEL_CONTRACT))
            .when(critical_days > C.ALERT_CRITICAL_DAYS, F.lit(C.ALERT_LEVEL_FREQUENT))
            .otherwise(F.lit(C.ALERT_LEVEL_LOW)))


def hppd_alert(avg_hppd: Column) -> Column:
    return (F.when(avg_hppd < C.ALERT_HIGH_HPPD, F.lit(C.HPPD_ALERT_BELOW_25))
            .when(avg_hppd < C.ALERT_MEDIUM_HPPD, F.lit(C.HPPD_ALERT_BELOW_30))
            .otherwise(F.lit("")))


def contract_alert(avg_contract: Column) -> Column:
    return (F.when(avg_contract > C.ALERT_CONTRACT_HIGH, F.lit(C.CONTRACT_ALERT_50))
            .when(avg_contract > C.ALERT_CONTRACT_WATCH, F.lit(C.CONTRACT_ALERT_30))
            .otherwise(F.lit("")))


def alert_severity(level: Column) -> Column:
    """Leading word of the alert level ('HIGH', 'MEDIUM', 'LOW')."""
    return F.split_part(level, F.lit(" - "), F.lit(1))


def severity_order(severity: Column) -> Column:
    return F.when(severity == "HIGH", 1).when(severity == "MEDIUM", 2).otherwise(3)


def hppd_bin(hppd: Column) -> tuple[Column, Column]:
    """(label, order) of the histogram bin; lower bounds inclusive."""
    label = None
    order = None
    for i, edge in enumerate(C.HPPD_BIN_EDGES):
        cond = hppd < edge
        label = F.when(cond, F.lit(C.HPPD_BIN_LABELS[i])) if label is None else label.when(cond, F.lit(C.HPPD_BIN_LABELS[i]))
        order = F.when(cond, F.lit(i + 1)) if order is None else order.when(cond, F.lit(i + 1))
    n = len(C.HPPD_BIN_LABELS)
    return label.otherwise(F.lit(C.HPPD_BIN_LABELS[-1])), order.otherwise(F.lit(n)).cast("bigint")
