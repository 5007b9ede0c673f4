"""Expose every layer and view under its warehouse name for SQL users.

``register_views(wh)`` creates session temp views with the names the
warehouse uses (the schema prefix dropped), so existing SQL such as
``SELECT * FROM v_kpi_summary`` or a dashboard's aggregate over
``v_state_monthly`` runs unchanged through ``spark.sql``. The views are the
lazy DataFrames of this package: Catalyst plans each SQL statement over the
same pruned, pushed-down scans as the DataFrame API.

The two same-named ``v_provider_monthly`` / ``v_state_monthly`` definitions
upstream (metric view vs. access view over the stored aggregate) are
registered as ``v_provider_monthly`` / ``v_state_monthly`` (metric views) and
``v_provider_monthly_agg`` / ``v_state_monthly_agg`` (access views).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from . import metrics as M
from . import serving as Q
from .warehouse import Warehouse

VIEW_BUILDERS = {
    # stored layers
    "facts": lambda wh: wh.fact,
    "fact_daily_staffing": lambda wh: wh.fact,
    "dim_date": lambda wh: wh.table("dim_date"),
    "dim_provider": lambda wh: wh.table("dim_provider"),
    "dim_provider_current": lambda wh: wh.table("dim_provider_current"),
    "dim_state": lambda wh: wh.table("dim_state"),
    "agg_provider_monthly": lambda wh: wh.table("agg_provider_monthly"),
    "agg_state_monthly": lambda wh: wh.table("agg_state_monthly"),
    "agg_overall_metrics": lambda wh: wh.table("agg_overall_metrics"),
    # metric views
    "v_daily_metrics": lambda wh: wh.daily(),
    "v_provider_monthly": lambda wh: wh.provider_monthly(),
    "v_state_monthly": lambda wh: wh.state_monthly(),
    "v_kpi_summary": lambda wh: M.v_kpi_summary(wh.daily()),
    # a view outlives the rows it is defined over: its ranks are planned with it, not taken beforehand
    "v_provider_rankings": lambda wh: M.v_provider_rankings(wh.provider_monthly(), materialize=False),
    "v_staffing_alerts": lambda wh: M.v_staffing_alerts(wh.provider_monthly()),
    "v_day_of_week_analysis": lambda wh: M.v_day_of_week_analysis(wh.daily()),
    # warehouse access views and materialized-view definitions
    "v_daily_staffing": Q.v_daily_staffing,
    "v_provider": Q.v_provider,
    "v_provider_monthly_agg": Q.v_provider_monthly_agg,
    "v_state_monthly_agg": Q.v_state_monthly_agg,
    "mv_staffing_summary": Q.mv_staffing_summary,
    "mv_provider_rankings": lambda wh: Q.mv_provider_rankings(wh, materialize=False),
}


def register_views(wh: Warehouse, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Register the named views (default: all). No job runs until a view is queried."""
    chosen = names or list(VIEW_BUILDERS)
    out = {}
    for name in chosen:
        df = VIEW_BUILDERS[name](wh)
        df.createOrReplaceTempView(name)
        out[name] = df
    return out
