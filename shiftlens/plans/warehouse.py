"""Where the layers come from: derived lazily from the driver tables, or read
from a gold folder written by the pipeline.

Both modes hand out the same DataFrames (silver records, the fact, the gold
tables), so every view and dashboard query is one function of a
``Warehouse`` and runs unchanged over either.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..operators import gold
from ..operators.history import provider_history
from ..operators.silver import to_silver
from ..sources.panel import facility_days, render_raw

GOLD_TABLES = {
    "dim_date": "dimensions/dim_date",
    "dim_provider": "dimensions/dim_provider",
    "dim_provider_current": "dimensions/dim_provider_current",
    "dim_provider_history": "dimensions/dim_provider_history",
    "dim_state": "dimensions/dim_state",
    "facts": "facts",
    "agg_provider_monthly": "aggregates/agg_provider_monthly",
    "agg_state_monthly": "aggregates/agg_state_monthly",
    "agg_state_monthly_etl": "aggregates/agg_state_monthly_etl",
    "agg_overall_metrics": "aggregates/agg_overall_metrics",
    # the two summaries most dashboard queries start from, stored once per load
    "provider_monthly_summary": "serving/provider_monthly_summary",
    "state_monthly_summary": "serving/state_monthly_summary",
}

DEFAULT_SNAPSHOT_DATE = C.DEFAULT_SNAPSHOT_DATE

# serving summaries that can always be recomputed from the stored fact
FACT_DERIVED = {"provider_monthly_summary", "state_monthly_summary"}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


@dataclass
class Warehouse:
    spark: SparkSession
    silver: DataFrame | None = None
    gold_dir: str | None = None
    snapshot_date: str = DEFAULT_SNAPSHOT_DATE
    _cache: dict = field(default_factory=dict)

    @classmethod
    def derived(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        """Silver built lazily from the driver tables (panel -> raw strings -> silver)."""
        raw = render_raw(facility_days(spark, sf_dir))
        return cls(spark, silver=to_silver(raw, source_file=f"{sf_dir}/lineitem.parquet"))

    @classmethod
    def from_gold(cls, spark: SparkSession, gold_dir: str, silver_dir: str | None = None) -> "Warehouse":
        silver = spark.read.parquet(silver_dir) if silver_dir else None
        return cls(spark, silver=silver, gold_dir=gold_dir.rstrip("/"))

    # -- tables ------------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        if name == "fact_daily_staffing":
            name = "facts"
        if name in self._cache:
            return self._cache[name]
        if self.gold_dir is not None:
            path = f"{self.gold_dir}/{GOLD_TABLES[name]}"
            if name in FACT_DERIVED and not _exists(self.spark, path):
                # gold written before the serving summaries existed: derive from the stored fact
                from .metrics import v_daily_metrics, v_provider_monthly, v_state_monthly
                daily = v_daily_metrics(self.fact)
                df = v_provider_monthly(daily) if name == "provider_monthly_summary" else v_state_monthly(daily)
            else:
                df = self.spark.read.parquet(path)
        else:
            df = build_gold_table(name, self.silver, self.snapshot_date)
        self._cache[name] = df
        return df

    @property
    def fact(self) -> DataFrame:
        return self.table("facts")

    def daily(self) -> DataFrame:
        from .metrics import v_daily_metrics
        return v_daily_metrics(self.fact)

    def materialized(self, name: str) -> DataFrame:
        """A materialized view: its newest complete version when reading gold
        (if the pipeline refreshed it), else its definition."""
        from . import serving as Q
        if self.gold_dir is not None:
            from ..sources.sinks import MaterializedView
            mv = MaterializedView(self.spark, f"{self.gold_dir}/serving/{name}", None)
            versions = mv.versions()
            if versions:
                return self.spark.read.parquet(f"{mv.path}/version={versions[-1]}")
        return {"mv_staffing_summary": Q.mv_staffing_summary,
                "mv_provider_rankings": Q.mv_provider_rankings}[name](self)

    def provider_monthly(self) -> DataFrame:
        """``v_provider_monthly``: the stored summary when reading gold, else computed.
        (Stored partitioned by state; the view's column order is restored.)"""
        df = self.table("provider_monthly_summary")
        return df.select("provider_id", "state", *[c for c in df.columns if c not in ("provider_id", "state")])

    def state_monthly(self) -> DataFrame:
        """``v_state_monthly``: the stored summary when reading gold, else computed."""
        return self.table("state_monthly_summary")


def build_gold_table(name: str, silver: DataFrame, snapshot_date: str = DEFAULT_SNAPSHOT_DATE) -> DataFrame:
    if name == "facts":
        return gold.build_fact(silver)
    if name == "dim_date":
        return gold.build_dim_date(silver)
    if name == "dim_provider":
        return gold.build_dim_provider(silver)
    if name == "dim_provider_current":
        return gold.build_dim_provider_current(silver)
    if name == "dim_provider_history":
        return provider_history(silver)
    if name == "dim_state":
        return gold.build_dim_state(silver)
    if name == "agg_provider_monthly":
        return gold.build_agg_provider_monthly(silver)
    if name == "agg_state_monthly":
        from .metrics import v_daily_metrics
        return gold.build_agg_state_monthly(v_daily_metrics(gold.build_fact(silver), extra=("contract_ratio",)))
    if name == "agg_state_monthly_etl":
        return gold.build_agg_state_monthly_etl(silver)
    if name == "agg_overall_metrics":
        return gold.build_agg_overall_metrics(silver, snapshot_date)
    if name in ("provider_monthly_summary", "state_monthly_summary"):
        from .metrics import v_daily_metrics, v_provider_monthly, v_state_monthly
        daily = v_daily_metrics(gold.build_fact(silver))
        return v_provider_monthly(daily) if name == "provider_monthly_summary" else v_state_monthly(daily)
    raise KeyError(name)
