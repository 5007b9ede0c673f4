"""Reloads, incremental ingest by header, uncapped figures, shared scratch folder, surrogate keys."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import hours, raw_frame
from shiftlens import config as C
from shiftlens.operators.gold import build_dim_provider
from shiftlens.operators.silver import to_silver
from shiftlens.plans import jobs as J
from shiftlens.plans import serving as Q
from shiftlens.plans.warehouse import Warehouse
from shiftlens.session import ensure_checkpoint_dir, scratch_dir
from shiftlens.sources.bronze import EmptySourceError, land_raw, read_raw
from shiftlens.sources.sinks import write_silver
from shiftlens.streaming.incremental import run_incremental_silver


def _days(states, quarter="2024Q2", day="20240401"):
    return [{"PROVNUM": f"{i:06d}", "STATE": s, "CY_Qtr": quarter, "WorkDate": day} | hours(20.0, 10.0, 30.0)
            for i, s in enumerate(states)]


def test_reload_without_a_state_leaves_none_of_its_rows(spark):
    base = scratch_dir(spark, "rerun")
    silver, gold = f"{base}/silver", f"{base}/gold"
    older = to_silver(raw_frame(spark, _days(["NY"], "2024Q1", "20240101")))
    write_silver(older, silver)
    write_silver(to_silver(raw_frame(spark, _days(["NY", "TX", "CA"]))), silver)
    J.run_silver_to_gold(spark, silver, gold)
    write_silver(to_silver(raw_frame(spark, _days(["CA", "TX"]))), silver)
    left = {(r.cy_qtr, r.state) for r in spark.read.parquet(silver).select("cy_qtr", "state").distinct().collect()}
    assert left == {("2024Q1", "NY"), ("2024Q2", "CA"), ("2024Q2", "TX")}  # the other quarter stays
    only = f"{base}/silver_without_ny"
    write_silver(spark.read.parquet(silver).where("state <> 'NY'"), only)
    J.run_silver_to_gold(spark, only, gold)
    wh = Warehouse.from_gold(spark, gold, only)
    for name in ("facts", "agg_provider_monthly", "provider_monthly_summary", "dim_state"):
        states = {r.state for r in spark.read.parquet(f"{gold}/{J.GOLD_TABLES[name]}").select("state").collect()} \
            if name in J.GOLD_TABLES else set()
        assert "NY" not in states
    assert all(v == 0 for r in Q.fk_violations(wh).collect() for v in r.asDict().values() if isinstance(v, int))


def _csv(spark, frame, path):
    frame.coalesce(1).write.option("header", True).csv(path)


def test_incremental_ingest_tells_columns_by_header(spark):
    base = scratch_dir(spark, "headers")
    # the full layout with its own quarter, under a folder that claims another quarter
    frame = raw_frame(spark, _days(["AL", "TX"]))
    assert "CY_Qtr" in frame.columns and len(frame.columns) == len(C.raw_columns())
    reordered = frame.select(*reversed(frame.columns))
    for name, own in (("full", frame), ("reordered", reordered)):
        raw = f"{base}/{name}/raw"
        _csv(spark, own, f"{raw}/cy_qtr=2023Q4/ingest_date=2024-07-01")
        got = run_incremental_silver(spark, raw, f"{base}/{name}/silver", f"{base}/{name}/ckpt")
        want = to_silver(read_raw(spark, raw))
        cols = [c for c in want.columns if c != "processed_at"]
        text = lambda df: sorted(map(str, df.select(*[F.col(c).cast("string") for c in cols]).collect()))
        assert text(got) == text(want)
        assert {r.cy_qtr for r in got.select("cy_qtr").collect()} == {"2024Q2"}
        assert got.agg(F.sum("hrs_rn")).first()[0] == 40.0


def test_incremental_ingest_never_reads_a_differing_header_by_position(spark):
    base = scratch_dir(spark, "mixed")
    land_raw(raw_frame(spark, _days(["AL"])), base, "2024-07-01")
    raw = J.pipeline_paths(base)["raw"]
    run_incremental_silver(spark, raw, f"{base}/silver", f"{base}/ckpt")
    frame = raw_frame(spark, _days(["TX"]))
    _csv(spark, frame.select(*reversed(frame.columns)), f"{raw}/cy_qtr=2024Q2/ingest_date=2024-07-02")
    try:  # told by its own header, or refused: it depends on which file's header names the columns
        got = run_incremental_silver(spark, raw, f"{base}/silver", f"{base}/ckpt")
    except StreamingQueryException as e:
        assert "header" in str(e).lower()
    else:
        assert sorted((r.state, r.hrs_rn, r.mdscensus) for r in got.collect()) == [("AL", 20.0, 10), ("TX", 20.0, 10)]


def test_read_raw_reports_only_missing_files_as_empty(spark):
    with pytest.raises(EmptySourceError):
        read_raw(spark, scratch_dir(spark, "nothing"))


def test_alert_figures_cover_more_rows_than_the_list_shows(spark):
    rows = [{"PROVNUM": f"{i:06d}", "MDScensus": "100"} | hours(10.0, 5.0, 5.0) for i in range(130)]
    month = [r | {"WorkDate": f"202404{d:02d}"} for r in rows for d in range(1, 31)]
    wh = Warehouse(spark, silver=to_silver(raw_frame(spark, month)))
    n = Q.alert_counts(wh).first()
    by_level = {r.alert_severity: r["count"] for r in Q._alerts(wh).groupBy("alert_severity").count().collect()}
    assert n.high_alerts == by_level.get("HIGH", 0) > 100 and sum(n) == sum(by_level.values())
    assert Q.alerts_top(wh).count() == 100
    assert Q.provider_page_stats(wh).first().providers == 130
    assert Q.provider_scatter(wh).count() == 130


class _ClusterSession:
    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return None

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_ClusterSession)


def test_surrogate_keys_tell_where_a_null_stands(spark):
    s = to_silver(raw_frame(spark, [{"COUNTY_NAME": "X", "COUNTY_FIPS": None}, {"COUNTY_NAME": None, "COUNTY_FIPS": "X"}]))
    keys = [r.provider_sk for r in build_dim_provider(s).select("provider_sk").collect()]
    assert len(set(keys)) == 2 and None not in keys


def test_registered_rankings_cover_rows_appended_later(spark):
    from shiftlens.plans.catalog import VIEW_BUILDERS, register_views

    path = scratch_dir(spark, "views") + "/silver"

    def month(n, start):
        return to_silver(raw_frame(spark, [{"PROVNUM": f"{i:06d}", "WorkDate": f"202404{d:02d}"} | hours(10.0 + i, 5.0, 5.0)
                                           for i in range(start, start + n) for d in range(1, 31)]))

    month(2, 0).write.parquet(path)
    schema = spark.read.parquet(path).schema

    wh = Warehouse(spark, silver=spark.read.schema(schema).parquet(path))
    assert {"v_provider_rankings", "mv_provider_rankings"} <= set(VIEW_BUILDERS)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    register_views(wh, ["v_provider_rankings"])
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs  # defining a view runs nothing
    assert spark.sql("SELECT * FROM v_provider_rankings").count() == 2
    month(1, 2).write.mode("append").parquet(path)
    wh = Warehouse(spark, silver=spark.read.schema(schema).parquet(path))
    register_views(wh, ["v_provider_rankings"])
    got = {r.provider_id: r.national_rank_hppd for r in spark.sql("SELECT * FROM v_provider_rankings").collect()}
    assert got == {"000002": 1, "000001": 2, "000000": 3}
