"""Raw landing, scanning, routing, inventory, jobs and incremental ingest."""

import pytest
from pyspark.sql import functions as F

from shiftlens.plans import jobs as J
from shiftlens.session import scratch_dir
from shiftlens.sources.bronze import EmptySourceError, land_raw, raw_inventory, read_raw, route_files
from shiftlens.sources.sinks import MaterializedView
from shiftlens.streaming.incremental import run_incremental_silver

from conftest import SF_SMALL
from helpers import raw_frame

# File router fixture (names as the upload tool receives them).
ROUTES = [
    ("PBJ_Daily_Nurse_Staffing_Q2_2024.csv", "nursing_staffing", "2024Q2"),
    ("PBJ_Daily_Nurse_Staffing_Q1_2024.csv", "nursing_staffing", "2024Q1"),
    ("PBJ_Daily_Nurse_Staffing_Q3_2024.csv", "nursing_staffing", "2024Q3"),
    ("PBJ_Daily_Nurse_Staffing_Q4_2023.csv", "nursing_staffing", "2023Q4"),
    ("PBJ_Daily_Nurse_Staffing.csv", "nursing_staffing", "2024Q2"),
    ("NH_ProviderInfo_Oct2024.csv", "supporting/provider_info", None),
    ("NH_QualityMsr_MDS_Oct2024.csv", "supporting/quality_mds", None),
    ("NH_QualityMsr_Claims_Oct2024.csv", "supporting/quality_claims", None),
    ("NH_HealthCitations_Oct2024.csv", "supporting/health_citations", None),
    ("NH_FireSafetyCitations_Oct2024.csv", "supporting/fire_citations", None),
    ("NH_Penalties_Oct2024.csv", "supporting/penalties", None),
    ("NH_Ownership_Oct2024.csv", "supporting/ownership", None),
    ("NH_StateUSAverages_Oct2024.csv", "supporting/state_averages", None),
    ("NH_SurveyInfo_Oct2024.csv", "supporting/survey_info", None),
    ("NH_InfectionControlViol_Oct2024.csv", "supporting/infection_control", None),
    ("NH_CovidVaxProvider_Oct2024.csv", "supporting/covid_vax", None),
    ("readme.csv", "other", None),
]


def test_route_files(spark):
    df = spark.createDataFrame([(n,) for n, _, _ in ROUTES], "file_name string")
    got = {r.file_name: r for r in route_files(df, ingest_date=F.lit("2024-07-01")).collect()}
    for name, cat, q in ROUTES:
        r = got[name]
        assert (r.category, r.cy_qtr) == (cat, q), name
        prefix = f"raw/{cat}/" + (f"cy_qtr={q}/" if q else "") + "ingest_date=2024-07-01/"
        assert r.key == prefix + name


def test_empty_raw_folder_raises_with_path(spark, tmp_path):
    p = tmp_path / "empty"
    p.mkdir()
    (p / "f.csv").write_text(",".join(["PROVNUM", "STATE"]) + "\n")
    with pytest.raises(EmptySourceError, match=str(p)):
        read_raw(spark, str(p))


def test_second_quarter_keeps_first_and_relanding_is_idempotent(spark):
    base = scratch_dir(spark, "quarters")
    q2 = raw_frame(spark, [{"CY_Qtr": "2024Q2", "PROVNUM": "000001"}])
    q3 = raw_frame(spark, [{"CY_Qtr": "2024Q3", "WorkDate": "20240701", "PROVNUM": "000001"}])
    land_raw(q2, base, "2024-07-01")
    land_raw(q3, base, "2024-10-01")
    land_raw(q3, base, "2024-10-01")  # same batch again: replaced, not duplicated
    p = J.pipeline_paths(base)
    J.run_raw_to_silver(spark, p["raw"], p["silver"])
    got = sorted((r.cy_qtr, r.state) for r in spark.read.parquet(p["silver"]).collect())
    assert got == [("2024Q2", "AL"), ("2024Q3", "AL")]
    # re-running the silver job leaves the same rows
    J.run_raw_to_silver(spark, p["raw"], p["silver"])
    assert spark.read.parquet(p["silver"]).count() == 2


def test_pipeline_counts_and_run_log(spark):
    base = scratch_dir(spark, "pipeline")
    log = {r.stage: r for r in J.run_pipeline(spark, SF_SMALL, base).collect()}
    assert all(r.status == "SUCCEEDED" for r in log.values())
    p = J.pipeline_paths(base)
    silver = spark.read.parquet(p["silver"])
    fact = spark.read.parquet(f"{p['gold']}/facts")
    assert log["raw_to_silver"].rows == silver.count() == fact.count() == 910
    inv = raw_inventory(spark, p["raw"]).first()
    assert inv.file_count >= 1 and inv.total_bytes > 0
    # the refreshed materialized view is what the gold-mode warehouse serves
    from shiftlens.plans.warehouse import Warehouse
    wh = Warehouse.from_gold(spark, p["gold"], p["silver"])
    stored = wh.materialized("mv_staffing_summary")
    assert "version=" in stored.inputFiles()[0] and stored.count() == log["refresh_views"].rows - \
        wh.materialized("mv_provider_rankings").count()


def test_pipeline_stops_at_first_failure(spark):
    log = J.run_pipeline(spark, "/nonexistent/sf", scratch_dir(spark, "failing")).collect()
    assert [r.status for r in log] == ["FAILED", "SKIPPED", "SKIPPED", "SKIPPED"]


def test_incremental_ingest_processes_new_files_once(spark):
    base = scratch_dir(spark, "stream")
    ckpt, out = f"{base}/_ckpt", f"{base}/silver"
    land_raw(raw_frame(spark, [{"PROVNUM": "000001"}]), base, "2024-07-01")
    p = J.pipeline_paths(base)
    assert run_incremental_silver(spark, p["raw"], out, ckpt).count() == 1
    land_raw(raw_frame(spark, [{"PROVNUM": "000002"}, {"PROVNUM": "000003"}]), base, "2024-07-02")
    assert run_incremental_silver(spark, p["raw"], out, ckpt).count() == 3
    assert run_incremental_silver(spark, p["raw"], out, ckpt).count() == 3  # nothing new


def test_materialized_view_refresh_versions(spark):
    counter = {"n": 1}
    mv = MaterializedView(spark, scratch_dir(spark, "mv"), lambda: spark.range(counter["n"]))
    assert mv.read().count() == 1
    counter["n"] = 5
    mv.refresh()
    assert mv.read().count() == 5 and len(mv.versions()) == 2
    counter["n"] = 7
    mv.refresh()
    assert mv.read().count() == 7 and len(mv.versions()) == 2  # oldest version pruned


def test_uploaded_file_keeps_its_own_quarter(spark, tmp_path):
    """Upstream-style upload: the whole CSV (with CY_Qtr) under a cy_qtr= folder.
    A wrong folder must not relabel the rows."""
    from shiftlens import config as C
    from shiftlens.operators.silver import to_silver
    folder = tmp_path / "raw" / "nursing_staffing" / "cy_qtr=2024Q2" / "ingest_date=2024-07-01"
    folder.mkdir(parents=True)
    cols = C.raw_columns()
    vals = {c: "1.0" for c in C.raw_hour_columns()}
    vals.update({"PROVNUM": "015001", "PROVNAME": "X", "CITY": "C", "STATE": " al ", "COUNTY_NAME": "B",
                 "COUNTY_FIPS": "1013", "CY_Qtr": "2024Q1", "WorkDate": "20240401", "MDScensus": "10"})
    (folder / "PBJ_Daily_Nurse_Staffing_Q2_2024.csv").write_text(
        ",".join(cols) + "\n" + ",".join(vals[c] for c in cols) + "\n")
    raw = read_raw(spark, str(tmp_path / "raw" / "nursing_staffing"))
    r = to_silver(raw).first()
    assert (r.cy_qtr, r.state, r.ingest_date, r.total_nursing_hours) == ("2024Q1", "AL", "2024-07-01", 3.0)


def test_missing_quarter_column_uses_file_name(spark):
    from shiftlens import config as C
    base = scratch_dir(spark, "byname")
    cols = [c for c in C.raw_columns() if c != "CY_Qtr"]
    land_raw(raw_frame(spark, [{}], cols), base, "2024-10-01", file_name="PBJ_Daily_Nurse_Staffing_Q3_2024.csv")
    assert read_raw(spark, J.pipeline_paths(base)["raw"]).first().cy_qtr == "2024Q3"


def test_gold_job_twice_gives_same_data(spark):
    """Idempotence: rebuilding gold from the same silver gives the same rows (modulo processed_at)."""
    base = scratch_dir(spark, "idem")
    p = J.pipeline_paths(base)
    J.land_panel(spark, SF_SMALL, base, "2024-07-01")
    J.run_raw_to_silver(spark, p["raw"], p["silver"])
    snaps = []
    for _ in range(2):
        J.run_silver_to_gold(spark, p["silver"], p["gold"])
        snap = {}
        for t in ("facts", "dimensions/dim_provider", "aggregates/agg_state_monthly"):
            df = spark.read.parquet(f"{p['gold']}/{t}")
            df = df.drop("processed_at") if "processed_at" in df.columns else df
            snap[t] = sorted(map(tuple, df.collect()), key=str)
        snaps.append(snap)
    assert snaps[0] == snaps[1]


def test_cli_pipeline_and_jobs(spark, capsys):
    import json
    from shiftlens.__main__ import main
    base = scratch_dir(spark, "cli")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                          "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        _cli_checks(spark, capsys, main, base)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _cli_checks(spark, capsys, main, base):
    import json
    assert main(["pipeline", "--sf-dir", SF_SMALL, "--base", base]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["raw_to_silver"] == {"status": "SUCCEEDED", "rows": 910}
    p = J.pipeline_paths(base)
    assert main(["silver-to-gold", "--silver", p["silver"], "--gold", base + "/gold2"]) == 0
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts["facts"] == 910 and counts["dim_date"] == 91


def test_shuffle_partitions_sized_from_input(spark):
    from shiftlens.session import input_bytes, size_shuffle_partitions
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        size = input_bytes(spark, [f"{SF_SMALL}/lineitem.parquet"])
        assert size > 0
        n = size_shuffle_partitions(spark, [f"{SF_SMALL}/lineitem.parquet"], target_bytes=max(1, size // 10), minimum=1)
        assert 10 <= n <= 11 and spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_session_without_checkpoint_dir_setting(tmp_path):
    """A cluster session that names no spark.checkpoint.dir: the library must not try to set
    that (immutable) conf, and checkpointing queries still run. Separate process, empty
    Spark defaults."""
    import os
    import subprocess
    import sys
    conf_dir = tmp_path / "conf"
    conf_dir.mkdir()
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false').getOrCreate()\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "import __spark_entry__ as E\n"
        "print('RESULT', E.queries()['v_provider_rankings'](spark, %r).count())\n"
    ) % (os.path.dirname(os.path.dirname(os.path.abspath(__file__))), SF_SMALL)
    env = dict(os.environ, SPARK_CONF_DIR=str(conf_dir))
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=600)
    assert "RESULT 9" in out.stdout, out.stderr[-2000:]


def test_incremental_ingest_resumes_after_a_stopped_run_without_duplicates(spark):
    """A run stopped after its first micro-batch (one file per batch) and restarted from the
    same checkpoint ends with every record exactly once."""
    import time
    from shiftlens.streaming.incremental import start_incremental_silver
    base = scratch_dir(spark, "resume")
    for day, ids in enumerate([["000001", "000002"], ["000003"], ["000004", "000005", "000006"]]):
        land_raw(raw_frame(spark, [{"PROVNUM": i} for i in ids]), base, f"2024-07-0{day + 1}")
    p = J.pipeline_paths(base)
    ckpt, out = f"{base}/_ckpt", f"{base}/silver"
    q = start_incremental_silver(spark, p["raw"], out, ckpt, max_files_per_trigger=1)
    deadline = time.time() + 120
    while not q.recentProgress and q.isActive and time.time() < deadline:
        time.sleep(0.2)
    q.stop()  # interrupted run
    done = run_incremental_silver(spark, p["raw"], out, ckpt)
    ids = sorted(r.provnum for r in done.select("provnum").collect())
    assert ids == ["000001", "000002", "000003", "000004", "000005", "000006"]


def test_failed_refresh_keeps_previous_version_readable(spark):
    state = {"fail": False}

    def definition():
        df = spark.range(3)
        return df.select(F.when(F.lit(state["fail"]), F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))

    mv = MaterializedView(spark, scratch_dir(spark, "mvfail"), definition)
    mv.refresh()
    state["fail"] = True
    with pytest.raises(Exception):
        mv.refresh()
    assert sorted(r.id for r in mv.read().collect()) == [0, 1, 2] and len(mv.versions()) == 1
