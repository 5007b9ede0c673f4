"""Gold from mergeable state equals gold rebuilt in full; refreshes from changes; versions; distinct counts and sketches."""

import random

import pytest
from pyspark.sql import functions as F

from shiftlens.operators import distinct
from shiftlens.operators.silver import to_silver
from shiftlens.plans import jobs, quarter_state as T, serving as Q
from shiftlens.plans.warehouse import GOLD_TABLES, Warehouse
from shiftlens.session import scratch_dir
from shiftlens.sources.sinks import MaterializedView, RefreshConflict, write_silver

from helpers import hours, raw_frame


def reports(spark, quarter, month, seed, providers=12, days=25):
    r, rows = random.Random(seed), []
    for p in range(providers):
        for d in r.sample(range(1, 29), days):
            rows.append({"PROVNUM": f"{p:06d}", "PROVNAME": r.choice(["A", "B"]) if p % 3 == 0 else "N", "STATE": "al" if p % 4 else "tx",
                         "CITY": f"C{p % 5}", "CY_Qtr": quarter, "WorkDate": f"2024{month + d % 3:02d}{d:02d}",
                         "MDScensus": r.choice(["", "0", "12", "55", "80"]), **hours(r.randint(0, 90) / 4, 7.5, r.randint(0, 400) / 8, 2.5)})
    return to_silver(raw_frame(spark, rows))


def same(a, b, drop=("processed_at",)):
    cols = sorted(set(a.columns) - set(drop))
    assert cols == sorted(set(b.columns) - set(drop))
    key = lambda df: sorted(map(str, df.select(*cols).collect()))
    assert key(a) == key(b)


@pytest.fixture(scope="module")
def loaded(spark):
    base = scratch_dir(spark, "quarters-test")
    write_silver(reports(spark, "2024Q2", 4, 1), f"{base}/silver")
    T.load_quarter(spark, f"{base}/silver", f"{base}/gold", "2024Q2")
    write_silver(reports(spark, "2024Q3", 7, 2, providers=15), f"{base}/silver")
    T.load_quarter(spark, f"{base}/silver", f"{base}/gold", "2024Q3")
    return base


def full(spark, base):
    out = scratch_dir(spark, "rebuilt")
    jobs.run_silver_to_gold(spark, f"{base}/silver", out)
    return Warehouse.from_gold(spark, out, f"{base}/silver")


def test_two_loads_equal_a_full_rebuild(spark, loaded):
    rebuilt, merged = full(spark, loaded), Warehouse.from_gold(spark, f"{loaded}/gold")
    for name in GOLD_TABLES:
        same(merged.table(name), rebuilt.table(name))
    same(merged.materialized("mv_staffing_summary"), Q.mv_staffing_summary(rebuilt))


def test_a_load_reads_its_own_quarter_only(spark, loaded):
    silver = spark.read.parquet(f"{loaded}/silver").where(F.col("cy_qtr") == "2024Q3")
    for fold in T.FOLDS.values():
        plan = fold(silver)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(cy_qtr" in plan and "SortAggregate" not in plan
    files = spark.read.parquet(f"{loaded}/gold/facts").where("cy_qtr = '2024Q2'").select("_metadata.file_modification_time").distinct()
    newest = files.agg(F.max("file_modification_time")).first()[0]
    T.load_quarter(spark, f"{loaded}/silver", f"{loaded}/gold", "2024Q3")  # again: the same result, other files untouched
    assert files.agg(F.max("file_modification_time")).first()[0] == newest
    with pytest.raises(ValueError):
        T.load_quarter(spark, f"{loaded}/silver", f"{loaded}/gold", "2031Q1")


def test_a_reload_replaces_its_quarter_and_survives_being_killed_before_the_refresh(spark, monkeypatch):
    base = scratch_dir(spark, "reload-test")
    write_silver(reports(spark, "2024Q2", 4, 5), f"{base}/silver")
    write_silver(reports(spark, "2024Q3", 7, 6), f"{base}/silver")
    for quarter in ("2024Q2", "2024Q3"):
        T.load_quarter(spark, f"{base}/silver", f"{base}/gold", quarter)
    # the quarter comes again without its last month; the first attempt dies before the view is refreshed
    write_silver(reports(spark, "2024Q3", 7, 7, providers=9).where("month(work_date) < 9"), f"{base}/silver")
    real = T.refresh_summary
    monkeypatch.setattr(T, "refresh_summary", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        T.load_quarter(spark, f"{base}/silver", f"{base}/gold", "2024Q3")
    monkeypatch.setattr(T, "refresh_summary", real)
    T.load_quarter(spark, f"{base}/silver", f"{base}/gold", "2024Q3")
    rebuilt, merged = full(spark, base), Warehouse.from_gold(spark, f"{base}/gold")
    for name in ("agg_provider_monthly", "agg_state_monthly", "dim_provider_history", "provider_monthly_summary"):
        same(merged.table(name), rebuilt.table(name))
    same(merged.materialized("mv_staffing_summary"), Q.mv_staffing_summary(rebuilt))
    assert merged.materialized("mv_staffing_summary").where("month = 9").count() == 0


def test_a_refresh_computes_the_changed_months_only(spark, loaded):
    view = MaterializedView(spark, f"{loaded}/gold/serving/mv_staffing_summary", None)
    before = {(r.state, r.month): r for r in view.read().collect()}
    T._touch(spark, f"{loaded}/gold", "2024Q3")
    state = T.read_state(spark, f"{loaded}/gold", "provider_month").withColumn("n", F.col("n") + 1000)
    real, T.read_state = T.read_state, lambda *a: state if a[2] == "provider_month" else real(*a)
    try:
        T.refresh_summary(spark, f"{loaded}/gold")
    finally:
        T.read_state = real
    for r in view.read().collect():
        old = before[r.state, r.month].record_count
        assert r.record_count > old if r.month >= 7 else r.record_count == old


def test_versions_are_numbered_conflicts_raise_and_killed_refreshes_are_cleared(spark):
    path = scratch_dir(spark, "versions")
    mv = MaterializedView(spark, path, lambda: spark.range(3))
    mv.refresh()

    def with_rival():
        MaterializedView(spark, path, lambda: spark.range(8)).refresh()  # commits while this one is computing
        return spark.range(5)

    with pytest.raises(RefreshConflict):
        MaterializedView(spark, path, with_rival).refresh()
    assert mv.read().count() == 8
    killed = MaterializedView(spark, path, lambda: spark.range(9))
    killed._commit = lambda *a: (_ for _ in ()).throw(KeyboardInterrupt())
    with pytest.raises(KeyboardInterrupt):
        killed.refresh()
    assert mv.read().count() == 8  # written, never committed
    mv.refresh()
    assert mv.read().count() == 3 and [int(v[:15]) for v in mv.versions()] == [2, 3]
    folders = {r.path.split("version=")[1].split("/")[0] for r in spark.read.format("binaryFile")
               .option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select("path").collect()}
    assert folders == set(mv.versions())


def test_numbers_are_dense_and_stay(spark, loaded):
    ids = spark.range(1000).select(F.format_string("%05d", "id").alias("k"))
    first = distinct.numbered(ids, "k", bucket_keys=64)
    assert sorted(r.number for r in first.collect()) == list(range(1, 1001))
    more = distinct.numbered(spark.range(5).select(F.col("id").cast("string").alias("k")), "k", after=1000)
    assert sorted(r.number for r in more.collect()) == list(range(1001, 1006))
    assert distinct.numbered(ids.limit(0), "k").count() == 0
    numbers = spark.read.parquet(f"{loaded}/gold/{T.NUMBERS}")
    assert sorted(r.number for r in numbers.collect()) == list(range(1, 16))


def test_united_bitmaps_count_once(spark):
    rows = spark.range(200_000).select((F.col("id") % 7).alias("g"), (F.col("id") % 90_000 + 1).alias("number"))
    sets = distinct.bitmaps(rows, ["g"])
    assert sets.agg(F.max(F.length("providers"))).first()[0] <= 4096
    want = {r.g: r.n for r in rows.groupBy("g").agg(F.count_distinct("number").alias("n")).collect()}
    assert {r.g: r.providers for r in distinct.count_united(sets, ["g"]).collect()} == want
    halves = sets.withColumn("h", F.col("g") < 3)
    want = {r.h: r.n for r in rows.groupBy((F.col("g") < 3).alias("h")).agg(F.count_distinct("number").alias("n")).collect()}
    assert {r.h: r.providers for r in distinct.count_united(halves, ["h"]).collect()} == want


def test_sketches_keep_their_bounds_after_merging(spark):
    rows = spark.range(60_000).select((F.col("id") % 12).alias("month"), F.lit("s").alias("state"), (F.col("id") % 20_000).cast("string").alias("p"),
                                      F.round(F.randn(3) * 2 + 4, 2).alias("v"))
    rows = rows.union(spark.createDataFrame([(0, "empty", "p", None)], "month long, state string, p string, v double")).checkpoint()
    found = distinct.sketches(rows, ["state", "month"], "p", "v")
    exact = rows.groupBy("state").agg(F.count_distinct("p").alias("providers"))
    counts = rows.groupBy("state", "v").agg(F.count(F.lit(1)).alias("n"))
    told = distinct.check(found, counts, exact, "state", "v", (0.01, 0.25, 0.5, 0.75, 0.99)).collect()
    assert len(told) == 5 and all(r.rank_ok and r.members_ok for r in told)
    got = {r.state: r for r in distinct.approximate(distinct.combined(found, ["state"]), ["state"]).collect()}
    assert got["empty"].quantiles is None and got["empty"].members == 1
    assert abs(got["s"].members - 20_000) <= 0.05 * 20_000
