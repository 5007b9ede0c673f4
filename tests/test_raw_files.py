"""Headers per file, reading by column name, rejected rows, catalog tables over stored folders, top-k rankings."""

import pytest
from pyspark.sql import functions as F

from shiftlens import config as C
from shiftlens.operators import quarantine as QU
from shiftlens.operators.silver import to_silver
from shiftlens.plans import metrics as M, serving as Q
from shiftlens.session import scratch_dir
from shiftlens.sources.bronze import EmptySourceError
from shiftlens.sources.headers import files_by_header, read_headers, read_raw_by_name, schema_check
from shiftlens.sources.sinks import create_external_tables, recover_partitions, write_table

from helpers import hours, raw_frame


def put(spark, path, text):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()


NEEDED = "PROVNUM,STATE,WorkDate,MDScensus,Hrs_RN,Hrs_LPN,Hrs_CNA"


def test_headers_and_reading_by_name(spark):
    base = scratch_dir(spark, "headers")
    put(spark, f"{base}/cy_qtr=2024Q2/ingest_date=2024-07-01/a.csv", NEEDED + "\n1,al,20240401,10,1.5,2,3\n")
    put(spark, f"{base}/cy_qtr=2024Q2/ingest_date=2024-07-01/b.csv",
        "\ufeffhrs_cna,hrs_lpn,hrs_rn,mdscensus,workdate,state,provnum,extra\r\n6,5,4.5,20,20240402,tx,2,\"x, y\"\r\n")
    put(spark, f"{base}/cy_qtr=2024Q2/ingest_date=2024-07-01/_SUCCESS", "")
    rows = {(r.PROVNUM, r.STATE, r.WorkDate, r.MDScensus, r.Hrs_RN, r.Hrs_CNA, r.extra, r.cy_qtr) for r in read_raw_by_name(spark, base).collect()}
    assert rows == {("1", "al", "20240401", "10", "1.5", "3", None, "2024Q2"), ("2", "tx", "20240402", "20", "4.5", "6", "x, y", "2024Q2")}
    assert to_silver(read_raw_by_name(spark, base)).agg(F.sum("total_nursing_hours")).first()[0] == 22.0
    assert files_by_header(spark, base).count() == 2
    put(spark, f"{base}/cy_qtr=2024Q2/ingest_date=2024-07-02/c.csv", "PROVNUM,STATE\n3,ny\n")
    put(spark, f"{base}/cy_qtr=2024Q2/ingest_date=2024-07-02/d.csv", "")
    told = {r.file.rsplit("/", 1)[1]: r for r in schema_check(spark, base).collect()}
    assert told["a.csv"].ok and told["a.csv"].same_order and not told["b.csv"].same_order and told["b.csv"].unknown == ["extra"]
    assert told["c.csv"].missing == ["workdate", "mdscensus", "hrs_rn", "hrs_lpn", "hrs_cna"] and not told["c.csv"].ok
    assert told["d.csv"].missing == C.REQUIRED_COLUMNS and told["d.csv"].columns == 0
    with pytest.raises(ValueError, match="c.csv.*hrs_cna"):
        read_raw_by_name(spark, base)
    assert read_raw_by_name(spark, base, skip_bad=True).count() == 2


def test_headers_of_nothing_and_of_a_file_without_lines(spark):
    base = scratch_dir(spark, "headers")
    with pytest.raises(EmptySourceError):
        read_raw_by_name(spark, base)
    assert schema_check(spark, base).count() == 0
    put(spark, f"{base}/a.csv", "x" * 70_000)
    with pytest.raises(ValueError, match="no header line"):
        read_headers(spark, [f"{base}/a.csv"])
    twice = scratch_dir(spark, "headers")
    put(spark, f"{twice}/a.csv", NEEDED + ",hrs_rn\n1,al,20240401,10,1,2,3,4\n")
    with pytest.raises(ValueError, match="named twice"):
        read_raw_by_name(spark, twice)


def test_rejected_rows_are_kept_with_reasons(spark):
    rows = [{**hours(8)}, {"PROVNUM": " ", **hours(8)}, {"WorkDate": "", **hours(8)}, {"WorkDate": "20241301", "PROVNUM": None, **hours(8)},
            {**hours(8), "Hrs_RN": "abc", "MDScensus": "x1"}, {**hours(8), "Hrs_LPN": "", "MDScensus": None}]
    checked = QU.checked_silver(raw_frame(spark, rows))
    path = scratch_dir(spark, "checked")
    assert QU.write_checked(checked, path) == {"read": 6, "rejected": 3, "rescued": 2, "no provider": 2, "no date": 1, "bad date": 1}
    good, bad = QU.good(spark, path), QU.quarantined(spark, path)
    assert good.count() == 3 and bad.count() == 3
    assert [dict(r.rescued) for r in good.where("rescued IS NOT NULL").collect()] == [{"hrs_rn": "abc", "mdscensus": "x1"}]
    assert sorted((tuple(r.reject_reasons), dict(r.rescued or {})) for r in bad.collect()) == [
        (("no date",), {}), (("no provider",), {}), (("no provider", "bad date"), {"workdate": "20241301"})]
    plain = to_silver(raw_frame(spark, rows))
    same = [c for c in plain.columns if c != "processed_at"]
    assert sorted(map(str, checked.select(*same).collect())) == sorted(map(str, plain.select(*same).collect()))
    assert {r["column"]: r["values"] for r in QU.rescue_counts(checked).collect()} == {"hrs_rn": 1, "mdscensus": 1, "workdate": 1}
    assert QU.write_checked(checked.limit(0), scratch_dir(spark, "checked"))["read"] == 0


def test_catalog_tables_are_read_by_other_sessions_and_know_their_partitions(spark):
    base, database = scratch_dir(spark, "external"), "staffing_test"
    df = spark.range(100).select("id", (F.col("id") % 4).cast("string").alias("state"), F.lit(1.5).alias("v"))
    write_table(df, f"{base}/facts", ["state"])
    write_table(df, f"{base}/plain")
    try:
        assert create_external_tables(spark, database, base, {"facts": "facts", "plain": "plain", "absent": "absent"}) == [
            f"{database}.facts", f"{database}.plain"]
        other = spark.newSession()
        one = other.sql(f"SELECT * FROM {database}.facts WHERE state = '3'")
        assert one.count() == 25 and other.table(f"{database}.plain").count() == 100
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(state" in plan and "CatalogFileIndex" in plan or "1 paths" in plan
        # a later load adds a partition folder
        df.where("id < 10").drop("state").write.parquet(f"{base}/facts/state=9")
        assert other.table(f"{database}.facts").where("state = '9'").count() == 0
        recover_partitions(spark, f"{database}.facts")
        assert spark.newSession().table(f"{database}.facts").where("state = '9'").count() == 10
        assert [r[0] for r in other.sql(f"SHOW PARTITIONS {database}.facts").collect()] == [f"state={s}" for s in "01239"]
        create_external_tables(spark, database, base, {"facts": "facts"})  # again: replaced, files kept
        assert other.table(f"{database}.facts").count() == 110
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


class Months:
    def __init__(self, spark, rows):
        self.spark = spark
        self.rows = spark.createDataFrame(rows, "provider_id string, state string, days_reported long, avg_daily_census double, avg_hppd double, "
                                                "avg_rn_mix_pct double, avg_contract_pct double, critical_days long")

    def provider_monthly(self):
        return self.rows


def test_top_rankings_equal_the_first_rows_of_the_ranking_view(spark):
    rows = [(f"p{i}", "ab"[i % 2] if i % 9 else None, 30, 10.0, [None, 4.1, 4.1, 3.0, 5.25][i % 5], [None, 12.5, 7.0][i % 3], [0.0, None, 1.5, 9.0][i % 4], i % 3)
            for i in range(60)] + [("few", "a", 29, 1.0, 99.0, 1.0, 1.0, 0)]
    for given in (rows, rows[:7], rows[:1], rows[-1:], [r for r in rows if r[4] is None]):
        wh = Months(spark, given)
        want = M.v_provider_rankings(wh.rows).orderBy("national_rank_hppd", *Q.RANKING_ORDER).limit(10)
        got = Q.rankings_top10(wh)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
