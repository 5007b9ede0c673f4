"""Row-wise rounding and exact sums without decimals give what the decimals give; the quarters' panel is built once."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from shiftlens.functions import partials as P
from shiftlens.functions.rounding import SUM_TYPE, decimal_sum, half_up, round_ratio, stable_round
from shiftlens.plans import quarter_state, registry
from shiftlens.sources.panel import facility_days, panel_of

VALUES = [None, 0.0, -0.0, 0.005, 0.015, 1.005, 2.675, -1.005, -0.001, 0.285, 0.49999999999999994, 0.5, 1.5, 2.5, -0.5, -2.5, 7.000000000000001,
          28.999999999999996, 0.1 + 0.2, 1 / 3, 0.0000005, 123456.7890125, 99999.999999, 100000.000001, 1e6, 12345678.905, 1e9, 98765432101.5, 3e13]


def _decimal_ratio(part, places, of, percent):
    ratio = stable_round(part, places) / of
    return stable_round(ratio * F.lit(100.0) if percent else ratio, 2)


def test_round_ratio_is_stable_round_twice(spark):
    of = [1.0, 3.0, 7.0, 0.3, 16.0, 1000.0]
    rows = spark.createDataFrame([(a, b) for a in VALUES for b in of], "a double, b double")
    b, a = F.col("b"), F.col("a")
    wrong = rows.select("a", "b", *[f(a, n, b, p).alias(f"{k}{n}{p}") for n, p in ((2, False), (4, True))
                                    for k, f in (("new", round_ratio), ("old", _decimal_ratio))])
    assert wrong.where("NOT (new2False <=> old2False AND new4True <=> old4True)").collect() == []
    signs = wrong.select(F.concat_ws(",", "new2False", "new4True").alias("new"), F.concat_ws(",", "old2False", "old4True").alias("old"))
    assert signs.where("new <> old").collect() == []  # no -0.0 either


def test_half_up_is_round(spark):
    rows = spark.createDataFrame([(v,) for v in VALUES], "a double").select(half_up(F.col("a")).alias("n"), F.round("a").alias("o"))
    assert rows.where("NOT n <=> o").collect() == []


def test_decimal_sums(spark):
    rows = spark.createDataFrame([(i % 4, v) for i, v in enumerate(VALUES + [-v for v in VALUES if v] + [None, None])] + [(9, None)], "g int, v double")
    got = rows.groupBy("g").agg(decimal_sum("v").alias("n"), F.sum(F.col("v").cast(SUM_TYPE)).alias("o"), *P.sums("v", "g"))
    assert got.schema["n"].dataType == got.schema["o"].dataType == got.schema["_s_v"].dataType == got.schema["_s_g"].dataType
    assert got.where("NOT (n <=> o AND _s_v <=> o AND _s_g <=> CAST(g * 15 AS decimal(30,6))) AND g <> 9 AND _n_g = 15").collect() == []
    assert got.where("NOT n <=> o").collect() == [] and got.where("g = 9 AND n IS NULL").count() == 1


@pytest.fixture
def inputs(spark, tmp_path):
    """Few line items of three suppliers."""
    d = str(tmp_path)
    spark.sql("""SELECT CAST(1 + id % 3 AS bigint) AS l_suppkey, CAST(id % 50 AS double) AS l_quantity, id % 11 / 100D AS l_discount,
                 id % 9 / 100D AS l_tax, 'R' AS l_returnflag, timestamp_ntz'1995-01-01' + make_interval(0, 0, 0, CAST(id AS int)) AS l_shipdate
                 FROM range(200)""").write.parquet(f"{d}/lineitem.parquet")
    spark.sql("SELECT CAST(id AS bigint) AS s_suppkey, concat('S', id) AS s_name, 1 AS s_nationkey FROM range(1, 4)").write.parquet(f"{d}/supplier.parquet")
    spark.sql("SELECT 1 AS n_nationkey, 'N' AS n_name, 1 AS n_regionkey").write.parquet(f"{d}/nation.parquet")
    spark.sql("SELECT 1 AS r_regionkey, 'R' AS r_name").write.parquet(f"{d}/region.parquet")
    return d


def test_quarters_read_the_line_items_once(spark, inputs, monkeypatch):
    """Both quarters' silver is made from one stored panel."""
    read, plain = [], registry.write_silver
    monkeypatch.setattr(registry, "write_silver", lambda df, path: read.append(df.inputFiles()) or plain(df, path))
    kpi = registry.QUARTER_QUERIES["quarters_kpi_summary"](spark, inputs).collect()
    assert len(read) == 2 and not [f for files in read for f in files if "lineitem.parquet" in os.path.dirname(f)]
    reach = registry.QUARTER_QUERIES["monthly_provider_reach"](spark, inputs).collect()
    assert kpi[0].total_providers == 3 and {r.providers for r in reach} == {2, 3}


def test_quarters_store_the_sums_of_line_items(spark, inputs, monkeypatch):
    """What is stored for both quarters is a narrow row a facility-day, and the panel made from it is the panel."""
    stored, plain = [], registry.write_table
    monkeypatch.setattr(registry, "write_table", lambda df, path, *a: stored.append((df.columns, path)) or plain(df, path, *a))
    registry._QUARTERS.pop((spark.sparkContext.applicationId, inputs), None)
    registry._quarters_gold(spark, inputs)
    (columns, path), = stored
    assert len(columns) <= 13 and not [c for c in columns if c.startswith("hrs_")]
    panel, made = facility_days(spark, inputs), panel_of(spark.read.parquet(path))
    assert made.dtypes == panel.dtypes and made.exceptAll(panel).isEmpty() and panel.exceptAll(made).isEmpty() and not panel.isEmpty()


def test_decimal_sums_of_noisy_doubles(spark):
    """Sums of hours are a little off their decimals; they add up as the decimals do, without going through them."""
    rows = spark.range(20000).select((F.col("id") % 7).alias("g"), (F.col("id") * 0.1 + (F.col("id") % 13) * 0.07 - 500).alias("v"))
    got = rows.groupBy("g").agg(decimal_sum("v").alias("n"), F.sum(F.col("v").cast(SUM_TYPE)).alias("o"))
    assert got.where("NOT n <=> o").collect() == [] and got.count() == 7
    scaled = F.col("v") * 1e6  # next to no tie, so no row takes the decimal way
    assert rows.where(F.abs(scaled - F.rint(scaled)) >= 0.4999).isEmpty() and not rows.where(F.rint(scaled) / 1e6 != F.col("v")).isEmpty()


def test_state_months_add_up_without_a_row_a_provider(spark):
    """Providers are counted once, nulls not at all; no exchange by provider carries more than its key and its days."""
    rows = [("A", 2024, 4, "p1", "n", 2, 5.0, 0), ("A", 2024, 4, "p1", "m", 3, 7.0, 1), ("A", 2024, 4, "p2", "n", 1, 1.0, 0),
            ("A", 2024, 4, None, "n", 4, 2.0, 4), ("A", 2024, 5, "p1", "n", 1, 9.0, 1), (None, None, None, "p3", "n", 6, 3.0, 6)]
    state = spark.createDataFrame(rows, "state string, year int, month int, provnum string, provname string, n long, max_ratio double, c_n long")
    out = quarter_state._by_state_month(state)
    got = {(r.state, r.year, r.month): (r.providers, r.c_providers, r.n, r.max_ratio, r.c_n) for r in out.collect()}
    assert got == {("A", 2024, 4): (2, 1, 10, 7.0, 5), ("A", 2024, 5): (1, 1, 1, 9.0, 1), (None, None, None): (1, 1, 6, 3.0, 6)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    by_provider = [x for x in plan.splitlines() if "Aggregate [" in x and "provnum" in x.split("]")[0]]
    assert len(by_provider) == 1 and "max_ratio" not in by_provider[0]
