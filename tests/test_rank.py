"""The scalable rank operator equals the built-in RANK / PERCENT_RANK."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from shiftlens.operators.rank import add_ranks, rank_table_by_ranges


def _frame(spark, n, seed, with_nulls):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = round(rnd.uniform(0, 8), 2) if rnd.random() > 0.1 else round(rnd.choice([1.0, 2.5, 3.33]), 2)
        if with_nulls and rnd.random() < 0.05:
            v = None
        rows.append((i, rnd.choice(["A", "B", "C", "D"]), v))
    return spark.createDataFrame(rows, "id long, grp string, v double")


@pytest.mark.parametrize("n,seed,nulls", [(1, 1, False), (30, 2, False), (300, 3, True), (3000, 4, True)])
def test_rank_matches_builtin(spark, n, seed, nulls):
    df = _frame(spark, n, seed, nulls)
    got = add_ranks(df, [
        dict(value="v", partition_by=["grp"], rank_desc="r_grp_desc"),
        dict(value="v", partition_by=["grp"], rank_asc="r_grp_asc"),
        dict(value="v", rank_desc="r_all", percent_rank_asc="pr_all"),
    ], bucket_width=0.5)
    wg = Window.partitionBy("grp")
    exp = df.select(
        "id",
        F.rank().over(wg.orderBy(F.col("v").desc_nulls_last())).cast("bigint").alias("r_grp_desc"),
        F.rank().over(wg.orderBy(F.col("v").asc_nulls_last())).cast("bigint").alias("r_grp_asc"),
        F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())).cast("bigint").alias("r_all"),
        F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_last())).alias("pr_all"),
    )
    a = {r.id: tuple(r)[1:] for r in got.select("id", "r_grp_desc", "r_grp_asc", "r_all", "pr_all").collect()}
    b = {r.id: tuple(r)[1:] for r in exp.collect()}
    assert a == b


def test_rank_has_no_unpartitioned_window_over_rows(spark):
    """The only windows without PARTITION BY run over the bucket table, never over the rows."""
    df = _frame(spark, 200, 7, False)
    plan = add_ranks(df, [dict(value="v", rank_desc="r")])._jdf.queryExecution().optimizedPlan().toString()
    assert "RANK" not in plan.upper().replace("RANK_DESC", "").replace("RANK_ASC", "")


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.floats(-1e300, 1e300), st.sampled_from([0.1, 0.2, 1 / 3]))),
                min_size=1, max_size=60))
def test_range_ranks_equal_the_built_in_ones_for_any_doubles(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    got = rank_table_by_ranges(df, "v", ["g"], range_rows=5)
    of = {(r.g, r.v): r for r in got.collect()}
    w = Window.partitionBy("g")
    want = df.select("g", "v", F.rank().over(w.orderBy(F.col("v").desc_nulls_last())).alias("d"),
                     F.rank().over(w.orderBy(F.col("v").asc_nulls_last())).alias("a"), F.count(F.lit(1)).over(w).alias("n")).collect()
    for r in want:
        found = of[r.g, r.v]
        assert (found.rank_desc, found.rank_asc, found.partition_rows) == (r.d, r.a, r.n)


def test_range_ranks_deal_one_bucket_of_values_to_many_tasks(spark):
    df = spark.range(20_000).select((F.rand(5) / 1000).alias("v"))  # a bucket of any fixed width would hold all
    placed = rank_table_by_ranges(df, "v", [], range_rows=1000)
    assert placed.count() == 20_000
    assert [r.rank_desc for r in placed.orderBy(F.col("v").desc()).limit(3).collect()] == [1, 2, 3]
    parts = df.repartitionByRange(20, F.col("v").desc()).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 20 and max(r["count"] for r in parts) < 2500
