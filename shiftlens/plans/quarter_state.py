"""Gold from mergeable state: a new quarter reads its own rows only.

Each quarter of silver is folded once into small tables of partial
aggregates, stored under ``cy_qtr=``:

* ``provider_month``: one row per (provider attributes, year, month) with counts,
  exact sums, extremes, sums of squares, and a bit mask of the days reported;
* ``hppd_counts``: rows per (state, year, month, 2-place HPPD), which give exact percentiles;
* ``sketches``: per (state, year, month) a sketch of the distinct providers and one of the HPPD values.

Beside them, ``provider_number`` gives each provider a dense number once and for all, so that sets of
providers are bitmaps. All gold tables follow from the first two by merging rows with equal keys: sums
add, extremes meet, masks unite. ``load_quarter`` replaces the quarter's state
and its partitions of the fact, then derives the other gold tables from the
state of all quarters; no fact row of another quarter is read. A provider-month is one
state row where silver holds up to 31, so a merge costs a small part of a rebuild.
Loading a quarter again replaces it: the job can be repeated after a failure.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions import partials as P
from ..functions import staffing as S
from ..functions.rounding import decimal_sum, stable_round
from ..operators import distinct, gold, history
from ..sources.sinks import MaterializedView, delete_path, path_exists, write_table
from .warehouse import GOLD_TABLES, Warehouse

STATE_TABLES = {"provider_month": "state/provider_month", "hppd_counts": "state/hppd_counts",
                "sketches": "state/sketches"}
NUMBERS, TOUCHED = "state/provider_number", "state/touched"
HOURS = ["hrs_rn", "hrs_lpn", "hrs_cna"]
TOTALS = ["total_nursing_hours", "total_employed_hours", "total_contract_hours"]
RATES = ["nursing_hppd", "rn_skill_mix_pct", "contract_staff_pct"]
KEYS = ["provnum", *history.ATTRS, "year", "month"]


def _daily(silver: DataFrame) -> DataFrame:
    """Silver rows beside their daily metrics, year and month; ``ratio`` is silver's unrounded HPPD."""
    census, total = F.col("mdscensus"), F.col("total_nursing_hours")
    contract = F.col("_contract")
    return silver.withColumn("_contract", S.null_safe_total(["hrs_rn_ctr", "hrs_lpn_ctr", "hrs_cna_ctr"])).select(
        "provnum", *history.ATTRS, "cy_qtr", "work_date", "mdscensus", *HOURS, *TOTALS,
        F.col("nursing_hppd").alias("ratio"), "contract_ratio",
        F.year("work_date").alias("year"), F.month("work_date").alias("month"),
        S.per_census(total, census).alias("nursing_hppd"),
        S.share_pct(S.nz("hrs_rn"), total).alias("rn_skill_mix_pct"),
        S.share_pct(contract, total).alias("contract_staff_pct"),
        S.staffing_category(total, census).alias("level"),
        F.coalesce(census > 0, F.lit(False)).alias("censused"))


def fold_provider_month(silver: DataFrame) -> DataFrame:
    """One hash aggregate over the quarter: ``_s_``/``_n_`` sums and counts over all days, ``c_`` those over days with patients."""
    rows = _daily(silver)
    on = F.col("censused")

    out = [F.count(F.lit(1)).alias("n"), F.min("work_date").alias("first"), F.max("work_date").alias("last"),
           F.bit_or(history.day_bit("work_date")).alias("mask"),
           F.sum("mdscensus").alias("_s_mdscensus"), F.count("mdscensus").alias("_n_mdscensus"),
           F.min("ratio").alias("min_ratio"), F.max("ratio").alias("max_ratio")]
    out += [decimal_sum(S.nz(c)).alias(f"_s_{c}") for c in HOURS]
    out += [decimal_sum(c).alias(f"_s_{c}") for c in TOTALS] + [F.count(c).alias(f"_n_{c}") for c in TOTALS]
    for c in ("ratio", "contract_ratio"):
        out += [F.sum(c).alias(f"_s_{c}"), F.count(c).alias(f"_n_{c}")]
    for c in RATES:
        out += [decimal_sum(c).alias(f"_s_{c}"), F.count(c).alias(f"_n_{c}"),
                decimal_sum(F.when(on, F.col(c))).alias(f"c_s_{c}"), F.count(F.when(on, F.col(c))).alias(f"c_n_{c}")]
    out += [decimal_sum(F.when(on, S.nz(c))).alias(f"c_s_{c}")
            for c in (*HOURS, "total_nursing_hours")]
    two_place, hundredths = F.col("nursing_hppd").cast("decimal(12,2)"), F.rint(F.col("nursing_hppd") * 100).cast("bigint")
    small = F.abs("nursing_hppd") < 1e4  # their squares are added as whole ten-thousandths
    squares = F.sum(F.when(on & small, hundredths * hundredths)).cast("decimal(20,0)") * F.lit(Decimal("0.0001"))
    rest = F.sum(F.when(on & ~small, (two_place * two_place).cast("decimal(28,4)")))
    out += [F.count_if(on).alias("c_n"), F.sum(F.when(on, F.col("mdscensus"))).alias("c_s_mdscensus"),
            F.min(F.when(on, F.col("nursing_hppd"))).alias("c_min"), F.max(F.when(on, F.col("nursing_hppd"))).alias("c_max"),
            F.coalesce(squares + rest, squares, rest).cast("decimal(38,4)").alias("c_squares"),
            F.count_if(on & (F.col("level") == C.CATEGORY_MEETS)).alias("c_meets"),
            F.count_if(on & (F.col("level") == C.CATEGORY_CRITICAL)).alias("c_critical")]
    return rows.groupBy("cy_qtr", *KEYS).agg(*out)


def fold_hppd_counts(silver: DataFrame) -> DataFrame:
    """(cy_qtr, state, year, month, nursing_hppd, n): rows per 2-place daily HPPD (null without patients)."""
    return _daily(silver).groupBy("cy_qtr", "state", "year", "month", "nursing_hppd").agg(F.count(F.lit(1)).alias("n"))


def fold_sketches(silver: DataFrame) -> DataFrame:
    return distinct.sketches(_daily(silver), ["cy_qtr", "state", "year", "month"], "provnum", "nursing_hppd")


FOLDS = {"provider_month": fold_provider_month, "hppd_counts": fold_hppd_counts, "sketches": fold_sketches}

#: How a state column of two rows becomes one.
_MERGE = {"first": F.min, "min_ratio": F.min, "c_min": F.min, "last": F.max, "max_ratio": F.max, "c_max": F.max,
          "mask": F.bit_or}


def merged(state: DataFrame, *keys: str) -> DataFrame:
    """State rows with equal ``keys`` merged into one."""
    rest = [c for c in state.columns if c not in {*KEYS, "cy_qtr"}]
    return state.groupBy(*keys).agg(*[_MERGE.get(c, F.sum)(c).alias(c) for c in rest])


# -- gold tables from state --------------------------------------------------

def _mean(total: str, n: str) -> Column:
    return F.try_divide(F.col(total).cast("double"), F.col(n).cast("double"))


def _double(c: str) -> Column:
    return F.col(c).cast("double")


def _year_month() -> Column:
    return F.format_string("%04d-%02d", "year", "month")


def _month_date() -> Column:
    return F.make_date("year", "month", F.lit(1)).cast("timestamp_ntz")


def dim_date(state: DataFrame) -> DataFrame:
    days = state.where("mask IS NOT NULL").groupBy("year", "month").agg(F.bit_or("mask").alias("mask"))
    first = F.make_date("year", "month", F.lit(1))
    return gold.build_dim_date(days.select(F.explode(history.mask_days(first, F.col("mask"))).alias("work_date")))


def dim_provider(state: DataFrame) -> DataFrame:
    return gold.build_dim_provider(state)


def dim_provider_current(state: DataFrame) -> DataFrame:
    return gold.build_dim_provider_current(state.withColumnRenamed("last", "work_date"))


def dim_provider_history(state: DataFrame) -> DataFrame:
    masks = state.where("mask IS NOT NULL").withColumn("month", F.make_date("year", "month", F.lit(1)))
    return history.history_of(masks.groupBy("provnum", *history.ATTRS, "month").agg(F.bit_or("mask").alias("mask")))


def dim_state(state: DataFrame) -> DataFrame:
    out = state.groupBy("state").agg(
        F.count_distinct("provnum").alias("provider_count"), F.count_distinct("county_fips").alias("county_count"),
        F.count_distinct("city").alias("city_count"), F.sum("_s_mdscensus").cast("bigint").alias("total_patient_days"),
        stable_round(F.try_divide(F.sum("_s_ratio"), F.sum("_n_ratio").cast("double")), 2).alias("avg_hppd"))
    return out.select(F.row_number().over(Window.orderBy("state")).cast("bigint").alias("state_sk"), "*")  # a row a state


def agg_state_monthly_etl(state: DataFrame) -> DataFrame:
    per = merged(state, "state", "year", "month", "provnum")
    out = per.groupBy("state", "year", "month").agg(
        F.count("provnum").alias("provider_count"),
        *[F.sum(c).alias(c) for c in ("_s_ratio", "_n_ratio", "_s_mdscensus", "_n_mdscensus", "n")])
    return out.select("state", "year", "month", "provider_count", stable_round(_mean("_s_ratio", "_n_ratio"), 2).alias("avg_hppd"),
                      stable_round(_mean("_s_mdscensus", "_n_mdscensus"), 1).alias("avg_census"),
                      F.col("n").alias("record_count"))


def agg_provider_monthly(state: DataFrame) -> DataFrame:
    keys = ["provnum", "state", "year", "month"]
    newest = Window.partitionBy(*keys).orderBy(F.col("last").desc_nulls_last(), F.col("provname").desc_nulls_last())
    name = (state.groupBy(*keys, "provname").agg(F.max("last").alias("last"))
            .withColumn("r", F.row_number().over(newest)).where("r = 1").drop("r", "last"))
    # both sides have one row per key
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    out = merged(state, *keys).alias("a").join(name.alias("b"), same).select("a.*", "b.provname")
    return out.select(
        F.col("provnum").alias("provider_id"), F.col("provname").alias("provider_name"), "state", "year", "month",
        _year_month().alias("year_month"),
        stable_round(_mean("_s_mdscensus", "_n_mdscensus"), 1).alias("avg_daily_census"),
        F.col("_s_mdscensus").cast("bigint").alias("total_patient_days"),
        *[_double(f"_s_{h}").alias(n) for h, n in zip(HOURS, ["total_rn_hours", "total_lpn_hours", "total_cna_hours"], strict=True)],
        *[_double(f"_s_{t}").alias(t) for t in TOTALS],
        stable_round(_mean("_s_ratio", "_n_ratio"), 2).alias("avg_nursing_hppd"),
        stable_round("min_ratio", 2).alias("min_nursing_hppd"), stable_round("max_ratio", 2).alias("max_nursing_hppd"),
        stable_round(_mean("_s_contract_ratio", "_n_contract_ratio"), 4).alias("avg_contract_ratio"),
        F.col("n").alias("days_reported"))


def _quartiles(counts: DataFrame, censused: bool) -> DataFrame:
    rows = counts.where("nursing_hppd IS NOT NULL") if censused else counts
    return rows.groupBy("state", "year", "month").agg(
        F.percentile("nursing_hppd", F.array(F.lit(0.5), F.lit(0.25), F.lit(0.75)), F.col("n")).alias("q"))


def _by_state_month(state: DataFrame) -> DataFrame:
    """State rows merged by state and month, with the number of providers (and of those with patients). Only the
    counting goes by provider; the other columns are added up at once, to a few rows a task."""
    keys = ["state", "year", "month"]
    seen = state.groupBy(*keys, "provnum").agg(F.max("c_n").alias("c_n"))
    providers = seen.groupBy(*keys).agg(
        F.count("provnum").alias("providers"), F.count(F.when(F.col("c_n") > 0, F.col("provnum"))).alias("c_providers"))
    return _with(merged(state, *keys), providers)


def _with(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per state and month on either side."""
    keys = ["state", "year", "month"]
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    rest = [F.col(f"b.{c}") for c in right.columns if c not in keys]
    return left.alias("a").join(right.alias("b"), same, "left").select("a.*", *rest)


def agg_state_monthly(state: DataFrame, counts: DataFrame) -> DataFrame:
    out, q = _with(_by_state_month(state), _quartiles(counts, False)), F.col("q")
    return out.select(
        "state", "year", "month", _year_month().alias("year_month"), F.col("providers").alias("provider_count"),
        F.col("_s_mdscensus").cast("bigint").alias("total_patient_days"),
        stable_round(_mean("_s_mdscensus", "_n_mdscensus"), 1).alias("avg_daily_census"),
        _double("_s_total_nursing_hours").alias("total_nursing_hours"), _double("_s_hrs_rn").alias("total_rn_hours"),
        _double("_s_hrs_lpn").alias("total_lpn_hours"), _double("_s_hrs_cna").alias("total_cna_hours"),
        stable_round(_mean("_s_nursing_hppd", "_n_nursing_hppd"), 2).alias("avg_nursing_hppd"),
        stable_round(q[0], 2).alias("median_nursing_hppd"), stable_round(q[1], 2).alias("p25_hppd"),
        stable_round(q[2], 2).alias("p75_hppd"),
        stable_round(_mean("_s_rn_skill_mix_pct", "_n_rn_skill_mix_pct"), 2).alias("avg_rn_mix_pct"),
        stable_round(_mean("_s_contract_staff_pct", "_n_contract_staff_pct"), 2).alias("avg_contract_pct"),
        stable_round(_mean("_s_contract_ratio", "_n_contract_ratio"), 4).alias("avg_contract_ratio"),
        F.col("n").alias("total_records"))


def agg_overall_metrics(state: DataFrame, snapshot_date: str) -> DataFrame:
    row = state.groupBy("provnum", "state").agg(
        *[F.sum(c).alias(c) for c in ("n", "_s_mdscensus", "_s_total_nursing_hours", "_s_total_contract_hours", "_s_ratio", "_n_ratio")],
        F.min("first").alias("first"), F.max("last").alias("last")).agg(
        F.count_distinct("provnum").alias("total_providers"), F.count_distinct("state").alias("total_states"),
        F.sum("_s_mdscensus").cast("bigint").alias("total_patient_days"), P.total("total_nursing_hours").alias("hours"),
        stable_round(F.try_divide(F.sum("_s_ratio"), F.sum("_n_ratio").cast("double")), 2).alias("overall_avg_hppd"),
        P.total("total_contract_hours").alias("contract"), F.min("first").alias("data_start_date"),
        F.max("last").alias("data_end_date"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_records"))
    return row.select(
        "total_providers", "total_states", "total_patient_days", F.col("hours").alias("total_nursing_hours"),
        "overall_avg_hppd", stable_round(F.try_divide("contract", "hours"), 4).alias("overall_contract_ratio"),
        "data_start_date", "data_end_date",
        (F.datediff("data_end_date", "data_start_date") + 1).cast("bigint").alias("total_days"), "total_records",
        F.lit(snapshot_date).cast("date").alias("snapshot_date"))


def provider_monthly_summary(state: DataFrame) -> DataFrame:
    """``v_provider_monthly``; the standard deviation from exact sums of the 2-place HPPD and its square."""
    out = merged(state, "provnum", "state", "year", "month").where("c_n > 0")
    n, s = F.col("c_n_nursing_hppd").cast("decimal(20,0)"), F.col("c_s_nursing_hppd").cast("decimal(18,2)")
    spread = (n.cast("decimal(18,0)") * F.col("c_squares").cast("decimal(18,4)")).cast("decimal(37,4)") - (s * s).cast("decimal(37,4)")
    variance = F.try_divide(spread.cast("double"), (n * (n - 1)).cast("double"))
    return out.select(
        F.col("provnum").alias("provider_id"), "state", _month_date().alias("month_date"), _year_month().alias("year_month"),
        F.col("c_n").alias("days_reported"), stable_round(_mean("c_s_mdscensus", "c_n"), 1).alias("avg_daily_census"),
        F.col("c_s_mdscensus").cast("bigint").alias("total_patient_days"),
        *[_double(f"c_s_{c}").alias(name) for c, name in zip(
            ["total_nursing_hours", *HOURS], ["total_nursing_hours", "total_rn_hours", "total_lpn_hours", "total_cna_hours"], strict=True)],
        stable_round(_mean("c_s_nursing_hppd", "c_n_nursing_hppd"), 2).alias("avg_hppd"),
        stable_round("c_min", 2).alias("min_hppd"), stable_round("c_max", 2).alias("max_hppd"),
        stable_round(F.sqrt(variance), 2).alias("stddev_hppd"),
        stable_round(_mean("c_s_rn_skill_mix_pct", "c_n_rn_skill_mix_pct"), 2).alias("avg_rn_mix_pct"),
        stable_round(_mean("c_s_contract_staff_pct", "c_n_contract_staff_pct"), 2).alias("avg_contract_pct"),
        F.col("c_critical").alias("critical_days"), F.col("c_meets").alias("benchmark_met_days"))


def state_monthly_summary(state: DataFrame, counts: DataFrame) -> DataFrame:
    """``v_state_monthly``."""
    out, q = _with(_by_state_month(state).where("c_n > 0"), _quartiles(counts, True)), F.col("q")
    return out.select(
        "state", _month_date().alias("month_date"), _year_month().alias("year_month"),
        F.col("c_providers").alias("provider_count"), F.col("c_s_mdscensus").cast("bigint").alias("total_patient_days"),
        stable_round(_mean("c_s_mdscensus", "c_n"), 1).alias("avg_daily_census"),
        _double("c_s_total_nursing_hours").alias("total_nursing_hours"), _double("c_s_hrs_rn").alias("total_rn_hours"),
        _double("c_s_hrs_lpn").alias("total_lpn_hours"), _double("c_s_hrs_cna").alias("total_cna_hours"),
        stable_round(_mean("c_s_nursing_hppd", "c_n_nursing_hppd"), 2).alias("avg_hppd"),
        stable_round(q[0], 2).alias("median_hppd"), stable_round(q[1], 2).alias("p25_hppd"), stable_round(q[2], 2).alias("p75_hppd"),
        stable_round(_mean("c_s_rn_skill_mix_pct", "c_n_rn_skill_mix_pct"), 2).alias("avg_rn_mix_pct"),
        stable_round(_mean("c_s_contract_staff_pct", "c_n_contract_staff_pct"), 2).alias("avg_contract_pct"),
        stable_round(F.lit(100.0) * _mean("c_meets", "c_n"), 1).alias("pct_meeting_benchmark"),
        stable_round(F.lit(100.0) * _mean("c_critical", "c_n"), 1).alias("pct_critical"))


def mv_staffing_summary(state: DataFrame) -> DataFrame:
    out = _by_state_month(state.where("year IS NOT NULL"))
    return out.select(
        "state", "year", "month", _year_month().alias("year_month"), F.col("providers").alias("provider_count"),
        F.col("_s_mdscensus").cast("bigint").alias("total_patient_days"),
        _mean("_s_mdscensus", "_n_mdscensus").alias("avg_daily_census"),
        _double("_s_total_nursing_hours").alias("total_nursing_hours"),
        stable_round(_mean("_s_ratio", "_n_ratio"), 6).alias("avg_nursing_hppd"),
        stable_round(_mean("_s_contract_ratio", "_n_contract_ratio"), 6).alias("avg_contract_ratio"),
        _double("_s_hrs_rn").alias("total_rn_hours"), _double("_s_hrs_lpn").alias("total_lpn_hours"),
        _double("_s_hrs_cna").alias("total_cna_hours"), F.col("n").alias("record_count"))


def derive(name: str, state: DataFrame, counts: DataFrame, snapshot_date: str = C.DEFAULT_SNAPSHOT_DATE) -> DataFrame:
    """A gold table (other than the fact) from the two state tables."""
    if name in ("agg_state_monthly", "state_monthly_summary"):
        return globals()[name](state, counts)
    if name == "agg_overall_metrics":
        return agg_overall_metrics(state, snapshot_date)
    return globals()[name](state)


# -- the job -------------------------------------------------------------------

PARTITIONS = {"agg_provider_monthly": ["state"], "provider_monthly_summary": ["state"]}


def read_state(spark: SparkSession, gold_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{gold_dir.rstrip('/')}/{STATE_TABLES[name]}")


def load_quarter(spark: SparkSession, silver_path: str, gold_dir: str, quarter: str,
                 snapshot_date: str = C.DEFAULT_SNAPSHOT_DATE, concurrent_writes: int = 6) -> dict[str, int]:
    """Bring one quarter of silver into gold; other quarters' facts are neither read nor written.

    Returns rows written per table (for the fact and the state: rows of this quarter)."""
    gold_dir = gold_dir.rstrip("/")
    silver = spark.read.parquet(silver_path).where(F.col("cy_qtr") == F.lit(quarter))  # a partition filter
    if silver.isEmpty():
        raise ValueError(f"No records of {quarter} in {silver_path}")
    _touch(spark, gold_dir, quarter)  # months that the quarter held until now

    def own(name: str) -> int:
        if name == "facts":  # silver is laid out by the same columns
            return write_table(gold.build_fact(silver), f"{gold_dir}/{GOLD_TABLES[name]}", ["cy_qtr", "state"],
                               replace="cy_qtr", rebalance=False)
        return write_table(FOLDS[name](silver), f"{gold_dir}/{STATE_TABLES[name]}", ["cy_qtr"], replace="cy_qtr")

    names = ["facts", *FOLDS]
    with ThreadPoolExecutor(max_workers=concurrent_writes) as pool:  # the quarter's tables do not depend on each other
        out = dict(zip(names, pool.map(own, names), strict=True))
    _touch(spark, gold_dir, quarter)  # and those it holds from now on
    state, counts = (read_state(spark, gold_dir, n) for n in ("provider_month", "hppd_counts"))

    def one(name: str) -> int:
        return write_table(derive(name, state, counts, snapshot_date), f"{gold_dir}/{GOLD_TABLES[name]}", PARTITIONS.get(name))

    derived = [name for name in GOLD_TABLES if name != "facts"]
    with ThreadPoolExecutor(max_workers=concurrent_writes) as pool:  # the tables do not depend on each other
        numbers = pool.submit(number_providers, spark, gold_dir, state)
        out.update(zip(derived, pool.map(one, derived), strict=True))
        numbers.result()
    out["mv_staffing_summary"] = refresh_summary(spark, gold_dir)
    return out


def _touch(spark: SparkSession, gold_dir: str, quarter: str) -> None:
    """Note the state-months of a quarter's state as changed. Notes pile up until a refresh has used them, so a
    load that is killed in between loses none."""
    if path_exists(spark, f"{gold_dir}/{STATE_TABLES['provider_month']}"):
        mine = read_state(spark, gold_dir, "provider_month").where(F.col("cy_qtr") == F.lit(quarter))
        mine.select("state", "year", "month").distinct().write.mode("append").parquet(f"{gold_dir}/{TOUCHED}")


def refresh_summary(spark: SparkSession, gold_dir: str) -> int:
    """Maintain ``mv_staffing_summary`` from the noted changes: only their state-months are computed again, from the
    state rows of those months; all other rows are taken over from the version before."""
    gold_dir = gold_dir.rstrip("/")
    state = read_state(spark, gold_dir, "provider_month")
    view = MaterializedView(spark, f"{gold_dir}/serving/mv_staffing_summary", lambda: mv_staffing_summary(state))
    if not view.versions():
        rows = view.refresh()
    else:
        notes, before = spark.read.parquet(f"{gold_dir}/{TOUCHED}").distinct(), view.read()
        same = [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in ("state", "year", "month")]
        view.definition = lambda: before.alias("s").join(notes.alias("t"), same, "left_anti").unionByName(
            mv_staffing_summary(state.alias("s").join(notes.alias("t"), same, "left_semi")))
        rows = view.refresh()
    delete_path(spark, f"{gold_dir}/{TOUCHED}")
    return rows


def number_providers(spark: SparkSession, gold_dir: str, state: DataFrame) -> DataFrame:
    """(provider_id, number): numbers once given stay; providers not seen before get the next ones."""
    path = f"{gold_dir}/{NUMBERS}"
    ids = state.select(F.col("provnum").alias("provider_id")).where("provnum IS NOT NULL").distinct()
    if path_exists(spark, path):
        known = spark.read.parquet(path)
        distinct.numbered(ids.join(known, "provider_id", "left_anti"), "provider_id", known.count()).write.mode("append").parquet(path)
    else:
        distinct.numbered(ids, "provider_id").write.parquet(path)
    return spark.read.parquet(path)


def provider_sets(spark: SparkSession, gold_dir: str) -> DataFrame:
    """(state, year, month, part, providers): the providers of each state-month as bitmaps."""
    rows = read_state(spark, gold_dir, "provider_month").select("state", "year", "month", F.col("provnum").alias("provider_id"))
    numbers = spark.read.parquet(f"{gold_dir.rstrip('/')}/{NUMBERS}")
    return distinct.bitmaps(rows.distinct().join(numbers, "provider_id"), ["state", "year", "month"])


def gold_warehouse(spark: SparkSession, gold_dir: str, silver_path: str | None = None) -> Warehouse:
    return Warehouse.from_gold(spark, gold_dir, silver_path)
