"""Facility-day staffing panel derived from the driver's TPC-H-style tables.

The staffing source is not shipped, so a deterministic stand-in is derived
from ``lineitem`` (one facility per supplier, one day per ship-date residue)
joined to ``supplier``/``nation``/``region``. The rule set is fixed in
FIXTURES.md §2; the oracle SQL derives the same panel in DuckDB.

Plan shape: the line items are reduced to one row per (supplier, day) with
a map-side partial aggregate *before* anything is joined, so the join sees
suppliers x 91 rows instead of every line item. ``nation`` (25 rows) and
``region`` (5 rows) are fixed-size TPC-H tables and are broadcast; the
supplier side is left to the planner/AQE, because it grows with the scale
factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.rounding import half_up

# FIXED VALUES of the panel rule (FIXTURES.md §2).
DAY_ZERO = "1995-01-01"
DAYS_IN_QUARTER = 91
QUARTER_START = "2024-04-01"
PANEL_QUARTER = "2024Q2"
SMALL_FACILITY_MOD, SMALL_FACILITY_REM = 11, 4
SMALL_DIVISOR, LARGE_DIVISOR = 100000, 10000
CENSUS_NULL_MOD, CENSUS_ZERO_MOD, RN_NULL_MOD = 53, 37, 41
NAME_CHANGE_MOD, NAME_CHANGE_DAY, NAME_SUFFIX = 10, 45, " LLC"
UNITS = ("rn", "lpn", "cna")  # the roles whose hours come from the line items
NEXT_QUARTER, LEAVES_MOD, LEAVES_REM = "2024Q3", 4, 1  # facilities that no longer report in the next quarter


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
            for t in ("lineitem", "supplier", "nation", "region")}


def facility_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed panel: one row per (facility, work date), source column names in lower case."""
    return panel_of(facility_sums(spark, sf_dir))


def facility_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the panel is computed from: one row per (facility, day) with the sums of its line items, its name and place.
    All of the work that grows with the line items, in a third of the panel's columns."""
    t = _tables(spark, sf_dir)
    li = t["lineitem"].select("l_suppkey", "l_quantity", "l_discount", "l_tax",
                              "l_returnflag", "l_shipdate")
    sk = F.col("l_suppkey")
    q = F.floor(F.col("l_quantity")).cast("bigint")
    d = half_up(F.col("l_discount") * 100).cast("bigint")
    tx = half_up(F.col("l_tax") * 100).cast("bigint")
    w = F.lit(70) + F.lit(10) * (sk % 7)
    dd = F.pmod(F.datediff(F.to_date("l_shipdate"), F.lit(DAY_ZERO).cast("date")), F.lit(DAYS_IN_QUARTER))
    contract = (F.when(sk % 3 == 0, 0)
                .when(F.col("l_returnflag") == "R", 1)
                .when((sk % 5 == 0) & (F.col("l_returnflag") == "A"), 1)
                .otherwise(0)).cast("bigint")
    units = {
        "rn": q * (F.lit(20) + F.lit(5) * d) * w,
        "lpn": q * (F.lit(30) + F.lit(10) * tx) * w,
        "cna": q * (F.lit(100) + F.lit(25) * d) * w,
    }
    per_item = li.select(sk.alias("sk"), dd.alias("dd"), q.alias("q"), contract.alias("c"),
                         *[u.alias(k) for k, u in units.items()])
    aggs = [F.sum("q").alias("sq")]
    for k in units:
        aggs += [F.sum(k).alias(f"s_{k}"), F.sum(F.col(k) * F.col("c")).alias(f"c_{k}")]
    per_day = per_item.groupBy("sk", "dd").agg(*aggs)

    sup = t["supplier"].select("s_suppkey", "s_name", "s_nationkey")
    nat = F.broadcast(t["nation"].select("n_nationkey", "n_name", "n_regionkey"))
    reg = F.broadcast(t["region"].select("r_regionkey", "r_name"))
    j = (per_day.join(sup, per_day.sk == sup.s_suppkey)
         .join(nat, F.col("s_nationkey") == F.col("n_nationkey"))
         .join(reg, F.col("n_regionkey") == F.col("r_regionkey")))
    return j.select(*per_day.columns, "s_name", "n_nationkey", "n_name", "r_name")


def panel_of(sums: DataFrame) -> DataFrame:
    """The panel from its sums, row by row."""
    sk, dd = F.col("sk"), F.col("dd")
    small = sk % SMALL_FACILITY_MOD == SMALL_FACILITY_REM
    k = F.when(small, F.lit(SMALL_DIVISOR)).otherwise(F.lit(LARGE_DIVISOR))
    skdd = sk + dd
    work_date = F.date_add(F.lit(QUARTER_START).cast("date"), dd.cast("int"))
    census = (F.when(skdd % CENSUS_NULL_MOD == 0, F.lit(None))
              .when(skdd % CENSUS_ZERO_MOD == 0, F.lit(0))
              .when(small, F.expr("sq div 10"))
              .otherwise(F.col("sq"))).cast("int")

    def hrs(total: Column) -> Column:
        return total / k

    cols = [
        F.lpad(sk.cast("string"), 6, "0").alias("provnum"),
        F.concat(F.col("s_name"),
                 F.when((sk % NAME_CHANGE_MOD == 0) & (dd >= NAME_CHANGE_DAY), F.lit(NAME_SUFFIX))
                 .otherwise(F.lit(""))).alias("provname"),
        F.concat(F.lit("CITY_"), (sk % 10).cast("string")).alias("city"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("county_name"),
        (F.col("n_nationkey") * 10 + sk % 4).cast("string").alias("county_fips"),
        F.lit(PANEL_QUARTER).alias("cy_qtr"),
        work_date.alias("work_date"),
        census.alias("mdscensus"),
    ]
    weekday = F.dayofweek(work_date).between(2, 6)
    extra = {
        "rndon": F.when(weekday, 8.0).otherwise(0.0),
        "rnadmin": F.when(sk % 2 == 0, 8.0).otherwise(0.0),
        "lpnadmin": F.when(sk % 3 == 0, 4.0).otherwise(0.0),
        "natrn": F.lit(0.0),
        "medaide": F.lit(2.0),
    }
    for role in C.RAW_HOUR_ROLES:
        r = role.lower()
        if r in UNITS:
            total = hrs(F.col(f"s_{r}"))
            if r == "rn":
                total = F.when(skdd % RN_NULL_MOD == 0, F.lit(None)).otherwise(total)
            cols += [total.cast("double").alias(f"hrs_{r}"),
                     hrs(F.col(f"s_{r}") - F.col(f"c_{r}")).alias(f"hrs_{r}_emp"),
                     hrs(F.col(f"c_{r}")).alias(f"hrs_{r}_ctr")]
        else:
            v = extra[r]
            cols += [v.alias(f"hrs_{r}"), v.alias(f"hrs_{r}_emp"), F.lit(0.0).alias(f"hrs_{r}_ctr")]
    return sums.select(*cols)


def next_quarter(panel: DataFrame) -> DataFrame:
    """The panel a quarter later: the same facility-days 91 days on, names as at the start of the first quarter again, without
    the facilities that have left."""
    stays = F.col("provnum").cast("bigint") % LEAVES_MOD != LEAVES_REM
    return (panel.where(stays).withColumn("work_date", F.date_add("work_date", DAYS_IN_QUARTER))
            .withColumn("cy_qtr", F.lit(NEXT_QUARTER)))


def render_raw(panel: DataFrame) -> DataFrame:
    """The panel as the raw file would carry it: original headers, every value a string,
    dates as yyyyMMdd, the state lower-cased and padded with spaces."""
    out = []
    for raw in C.raw_columns():
        low = raw.lower()
        if raw == "WorkDate":
            v = F.date_format("work_date", "yyyyMMdd")
        elif raw == "STATE":
            v = F.concat(F.lit(" "), F.lower("state"), F.lit(" "))
        else:
            v = F.col(low).cast("string")
        out.append(v.alias(raw))
    return panel.select(*out)
