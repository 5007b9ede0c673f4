"""Distinct counts and percentiles that can be combined after they are stored.

``SUM(provider_count)`` over months counts a provider once per month. Two forms
that merge instead:

* exact: providers get dense numbers, a group's providers are bitmaps of
  32,768 numbers each (4 KB at most), and uniting bitmaps before counting gives the distinct
  count of any union of groups;
* sketches: a HyperLogLog sketch of the distinct keys and a KLL sketch of a value, both of
  a size that does not grow with the rows, with a stated error.

All of it is built-in aggregate functions with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: 2**12 registers: a relative standard error of 1.04 / sqrt(4096), 1.6 %.
HLL_BITS = 12
#: With k = 200 a KLL quantile's rank is off by about 1.33 % of the rows at most, with 99 % confidence.
KLL_K, KLL_RANK_ERROR = 200, 0.0133
BUCKET_KEYS = 1 << 17


def numbered(keys: DataFrame, key: str, after: int = 0, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """(key, number): the distinct non-null ``key`` values numbered from ``after`` + 1 without gaps.

    Keys are dealt to buckets by a hash; a window numbers within a bucket, and the buckets' sizes (one
    row each) give where each starts. No task sees all keys."""
    buckets = max(1, -(-keys.count() // bucket_keys))
    dealt = keys.select(key).withColumn("_b", F.pmod(F.xxhash64(key), F.lit(buckets)))
    sizes = dealt.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # over one row a bucket
    starts = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_b").orderBy(key))
    return (dealt.withColumn("_r", place).join(F.broadcast(starts), "_b")
            .select(key, (F.col("_start") + F.col("_r") + F.lit(after)).cast("bigint").alias("number")))


def bitmaps(rows: DataFrame, keys: list[str], number: str = "number") -> DataFrame:
    """(keys, part, providers): the numbers of each group as bitmaps of 32,768 numbers."""
    return rows.groupBy(*keys, F.bitmap_bucket_number(number).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("providers"))


def count_united(sets: DataFrame, keys: list[str], name: str = "providers") -> DataFrame:
    """(keys, name): exact distinct counts over the union of all bitmaps with equal ``keys``."""
    united = sets.groupBy(*keys, "part").agg(F.bitmap_or_agg("providers").alias("_set"))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("_set")).cast("bigint").alias(name))


def sketches(rows: DataFrame, keys: list[str], member: str, value: str) -> DataFrame:
    """(keys, members, values): one sketch of the distinct ``member`` and one of the ``value`` per group."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(member, HLL_BITS).alias("members"),
                                   F.kll_sketch_agg_double(value, KLL_K).alias("values"))


def combined(found: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches with equal ``keys`` merged."""
    return found.groupBy(*keys).agg(F.hll_union_agg("members").alias("members"),
                                    F.kll_merge_agg_double("values").alias("values"))


def approximate(found: DataFrame, keys: list[str], quantiles: tuple[float, ...] = (0.5, 0.25, 0.75)) -> DataFrame:
    """(keys, members, quantiles): the estimates of the sketches; null quantiles where a group has no value."""
    n = F.kll_sketch_get_n_double("values")
    marks = F.array(*[F.lit(q) for q in quantiles])
    return found.select(*keys, F.hll_sketch_estimate("members").alias("members"),
                        F.when(n > 0, F.kll_sketch_get_quantile_double("values", marks)).alias("quantiles"))


def check(found: DataFrame, counts: DataFrame, exact: DataFrame, key: str, value: str,
          quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(key, quantile, rank_ok, members_ok): whether the combined sketches keep their error bounds (three standard errors for
    the distinct count), against exact counts per value (``counts``: key, value, n) and members (``exact``)."""
    told = approximate(combined(found, [key]), [key], quantiles)
    marks = told.where("quantiles IS NOT NULL").select(key, "members", F.explode(F.arrays_zip(
        F.array(*[F.lit(q) for q in quantiles]).alias("quantile"), F.col("quantiles").alias("at"))).alias("m"))
    ranks = (counts.where(F.col(value).isNotNull()).join(marks.select(key, "m.quantile", "m.at"), key)  # a few marks per group
             .groupBy(key, "quantile").agg(
                 F.try_divide(F.sum(F.when(F.col(value) < F.col("at"), F.col("n")).otherwise(0)), F.sum("n")).alias("below"),
                 F.try_divide(F.sum(F.when(F.col(value) <= F.col("at"), F.col("n")).otherwise(0)), F.sum("n")).alias("upto")))
    q, e = F.col("quantile"), F.lit(KLL_RANK_ERROR)
    rank_ok = (F.col("below") <= q + e) & (F.col("upto") >= q - e)
    off = F.abs(F.col("members") - F.col("providers")) <= F.ceil(F.lit(3 * 1.04 / 2 ** (HLL_BITS / 2)) * F.col("providers"))
    return (ranks.join(told.select(key, "members"), key).join(exact, key)
            .select(key, "quantile", rank_ok.alias("rank_ok"), off.alias("members_ok")))
