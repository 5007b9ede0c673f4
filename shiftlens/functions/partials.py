"""Aggregates in two steps: first within a finer grouping, then over its rows.

A distinct count, a percentile or a "latest text" beside plain sums would
copy or sort the fact's rows. The finer step is a plain hash aggregate of the fact;
whatever needs copies or a sort then sees its few rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rounding import decimal_sum


def sums(*cols: str, exact: bool = True) -> list[Column]:
    """First step: sum and count of each column. ``exact``: on decimals, so that
    the order of rows does not matter (at most 6 decimals)."""
    out = []
    for c in cols:
        out += [(decimal_sum(c) if exact else F.sum(c)).alias(f"_s_{c}"), F.count(c).alias(f"_n_{c}")]
    return out


def total(c: str) -> Column:
    return F.sum(f"_s_{c}").cast("double")


def whole(c: str) -> Column:
    """A total of an integer column."""
    return F.sum(f"_s_{c}").cast("bigint")


def count(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def mean(c: str) -> Column:
    return F.try_divide(total(c), count(f"_n_{c}").cast("double"))


def share_pct(c: str, of: str) -> Column:
    return F.lit(100.0) * count(c).cast("double") / count(of).cast("double")


def with_quartiles(agg: DataFrame, rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``agg`` (one row per ``keys``) with ``_q``: median and quartiles of ``value`` over ``rows``.

    Rows are counted per distinct value by a hash aggregate; the percentile buffers are
    filled from those counts alone. Both sides of the join have one row per ``keys``."""
    counted = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    q = counted.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.percentile(value, F.array(F.lit(0.5), F.lit(0.25), F.lit(0.75)), F.col("_n")).alias("_q"))
    cond = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return agg.join(q, cond, "left").drop(*[f"_k{i}" for i in range(len(keys))])
