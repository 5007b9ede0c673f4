"""Engine-stable rounding and exact aggregation helpers.

Doubles are rounded through a decimal so that a value that is a tie in
decimal notation (1.005, 0.285) rounds half away from zero no matter which
side of the tie its binary form lands on, and tiny summation-order noise is
absorbed before the final rounding. Sums of hour columns run on decimals so
that the result does not depend on the order partitions are combined in.
All helpers are plain column expressions: they stay inside whole-stage
codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scale at which float noise is cut before rounding to n places.
SNAP_TYPE = "decimal(28,10)"
# Exact type for summing hour values (at most 6 decimals) and 2-decimal metrics.
SUM_TYPE = "decimal(20,6)"
TOTAL_TYPE = "decimal(30,6)"  # of a sum of them
MILLIONTH = Decimal("0.000001")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stable_round(c: Column | str, n: int) -> Column:
    """round half away from zero at ``n`` places, returned as double."""
    return F.round(_col(c).cast(SNAP_TYPE), n).cast("double")


def round_ratio(part: Column, part_places: int, of: Column, percent: bool = False) -> Column:
    """``part`` rounded to ``part_places``, over ``of`` (times 100 for a ``percent``), rounded to 2 places: both times as by
    ``stable_round``. Values that are small and clear of a tie round alike as binary and as decimal, and a decimal of few
    digits is the double ``digits / 10**n``; only the rest goes through decimals. Kept short: the JVM compiles no method over 8 KB."""
    def ratio(rounded: Column) -> Column:
        return rounded / of * F.lit(100.0) if percent else rounded / of

    first = part * F.lit(10.0 ** part_places)
    second = ratio(F.rint(first) / F.lit(10.0 ** part_places)) * F.lit(100.0)
    clear = (F.abs(first - F.rint(first)) < 0.4999) & (F.abs(first) < 1e10) & (F.abs(second - F.rint(second)) < 0.4999) & (F.abs(second) < 1e8)
    return (F.when(clear, (F.rint(second) + F.lit(0.0)) / F.lit(100.0))
            .otherwise(stable_round(ratio(stable_round(part, part_places)), 2)))


def half_up(c: Column) -> Column:
    """round half away from zero to a whole double, as ``F.round(c)`` without its decimal."""
    whole = F.rint(c)
    return F.when(F.abs(c - whole) == 0.5, c + F.signum(c) * 0.5).otherwise(whole)


def decimal_sum(c: Column | str) -> Column:
    """``F.sum(c.cast(SUM_TYPE))`` of a number, added up as two longs: millionths, and the whole part of those values that
    are large or next to a tie. A value of at most 11 digits that is clear of a tie has the same millionths as binary and as decimal."""
    c = _col(c)
    scaled = c * F.lit(1e6)
    millionths = F.rint(scaled)
    short = (F.abs(millionths) < 1e11) & (F.abs(scaled - millionths) < 0.4999)
    exact = c.cast(SUM_TYPE)
    whole = exact.cast("bigint")
    rest = ((exact - whole.cast("decimal(20,0)")) * F.lit(1000000)).cast("bigint")
    small = F.sum(F.when(short, millionths.cast("bigint")).otherwise(rest)).cast("decimal(20,0)") * F.lit(MILLIONTH)
    large = F.sum(F.when(short, F.lit(0).cast("bigint")).otherwise(whole)).cast("decimal(20,0)")
    return (small + large).cast(TOTAL_TYPE)


def exact_sum(c: Column | str) -> Column:
    """Order-independent sum of a double column with at most 6 decimals."""
    return F.sum(_col(c).cast(SUM_TYPE)).cast("double")


def exact_avg(c: Column | str) -> Column:
    """Order-independent mean of a double column with at most 6 decimals."""
    c = _col(c)
    return F.try_divide(F.sum(c.cast(SUM_TYPE)).cast("double"), F.count(c).cast("double"))


def int_avg(c: Column | str) -> Column:
    """Fractional mean of an integer column (exact sum / count)."""
    c = _col(c)
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def pct_of_rows(cond: Column) -> Column:
    """100 * (rows where ``cond``) / (all rows), as double."""
    return F.lit(100.0) * F.count_if(cond).cast("double") / F.count(F.lit(1)).cast("double")
