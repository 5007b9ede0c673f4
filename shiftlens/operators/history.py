"""Provider history: which attributes were in force when, and joins as of a date.

``dim_provider`` lists a provider's attribute tuples without dates, so a join
on the provider alone multiplies rows; ``dim_provider_current`` knows only the
newest tuple. ``provider_history`` gives each tuple its validity intervals
(gaps and islands over the reported days), and ``as_of`` joins rows to the
interval that holds their date: every row stays one row.

Scale. The days are first folded into one bit mask per (provider, tuple,
month) by a hash aggregate with map-side combine, so a month of rows is
shuffled as one; only months in which a provider reports several tuples are
unfolded into days. A window then holds one provider's months and change days: bounded by
the calendar, however many rows the provider has. The join's keys are (provider,
month): a provider that holds a third of all rows is spread over its months, and a row
meets the few intervals of one month instead of the provider's whole history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ATTRS = ["provname", "city", "state", "county_name", "county_fips"]
NAMES = ["provider_name", "city", "state", "county_name", "county_fips"]


def day_bit(date: str) -> Column:
    """The bit of a date's day in its month's mask."""
    return F.expr(f"shiftleft(1, dayofmonth({date}) - 1)")


def day_masks(silver: DataFrame) -> DataFrame:
    """(provnum, attributes, month, mask): bit d - 1 is set if the tuple is reported on day d of the month."""
    d = F.col("work_date")
    return (silver.where(d.isNotNull()).groupBy("provnum", *ATTRS, F.trunc(d, "month").alias("month"))
            .agg(F.bit_or(day_bit("work_date")).alias("mask")))


def mask_days(month: Column, mask: Column) -> Column:
    """The dates of a day mask, in order."""
    days = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda i: F.getbit(mask.cast("bigint"), i) == 1)
    return F.transform(days, lambda i: F.date_add(month, i.cast("int")))


def history_of(masks: DataFrame) -> DataFrame:
    """(provider_id, attributes, valid_from, valid_to, is_current, last_reported) from ``day_masks``.

    A tuple is in force from the first day it is reported until the day before another one is;
    ``valid_to`` is null for the tuple in force last. Days without a report belong to
    the tuple before them. Of two tuples on one day the greater one counts (attribute order,
    nulls least). ``last_reported`` is the provider's last day of all."""
    mine = Window.partitionBy("provnum")
    dates = mask_days(F.col("month"), F.col("mask"))
    days = masks.select("provnum", *ATTRS, "month", dates.alias("dates")).select(
        "*", F.count(F.lit(1)).over(Window.partitionBy("provnum", "month")).alias("tuples"),
        F.max(F.element_at("dates", -1)).over(mine).alias("last_reported"))
    # in a month with one tuple only its first day can bring a change
    days = days.select("provnum", *ATTRS, "last_reported", F.explode(
        F.when(F.col("tuples") > 1, F.col("dates")).otherwise(F.slice("dates", 1, 1))).alias("day"))
    by_tuple = mine.orderBy("day", *[F.col(c).asc_nulls_first() for c in ATTRS])
    days = days.withColumn("next", F.lead("day").over(by_tuple)).where("next IS NULL OR next <> day")
    by_day = mine.orderBy("day")
    changes = (days.withColumn("before", F.lag(F.struct(*ATTRS)).over(by_day))
               .where(F.col("before").isNull() | ~F.struct(*ATTRS).eqNullSafe(F.col("before")))
               .withColumn("next", F.lead("day").over(by_day)))
    return changes.select(
        F.col("provnum").alias("provider_id"), *[F.col(a).alias(n) for a, n in zip(ATTRS, NAMES, strict=True)],
        F.col("day").alias("valid_from"), F.date_sub("next", 1).alias("valid_to"),
        F.col("next").isNull().alias("is_current"), "last_reported")


def provider_history(silver: DataFrame) -> DataFrame:
    return history_of(day_masks(silver))


def as_of(rows: DataFrame, history: DataFrame, key: str, date: str, columns: list[str] | None = None,
          until: str | None = None) -> DataFrame:
    """``rows`` with the ``columns`` of the ``history`` interval that holds their ``date``, as a struct ``as_of``
    (null where there is none: an unknown or null key, a null date, or a date before the first interval).

    Open intervals reach to the end of the month of the provider's last report, or with ``until`` to that date's."""
    end = F.coalesce("valid_to", F.greatest("last_reported", F.lit(until).cast("date")))
    months = F.sequence(F.trunc("valid_from", "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
    laid = history.select(F.col("provider_id").alias("_k"), F.explode(months).alias("_m"), F.col("valid_from").alias("_from"),
                          F.col("valid_to").alias("_to"), F.struct(*(columns or NAMES)).alias("as_of"))
    hit = ((F.col(key) == F.col("_k")) & (F.trunc(date, "month") == F.col("_m")) & (F.col("_from") <= F.col(date))
           & (F.col("_to").isNull() | (F.col(date) <= F.col("_to"))))
    return rows.join(laid, hit, "left").drop("_k", "_m", "_from", "_to")
