"""Provider history and as-of joins: intervals, gaps, alternating tuples, edges, and the plan of a hot provider."""

import datetime as dt
import random

from shiftlens.operators import history as H
from shiftlens.operators.silver import to_silver

from helpers import hours, raw_frame


def day(n):
    return dt.date(2024, 4, 1) + dt.timedelta(days=n)


def silver(spark, reports):
    """reports: (provider, day number, name)"""
    rows = [{"PROVNUM": p, "PROVNAME": n, "WorkDate": None if d is None else day(d).strftime("%Y%m%d"), **hours(10)} for p, d, n in reports]
    return to_silver(raw_frame(spark, rows))


def got(spark, reports):
    return [(r.provider_id, r.provider_name, r.valid_from, r.valid_to, r.is_current, r.last_reported)
            for r in H.provider_history(silver(spark, reports)).orderBy("provider_id", "valid_from").collect()]


def test_intervals(spark):
    reports = [("p", 0, "A"), ("p", 1, "A"), ("p", 5, "A"),  # a gap belongs to the tuple before it
               ("p", 6, "B"), ("p", 40, "A"), ("p", 41, "A"),  # an old tuple comes back, a month later
               ("q", 3, "A"), ("q", 3, "C"), ("q", 3, None), ("q", None, "Z"),  # the greater of two on one day; no date
               ("r", 100, "X")]
    assert got(spark, reports) == [
        ("p", "A", day(0), day(5), False, day(41)), ("p", "B", day(6), day(39), False, day(41)),
        ("p", "A", day(40), None, True, day(41)), ("q", "C", day(3), None, True, day(3)), ("r", "X", day(100), None, True, day(100))]
    assert got(spark, []) == []
    assert got(spark, [("n", 0, None), ("n", 1, "A"), ("n", 2, None)])[0][1:4] == (None, day(0), day(0))


def test_history_and_join_equal_a_walk_over_the_days(spark):
    r = random.Random(1)
    reports = [(p, d, r.choice("AB" if p != "hot" else "ABC")) for p in ("hot", "b", "c") for d in sorted(r.sample(range(200), 60))]
    s = silver(spark, reports + reports[:20])  # repeated rows change nothing
    named = {(p, day(d)): n for p, d, n in reports}
    probes = [(p, day(d)) for p in ("hot", "b", "c", "unknown", None) for d in range(-3, 200)] + [("b", None)]
    rows = spark.createDataFrame([(p, d, i, "x") for i, (p, d) in enumerate(probes)], "provider_id string, d date, i int, as_of_ string")
    joined = H.as_of(rows, H.provider_history(s), "provider_id", "d", until="2024-12-31").collect()
    assert len(joined) == len(probes)
    for row in joined:
        earlier = [d for (p, d) in named if p == row.provider_id and row.d and d <= row.d]
        want = named[row.provider_id, max(earlier)] if earlier else None
        assert (row.as_of.provider_name if row.as_of else None) == want
    # without ``until`` open intervals end with the month of the last report
    late = spark.createDataFrame([("b", day(300))], "provider_id string, d date")
    assert H.as_of(late, H.provider_history(s), "provider_id", "d").first().as_of is None


def test_a_month_of_rows_is_shuffled_as_one_and_the_join_spreads_a_provider_over_its_months(spark):
    s = silver(spark, [("p", d, "A") for d in range(60)])
    h = H.provider_history(s)
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "SortAggregate" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = H.as_of(s.select("provnum", "work_date"), h, "provnum", "work_date")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(provnum" in text and "trunc(work_date" in text.split("SortMergeJoin")[1]
        assert joined.count() == 60
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
