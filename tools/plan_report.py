"""Write PLANS.md: the physical plan shape of the headline queries.

usage: python tools/plan_report.py [sf_dir] > PLANS.md

Runs the pipeline into a scratch folder, executes each query over the stored
gold tables (so AQE's final plan is shown) and prints a condensed operator
tree plus the scan details (pushed filters, partition filters, read schema).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shiftlens.plans import jobs as J  # noqa: E402
from shiftlens.plans import metrics as M  # noqa: E402
from shiftlens.plans import serving as Q  # noqa: E402
from shiftlens.plans.warehouse import Warehouse  # noqa: E402
from shiftlens.session import build_session, scratch_dir  # noqa: E402

KEEP = re.compile(r"(Exchange|Aggregate|Join|Window|Scan|Expand|Sort|TakeOrdered|Generate|Union|Filter|"
                  r"ReusedExchange|BroadcastExchange|AQEShuffleRead|WholeStageCodegen|Project|Limit)")


def condensed(plan: str) -> str:
    plan = plan.split("== Initial Plan ==")[0]
    out = []
    for line in plan.split("\n"):
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        if "Scan parquet" in line or "FileScan" in line:
            scan = {k: re.search(k + r": (\[[^\]]*\]|struct<[^>]*>|[^,]+)", line) for k in
                    ("PushedFilters", "PartitionFilters", "ReadSchema")}
            head = line.split("Scan parquet")[0] + "Scan parquet"
            line = head + " " + " ".join(f"{k}={m.group(1)}" for k, m in scan.items() if m)
        out.append(line if "Scan parquet" in line else line[:200])
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(extra={"spark.sql.maxMetadataStringLength": "2000"})
    base = scratch_dir(spark, "plans")
    p = J.pipeline_paths(base)
    J.land_panel(spark, sf, base, "2024-07-01")
    J.run_raw_to_silver(spark, p["raw"], p["silver"])
    J.run_silver_to_gold(spark, p["silver"], p["gold"])
    wh = Warehouse.from_gold(spark, p["gold"], p["silver"])
    cases = {
        "v_kpi_summary (flagship)": M.v_kpi_summary(wh.daily()),
        "v_state_monthly (percentiles, distinct count)": M.v_state_monthly(wh.daily()),
        "v_provider_rankings (scalable ranks)": M.v_provider_rankings(M.v_provider_monthly(wh.daily())),
        "mv_staffing_summary (fact x dim_date)": Q.mv_staffing_summary(wh),
        "provider_details state filter (partition pruning)": Q.provider_details(wh, state="NATION_9", limit=200),
        "fk_violations (one pass, left joins)": Q.fk_violations(wh),
        "panel derivation from lineitem": Warehouse.derived(spark, sf).silver,
    }
    print("# PLANS\n")
    print(f"Physical plans (AQE final) of the headline queries over the gold tables written from `{sf}`.")
    print("Generated by `tools/plan_report.py`; expression ids and plan ids removed, scans condensed to")
    print("their pushed filters, partition filters and read schema.\n")
    for title, df in cases.items():
        df.write.format("noop").mode("overwrite").save()
        df.collect() if "panel" not in title else None
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {title}\n\n```\n{condensed(plan)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
