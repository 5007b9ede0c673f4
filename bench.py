"""Benchmark: the pipeline and every registered view/dashboard query.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8) and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Stages timed:
  pipeline_land / _silver / _gold / _refresh_views -- the batch jobs (CSV -> Parquet star schema
                                                     -> materialized views)
  kpi_end_to_end                                   -- flagship KPI straight from lineitem, no stored layers
  <query key>                                      -- each query over the stored gold tables
Each query is executed in full with the no-op sink (no driver collect). An
untimed warm-up pass runs the same pipeline and queries over sf0.001 first, so
the figures are steady-state rather than JVM start-up.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from shiftlens.session import build_session, scratch_dir
    from shiftlens.plans import jobs as J
    from shiftlens.plans import metrics as M
    from shiftlens.plans.registry import WH_QUERIES
    from shiftlens.plans.warehouse import Warehouse

    extra = {}
    if not os.environ.get("BENCH_NO_EVENTLOG"):
        log_dir = tempfile.mkdtemp(prefix="shiftlens-events-")
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), extra=extra)

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    # Warm-up, not timed: the same code paths once over the smallest scale
    # factor, so the timings below are steady-state (JIT-compiled) figures.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    warmed = os.path.isdir(warm_dir)
    if warmed:
        wbase = scratch_dir(spark, "bench-warmup")
        wp = J.pipeline_paths(wbase)
        J.land_panel(spark, warm_dir, wbase, "2024-07-01")
        J.run_raw_to_silver(spark, wp["raw"], wp["silver"])
        J.run_silver_to_gold(spark, wp["silver"], wp["gold"])
        J.refresh_materialized_views(spark, wp["gold"], wp["silver"])
        wwh = Warehouse.from_gold(spark, wp["gold"], wp["silver"])
        for fn in WH_QUERIES.values():
            run(fn(wwh))
    else:
        run(spark.read.parquet(f"{sf_dir}/region.parquet"))

    times: dict[str, float] = {}
    base = scratch_dir(spark, "bench")
    p = J.pipeline_paths(base)

    t = time.time()
    J.land_panel(spark, sf_dir, base, "2024-07-01")
    times["pipeline_land"] = time.time() - t
    t = time.time()
    records = J.run_raw_to_silver(spark, p["raw"], p["silver"])
    times["pipeline_silver"] = time.time() - t
    t = time.time()
    J.run_silver_to_gold(spark, p["silver"], p["gold"])
    times["pipeline_gold"] = time.time() - t
    t = time.time()
    J.refresh_materialized_views(spark, p["gold"], p["silver"])
    times["pipeline_refresh_views"] = time.time() - t

    t = time.time()
    run(M.v_kpi_summary(Warehouse.derived(spark, sf_dir).daily()))
    times["kpi_end_to_end"] = time.time() - t

    wh = Warehouse.from_gold(spark, p["gold"], p["silver"])
    for key, fn in WH_QUERIES.items():
        t = time.time()
        run(fn(wh))
        times[key] = time.time() - t

    spark.stop()
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": {k: round(v, 3) for k, v in times.items()}, "sf": sf,
           "cpus": cpus, "facility_days": records,
           "warmup": f"untimed pass over {warm_dir}" if warmed else "none",
           "pipeline_records_per_sec": round(records / sum(v for k, v in times.items()
                                                             if k.startswith("pipeline_")), 1)}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
