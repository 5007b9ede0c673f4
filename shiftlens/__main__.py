"""Job entry points for ``spark-submit`` (or ``python -m shiftlens``).

    spark-submit --master <cluster> -m shiftlens raw-to-silver --raw <dir> --silver <dir>
    python -m shiftlens silver-to-gold --silver <dir> --gold <dir> [--snapshot-date 2024-07-01]
    python -m shiftlens refresh-views --gold <dir> [--silver <dir>]
    python -m shiftlens land --sf-dir /root/testdata/sf0.1 --base <dir> [--ingest-date D]
    python -m shiftlens pipeline --sf-dir /root/testdata/sf0.1 --base <dir>

The session comes from the launcher (``getOrCreate``): master, executors and
``spark.checkpoint.dir`` are the cluster's; only the library's SQL settings
(AQE, UTC, dynamic partition overwrite) are applied on top, and the shuffle
partition count is sized to the job's input (about 256 MB per partition). Each command
prints one JSON line with what it wrote.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from . import config as C
from .plans import jobs as J
from .session import apply_library_conf, ensure_checkpoint_dir, size_shuffle_partitions


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="shiftlens")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("raw-to-silver")
    s.add_argument("--raw", required=True)
    s.add_argument("--silver", required=True)
    s = sub.add_parser("silver-to-gold")
    s.add_argument("--silver", required=True)
    s.add_argument("--gold", required=True)
    s.add_argument("--snapshot-date", default=C.DEFAULT_SNAPSHOT_DATE)
    s = sub.add_parser("refresh-views")
    s.add_argument("--gold", required=True)
    s.add_argument("--silver")
    for name in ("land", "pipeline"):
        s = sub.add_parser(name)
        s.add_argument("--sf-dir", required=True)
        s.add_argument("--base", required=True)
        s.add_argument("--ingest-date", default="2024-07-01")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"shiftlens-{args.cmd}").getOrCreate()
    apply_library_conf(spark)
    ensure_checkpoint_dir(spark)
    # shuffle partitions sized to this job's input (metadata only), AQE coalesces the rest
    source = {"raw-to-silver": "raw", "silver-to-gold": "silver", "refresh-views": "gold"}.get(args.cmd)
    inputs = [getattr(args, source)] if source else [f"{args.sf_dir}/lineitem.parquet"]
    size_shuffle_partitions(spark, inputs)
    if args.cmd == "raw-to-silver":
        out = {"silver_rows": J.run_raw_to_silver(spark, args.raw, args.silver)}
    elif args.cmd == "silver-to-gold":
        out = J.run_silver_to_gold(spark, args.silver, args.gold, args.snapshot_date)
    elif args.cmd == "refresh-views":
        out = {"view_rows": J.refresh_materialized_views(spark, args.gold, args.silver)}
    elif args.cmd == "land":
        out = {"landed_rows": J.land_panel(spark, args.sf_dir, args.base, args.ingest_date)}
    else:
        log = J.run_pipeline(spark, args.sf_dir, args.base, args.ingest_date)
        out = {r.stage: {"status": r.status, "rows": r.rows} for r in log.collect()}  # one row per stage
    print(json.dumps(out))
    failed = args.cmd == "pipeline" and any(v["status"] != "SUCCEEDED" for v in out.values())
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
