"""Summarize a Spark event log: slowest stages with task counts, shuffle bytes and spill.

usage: python tools/eventlog_stages.py <event-log-file-or-dir> [top_n]

bench.py writes its event log to a fresh scratch folder (/tmp/shiftlens-events-*). Reads the JSON lines only; no UI or server involved.
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(f: str):
    """Event lines of one file; rolling logs are zstd-compressed by default."""
    if f.endswith(".zstd"):
        import io

        import zstandard
        with open(f, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f) as fh:
            yield from fh


def _event_files(path: str) -> list[str]:
    if not os.path.isdir(path):
        return [path]
    return sorted(f for f in glob.glob(os.path.join(path, "**", "events_*"), recursive=True)
                  + glob.glob(os.path.join(path, "*")) if os.path.isfile(f)
                  and not os.path.basename(f).startswith((".", "appstatus")))


def stages(path: str):
    out = {}
    for f in _event_files(path):
        for line in _lines(f):
            try:
                ev = json.loads(line)
            except ValueError:
                continue
            if ev.get("Event") != "SparkListenerStageCompleted":
                continue
            info = ev["Stage Info"]
            acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
            dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
            out[(f, info["Stage ID"], info.get("Stage Attempt ID", 0))] = {
                "stage": info["Stage ID"], "name": info.get("Stage Name", "")[:60], "sec": dur,
                "tasks": info.get("Number of Tasks"),
                "shuffle_write_mb": round((acc.get("internal.metrics.shuffle.write.bytesWritten") or 0) / 2**20, 2),
                "shuffle_read_mb": round((acc.get("internal.metrics.shuffle.read.localBytesRead") or 0) / 2**20
                                         + (acc.get("internal.metrics.shuffle.read.remoteBytesRead") or 0) / 2**20, 2),
                "spill_mb": round((acc.get("internal.metrics.diskBytesSpilled") or 0) / 2**20, 2),
            }
    return list(out.values())


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    st = stages(path)
    print(f"{len(st)} stages, {sum(s['sec'] for s in st):.1f} stage-seconds, "
          f"spill {sum(s['spill_mb'] for s in st):.1f} MB")
    for s in sorted(st, key=lambda s: -s["sec"])[:top]:
        print(json.dumps(s))


if __name__ == "__main__":
    main()
