"""Summarize a Spark event log: per job group (query), the number of stages,
the summed stage run time and the largest shuffle read.

Usage: BENCH_EVENTLOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py q1 q2
       python tools/stage_times.py $BENCH_EVENTLOG_DIR
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard
        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    folder = sys.argv[1]
    files = sorted(f for f in glob.glob(os.path.join(folder, "**", "*"), recursive=True)
                   if os.path.isfile(f) and "appstatus" not in os.path.basename(f))
    group_of_job, stage_job = {}, {}
    stats = defaultdict(lambda: {"stages": 0, "ms": 0, "max_shuffle_read_mb": 0.0})
    for f in files:
        for line in _lines(f):
            if True:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    group = props.get("spark.jobGroup.id", "-")
                    group_of_job[ev["Job ID"]] = group
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    group = group_of_job.get(stage_job.get(info["Stage ID"]), "-")
                    s = stats[group]
                    s["stages"] += 1
                    if info.get("Submission Time") and info.get("Completion Time"):
                        s["ms"] += info["Completion Time"] - info["Submission Time"]
                    for acc in info.get("Accumulables", []):
                        if acc.get("Name") in ("internal.metrics.shuffle.read.remoteBytesRead",
                                               "internal.metrics.shuffle.read.localBytesRead"):
                            s["max_shuffle_read_mb"] = max(s["max_shuffle_read_mb"], int(acc.get("Value", 0)) / 1e6)
    for group, s in sorted(stats.items(), key=lambda kv: -kv[1]["ms"]):
        print(f"{group:28s} stages={s['stages']:4d} stage_ms={s['ms']:8d} max_shuffle_read_mb={s['max_shuffle_read_mb']:.1f}")


if __name__ == "__main__":
    main()
