"""Print stage and task times from a Spark event log folder (no UI needed).

Run a job with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir=<scratch folder>``,
then: ``python tools/stage_times.py <scratch folder> [last_n]``. Handles plain and
zstd-compressed (``.zstd``) rolling event logs.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def stage_times(log_dir: str) -> list[dict]:
    files = sorted(f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(f) and not os.path.basename(f).startswith("appstatus"))
    stages, tasks = {}, {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = dict(stage=si["Stage ID"], name=si["Stage Name"][:40],
                                              tasks=si["Number of Tasks"],
                                              ms=si.get("Completion Time", 0) - si.get("Submission Time", 0))
            elif kind == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
    out = []
    for sid in sorted(stages):
        d = stages[sid]
        ts = tasks.get(sid, [0])
        d.update(max_task_ms=max(ts), sum_task_ms=sum(ts))
        out.append(d)
    return out


def main() -> None:
    log_dir = sys.argv[1]
    last = int(sys.argv[2]) if len(sys.argv) > 2 else 50
    for d in stage_times(log_dir)[-last:]:
        print(f"stage {d['stage']:4d} tasks {d['tasks']:5d} stage {d['ms']:7d} ms  "
              f"max task {d['max_task_ms']:7d} ms  sum tasks {d['sum_task_ms']:8d} ms  {d['name']}")


if __name__ == "__main__":
    main()
