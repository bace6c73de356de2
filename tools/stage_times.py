"""Summarise a Spark event log: wall time per job, the slowest stages and
their task-time totals.

    python tools/stage_times.py <event-log-file-or-dir> [top_n]
"""

from __future__ import annotations

import json
import os
import sys


def _lines(f):
    if f.endswith(".zstd"):
        import io

        import zstandard

        with open(f, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f) as fh:
            yield from fh


def _events(path):
    files = [os.path.join(path, f) for f in sorted(os.listdir(path))] if os.path.isdir(path) else [path]
    for f in files:
        if os.path.isdir(f):
            yield from _events(f)
        elif os.path.basename(f).startswith(("events", "local-", "app-")):
            for line in _lines(f):
                if line.strip():
                    yield json.loads(line)


def main() -> None:
    path, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, task_ms, jobs = {}, {}, {}
    for e in _events(path):
        kind = e.get("Event")
        if kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            wall = (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0)
            stages[info["Stage ID"]] = (wall, info["Number of Tasks"], info["Stage Name"][:60])
        elif kind == "SparkListenerTaskEnd":
            sid = e["Stage ID"]
            t = e["Task Info"]
            task_ms[sid] = task_ms.get(sid, 0) + (t["Finish Time"] - t["Launch Time"])
        elif kind == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None]
        elif kind == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
    total = sum((b - a) for a, b in jobs.values() if b)
    print(f"{len(jobs)} jobs, {len(stages)} stages, job wall sum {total / 1000:.2f}s")
    for sid, (wall, n, name) in sorted(stages.items(), key=lambda x: -x[1][0])[:top]:
        print(f"stage {sid:5d} wall {wall / 1000:6.2f}s tasks {n:4d} task-sum "
              f"{task_ms.get(sid, 0) / 1000:6.2f}s  {name}")


if __name__ == "__main__":
    main()
