"""Task-time spread per stage from a Spark event log folder (bench.py with
BENCH_EVENT_LOG=<scratch dir>): for every stage with several tasks, the slowest
and the median task.  A skewed key shows up as max >> median.

usage: python scripts/stage_skew.py <event log folder>
"""

from __future__ import annotations

import collections
import glob
import io
import json
import statistics
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    root = sys.argv[1]
    files = [f for f in glob.glob(f"{root}/**/events_*", recursive=True) if not f.endswith(".crc")]
    tasks, names = collections.defaultdict(list), {}
    for f in files:
        for line in _lines(f):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if e.get("Event") == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks[e["Stage ID"]].append(ti["Finish Time"] - ti["Launch Time"])
            elif e.get("Event") == "SparkListenerStageCompleted":
                names[e["Stage Info"]["Stage ID"]] = e["Stage Info"]["Stage Name"][:60]
    rows = sorted(((max(d), statistics.median(d), len(d), s) for s, d in tasks.items() if len(d) >= 4),
                  reverse=True)
    print(f"stages={len(tasks)} multi-task={len(rows)}")
    for mx, med, n, s in rows[:15]:
        print(f"stage {s:5d} tasks={n:4d} max={mx:7d}ms median={med:9.1f}ms ratio={mx / max(med, 1):5.2f} {names.get(s, '')}")


if __name__ == "__main__":
    main()
