"""Summarise stage and task times from Spark event logs (no UI needed).

    BENCH_EVENT_LOG_DIR=/tmp/run-x/events python bench.py ...
    python tools/stage_times.py /tmp/run-x/events [top_n]

Reads the rolling event-log folders Spark writes (zstd-compressed or plain)
and prints, per stage call site, total stage wall time, task count and the
largest task, which is where skew shows up.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def summarise(log_dir: str):
    wall = collections.Counter()
    tasks = collections.Counter()
    longest = collections.Counter()
    stage_site: dict[int, str] = {}
    files = [f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(f) and "events_" in os.path.basename(f)]
    for f in files:
        for line in _lines(f):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                site = info["Stage Name"].split(" at ")[0]
                stage_site[info["Stage ID"]] = site
                wall[site] += info.get("Completion Time", 0) - info.get("Submission Time", 0)
            elif kind == "SparkListenerTaskEnd":
                t = ev["Task Info"]
                sid = ev["Stage ID"]
                tasks[sid] += 1
                longest[sid] = max(longest[sid], t["Finish Time"] - t["Launch Time"])
    per_site_tasks = collections.Counter()
    per_site_longest = collections.Counter()
    for sid, site in stage_site.items():
        per_site_tasks[site] += tasks[sid]
        per_site_longest[site] = max(per_site_longest[site], longest[sid])
    return wall, per_site_tasks, per_site_longest


def main(argv: list[str]) -> None:
    log_dir = argv[1]
    top = int(argv[2]) if len(argv) > 2 else 15
    wall, tasks, longest = summarise(log_dir)
    print(f"{'stage ms':>9} {'tasks':>6} {'max task ms':>11}  call site")
    for site, ms in wall.most_common(top):
        print(f"{ms:>9} {tasks[site]:>6} {longest[site]:>11}  {site}")


if __name__ == "__main__":
    main(sys.argv)
