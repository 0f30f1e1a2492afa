"""Slowest stages from a Spark event log (written with BENCH_EVENT_LOG).

usage: python tools/stage_times.py <event log file or folder> [top_n]
"""

from __future__ import annotations

import json
import os
import sys


def _lines(fp: str):
    """Event-log lines; zstd-compressed rolling logs are decoded in memory."""
    if fp.endswith(".zstd") or fp.endswith(".zst"):
        import io

        import zstandard

        with open(fp, "rb") as fh:
            text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            yield from (ln for ln in text if ln.strip())
    else:
        with open(fp) as fh:
            yield from (ln for ln in fh if ln.strip())


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    files = [os.path.join(path, f) for f in sorted(os.listdir(path))] if os.path.isdir(path) else [path]
    stages = []
    for fp in files:
        if os.path.isdir(fp):
            files += [os.path.join(fp, f) for f in sorted(os.listdir(fp))]
            continue
        name = os.path.basename(fp)
        if name.startswith(".") or name.startswith("appstatus"):
            continue
        for line in _lines(fp):
            ev = json.loads(line)
            if ev.get("Event") != "SparkListenerStageCompleted":
                continue
            info = ev["Stage Info"]
            if "Completion Time" in info and "Submission Time" in info:
                ms = info["Completion Time"] - info["Submission Time"]
                stages.append((ms, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:70]))
    stages.sort(reverse=True)
    print(f"{len(stages)} stages, {sum(s[0] for s in stages) / 1000:.1f} s in total")
    for ms, sid, tasks, name in stages[:top]:
        print(f"{ms / 1000:8.2f} s  stage {sid:<5} tasks {tasks:<5} {name}")


if __name__ == "__main__":
    main()
