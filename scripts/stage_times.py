"""Summarise a Spark event log: time per job description and its slowest stages.

usage: python scripts/stage_times.py <event-log-file-or-folder> [top_n]
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Event lines from a log file or a rolling log folder (zstd or plain)."""
    files = [path] if os.path.isfile(path) else sorted(
        os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_")
    )
    for f in files:
        if f.endswith(".zstd"):
            import zstandard

            with open(f, "rb") as raw:
                stream = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                yield from io.TextIOWrapper(stream, encoding="utf-8")
        else:
            with open(f, encoding="utf-8") as fh:
                yield from fh


def main() -> None:
    path = sys.argv[1]
    top_n = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    job_desc: dict[int, str] = {}
    stage_job: dict[int, int] = {}
    stages: dict[int, dict] = {}
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                props = ev.get("Properties") or {}
                job_desc[ev["Job ID"]] = props.get("spark.job.description", "?")
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = ev["Job ID"]
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                if "Completion Time" in info and "Submission Time" in info:
                    stages[info["Stage ID"]] = {
                        "name": info.get("Stage Name", "")[:60],
                        "tasks": info.get("Number of Tasks"),
                        "ms": info["Completion Time"] - info["Submission Time"],
                    }
    per_desc: dict[str, list] = defaultdict(list)
    for sid, st in stages.items():
        per_desc[job_desc.get(stage_job.get(sid, -1), "?")].append((st["ms"], sid, st))
    for desc, items in sorted(per_desc.items(), key=lambda kv: -sum(x[0] for x in kv[1])):
        total = sum(x[0] for x in items)
        print(f"{desc:40s} stages={len(items):4d} stage_ms={total:8d}")
        for ms, sid, st in sorted(items, key=lambda x: -x[0])[:top_n]:
            print(f"    stage {sid:5d} {ms:7d} ms tasks={st['tasks']:4d} {st['name']}")


if __name__ == "__main__":
    main()
