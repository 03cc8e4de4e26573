"""Summarise a Spark event log: per stage, time, shuffle volume and task spread.

    python tools/stages.py EVENT_LOG_DIR_OR_FILE [--top N]

Reads plain, zstd-compressed and rolling (``eventlog_v2_*``) logs. For each
stage it prints wall time, tasks, records read from shuffle and input, bytes
written to shuffle, bytes spilled to disk, and ``max/total``: the largest single task's share of the
records the stage read from shuffle. A stage in which one key's rows meet in
one task shows that share near the key's share of the data.
"""

from __future__ import annotations

import argparse
import io
import json
import os
from collections import defaultdict


def _open(path: str):
    if path.endswith(".zstd") or path.endswith(".zst"):
        import zstandard
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(path, "rb")), encoding="utf-8")
    return open(path, encoding="utf-8")


def _files(path: str) -> list[str]:
    if os.path.isfile(path):
        return [path]
    out = []
    for root, _, names in os.walk(path):
        out += [os.path.join(root, n) for n in sorted(names)
                if not n.startswith(".") and not n.startswith("appstatus")]
    return sorted(out)


def read_events(path: str):
    for f in _files(path):
        with _open(f) as fh:
            for line in fh:
                if line.strip():
                    yield json.loads(line)


def stage_summary(events) -> list[dict]:
    stages: dict[tuple, dict] = {}
    tasks: dict[tuple, list] = defaultdict(list)
    job_of_stage: dict[int, str] = {}
    for e in events:
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description", "")
            for sid in e.get("Stage IDs", []):
                job_of_stage[sid] = desc
        elif kind == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            sr = m.get("Shuffle Read Metrics") or {}
            inp = m.get("Input Metrics") or {}
            sw = m.get("Shuffle Write Metrics") or {}
            tasks[(e["Stage ID"], e["Stage Attempt ID"])].append({
                "records": sr.get("Total Records Read", 0) + inp.get("Records Read", 0),
                "shuffle_records": sr.get("Total Records Read", 0),
                "shuffle_write_bytes": sw.get("Shuffle Bytes Written", 0),
                "spill_bytes": m.get("Disk Bytes Spilled", 0),
            })
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            key = (info["Stage ID"], info.get("Stage Attempt ID", 0))
            start, end = info.get("Submission Time"), info.get("Completion Time")
            stages[key] = {"stage": info["Stage ID"], "name": info.get("Stage Name", "")[:60],
                           "ms": (end - start) if start and end else None,
                           "job": job_of_stage.get(info["Stage ID"], "")}
    out = []
    for key, s in stages.items():
        ts = tasks.get(key, [])
        total = sum(t["records"] for t in ts)
        shuffled = sum(t["shuffle_records"] for t in ts)
        s.update(tasks=len(ts), records=total, shuffle_records=shuffled,
                 shuffle_write_bytes=sum(t["shuffle_write_bytes"] for t in ts),
                 spill_bytes=sum(t["spill_bytes"] for t in ts),
                 max_share=(max(t["records"] for t in ts) / total) if total else 0.0,
                 max_shuffle_share=(max(t["shuffle_records"] for t in ts) / shuffled) if shuffled else 0.0,
                 max_task_shuffle_records=max((t["shuffle_records"] for t in ts), default=0))
        out.append(s)
    return sorted(out, key=lambda s: s["stage"])


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("path")
    ap.add_argument("--top", type=int, default=0, help="only the N slowest stages")
    args = ap.parse_args()
    rows = stage_summary(read_events(args.path))
    if args.top:
        rows = sorted(rows, key=lambda s: -(s["ms"] or 0))[:args.top]
    print(f"{'stage':>5} {'ms':>7} {'tasks':>5} {'records':>10} {'shuf_w_MB':>9} {'spill_MB':>8} {'max/total':>9}  job")
    for s in rows:
        print(f"{s['stage']:>5} {s['ms'] or 0:>7} {s['tasks']:>5} {s['records']:>10} "
              f"{s['shuffle_write_bytes'] / 1e6:>9.2f} {s['spill_bytes'] / 1e6:>8.1f} {s['max_shuffle_share']:>9.2f}  "
              f"{s['job'] or s['name']}")


if __name__ == "__main__":
    main()
