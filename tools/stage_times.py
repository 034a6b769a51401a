"""Summarise a Spark event log: per SQL execution (one per bench query),
its jobs, stages, stage wall time, summed task time and shuffle bytes.

    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py parent_table
    python tools/stage_times.py <that dir>/<app log file or folder>
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of an event log: a file, or a rolling log directory (zstd parts)."""
    files = [path]
    if os.path.isdir(path):
        files = sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_"))
    for fp in files:
        if fp.endswith(".zstd"):
            import zstandard
            with open(fp, "rb") as raw:
                text = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
            yield from text.decode("utf-8").splitlines()
        else:
            with open(fp) as f:
                yield from f


def main(path: str) -> None:
    stages = {}
    stage_exec = {}
    job_exec = {}
    exec_desc = {}
    task_ms = defaultdict(int)
    shuffle = defaultdict(int)
    if True:
        for line in _lines(path):
            if not line.strip():
                continue
            e = json.loads(line)
            ev = e.get("Event", "")
            if ev.endswith("SparkListenerSQLExecutionStart"):
                exec_desc[e["executionId"]] = e.get("description", "")[:60]
            elif ev == "SparkListenerJobStart":
                eid = (e.get("Properties") or {}).get("spark.sql.execution.id")
                for sid in e.get("Stage IDs", []):
                    stage_exec[sid] = eid
                job_exec[e["Job ID"]] = eid
            elif ev == "SparkListenerTaskEnd":
                info, metrics = e["Task Info"], e.get("Task Metrics") or {}
                task_ms[e["Stage ID"]] += info["Finish Time"] - info["Launch Time"]
                shuffle[e["Stage ID"]] += (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                if "Completion Time" in si and "Submission Time" in si:
                    stages[si["Stage ID"]] = (si["Stage Name"], si["Number of Tasks"],
                                              si["Completion Time"] - si["Submission Time"])
    by_exec = defaultdict(list)
    for sid, (name, ntasks, ms) in sorted(stages.items()):
        by_exec[stage_exec.get(sid)].append((sid, name, ntasks, ms))
    for eid, rows in by_exec.items():
        total = sum(r[3] for r in rows)
        print(f"execution {eid} {exec_desc.get(int(eid), '') if eid is not None else ''}  stages={len(rows)} wall={total} ms")
        for sid, name, ntasks, ms in rows:
            print(f"   stage {sid:4d} tasks={ntasks:4d} wall={ms:6d} ms task_sum={task_ms[sid]:7d} ms "
                  f"shuffle_write={shuffle[sid]:>10d} B  {name[:50]}")


if __name__ == "__main__":
    main(sys.argv[1])
