"""Summarise a Spark event log: jobs, stages, tasks, task time and core use,
and the stages with the most task time, labelled with the model each one wrote.

usage: python tools/eventlog.py EVENT_LOG_DIR [top_n]

Record a log with ``BENCH_EVENT_LOG_DIR=/some/scratch python bench.py`` (or
``spark.eventLog.enabled`` / ``spark.eventLog.dir`` on any session). No UI or
REST server is involved: the log is a file read here.
"""
import collections
import glob
import io
import json
import os
import re
import sys

import zstandard


def events(path: str):
    for f in sorted(glob.glob(os.path.join(path, "**", "events*"), recursive=True)
                    + glob.glob(os.path.join(path, "*local-*"))):
        if os.path.isdir(f):
            continue
        with open(f, "rb") as raw:
            if f.endswith(".zstd"):
                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
            else:
                stream = io.TextIOWrapper(raw, encoding="utf-8")
            for line in stream:
                yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    jobs, stage_names, model_of_exec, exec_of_job = {}, {}, {}, {}
    tasks = []
    for e in events(path):
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e["Stage IDs"]}
            exec_of_job[e["Job ID"]] = props.get("spark.sql.execution.id")
        elif kind == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            stage_names[e["Stage Info"]["Stage ID"]] = e["Stage Info"].get("Stage Name", "")
        elif kind == "SparkListenerTaskEnd":
            ti, tm = e["Task Info"], e.get("Task Metrics") or {}
            tasks.append((e["Stage ID"], ti["Launch Time"], ti["Finish Time"], tm.get("Executor Run Time", 0),
                          tm.get("Executor CPU Time", 0) / 1e6))
        elif kind.endswith("SparkListenerSQLExecutionStart"):
            m = re.search(r"Arguments: \S*/(\w+)/run=", e.get("physicalPlanDescription", ""))
            model_of_exec[str(e["executionId"])] = m.group(1) if m else e.get("description", "")[:30]
    if not jobs:
        print("no jobs in", path)
        return
    stage_exec = {s: exec_of_job[j] for j, info in jobs.items() for s in info["stages"]}
    lo = min(j["start"] for j in jobs.values())
    hi = max(j.get("end", j["start"]) for j in jobs.values())
    wall = (hi - lo) / 1000
    run = sum(t[3] for t in tasks) / 1000
    cpu = sum(t[4] for t in tasks) / 1000
    print(f"jobs {len(jobs)}  stages {len(stage_names)}  tasks {len(tasks)}  wall {wall:.1f}s  "
          f"task run {run:.1f}s  task cpu {cpu:.1f}s")
    per_stage = collections.defaultdict(lambda: [0.0, 0.0, 0])
    per_model = collections.defaultdict(float)
    for sid, _, _, r, c in tasks:
        per_stage[sid][0] += r / 1000
        per_stage[sid][1] += c / 1000
        per_stage[sid][2] += 1
        per_model[model_of_exec.get(stage_exec.get(sid), "?")] += r / 1000
    print("task run seconds by model:")
    for m, s in sorted(per_model.items(), key=lambda x: -x[1]):
        print(f"  {m:32s} {s:7.1f}")
    print(f"top {top} stages by task run time:")
    for sid, (r, c, n) in sorted(per_stage.items(), key=lambda x: -x[1][0])[:top]:
        print(f"  stage {sid:5d}  run {r:6.1f}s  cpu {c:6.1f}s  tasks {n:4d}  "
              f"model {model_of_exec.get(stage_exec.get(sid), '?')}")


if __name__ == "__main__":
    main()
