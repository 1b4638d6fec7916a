"""Summarise a Spark event log per job group: jobs, stages, task time, busiest stages.

usage: python tools/stage_report.py <event log dir or file>
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def _lines(path: str):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    for line in raw.decode().splitlines():
        if line.strip():
            yield json.loads(line)


def main():
    root = sys.argv[1]
    files = [root] if os.path.isfile(root) else [f for f in glob.glob(f"{root}/**/*", recursive=True)
                                                 if os.path.basename(f).startswith(("events_", "eventlog", "local-"))
                                                 and os.path.isfile(f)]
    group, jobs, stage_group, stages, task_ms = {}, {}, {}, {}, collections.Counter()
    for f in files:
        for ev in _lines(f):
            t = ev["Event"]
            if t == "SparkListenerJobStart":
                g = ev.get("Properties", {}).get("spark.jobGroup.id") or "-"
                jobs[ev["Job ID"]] = [g, ev["Submission Time"], None]
                for s in ev.get("Stage IDs", []):
                    stage_group[s] = g
            elif t == "SparkListenerJobEnd":
                jobs[ev["Job ID"]][2] = ev["Completion Time"]
            elif t == "SparkListenerStageCompleted":
                si = ev["Stage Info"]
                stages[si["Stage ID"]] = ((si.get("Completion Time") or 0) - (si.get("Submission Time") or 0),
                                          si["Stage Name"][:60], si["Number of Tasks"])
            elif t == "SparkListenerTaskEnd":
                info = ev.get("Task Info", {})
                task_ms[stage_group.get(ev["Stage ID"], "-")] += info.get("Finish Time", 0) - info.get("Launch Time", 0)
    per = collections.defaultdict(lambda: [0, 0.0])
    for g, a, b in jobs.values():
        per[g][0] += 1
        per[g][1] += ((b or a) - a) / 1000
    n_stages = collections.Counter(stage_group.get(s, "-") for s in stages)
    print(f"{'group':28s} {'jobs':>5s} {'stages':>6s} {'job s':>7s} {'task s':>7s}")
    for g, (nj, sec) in sorted(per.items(), key=lambda kv: -kv[1][1]):
        print(f"{g:28s} {nj:5d} {n_stages[g]:6d} {sec:7.2f} {task_ms[g] / 1000:7.2f}")
    print("\nbusiest stages:")
    for sid, (ms, name, nt) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:10]:
        print(f"  {ms / 1000:6.2f}s  stage {sid:5d}  {stage_group.get(sid, '-'):24s} tasks={nt:<5d} {name}")


if __name__ == "__main__":
    main()
