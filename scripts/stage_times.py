"""Summarise a Spark event log: wall time per job description (query name)
and the slowest stages with their task counts and shuffle volumes.

usage: python scripts/stage_times.py <event-log-dir-or-file> [top_n]
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _files(path):
    """Event-log files under ``path`` (rolling logs are folders of parts)."""
    if not os.path.isdir(path):
        return [path]
    out = []
    for root, _, names in os.walk(path):
        out += [os.path.join(root, n) for n in sorted(names)
                if not n.startswith(".") and not n.startswith("appstatus")]
    return sorted(out)


def _lines(f):
    """Lines of a plain or zstd-compressed event-log part."""
    if f.endswith(".zstd") or f.endswith(".zst"):
        import io

        import zstandard
        with open(f, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
        return
    with open(f, encoding="utf-8") as fh:
        yield from fh


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    job_desc, job_time, stage_job = {}, {}, {}
    stages = {}
    for f in _files(path):
        for line in _lines(f):
            if True:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    job_desc[ev["Job ID"]] = props.get("spark.job.description", "?")
                    job_time[ev["Job ID"]] = [ev["Submission Time"], None]
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerJobEnd":
                    job_time[ev["Job ID"]][1] = ev["Completion Time"]
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                    stages[info["Stage ID"]] = {
                        "name": info.get("Stage Name", "")[:60],
                        "tasks": info.get("Number of Tasks"),
                        "ms": (info.get("Completion Time") or 0) - (info.get("Submission Time") or 0),
                        "shuffle_read": acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0)
                        or acc.get("internal.metrics.shuffle.read.localBytesRead", 0),
                        "shuffle_write": acc.get("internal.metrics.shuffle.write.bytesWritten", 0),
                    }
    per_query = defaultdict(float)
    for jid, (start, end) in job_time.items():
        if end:
            per_query[job_desc.get(jid, "?")] += (end - start) / 1000.0
    print("job seconds per query (sum over its jobs):")
    for q, sec in sorted(per_query.items(), key=lambda kv: -kv[1]):
        print(f"  {q:28s} {sec:8.2f}")
    print(f"\nslowest {top} stages:")
    for sid, st in sorted(stages.items(), key=lambda kv: -kv[1]["ms"])[:top]:
        q = job_desc.get(stage_job.get(sid), "?")
        print(f"  stage {sid:5d} {st['ms'] / 1000:7.2f}s tasks={st['tasks']:4d} "
              f"shuffle_w={int(st['shuffle_write'] or 0):>10d}B  {q:22s} {st['name']}")


if __name__ == "__main__":
    main()
