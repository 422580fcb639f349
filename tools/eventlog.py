"""Summarise a Spark event log folder: per SQL execution and job, the wall
time, and per stage the task count and duration.

    python tools/eventlog.py <event log dir>
"""

from __future__ import annotations

import glob
import io
import json
import sys


def events(folder: str):
    for f in sorted(glob.glob(f"{folder}/**/events*", recursive=True)):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard

            reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True)
            chunks = []
            while chunk := reader.read(1 << 20):
                chunks.append(chunk)
            raw = b"".join(chunks)
        for line in raw.decode("utf-8").split("\n"):
            if line.strip():
                yield json.loads(line)


def main(folder: str) -> None:
    stages, jobs, sql = {}, {}, {}
    for e in events(folder):
        ev = e["Event"]
        if ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Stage Name"][:40], si["Number of Tasks"],
                                      si["Completion Time"] - si["Submission Time"])
        elif ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None, e["Stage IDs"],
                                 e.get("Properties", {}).get("spark.sql.execution.id")]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif ev.endswith("SQLExecutionStart"):
            sql[e["executionId"]] = [e["time"], None, e.get("description", "")[:40]]
        elif ev.endswith("SQLExecutionEnd"):
            sql[e["executionId"]][1] = e["time"]
    for k, (s, t, d) in sorted(sql.items()):
        print(f"sql {k} {t - s if t else None} ms {d}")
        for j, (js, jt, st, x) in sorted(jobs.items()):
            if str(x) == str(k):
                done = [(y,) + stages[y] for y in st if y in stages]
                print(f"   job {j} {jt - js} ms stages {done}")


if __name__ == "__main__":
    main(sys.argv[1])
