"""Summarise a Spark event log (stage and job durations).

    python tools/stages.py <event-log-dir>
"""
import glob
import io
import json
import sys

import zstandard


def events(path):
    for f in sorted(glob.glob(f"{path}/**/events*", recursive=True)):
        raw = open(f, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if f.endswith(".zstd") else raw
        for line in io.TextIOWrapper(stream, encoding="utf-8", errors="ignore"):
            try:
                yield json.loads(line)
            except ValueError:
                continue


def main():
    stages, jobs = {}, {}
    for e in events(sys.argv[1]):
        ev = e.get("Event")
        if ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Completion Time"] - si["Submission Time"], si["Number of Tasks"],
                                      si["Stage Name"][:70])
        elif ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None]
        elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]][1] = e["Completion Time"]
    print("jobs", len(jobs), "stages", len(stages), "stage-ms", sum(v[0] for v in stages.values()))
    for k, v in sorted(stages.items(), key=lambda kv: -kv[1][0])[:int(sys.argv[2]) if len(sys.argv) > 2 else 15]:
        print(k, v)


if __name__ == "__main__":
    main()
