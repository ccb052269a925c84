"""Summarise a Spark event log: the slowest stages and time per job description.

usage: python tools/stage_times.py EVENT_LOG_FILE_OR_DIR [top]
"""

from __future__ import annotations

import collections
import json
import os
import sys


def _files(path: str):
    if not os.path.isdir(path):
        return [path]
    out = []
    for root, _, names in os.walk(path):
        out += [os.path.join(root, n) for n in sorted(names) if n.startswith(("events", "eventlog", "local-", "app"))
                and not n.startswith("appstatus") and not n.endswith(".crc")]
    return sorted(out)


def _lines(f: str):
    if f.endswith((".zstd", ".zst")):
        import io

        import zstandard
        with open(f, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(f, encoding="utf-8") as fh:
            yield from fh


def events(path: str):
    for f in _files(path):
        for line in _lines(f):
            if line.strip():
                yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for e in events(path):
        if e.get("Event") == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            if start and end:
                stages.append((end - start, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:90]))
    stages.sort(reverse=True)
    print(f"{len(stages)} stages, {sum(s[0] for s in stages) / 1000:.1f} s stage time in total")
    for ms, sid, tasks, name in stages[:top]:
        print(f"{ms / 1000:7.2f} s  stage {sid:5d}  tasks {tasks:5d}  {name}")
    by_call = collections.Counter()
    for ms, _, _, name in stages:
        by_call[name.split(" at ")[0]] += ms
    print("by operation:")
    for name, ms in by_call.most_common(top):
        print(f"{ms / 1000:7.2f} s  {name}")


if __name__ == "__main__":
    main()
