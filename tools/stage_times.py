"""Stage times from a Spark event log folder (written by ``BENCH_EVENT_LOG=<dir> python bench.py``).

    python tools/stage_times.py <event-log dir> [top-n]

Prints the slowest stages: id, tasks, milliseconds, shuffle bytes read/written, name.
"""

from __future__ import annotations

import io
import json
import os
import sys

import zstandard


def _lines(path: str):
    with open(path, "rb") as raw:
        if path.endswith(".zstd"):
            stream = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(stream, encoding="utf-8")
        else:
            yield from io.TextIOWrapper(raw, encoding="utf-8")


def _event_files(root: str):
    for dirpath, _, files in os.walk(root):
        for name in sorted(files):
            if name.startswith("events") or name.startswith("local-") or name.startswith("app-"):
                yield os.path.join(dirpath, name)


def main() -> None:
    root, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 20
    stages = []
    for path in _event_files(root):
        for line in _lines(path):
            event = json.loads(line)
            if event.get("Event") != "SparkListenerStageCompleted":
                continue
            info = event["Stage Info"]
            acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
            stages.append((
                info.get("Completion Time", 0) - info.get("Submission Time", 0),
                info["Stage ID"], info["Number of Tasks"],
                (acc.get("internal.metrics.shuffle.read.remoteBytesRead") or 0)
                + (acc.get("internal.metrics.shuffle.read.localBytesRead") or 0),
                acc.get("internal.metrics.shuffle.write.bytesWritten") or 0,
                info["Stage Name"][:60],
            ))
    for ms, sid, tasks, read, written, name in sorted(stages, reverse=True)[:top]:
        print(f"stage {sid:4d}  tasks {tasks:4d}  {ms:6d} ms  shuffle read {read:>10}  write {written:>10}  {name}")
    print(f"{len(stages)} stages, {sum(s[0] for s in stages)} ms in total")


if __name__ == "__main__":
    main()
