"""A streaming source over append-only message logs, with byte offsets.

Every file `*.log` or `*.txt` in a folder is one partition of the log, one
message a line. An offset is the number of bytes of complete lines in each file,
so a query that starts again from its checkpoint reads on where it stopped.
Ranges are cut into parts of bounded size that tasks read side by side: a task
takes the lines that start in its part. The folder has to be a plain path that
the driver and every executor see.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Executors need no installed package: this module travels with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART_BYTES = 32 << 20
_TAIL = 1 << 16


@dataclass
class LogPart(InputPartition):
    """Lines of a file that start at byte `start` or later, before `end`; `first` if a line starts at `start` for sure."""

    file: str
    start: int
    end: int
    first: bool


def complete_bytes(path: str) -> int:
    """Bytes of a file up to the end of its last complete line."""
    with open(path, "rb") as log:
        at = log.seek(0, os.SEEK_END)
        while at > 0:
            begin = max(0, at - _TAIL)
            log.seek(begin)
            last = log.read(at - begin).rfind(b"\n")
            if last >= 0:
                return begin + last + 1
            at = begin
    return 0


def cut_range(file: str, start: int, end: int, part_bytes: int) -> list[LogPart]:
    starts = range(start, end, part_bytes)
    return [LogPart(file, at, min(at + part_bytes, end), at == start) for at in starts]


def read_lines(path: str, part: LogPart) -> Iterator[tuple[int, str]]:
    """(byte offset, line) of the lines that start in the part."""
    with open(path, "rb") as log:
        at = part.start
        if not part.first:  # a line starts here only where the byte before ends one
            at -= 1
            log.seek(at)
            at += len(log.readline())
        log.seek(at)
        while at < part.end:
            line = log.readline()
            yield at, line.rstrip(b"\r\n").decode(errors="replace")
            at += len(line)


class LogReader(DataSourceStreamReader):
    def __init__(self, folder: str, part_bytes: int):
        self.folder, self.part_bytes = folder, part_bytes

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        names = sorted(n for n in os.listdir(self.folder) if n.endswith((".log", ".txt")))
        return {name: complete_bytes(os.path.join(self.folder, name)) for name in names}

    def partitions(self, start: dict, end: dict) -> list[LogPart]:
        parts = [cut_range(name, start.get(name, 0), size, self.part_bytes) for name, size in end.items()]
        return [part for file_parts in parts for part in file_parts]

    def read(self, partition: LogPart) -> Iterator[tuple]:
        for at, line in read_lines(os.path.join(self.folder, partition.file), partition):
            yield partition.file, at, line


class LogSource(DataSource):
    """Format `message_log`: columns file, at (byte offset) and value (the message)."""

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return "file string, at bigint, value string"

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options["path"], int(self.options.get("partBytes", PART_BYTES)))
