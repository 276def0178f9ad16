"""Landed text files as a stream that flushes by rows or by time, whichever comes first.

Spark's file source starts a batch for whatever has landed. This source admits
new files once enough rows wait in them, or once the first of them has waited
long enough; until then the stream is idle. Files are taken in order of (time
of modification, path) and must not change once they are there. Storage is
reached through Arrow's file systems; executors read the files, the driver only
counts lines of files that wait.
"""

from __future__ import annotations

import datetime
import sys
import time
from collections.abc import Iterator

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# The source travels with its code, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "landed_events"
_CHUNK = 1 << 20


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class LandedFile(InputPartition):
    def __init__(self, modified: int, path: str):
        self.modified, self.path = modified, path


class LandedReader(DataSourceStreamReader):
    """Offsets are (time of modification in nanoseconds, path) of the last file taken."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.rows, self.seconds = int(options["flushRows"]), float(options["flushSeconds"])
        self.taken = (-1, "")
        self.counts: dict[str, int] = {}
        self.waiting_since: float | None = None

    def initialOffset(self) -> dict:
        return {"modified": -1, "path": ""}

    def _files(self, after: tuple[int, str], upto: tuple[int, str] | None = None) -> list[tuple[int, str]]:
        store, root = _opened(self.path)
        found = []
        for info in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            if info.type == fs.FileType.File and not info.base_name.startswith(("_", ".")):
                key = (info.mtime_ns, info.path)
                if after < key and (upto is None or key <= upto):
                    found.append(key)
        return sorted(found)

    def _lines(self, path: str) -> int:
        if path not in self.counts:
            store, _ = _opened(self.path)
            n, last = 0, b"\n"
            with store.open_input_stream(path) as file:
                while part := file.read(_CHUNK):
                    n, last = n + part.count(b"\n"), part[-1:]
            self.counts[path] = n + (last != b"\n")
        return self.counts[path]

    def latestOffset(self) -> dict:
        waiting = self._files(self.taken)
        if waiting:
            self.waiting_since = self.waiting_since or time.monotonic()
            enough = sum(self._lines(path) for _, path in waiting) >= self.rows
            if enough or time.monotonic() - self.waiting_since >= self.seconds:
                self.taken, self.waiting_since, self.counts = waiting[-1], None, {}
        return {"modified": self.taken[0], "path": self.taken[1]}

    def partitions(self, start: dict, end: dict) -> list[LandedFile]:
        upto = (end["modified"], end["path"])
        # After a restart the checkpoint knows what has been taken.
        self.taken = max(self.taken, upto)
        return [LandedFile(*key) for key in self._files((start["modified"], start["path"]), upto)]

    def read(self, partition: LandedFile) -> Iterator[tuple]:
        store, _ = _opened(self.path)
        modified = datetime.datetime.fromtimestamp(partition.modified / 1e9, datetime.timezone.utc)
        with store.open_input_stream(partition.path) as file:
            rest, number = b"", 0
            while part := file.read(_CHUNK):
                *lines, rest = (rest + part).split(b"\n")
                for line in lines:
                    yield line.decode("utf-8", "replace"), modified, partition.path, number
                    number += 1
            if rest:
                yield rest.decode("utf-8", "replace"), modified, partition.path, number

    def commit(self, end: dict) -> None:
        """The files stay where they landed."""


class LandedEvents(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string, modified timestamp, file string, line bigint"

    def streamReader(self, schema) -> LandedReader:
        return LandedReader(self.options)
