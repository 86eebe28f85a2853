"""Following a log folder as a stream.

An offset is a file and a position after a complete transaction, so a batch never
starts between a table map and its rows, and a torn tail waits until it is whole.
Positions in a file are looked for again after its successor appears, so nothing
appended in between is lost.
"""

from __future__ import annotations

from pyspark.sql.datasource import DataSourceStreamReader

from ..plans.planner import FIRST, list_files, plan, resolve, safe_end
from ..sources.datasource import RangePartition, Scanner
from ..sources.files import Folder


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema):
        self.scanner = Scanner(options, schema)
        self.known: dict | None = None

    @property
    def folder(self) -> Folder:
        return self.scanner.folder

    def initialOffset(self):  # noqa: N802
        name, pos = resolve(self.folder, self.scanner.options.get("startingPosition"))
        return {"file": name, "pos": pos}

    def latestOffset(self):  # noqa: N802
        files = list_files(self.folder)
        if not files:
            return {"file": "", "pos": 0}
        name = files[-1]
        start = self.known["pos"] if self.known and self.known["file"] == name else FIRST
        self.known = {"file": name, "pos": safe_end(self.folder, name, start)}
        return dict(self.known)

    def partitions(self, start, end):
        if not end["file"] or start == end:
            return []
        begin = f"{start['file']}:{start['pos']}" if start["file"] else "earliest"
        return [RangePartition(r) for r in plan(self.folder, begin, (end["file"], end["pos"]), self.scanner.range_bytes())]

    def read(self, partition):
        yield from self.scanner.scan(partition.range)

    def commit(self, end):
        pass
