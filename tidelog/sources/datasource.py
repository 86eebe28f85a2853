"""The ``tidelog`` data source: batch and streaming reads of log folders, and writes.

Options for reading: ``path``; ``mode`` (``events``, ``rows``, ``table`` or ``corrupt``); ``table``
(``db.table``, of mode ``table``); ``startingPosition`` (``earliest``, ``latest``, ``FILE``
or ``FILE:POS``); ``endingPosition``; ``rangeBytes``; ``verify`` (checksums, on by
default); ``lookback`` (take in the table maps before the start); ``payload`` (bodies
of events); ``windowBytes`` (what a task holds of its range at a time); ``errors`` (``failfast``,
or ``permissive``: events with a wrong checksum, without a table map or that can't be decoded give
no rows, and in mode ``events`` no detail; mode ``corrupt`` lists them with the reason).

Options for writing: ``path``, ``database``, ``table``, ``types`` (JSON by column), ``key``,
``rowsPerEvent``, ``eventsPerTransaction``, ``checksum``, ``metadata`` (``full`` or
``minimal``), ``time``, ``imageColumns`` (the only columns that images hold), ``fileBytes`` (a task
begins another file when its file has so many).
"""

from __future__ import annotations

import json
import uuid
from contextlib import ExitStack
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

from ..plans.planner import RANGE_BYTES, Range, list_files, plan, resolve
from .encoder import LogWriter, table_of
from .files import Folder
from .scan import CORRUPT_SCHEMA, EVENTS_SCHEMA, ROWS_SCHEMA, WINDOW, RangeScan, first_table_map, scan_corrupt, scan_events, scan_rows, scan_table, table_schema

NAME = "tidelog"
FILE_BYTES = 128 << 20


class Options(dict):
    """Options by name, whatever their case."""

    def __init__(self, options):
        super().__init__({k.lower(): v for k, v in dict(options).items()})

    def __getitem__(self, name: str):
        return super().__getitem__(name.lower())

    def get(self, name: str, default=None):
        return super().get(name.lower(), default)


def _on(options, name: str, default: bool) -> bool:
    return str(options.get(name, default)).lower() in ("true", "1", "yes")


@dataclass
class RangePartition(InputPartition):
    range: Range

    def __init__(self, r: Range):
        self.range = r


class Scanner:
    """What batch and streaming reads have in common."""

    def __init__(self, options: dict, schema: StructType):
        self.options, self.schema = Options(options), schema
        self.folder = Folder(options["path"])
        self.mode = options.get("mode", "rows")
        self.types: set[int] | None = None
        self.tables: set[str] | None = None
        self.schemas: set[str] | None = None

    def arrow(self) -> pa.Schema:
        return to_arrow_schema(self.schema)

    def scan(self, r: Range):
        o = self.options
        permissive = self.mode == "corrupt" or o.get("errors", "failfast").lower() == "permissive"
        scan = RangeScan(self.folder, r, _on(o, "verify", True), _on(o, "lookback", False), int(o.get("windowBytes", WINDOW)), permissive)
        for s in scan.windows():
            if self.mode == "events":
                yield from scan_events(s, self.types, _on(o, "payload", True))
            elif self.mode == "corrupt":
                yield from scan_corrupt(s)
            elif permissive:
                yield from s.tolerant(self._changes)
            else:
                yield from self._changes(s)

    def _changes(self, s: RangeScan):
        if self.mode == "table":
            return scan_table(s, self.options["table"], self.arrow())
        return scan_rows(s, self._wanted if self.types or self.tables or self.schemas else None)

    def _wanted(self, t, h) -> bool:
        return (self.types is None or h.type in self.types) and (self.tables is None or t.table in self.tables) and (self.schemas is None or t.schema in self.schemas)

    def range_bytes(self) -> int:
        return int(self.options.get("rangeBytes", RANGE_BYTES))


class LogReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.scanner = Scanner(options, schema)
        self.files: set[str] | None = None

    def partitions(self):
        s = self.scanner
        until = resolve(s.folder, s.options["endingPosition"]) if s.options.get("endingPosition") else None
        found = plan(s.folder, s.options.get("startingPosition"), until, s.range_bytes())
        return [RangePartition(r) for r in found if self.files is None or r.file in self.files] or [RangePartition(Range("", 0, 0, 0))]

    def read(self, partition):
        if partition.range.file:
            yield from self.scanner.scan(partition.range)


class PushingLogReader(LogReader):
    """With filters pushed to it: files, kinds of events, and tables not asked for are
    not read or not decoded.  Spark applies the filters again.  (A reader that takes
    filters only works where spark.sql.python.filterPushdown.enabled is on.)"""

    def pushFilters(self, filters):  # noqa: N802
        s = self.scanner
        for f in filters:
            name = ".".join(getattr(f, "attribute", ()))
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is not None and name == "log_file":
                self.files = values if self.files is None else self.files & values
            elif values is not None and name == "event_type":
                s.types = {int(v) for v in values} if s.types is None else s.types & {int(v) for v in values}
            elif values is not None and name == "table_name" and s.mode == "rows":
                s.tables = values if s.tables is None else s.tables & values
            elif values is not None and name == "schema_name" and s.mode == "rows":
                s.schemas = values if s.schemas is None else s.schemas & values
            yield f


@dataclass
class Written(WriterCommitMessage):
    files: list[str]
    rows: int


class FolderWriter(DataSourceArrowWriter):
    """Each task writes files of a bounded size; the commit gives them names and links in order."""

    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.options, self.schema, self.overwrite = Options(options), schema, overwrite
        self.run = uuid.uuid4().hex[:12]

    def _log(self, batch: pa.RecordBatch) -> LogWriter:
        o, fields = self.options, batch.schema
        if {"op", "before", "after"} <= set(fields.names):
            fields = list(fields.field("after").type)
        t = table_of(o.get("database", "db"), o.get("table", "t"), fields, json.loads(o.get("types", "{}")), [k for k in o.get("key", "").split(",") if k])
        return LogWriter(t, int(o.get("rowsPerEvent", 256)), int(o.get("eventsPerTransaction", 8)), _on(o, "checksum", True), o.get("metadata", "full") == "full", int(o.get("time", 0)), images=[c for c in o.get("imageColumns", "").split(",") if c])

    def write(self, iterator):
        from pyspark import TaskContext

        number, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:8]
        limit, folder = int(self.options.get("fileBytes", FILE_BYTES)), Folder(self.options["path"])
        log, out, rows, files = None, None, 0, []
        with ExitStack() as current:

            def end() -> None:
                log.close()
                out.write(log.log.drain())
                current.close()

            for batch in iterator:
                if not batch.num_rows:
                    continue
                if log is not None and log.size() >= limit:
                    end()
                    log = None
                if log is None:
                    log = self._log(batch)
                    files.append(f"new-{self.run}-{number:06d}-{attempt}-{len(files):06d}")
                    out = current.enter_context(folder.stream(files[-1]))
                log.extend(batch)
                out.write(log.log.drain())
                rows += batch.num_rows
            if log is not None:
                end()
        return Written(files, rows)

    def commit(self, messages):
        """Links new files behind the old ones.  An overwrite links the new chain first, lets the folder's
        first link go over to it at once, and then removes the old files: a reader sees one chain or the other."""
        folder = Folder(self.options["path"])
        old = list_files(folder) if folder.exists() else []
        number = max([int(n.rsplit(".", 1)[1]) for n in old if n.rsplit(".", 1)[-1].isdigit()] or [0])
        names = []
        for new in sorted(f for m in messages if m for f in m.files):
            number += 1
            names.append(f"log.{number:06d}")
            folder.rename(new, names[-1])
        for a, b in zip(names, names[1:]):
            folder.write(f"{a}.next", b.encode())
        if self.overwrite or not old:
            folder.write(".next", names[0].encode() if names else b"")
        elif names:
            folder.write(f"{old[-1]}.next", names[0].encode())
        for name in old if self.overwrite else ():
            folder.remove(name)
            if folder.has(f"{name}.next"):
                folder.remove(f"{name}.next")

    def abort(self, messages):
        folder = Folder(self.options["path"])
        for m in messages:
            for name in m.files if m else ():
                if folder.has(name):
                    folder.remove(name)


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        mode = self.options.get("mode", "rows")
        if mode == "events":
            return from_arrow_schema(EVENTS_SCHEMA, prefer_timestamp_ntz=True)
        if mode == "corrupt":
            return from_arrow_schema(CORRUPT_SCHEMA, prefer_timestamp_ntz=True)
        if mode == "table":
            folder = Folder(self.options["path"])
            t = first_table_map(folder, plan(folder, None, None, 1 << 62), self.options["table"])
            if t is None:
                raise ValueError(f"{self.options['table']} is not in {self.options['path']}; give a schema")
            return from_arrow_schema(table_schema(t.columns), prefer_timestamp_ntz=True)
        return from_arrow_schema(ROWS_SCHEMA, prefer_timestamp_ntz=True)

    def reader(self, schema):
        kind = PushingLogReader if _on(self.options, "pushFilters", False) else LogReader
        return kind(self.options, schema)

    def writer(self, schema, overwrite):
        return FolderWriter(self.options, schema, overwrite)

    def streamReader(self, schema):  # noqa: N802
        from ..streaming.stream import LogStreamReader

        return LogStreamReader(self.options, schema)
