"""Change logs as DataFrames."""

from __future__ import annotations

import importlib

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.planner import end_position as _end_position
from ..plans.planner import list_files
from ..sources.datasource import NAME, LogSource
from ..sources.files import Folder

ORDER = ("file_seq", "start_pos", "row_no")


def register(spark: SparkSession) -> None:
    """Makes the source known.  Its code travels with it, as the processes in which
    Spark plans a source don't see the driver's import path."""
    for package in ("functions", "plans", "sources", "streaming"):
        cloudpickle.register_pickle_by_value(importlib.import_module(f"..{package}", __package__))
    spark.dataSource.register(LogSource)


def _read(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    register(spark)
    reader = (spark.readStream if stream else spark.read).format(NAME).option("path", path)
    push = str(spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")).lower()
    for k, v in {"pushFilters": push if not stream else "false", **options}.items():
        if v is not None:
            reader = reader.option(k, str(v))
    return reader.load()


def events(spark: SparkSession, path: str, **options) -> DataFrame:
    """One row an event, with its position, checksum state, fields and body."""
    return _read(spark, path, mode="events", **options)


def rows(spark: SparkSession, path: str, **options) -> DataFrame:
    """One row a changed row of any table, images as maps of text."""
    return _read(spark, path, mode="rows", **options)


def corrupt(spark: SparkSession, path: str, **options) -> DataFrame:
    """One row an event that ``errors="permissive"`` leaves out, with the reason."""
    return _read(spark, path, mode="corrupt", **options)


def table(spark: SparkSession, path: str, name: str, **options) -> DataFrame:
    """One row a changed row of one table, images as typed structs."""
    return _read(spark, path, mode="table", table=name, **options)


def write_log(df: DataFrame, path: str, table: str, mode: str = "append", **options) -> None:
    """Writes rows (or changes: op, before, after) as log files, one a partition."""
    register(df.sparkSession)
    database, _, name = table.rpartition(".")
    writer = df.write.format(NAME).mode(mode).option("path", path).option("database", database or "db").option("table", name)
    for k, v in options.items():
        writer = writer.option(k, str(v))
    writer.save()


def files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder in order of creation: file_seq, log_file, bytes."""
    folder = Folder(path)
    return spark.createDataFrame([(i, n, folder.size(n)) for i, n in enumerate(list_files(folder))], "file_seq int, log_file string, bytes long")


def end_position(spark: SparkSession, path: str) -> DataFrame:
    """The last file and the end of its last complete event."""
    return spark.createDataFrame([_end_position(Folder(path))], "log_file string, pos long")


def _key_of(keys: list[str]) -> list[Column]:
    return [F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")).alias(k) for k in keys]


def latest_state(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that a table holds after all changes.

    A grouped maximum by log order: partial aggregation keeps one image a key and
    task, so neither a long history nor a hot key is sorted or gathered.  An update
    that changes its key deletes the old one, too.
    """
    at = F.struct(*ORDER)
    moved = changes.where("op = 'update'").where(~(F.struct(*[F.col(f"before.{k}") for k in keys]).eqNullSafe(F.struct(*[F.col(f"after.{k}") for k in keys]))) & F.col("before").isNotNull())
    gone = moved.select(*[F.col(f"before.{k}").alias(k) for k in keys], F.struct(at, F.lit(0)).alias("_at"), F.lit(None).cast(changes.schema["after"].dataType).alias("_image"))
    now = changes.select(*_key_of(keys), F.struct(at, F.lit(1)).alias("_at"), F.when(F.col("op") != "delete", F.col("after")).alias("_image"))
    last = now.unionByName(gone).groupBy(*keys).agg(F.max_by("_image", "_at").alias("_image"))
    return last.where("_image IS NOT NULL").select("_image.*")


def changes_between(changes: DataFrame, start: tuple[int, int] | None = None, end: tuple[int, int] | None = None) -> DataFrame:
    """Changes from (file_seq, start_pos), included, to another, excluded."""
    at = F.struct("file_seq", "start_pos")
    for bound, keep in ((start, lambda b: at >= b), (end, lambda b: at < b)):
        if bound is not None:
            changes = changes.where(keep(F.struct(F.lit(bound[0]).cast("int"), F.lit(bound[1]).cast("long"))))
    return changes


def with_table_map(log: DataFrame) -> DataFrame:
    """Events with the table that their table id means there: the last table map of
    that id before them in the same file."""
    maps = F.when(F.col("event_name") == "tableMap", F.col("detail"))
    key = F.coalesce(F.get_json_object(maps, "$.table_id").cast("long"), F.when(F.col("event_name").like("%Rows%"), little_endian(F.col("body"), 0, 6).cast("long")))
    named = F.when(maps.isNotNull(), F.concat_ws(".", F.get_json_object(maps, "$.schema"), F.get_json_object(maps, "$.table")))
    w = Window.partitionBy("log_file", "_id").orderBy("start_pos").rowsBetween(Window.unboundedPreceding, 0)
    return log.withColumn("_id", key).withColumn("_name", named).where("_id IS NOT NULL").withColumn("table", F.last("_name", ignorenulls=True).over(w)).drop("_name").withColumnRenamed("_id", "table_id")


def with_query(log: DataFrame) -> DataFrame:
    """Events with the text of the last rows-query event before them in their file."""
    text = F.when(F.col("event_name") == "rowsQuery", F.get_json_object("detail", "$.query"))
    w = Window.partitionBy("log_file").orderBy("start_pos").rowsBetween(Window.unboundedPreceding, 0)
    return log.withColumn("statement", F.last(text, ignorenulls=True).over(w))


def little_endian(data: Column, offset: int, n: int) -> Column:
    from ..functions.exprs import le_uint

    return le_uint(data, offset, n)
