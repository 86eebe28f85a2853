"""Copies of log folders, pruning, and text views."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.planner import FIRST, end_position, hop, list_files, resolve
from ..sources.files import Folder
from . import frames


def copy_log(spark: SparkSession, source: str, target: str, start: str | None = None) -> DataFrame:
    """Copies the complete events of a folder, or what another copy lacks: file, bytes.

    The copy of a file is byte for byte, so positions stay; a torn tail is left out and
    written over next time.  Each file is a task; links follow when all files are there.
    """
    frames.register(spark)
    src, dst = Folder(source), Folder(target)
    names = list_files(src)
    have = list_files(dst) if dst.exists() else []
    begin = names.index(have[-1]) if have and have[-1] in names else 0
    if not have and start:
        begin = names.index(resolve(src, start)[0])
    todo = names[begin:]

    def run(frames_of_names):
        for pdf in frames_of_names:
            done = []
            for name in pdf["file"]:
                a, b, end = Folder(source), Folder(target), FIRST
                for pos, _, n in hop(a, name):
                    end = pos + n
                if b.size(name) != end:
                    a.copy(name, b, end)
                done.append((name, end))
            yield pd.DataFrame(done, columns=["file", "bytes"])

    files = spark.createDataFrame([(n,) for n in todo], "file string").repartition(max(1, len(todo)))
    done = files.mapInPandas(run, "file string, bytes long").collect()  # a row a file
    last = have[-2] if len(have) > 1 else ""
    for name in todo:
        dst.write(f"{last}.next", name.encode())
        last = name
    return spark.createDataFrame(done or [], "file string, bytes long")


def prune_first(path: str) -> str:
    """Removes the oldest file of a folder, which must not be its only one."""
    folder = Folder(path)
    names = list_files(folder)
    if len(names) < 2:
        raise ValueError("the only file of a folder can't be removed")
    folder.write(".next", names[1].encode())
    folder.remove(names[0])
    folder.remove(f"{names[0]}.next")
    return names[0]


def follow(spark: SparkSession, path: str, show, checkpoint: str, once: bool = False, **options):
    """A streaming query that gives each new event's line (as ``view``) to ``show``, in log order within a batch."""
    log = frames.events(spark, path, stream=True, **options)

    def each(batch: DataFrame, _: int) -> None:
        for r in event_lines(batch).orderBy("file_seq", "start_pos").toLocalIterator():
            show(r["line"])

    writer = log.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 second")).start()


def event_lines(log: DataFrame) -> DataFrame:
    """file_seq, start_pos and one line an event."""
    head = F.format_string("%s %s:0x%04x %-17s", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.col("log_file"), F.col("next_pos"), F.col("event_name"))
    return log.select("file_seq", "start_pos", F.rtrim(head).alias("line"))


def latest(path: str) -> tuple[str, int]:
    return end_position(Folder(path))


def view(spark: SparkSession, path: str, **options) -> DataFrame:
    """Lines of text in log order: file_seq, start_pos, line_no, line.  An event's line is
    followed by its rows: SET with the new image, WHERE with the old one."""
    log = frames.events(spark, path, **options)
    named = F.when(F.col("event_name") == "tableMap", F.concat_ws(".", F.get_json_object("detail", "$.schema"), F.get_json_object("detail", "$.table"))).when(
        F.col("event_name") == "formatDescription", F.concat(F.lit("  v"), F.get_json_object("detail", "$.version"), F.lit(" "), F.get_json_object("detail", "$.server"))
    )
    rows = frames.rows(spark, path, **options)
    tables = rows.groupBy("file_seq", "start_pos").agg(F.concat_ws(".", F.first("schema_name"), F.first("table_name")).alias("_table"))
    head = F.format_string("%s %s:0x%04x %-17s", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.col("log_file"), F.col("next_pos"), F.col("event_name"))
    lines = log.select("file_seq", "start_pos", "log_file", "event_time", "next_pos", "event_name", named.alias("_named")).join(tables, ["file_seq", "start_pos"], "left")
    lines = lines.select("file_seq", "start_pos", F.lit(-1).alias("row_no"), F.lit(0).alias("_side"), F.rtrim(F.concat(head, F.coalesce("_named", "_table", F.lit("")))).alias("line"))

    def json(image: str):
        return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(image))), {"ignoreNullFields": "false"})

    new = rows.where("after IS NOT NULL").select("file_seq", "start_pos", "row_no", F.lit(0).alias("_side"), F.concat(F.lit("   SET: "), json("after")).alias("line"))
    old = rows.where("before IS NOT NULL").select("file_seq", "start_pos", "row_no", F.lit(1).alias("_side"), F.concat(F.lit(" WHERE: "), json("before")).alias("line"))
    number = F.row_number().over(Window.partitionBy("file_seq", "start_pos").orderBy("row_no", "_side")) - 1
    return lines.unionByName(new).unionByName(old).select("file_seq", "start_pos", number.alias("line_no"), "line")
