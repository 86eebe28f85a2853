"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = "4m"
#: Settings of own actions: Arrow batches are bounded by bytes, and shuffle files go as
#: soon as what was computed from them is written.
ACTION_SETTINGS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES,
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; only where that is unset on a
    single machine (as in tests) a folder of this machine is set instead."""
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = os.path.join(tempfile.gettempdir(), "checkpoints")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


@contextmanager
def own_action(spark: SparkSession):
    """Runs an action under ACTION_SETTINGS; the session's own come back after it."""
    before = {}
    for name, value in ACTION_SETTINGS.items():
        try:
            before[name] = spark.conf.get(name)
            spark.conf.set(name, value)
        except Exception:  # a Spark without this setting
            before.pop(name, None)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared checkpoint folder: later
    steps read it from there, whatever executor is lost."""
    ensure_checkpoint_dir(df.sparkSession)
    with own_action(df.sparkSession):
        return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read again: as
    ``cut``, and without the constraints that a checkpoint keeps, which iterations
    would let grow without end."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    with own_action(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fetched(df: DataFrame):
    """The rows of a frame of bounded size, as an Arrow table on the driver."""
    with own_action(df.sparkSession):
        return df.toArrow()


def bounded_batches(spark: SparkSession) -> None:
    """For queries and stages, which are applications: their session's Arrow batches are bounded by bytes, where
    the session has Spark's default.  Operators leave the session as it is."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, "64m").rstrip("b") in ("64m", "67108864"):
        spark.conf.set(name, BATCH_BYTES)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def computed_once(c: Column) -> Column:
    """``c``, kept from being copied into filters above it: the optimizer moves a filter
    below a projection by putting the whole expression into it, which for chains of
    large expressions multiplies them."""
    return F.when(F.monotonically_increasing_id() >= 0, c)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))
