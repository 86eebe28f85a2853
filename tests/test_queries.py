"""Every query with SQL gives what DuckDB gives on the tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from tidelog.plans import controls, relational  # noqa: F401  register their queries
from tidelog.plans import queries as core
from tidelog.sources import datasource

SMALL = "/root/testdata/sf0.001"

ALL = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in ALL:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def cells(rows):
    def one(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return "NULL"
        return repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(map(one, r)) for r in rows)


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query(spark, tables, name):
    df = core.QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    got = cells(map(tuple, df.select(*cols).collect()))
    if name in core.SQL:
        rel = tables.sql(core.SQL[name])
        assert sorted(rel.columns) == cols
        assert got == cells(rel.select(*[duckdb.ColumnExpression(c) for c in cols]).fetchall())


@pytest.mark.parametrize("name", ["tablemap_asof", "checksum_ok", "event_positions", "event_type_counts", "header_expressions", "multi_file_chain", "prefix_prune", "resume_from_position", "sql_functions"])
def test_batches_and_files_end_early(spark, tables, tmp_path, monkeypatch, name):
    """As with large tables: where Arrow batches and files of bounded size end changes no result."""
    monkeypatch.setattr(core, "base_folder", lambda spark: str(tmp_path))
    monkeypatch.setattr(datasource, "FILE_BYTES", 10_000)
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": "100", "spark.sql.execution.arrow.maxBytesPerBatch": "4096"}
    before = {k: spark.conf.get(k) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    try:
        df = core.QUERIES[name](spark, SMALL)
        cols = sorted(df.columns)
        got = cells(map(tuple, df.select(*cols).collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == cells(tables.sql(core.SQL[name]).select(*[duckdb.ColumnExpression(c) for c in cols]).fetchall())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
