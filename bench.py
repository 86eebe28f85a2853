"""Times the headline queries; prints one JSON line.

Logs are encoded before anything is timed.  Each query runs once to warm up and then
BENCH_RUNS times (3) into a sink that drops its rows; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidelog.operators import frames
from tidelog.plans import queries as core
from tidelog.plans.planner import hop, list_files
from tidelog.sources.files import Folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def timed(run) -> float:
    run()
    took = []
    for _ in range(RUNS):
        began = time.perf_counter()
        run()
        took.append(time.perf_counter() - began)
    return round(statistics.median(took), 4)


def drop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    parts = max(4, int(CPUS))
    line = core.plain(spark, SF_DIR, "lineitem", parts)
    sizes = {"lineitem_log_mb": round(sum(Folder(line).size(n) for n in list_files(Folder(line))) / 1e6, 1)}
    change = core.change_log(spark, SF_DIR)
    events_log = core.plain(spark, SF_DIR, "events", parts)

    def stream() -> None:
        core._drain(spark, events_log, f"{core.base_folder(spark)}/bench-{time.time_ns()}")

    queries = {
        "plan_header_hop": lambda: [sum(1 for _ in hop(Folder(line), n)) for n in list_files(Folder(line))],
        "events_scan": lambda: drop(frames.events(spark, line, payload=False)),
        "events_scan_no_crc": lambda: drop(frames.events(spark, line, payload=False, verify=False)),
        "table_decode_lineitem": lambda: drop(frames.table(spark, line, "shop.lineitem")),
        "table_decode_small_ranges": lambda: drop(frames.table(spark, line, "shop.lineitem", rangeBytes=2 << 20)),
        "rows_as_maps_lineitem": lambda: drop(frames.rows(spark, line)),
        "latest_state_orders": lambda: drop(frames.latest_state(frames.table(spark, change, "shop.orders"), ["o_orderkey"])),
        "pricing_summary": lambda: drop(
            frames.table(spark, line, "shop.lineitem")
            .select("after.*")
            .groupBy("l_returnflag", "l_linestatus")
            .agg(F.sum("l_quantity").alias("q"), F.sum("l_extendedprice").alias("p"), F.avg("l_discount").alias("d"), F.count("*").alias("n"))
        ),
        "segment_revenue": lambda: drop(core.QUERIES["segment_revenue"](spark, SF_DIR)),
        "tumbling_counts": lambda: drop(core.QUERIES["tumbling_counts"](spark, SF_DIR)),
        "stream_available_now": stream,
    }
    chosen = sys.argv[1:] or list(queries)
    found = {name: timed(queries[name]) for name in chosen}
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(found.values()), 3), "unit": "sec", "queries": found, "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": int(CPUS), **sizes}))


if __name__ == "__main__":
    main()
