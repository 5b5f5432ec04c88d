"""Times the headline queries: one JSON line on standard output.

BENCH_SF_DIR: folder of the tables; BENCH_CPUS: threads.  The rollup queries run
on a stored fact, partitioned by day, of ``COPIES`` times the events, and on its
stored cube, both written by a commit before timing; every query is run once to
warm up and then timed as the better of two runs.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallystone import queries as engine
from tallystone.plans.cubes import Agg, AggQuery
from tallystone.session import EngineConfig, Session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
PLAIN = ["agg_star_flow", "join_star", "sum_group", "count_distinct", "topn_desc", "agg_sorted_limit", "filter_floor_day_ge", "rowvalue_desc_key", "window_frame", "join_inner", "grouping_sets", "subquery_exists"]


COPIES = 40


def rollup(lo: datetime, hi: datetime) -> AggQuery:
    return AggQuery("visits", [], [Agg("SUM", "amount", "total"), Agg("COUNT", None, "n")], "ts", "DAY", lo=lo, hi=hi)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="bench-")
    spark.sparkContext.setCheckpointDir(root)
    runs = {n: (lambda n=n: engine.QUERIES[n](spark, FOLDER)) for n in PLAIN}

    root_of = f"{root}/store"
    s = Session(spark, root_of, EngineConfig(enable_inserts=True))
    s.sql("CREATE TABLE visits (user_id BIGINT PRIMARY KEY, ts TIMESTAMP PRIMARY KEY DESC ROW_TIMESTAMP, event_id BIGINT PRIMARY KEY, event_type VARCHAR, amount DECIMAL(22, 6)) PARTITION BY HASH (user_id) PARTITIONS 8")
    s.sql("CREATE MATERIALIZED VIEW visits_by_day AS SELECT SUM(amount) AS total, COUNT(*) AS n FROM visits GROUP BY user_id, FLOOR(ts TO DAY)")
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    s.append("visits", events.crossJoin(spark.range(COPIES).withColumnRenamed("id", "copy")).select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), (F.col("event_id") * COPIES + F.col("copy")).alias("event_id"), "event_type", F.col("value").cast("decimal(22,6)").alias("amount")))
    s.commit()
    off = Session(spark, root_of, EngineConfig(disable_materialized_views=True))
    whole = (datetime(2024, 1, 2), datetime(2024, 1, 28))
    odd = (datetime(2024, 1, 2, 0, 30, 30), datetime(2024, 1, 28, 0, 30, 30))
    assert (s.route(rollup(*whole)).kind, s.route(rollup(*odd)).kind) == ("cube", "union")
    runs |= {
        "rollup_from_fact": lambda: off.aggregate(rollup(*odd)),
        "rollup_from_cube": lambda: s.aggregate(rollup(*whole)),
        "rollup_from_union": lambda: s.aggregate(rollup(*odd)),
        "one_day_of_the_fact": lambda: off.sql("SELECT event_type, COUNT(*) AS n FROM visits WHERE FLOOR(ts TO DAY) = TIMESTAMP '2024-01-05 00:00:00' GROUP BY event_type"),
    }
    times = {}
    for name, run in runs.items():
        best = None
        for i in range(3):
            begun = time.perf_counter()
            run().write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - begun
            if i:
                best = took if best is None else min(best, took)
        times[name] = round(best, 4)
    spark.stop()
    shutil.rmtree(root, ignore_errors=True)
    print(json.dumps({"metric": "seconds for the headline queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(FOLDER.rstrip("/"))}))


if __name__ == "__main__":
    sys.exit(main())

