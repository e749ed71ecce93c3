"""Headline timings as one JSON line: single queries from the raw tables, the full rebuild, and on top of the
published run the payload (all feeds) and all insights.

BENCH_SF_DIR  folder with the driver tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from salesgrain.plans import payload, publish  # noqa: E402
from salesgrain.plans.catalog import Tables  # noqa: E402
from salesgrain.plans.insights import INSIGHTS  # noqa: E402
from salesgrain.plans.staging import Stage  # noqa: E402
from salesgrain.registry import all_queries  # noqa: E402
from salesgrain.sources.driver_tables import PARAMS, driver_relations  # noqa: E402

SINGLE = (
    "tree_daily", "hourly", "item_daily", "option_monthly", "topping_route", "pair_lift", "party_size",
    "member_visits", "calendar_daily", "grab_match", "pair_attach", "occupancy_hourly", "dead_hours",
    "opportunity", "feed_pairs_menu", "insight_driver_tree",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    scratch = tempfile.mkdtemp(prefix="bench-")
    queries = all_queries()
    for name in ("ticket_hist", "tree_daily"):  # start the executors, load and compile the classes
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        timings[name] = round(time.perf_counter() - start, 3)

    for name in SINGLE:
        timed(name, lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    rel = driver_relations(spark, sf_dir)
    timed("full_rebuild", lambda: publish.rebuild(rel, PARAMS, f"{scratch}/published", "bench"))
    tables = Tables(rel, PARAMS, Stage(spark, None, f"{scratch}/feeds"))
    current = publish.published(spark, f"{scratch}/published")
    for name in current.manifest["tables"]:
        tables.put(name, current[name])
    timed("payload", lambda: payload.write_payload(tables, f"{scratch}/payload", dt.datetime(2001, 8, 2)))

    def all_insights() -> None:
        for make in INSIGHTS.values():
            make(tables).write.format("noop").mode("overwrite").save()

    timed("insights", all_insights)
    print(json.dumps({
        "metric": "total_wall_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
