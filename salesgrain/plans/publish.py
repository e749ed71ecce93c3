"""Full rebuild: stage the shared base, write every table, then switch readers to the new run."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesgrain.params import Params
from salesgrain.plans.catalog import BUILDERS, Tables
from salesgrain.plans.staging import Stage, new_run_id, remove, side_by_side, write_line
from salesgrain.sources.relations import Relations

SHARED = frozenset({
    "orders", "lines", "sold_rows", "options", "units", "order_meals", "split_children",
    "recorded_stays", "seat_days", "till_cells", "numbered_tabs",
})


JOBS_AT_ONCE = 8
KEEP_RUNS = 3


def rebuild(rel: Relations, params: Params, root: str, run_id: str | None = None, keep_runs: int = KEEP_RUNS) -> str:
    """S16, S17, S20. Write all tables of a run; the manifest, written last, makes it visible.

    A run that fails on the way leaves no manifest, so readers keep the run before it. Shared
    intermediates lie in a work folder of the run that is removed at its end; of finished runs the
    last keep_runs stay. Tables and intermediates are Parquet: one that reads another reads the
    stored copy, and lost executors only cost the tasks they held. Tables do not depend on the order
    they are started in, so several are written at once.
    """
    spark, run_id = rel.spark, run_id or new_run_id()
    run, work = f"{root}/runs/{run_id}", f"{root}/work/{run_id}"
    stage = Stage(spark, SHARED | frozenset(BUILDERS), lambda name: run if name in BUILDERS else work)
    tables = Tables(rel, params, stage)
    try:
        counts = side_by_side(lambda name: tables[name].count(), BUILDERS, JOBS_AT_ONCE)
    except BaseException:
        remove(spark, run)
        raise
    finally:
        remove(spark, work)
    manifest = {
        "run_id": run_id,
        "as_of": params.as_of.isoformat(),
        "data_through": params.data_through.isoformat(),
        "tables": counts,
    }
    write_line(spark, manifest, f"{root}/manifests/{run_id}")
    for old in manifests(spark, root).select("run_id").offset(keep_runs).collect():  # a few names
        remove(spark, f"{root}/manifests/{old.run_id}")
        remove(spark, f"{root}/runs/{old.run_id}")
    return run_id


@dataclass(frozen=True)
class Published:
    """The current run, or a named one, as tables."""

    spark: SparkSession
    root: str
    manifest: dict

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/runs/{self.manifest['run_id']}/{name}")


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """Run status, newest first: one small JSON line per finished run."""
    schema = "run_id string, as_of date, data_through date, tables map<string, bigint>"
    text = spark.read.option("recursiveFileLookup", True).text(f"{root}/manifests")
    parsed = text.select(F.from_json("value", schema).alias("m"), "value").select("m.*", "value")
    return parsed.orderBy(F.desc("run_id"))


def published(spark: SparkSession, root: str, run_id: str | None = None) -> Published:
    runs = manifests(spark, root)
    if run_id is not None:
        runs = runs.where(F.col("run_id") == run_id)
    return Published(spark, root, json.loads(runs.select("value").first()["value"]))


def row_counts(spark: SparkSession, root: str) -> DataFrame:
    """S22. Rows per expected table of the current run; a missing table has NULL rows."""
    current = manifests(spark, root).limit(1).select(F.explode("tables").alias("name", "rows"))
    expected = spark.createDataFrame([(name,) for name in BUILDERS], "name string")
    return expected.join(current, "name", "left").orderBy("name")
