from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("salesgrain-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.log.level", "ERROR")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def shop(spark):
    """The hand-made noodle-chain fixture as tables."""
    from domain import PARAMS, frames, stage
    from salesgrain.plans.catalog import Tables
    from salesgrain.sources.relations import frame_relations

    return Tables(frame_relations(spark, frames(spark)), PARAMS, stage(spark, "recorded_stays"))


def rows(df, *keys):
    """Rows as dicts, indexed by key columns when some are named."""
    out = [r.asDict() for r in df.collect()]
    if not keys:
        return out
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in out}
