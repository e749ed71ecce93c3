"""Plan shapes that keep the work distributed, and values against the SQL counterparts."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry
from oracles import all_sql
from salesgrain.plans.models import MODELS
from salesgrain.registry import all_queries

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_sql_counterpart():
    solved = {f"model_{name}" for name in MODELS}  # regressions: tests/test_models.py
    assert set(all_queries()) - solved == set(all_sql()) and solved <= set(all_queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_data
def test_making_a_query_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("making", "queries")
    try:
        for make in all_queries().values():
            make(spark, SF)
        assert list(tracker.getJobIdsForGroup("making")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def scans_of_lines(plan: str) -> int:
    return sum("l_orderkey" in line and "FileScan" in line for line in plan.splitlines())


# most scans of lineitem and most hash exchanges of the initial plan, nothing broadcast
CEILINGS = {
    "tree_daily": (2, 18), "hourly": (2, 18), "pax_trust": (2, 18), "item_daily": (2, 20), "topping_route": (3, 24),
    "pair_attach": (2, 23), "lever_daily": (2, 24), "lever_value": (2, 25), "set_incremental": (2, 22),
    "opportunity_notes": (2, 27), "occupancy_hourly": (3, 76), "bill_intervals": (3, 75), "dead_hours": (3, 82),
    "dead_hours_rollup": (3, 83), "opportunity": (5, 110), "feed_opportunity": (5, 110), "insight_digest": (7, 145),
    "insight_keying_lag": (0, 35), "grab_match": (0, 20), "feed_grab_basket": (2, 34), "feed_grab_match_cov": (0, 27),
    "insight_platform_attach": (4, 55), "pair_lift": (1, 14), "party_size": (2, 36), "model_attach_regression": (4, 42),
    "model_calendar_regression": (0, 20),
}

@needs_data
def test_no_query_reads_facts_again_and_again(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    over = {}
    try:
        queries = all_queries()
        for name, most in CEILINGS.items():
            plan = physical(queries[name](spark, SF))
            got = scans_of_lines(plan), plan.count("Exchange hashpartitioning")
            if got[0] > most[0] or got[1] > most[1]:
                over[name] = got
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert not over


def operators_above(plan: str, marker: str) -> list[str]:
    """From the line with the marker up to the nearest join: the operators that its rows pass, without the lines between."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if marker in line)
    depth, out = len(lines[at]), []
    for line in reversed(lines[:at]):
        indent = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if indent < depth:
            depth = indent
            out.append(line.strip(" :+-"))
        if "Join" in line:
            return out
    return out


@needs_data
@pytest.mark.parametrize("name", ["insight_attach_layers", "tree_daily", "hourly", "base_order_facts", "base_promo"])
def test_sums_per_order_keep_no_table_of_orders(spark, name):
    """Rows are sorted by order once and summed as they pass, up to the join with orders: no hash table, no second sort."""
    passed = operators_above(physical(all_queries()[name](spark, SF)), "REPARTITION_BY_COL")
    assert sum("Sort [" in x for x in passed) == 1 and not any("Aggregate" in x for x in passed), passed


def test_an_order_whose_rows_share_a_line_has_one_row_of_facts(spark, shop):
    """Several rows of one line id, as many as one wants, are all summed and the order stays one row."""
    import domain

    from salesgrain.plans.catalog import Tables
    from salesgrain.sources.relations import frame_relations

    data = domain.frames(spark)
    twice = data["order_lines"].unionByName(data["order_lines"])
    t = Tables(frame_relations(spark, {**data, "order_lines": twice}), domain.PARAMS)

    def menu_mains(t):
        facts = t.base.facts(["main_units", "main_thb"]).select("order_id", "main_units", "main_thb").collect()
        return {r["order_id"]: (r["main_units"], r["main_thb"]) for r in facts}, len(facts)

    once, orders = menu_mains(shop)
    doubled, rows_ = menu_mains(t)
    assert rows_ == orders == len(once) and any(units for units, _ in once.values())
    assert doubled == {order: (2 * units, 2 * thb) for order, (units, thb) in once.items()}


@needs_data
@pytest.mark.parametrize("name", [
    "tree_daily", "pair_lift", "party_size", "bill_intervals", "occupancy_hourly", "calendar_daily",
    "grab_match", "pair_attach", "lever_daily",
])
def test_no_nested_loops_or_cartesian_products(spark, name):
    plan = physical(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@needs_data
def test_no_join_is_forced_to_broadcast(spark):
    """Without a size limit for broadcasting, nothing is broadcast: no hint overrides it."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("tree_daily", "pair_lift", "grab_match", "item_daily"):
            plan = physical(entry.queries()[name](spark, SF))
            assert "BroadcastHashJoin" not in plan and "CartesianProduct" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@needs_data
def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = physical(entry.queries()["ticket_hist"](spark, SF))
    orders = next(line for line in plan.splitlines() if "o_totalprice" in line and "ReadSchema" in line)
    assert "o_orderstatus" in orders and "PushedFilters: [" in orders
    assert "GreaterThanOrEqual(o_totalprice" in orders
    lines = physical(entry.queries()["set_monthly"](spark, SF))
    scans = [line for line in lines.splitlines() if "l_orderkey" in line and "ReadSchema" in line]
    assert scans and not any("l_shipdate" in re.sub(r".*ReadSchema", "", line) for line in scans)


def test_windows_reach_every_partitioned_source(spark, tmp_path):
    """Days outside the window are not even listed, whichever table a query reads."""
    import domain
    from pyspark.sql import functions as F

    from salesgrain.plans.catalog import Tables
    from salesgrain.sources.relations import SCHEMAS, parquet_relations

    data = domain.frames(spark)
    for name in SCHEMAS:
        df = data[name] if name in data else spark.createDataFrame([], SCHEMAS[name])
        if name in ("order_lines", "sold_options", "table_sessions"):
            df = df.drop("business_date").join(data["orders"].select("order_id", "business_date"), "order_id")
        partitioned = name in ("orders", "order_lines", "sold_options", "table_sessions")
        writer = df.write.partitionBy("business_date") if partitioned else df.write
        writer.parquet(f"{tmp_path}/{name}")
    t = Tables(parquet_relations(spark, str(tmp_path)), domain.PARAMS)
    first = str(domain.PARAMS.days_ago(domain.PARAMS.window_days))
    for name, sources in {"tree_daily": 3, "option_monthly": 3, "dwell": 2, "occupancy_hourly": 4}.items():
        plan = t.build(name)._jdf.queryExecution().executedPlan().toString()
        scans_ = [x for x in plan.splitlines() if "FileScan" in x and "business_date" in x]
        assert len(scans_) >= sources, name
        assert all("PartitionFilters: [isnotnull(business_date" in x for x in scans_), name
    assert first and t.build("tree_daily").agg(F.sum("orders")).first()[0] > 0


def test_relations_without_a_day_are_read_whole(spark, tmp_path):
    import domain

    from salesgrain.plans.catalog import Tables
    from salesgrain.sources.relations import SCHEMAS, parquet_relations

    data = domain.frames(spark)
    dated = ("order_lines", "sold_options", "table_sessions")
    for root in ("with", "without", "empty"):
        for name in SCHEMAS:
            df = data[name] if name in data else spark.createDataFrame([], SCHEMAS[name])
            if name in dated:
                df = df.drop("business_date")
                if root == "with":
                    df = df.join(data["orders"].select("order_id", "business_date"), "order_id")
                df = df.limit(0) if root == "empty" else df
            (df.write.partitionBy("business_date") if root == "with" and name in dated else df.write).parquet(f"{tmp_path}/{root}/{name}")
    t = {root: Tables(parquet_relations(spark, f"{tmp_path}/{root}"), domain.PARAMS) for root in ("with", "without", "empty")}
    for name in ("tree_daily", "option_monthly", "dwell"):
        want = sorted(map(str, t["with"].build(name).collect()))
        assert want and sorted(map(str, t["without"].build(name).collect())) == want, name
    assert t["empty"].build("dwell").collect() == []


@needs_data
def test_values_match_the_sql_counterparts(spark):
    import duckdb

    from scripts.check import rows as canonical

    db = duckdb.connect()
    for name in sorted(f[:-8] for f in os.listdir(SF) if f.endswith(".parquet")):
        db.sql(f"CREATE VIEW {name} AS FROM '{SF}/{name}.parquet'")
    sql = entry.oracle_sql()
    for name in ("tree_daily", "item_daily", "party_size", "calendar_daily", "occupancy_hourly", "grab_match",
                 "set_incremental", "feed_pairs_menu", "insight_driver_tree", "insight_keying_lag"):
        df = entry.queries()[name](spark, SF)
        rel = db.sql(sql[name])
        assert sorted(df.columns) == sorted(rel.columns), name
        assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(rel.columns, rel.fetchall()), name


@needs_data
def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
