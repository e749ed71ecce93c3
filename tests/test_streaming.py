"""The hourly stream against the hourly table."""

from __future__ import annotations

import datetime as dt

import domain
from conftest import rows
from domain import PARAMS, TODAY, line, order
from pyspark.sql import functions as F

from salesgrain.plans.catalog import Tables
from salesgrain.sources.relations import frame_relations
from salesgrain.streaming.hourly import read_hourly, run_hourly

KEY = ("location_id", "business_date", "hour", "channel")
FAR = TODAY + dt.timedelta(days=30)


def instants(orders):
    """Wall-clock times of the fixture as the instants that files hold."""
    return orders.withColumns({c: F.to_utc_timestamp(F.col(c).cast("timestamp"), "Asia/Bangkok") for c in ("opened_at", "closed_at")})


def arrive(spark, root, orders=(), lines=(), options=None):
    """Adds files: orders, lines as (day, line), options of the fixture's schema with their day."""
    data = domain.frames(spark)
    if orders:
        instants(spark.createDataFrame(list(orders), data["orders"].schema)).write.mode("append").parquet(f"{root}/orders")
    if lines:
        schema = data["order_lines"].schema.add("business_date", "date")
        spark.createDataFrame([(*row, day) for day, row in lines], schema).write.mode("append").parquet(f"{root}/order_lines")
    if options is not None:
        options.write.mode("append").parquet(f"{root}/sold_options")


def later_rows(day):
    """A bill that comes late, and one that its line comes to late."""
    return [order("9-1", day=day, total=77, pax=3, closed="12:45")], [
        (day, line("9-1", 901, 10, "N1 ก๋วยเตี๋ยว ต้มยำ ทรงเครื่อง", "main", qty=2)),
        (day, line("1-2", 902, 10, "N1 ก๋วยเตี๋ยว ต้มยำ ทรงเครื่อง", "main")),
    ]


def tick(spark, root, day):
    """Rows that meet nothing and move every input's day on: a closed branch's bill, a line and an option of no bill."""
    options = domain.frames(spark)["sold_options"].where(F.col("modifier_group").rlike(PARAMS.rules.option_item_groups_re))
    nowhere = options.limit(1).withColumn("order_id", F.lit("none")).withColumn("business_date", F.lit(day))
    arrive(spark, root, [order("none", loc="ghost", day=day)], [(day, line("none", 0, 10, "x", "main"))], nowhere)


def test_finished_days_equal_the_table_with_late_rows(spark, tmp_path):
    data = domain.frames(spark)
    root, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    days = data["orders"].select("order_id", "business_date")
    for name in ("orders", "order_lines", "sold_options"):
        df = instants(data[name]) if name == "orders" else data[name].join(days, "order_id")
        df.write.parquet(f"{root}/{name}")
    rel = frame_relations(spark, {name: df for name, df in data.items() if name not in ("orders", "order_lines", "sold_options")})

    def finished():
        run_hourly(rel, root, PARAMS, out, checkpoint)
        return rows(read_hourly(spark, out), *KEY)

    first = finished()
    assert all(k[1] < TODAY - dt.timedelta(days=2) for k in first)  # two days may still change
    late = domain.D
    orders, lines = later_rows(late)
    arrive(spark, root, orders, lines)
    finished()
    tick(spark, root, FAR)
    got = finished()
    # after its day is finished a row no longer counts
    arrive(spark, root, [order("9-2", day=late, total=1000)])
    assert finished() == got

    all_data = dict(data)
    all_data["orders"] = data["orders"].unionByName(spark.createDataFrame(orders, data["orders"].schema))
    all_data["order_lines"] = data["order_lines"].unionByName(spark.createDataFrame([row for _, row in lines], data["order_lines"].schema))
    table = rows(Tables(frame_relations(spark, all_data), PARAMS).build("hourly").select(
        *KEY, "orders", "pax_keyed", "net_thb", "main_units"
    ), *KEY)
    assert set(got) == set(table) and len(got) > 8
    for key, want in table.items():
        assert {c: got[key][c] for c in want} == want, key
    assert any(k[1] == late and got[k]["main_units"] > 1 for k in got)
