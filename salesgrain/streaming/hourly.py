"""The hourly table as a stream: bills, lines and options arrive as files, finished days come out.

The event time is the business day. Options meet their line and units meet their bill in stream-stream joins on
the order and its day, bills and units meet in one aggregation, and a day is written once, when the watermark
(the latest day of every input's rows that can count, less LATE_DAYS) has passed it: rows that come later than that no longer
count, all others do, in whatever order the three inputs bring them. Joins and sums keep state for days
that are still open only.

A run takes the files that are there and ends; the checkpoint says where the next one goes on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesgrain.functions import text
from salesgrain.functions.numbers import MONEY
from salesgrain.params import Params
from salesgrain.plans.base import Base
from salesgrain.plans.staging import no_stage
from salesgrain.sources.relations import DATED, SCHEMAS, Relations, normalize

LATE_DAYS = 2
DAY = "day"


def arriving(spark: SparkSession, root: str, name: str, late_days: int) -> DataFrame:
    """A relation as a stream of Parquet files, with its business day as event time."""
    schema = ", ".join([SCHEMAS[name], *([DATED[name]] if name in DATED else [])])
    files = normalize(name, spark.readStream.schema(schema).parquet(f"{root}/{name}"))
    return files.withColumn(DAY, F.col("business_date").cast("timestamp")).withWatermark(DAY, f"{late_days} days")


def hourly_stream(rel: Relations, root: str, params: Params, late_days: int = LATE_DAYS) -> DataFrame:
    """Orders, keyed guests, net and mains by branch, day, closing hour and channel, as the batch table has them.

    Orders, order_lines and sold_options stream from below root; the small relations are those of rel.
    """
    spark, rules = rel.spark, params.rules
    base = Base(rel, params, no_stage(spark))

    def stream(name: str) -> DataFrame:
        return arriving(spark, root, name, late_days).where(base.since("business_date", params.window_days))

    live = rel["locations"].where(F.col("is_confirmed_live") & (F.col("location_type") == "branch")).select("location_id")
    orders = (
        stream("orders").where(F.col("is_finalized") & ~F.col("is_voided"))
        .join(live, "location_id", "left_semi")
        .select("order_id", DAY, "location_id", "channel", F.hour("closed_at").alias("hour"), "pax", "total_thb")
    )
    codes = rel["items"].select("itemid", "item_code")
    copies = rel["split_dupe_lines"].select("line_id").distinct()
    lines = (
        stream("order_lines").where(F.col("is_active") & ~F.col("is_special_line"))
        .join(copies, "line_id", "left_anti")
        .join(codes, "itemid", "left")
    )
    is_main = F.col("tree_category") == "main"
    free = text.is_free_item(F.col("item_code"), F.col("name_th"), rules)
    on_menu = lines.where(is_main & ~free).select("order_id", DAY, F.col("qty").cast(MONEY).alias("mains"))
    picks = (
        base.item_options(stream("sold_options")).join(base.item_choices.where(is_main), "choice_key")
        .select("order_id", "line_id", DAY, (F.col("choice_qty") * F.col("qty_mult")).cast(MONEY).alias("mains"))
        .join(lines.select("order_id", "line_id", DAY), ["order_id", "line_id", DAY])
        .select("order_id", DAY, "mains")
    )
    cell = ["location_id", DAY, "hour", "channel"]

    def none(kind: str) -> Column:
        return F.lit(None).cast(kind)

    bills = orders.select(*cell, F.lit(1).alias("bill"), "pax", "total_thb", none(MONEY).alias("mains"))
    units = on_menu.unionByName(picks).join(orders, ["order_id", DAY]).select(
        *cell, F.lit(0).alias("bill"), none("decimal(18,4)").alias("pax"), none("decimal(18,4)").alias("total_thb"), "mains"
    )
    return (
        bills.unionByName(units).groupBy(*cell)
        .agg(
            F.sum("bill").alias("orders"), F.sum("pax").alias("pax_keyed"), F.sum("total_thb").alias("net_thb"),
            F.coalesce(F.sum("mains"), F.lit(0)).cast(MONEY).alias("main_units"),
        )
        .withColumn("business_date", F.col(DAY).cast("date")).drop(DAY)
    )


def run_hourly(rel: Relations, root: str, params: Params, out: str, checkpoint: str, late_days: int = LATE_DAYS) -> StreamingQuery:
    """Takes the files that are there, adds the days they finish to out, by day, and ends."""
    query = (
        hourly_stream(rel, root, params, late_days).writeStream.format("parquet").outputMode("append")
        .partitionBy("business_date").option("checkpointLocation", checkpoint).option("path", out)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def read_hourly(spark: SparkSession, out: str) -> DataFrame:
    """The days finished so far."""
    money = "decimal(28,4)"
    schema = f"location_id string, hour int, channel string, orders bigint, pax_keyed {money}, net_thb {money}, main_units decimal(18,4), business_date date"
    return spark.read.schema(schema).parquet(out)
