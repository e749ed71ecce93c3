"""Delivery-platform orders matched to till bills by order number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesgrain.functions import text


def numbered_tabs(t) -> DataFrame:
    """Till tabs that carry a platform order number, with whether their bill stands."""
    p = t.params
    since = F.lit(p.days_ago(p.window_days + p.match_extra_days)).cast("timestamp_ntz")
    number = F.coalesce(
        text.keyed_order_number(F.col("refdeliveryorder"), p.rules),
        text.keyed_order_number(F.col("takehomename"), p.rules),
    )
    tabs = (
        t.rel["pos_sale_tabs"].where(F.col("starttime") >= since)
        .select("order_id", "branchid", "starttime", text.pad_number(number).alias("num"))
        .where(F.col("num").isNotNull())
    )
    branch = t.rel["locations"].select("branchid", "location_id")
    bills = t.base.windowed("orders", p.match_extra_days).select("order_id", (F.col("is_finalized") & ~F.col("is_voided")).alias("stands"))
    numbered = (
        tabs.join(branch, "branchid")
        .join(bills, "order_id", "left")
        .select(
            F.col("order_id").alias("bill_id"), "location_id", "num",
            F.col("starttime").cast("date").alias("business_date"),
            F.coalesce("stands", F.lit(False)).alias("ok"),
        )
    )
    return t.base.stage.keep("numbered_tabs", numbered)


def _side(df: DataFrame, kind: str, number: str, *own: str) -> DataFrame:
    """Tabs or bookings in the common layout of both; what has no place has no number either."""
    placed = F.col("location_id").isNotNull() & F.col("business_date").isNotNull()
    return df.select(F.lit(kind).alias("kind"), "location_id", "business_date", F.when(placed, F.col(number)).alias("num"), *own)


def grab_match(t) -> DataFrame:
    """A28. Payment row -> bill: same branch and day, same number, else the last three digits.

    The fallback serves only bookings without an exact hit and bills not hit exactly. Of several
    bills the lowest standing one is taken; more than one standing makes the match ambiguous.

    Tabs and bookings lie together by branch, day and number, at most what one branch keys in a day, and
    look at each other in windows: once by the whole number, once by the last three digits among those
    without an exact hit. Neither is read twice.
    """
    booked = t.rel["grab_orders"].where(F.col("category") == "payment")
    tabs = _side(numbered_tabs(t), "tab", "num", "bill_id", "ok")
    both = tabs.unionByName(_side(booked, "booking", "gf_no", "booking_id", "gf_no"), allowMissingColumns=True)
    is_tab = F.col("kind") == "tab"
    standing = F.when(is_tab & F.col("ok"), F.col("bill_id"))
    place = Window.partitionBy("location_id", "business_date", "num")
    one = Window.partitionBy("kind", "who")  # a bill with all its tabs, a booking with all its rows
    met = F.col("num").isNotNull() & F.when(is_tab, F.count("booking_id").over(place)).otherwise(F.count("bill_id").over(place)).cast("boolean")
    exact = (
        both.withColumns({"bill": F.min(standing).over(place), "n": F.count(standing).over(place), "met": met})
        .withColumn("who", F.coalesce(F.col("bill_id").cast("string"), "booking_id"))
        .withColumn("hit", F.max("met").over(one))
    )
    short = F.when(is_tab, F.col("num")).when(F.length("num") > 3, F.right("num", F.lit(3)))
    open_tab = F.when(is_tab & ~F.col("hit") & F.col("ok"), F.col("bill_id"))
    found = (
        exact.withColumn("num", short)
        .withColumns({"short_bill": F.min(open_tab).over(place), "short_n": F.count(open_tab).over(place)})
        .where(~is_tab)
        .withColumn("falls_back", ~F.col("hit") & F.col("num").isNotNull())
        .withColumn("bill_id", F.when(F.col("met"), F.col("bill")).when(F.col("falls_back"), F.col("short_bill")))
        .withColumn("n", F.when(F.col("met"), F.col("n")).when(F.col("falls_back"), F.col("short_n")))
        .where("n > 0")
    )
    return (
        found.groupBy("booking_id")
        .agg(
            F.min_by(F.struct("location_id", "business_date", "gf_no"), "bill_id").alias("row"),
            F.min("bill_id").alias("bill_id"),
            F.sum("n").alias("n"),
        )
        .select("booking_id", "row.*", "bill_id", (F.col("n") > 1).alias("ambiguous"))
    )
