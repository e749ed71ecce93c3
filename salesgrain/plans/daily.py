"""Tables at day grain: the driver tree, hours, dwell, trust, items, promotions, calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesgrain.functions import times
from salesgrain.functions.numbers import half_up, ratio

TREE_UNITS = ("main", "bev", "bev_water", "bev_paid", "bev_premium", "side", "topping", "dessert")
TREE_THB = ("main", "bev", "side", "topping", "dessert", "bev_paid", "bev_premium")
TREE_SET_LAYER = ("side", "bev_paid", "bev_premium", "dessert", "topping")


def totals(columns: list[str]) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def tree_daily(t) -> DataFrame:
    """A1. Volume and ticket by branch, day, daypart and channel; column order is a contract."""
    grain = ["location_id", "business_date", "daypart", "channel"]
    units = [f"{g}_units" for g in TREE_UNITS]
    money = [f"{g}_thb" for g in TREE_THB]
    set_layer = [f"{g}_set_units" for g in TREE_SET_LAYER]
    columns = [*units, *money, "set_units", "set_thb", *set_layer]
    sums = t.base.facts(columns).groupBy(*grain).agg(
        F.count("*").alias("orders"),
        F.sum("pax").alias("pax_keyed"),
        F.sum("total_thb").alias("net_thb"),
        F.sum("discount_thb").alias("discount_thb"),
        *totals(columns),
    )
    unused = F.lit(0)  # two columns kept as zeros so later columns never move
    return sums.select(
        *grain, "orders", "pax_keyed", *units,
        unused.alias("paid_option_picks"), unused.cast("decimal(18,4)").alias("paid_option_thb"),
        (F.col("net_thb") + F.col("discount_thb")).alias("gross_thb"), "discount_thb", "net_thb",
        *money, "set_units", "set_thb", *set_layer,
    )


def hourly(t) -> DataFrame:
    """A2. Orders, keyed guests, net and mains by branch, day, closing hour and channel."""
    return t.base.facts(["main_units"]).groupBy("location_id", "business_date", F.col("hr").alias("hour"), "channel").agg(
        F.count("*").alias("orders"),
        F.sum("pax").alias("pax_keyed"),
        F.sum("total_thb").alias("net_thb"),
        *totals(["main_units"]),
    )


def dwell(t) -> DataFrame:
    """A3. Dine-in sessions of believable length; an unset cancel flag means not cancelled."""
    p = t.params
    sessions = t.base.windowed("table_sessions").where(
        ~F.coalesce("is_cancelled", F.lit(False))
        & F.col("dwell_minutes").between(p.dwell_min, p.dwell_max)
    ).select("order_id", "dwell_minutes", F.col("pax").alias("party"))
    dine_in = t.base.orders.where(F.col("channel") == "dine_in").select(
        "order_id", "location_id", "business_date", "daypart"
    )
    sums = sessions.join(dine_in, "order_id").groupBy("location_id", "business_date", "daypart").agg(
        F.count("*").alias("sessions"),
        F.sum("dwell_minutes").alias("minutes"),
        F.sum("party").alias("guests"),
        F.count("party").alias("parties"),
    )
    return sums.select(
        "location_id", "business_date", "daypart", "sessions",
        half_up(ratio(F.col("minutes"), F.col("sessions")), 1).alias("avg_dwell_min"),
        half_up(ratio(F.col("guests"), F.col("parties")), 2).alias("avg_party"),
    )


def pax_trust(t) -> DataFrame:
    """A4. Bowls per keyed guest; outside the band the keyed count is not believed."""
    p = t.params
    columns = ["main_units", "set_units"]
    dine_in = t.base.facts(columns).where(F.col("channel") == "dine_in")
    sums = dine_in.groupBy("location_id", "business_date").agg(
        F.sum("pax").alias("keyed_pax"), *totals(columns)
    ).withColumn("bowls", F.col("main_units") + F.col("set_units"))
    keyed = F.col("keyed_pax") > 0
    low, high = (F.lit(x).cast("decimal(3,2)") for x in (p.trust_low, p.trust_high))
    inside = F.col("bowls").between(F.col("keyed_pax") * low, F.col("keyed_pax") * high)
    return sums.select(
        "location_id", "business_date", "bowls", "keyed_pax",
        F.when(keyed, half_up(ratio(F.col("bowls"), F.col("keyed_pax")), 2)).alias("ratio"),
        F.coalesce(keyed & inside, F.lit(False)).alias("trusted"),
    )


def item_daily(t) -> DataFrame:
    """A5. Units, money and bills per item and per route it was sold by."""
    grain = ["location_id", "business_date", "channel", "itemid", "item_name", "main_category", "bev_tier", "source"]
    sums = (
        t.base.units.withColumn("main_category", F.coalesce("tree_category", F.lit("other")))
        .groupBy(*grain)
        .agg(
            F.sum("qty").alias("units"),
            F.sum("thb").alias("thb"),
            F.count_distinct("order_id").alias("bills"),
        )
    )
    vendor = t.rel["items"].select("itemid", F.col("vendor_category").alias("sub_category"))
    return sums.join(vendor, "itemid", "left").select(
        "location_id", "business_date", "channel", F.col("itemid").alias("item_id"), "item_name",
        "main_category", "sub_category", "bev_tier", "units", "thb", "bills",
        half_up(ratio(F.col("thb"), F.col("units")), 2).alias("avg_price"), "source",
    )


def promo_daily(t) -> DataFrame:
    """A14. Bills, mains and net with and without the derived promotion."""
    return t.base.order_meals.groupBy("location_id", "business_date", "channel", "promo").agg(
        F.count("*").alias("bills"),
        F.sum("main_units").alias("main_units"),
        F.sum("total_thb").alias("net_thb"),
    )


def _calendar_days(t) -> DataFrame:
    d = F.col("business_date")
    days = t.base.orders.groupBy("location_id", "business_date", "channel").agg(
        F.count("*").alias("orders"), F.sum("total_thb").alias("net_thb")
    )
    off = t.rel["holidays"].select(F.col("d").alias("business_date"), F.lit(True).alias("_off"))
    return days.join(off, "business_date", "left").select(
        "location_id", "business_date", "channel", "orders", "net_thb",
        times.iso_weekday(d).alias("dow"),
        F.dayofmonth(d).alias("dom"),
        (F.floor((F.dayofmonth(d) - 1) / 7) + 1).cast("int").alias("wom"),
        F.coalesce("_off", F.lit(False)).alias("is_holiday"),
    )


def _with_baseline(t, days: DataFrame) -> DataFrame:
    """Mean net of the same weekday over the eight weeks up to a week ago, holidays left out.

    Same weekday means same partition, so a range frame in days replaces a self join.
    """
    p = t.params
    frame = (
        Window.partitionBy("location_id", "channel", "dow")
        .orderBy(F.unix_date("business_date").cast("bigint"))
        .rangeBetween(-p.baseline_from_days, -p.baseline_to_days)
    )
    usual = F.when(~F.col("is_holiday"), F.col("net_thb"))
    count = F.count(usual).over(frame)
    mean = ratio(F.sum(usual).over(frame), count)
    return days.withColumn("comparables", count).withColumn(
        "expected_thb", F.when(F.col("comparables") >= p.baseline_min_days, half_up(mean, 0))
    )


def baseline(t) -> DataFrame:
    """A17. The same-weekday baseline of every branch, channel and day that has one."""
    return (
        _with_baseline(t, _calendar_days(t))
        .where(F.col("expected_thb").isNotNull())
        .select("location_id", "business_date", "channel", "comparables", "expected_thb")
    )


def calendar_daily(t) -> DataFrame:
    """A16. Day facts with calendar, rain, and the gap to the same-weekday baseline."""
    rain = t.rel["weather_daily"].select(F.col("d").alias("business_date"), "rain_mm")
    expected = F.col("expected_thb")
    gap = (F.col("net_thb").cast("double") - expected) * 100 / F.nullif(expected, F.lit(0.0))
    return (
        _with_baseline(t, _calendar_days(t))
        .join(rain, "business_date", "left")
        .select(
            "location_id", "business_date", "channel", "orders", "net_thb", "dow", "dom", "wom",
            "is_holiday", "rain_mm", "expected_thb",
            F.when(expected > 0, half_up(gap, 1)).alias("gap_pct"),
        )
    )
