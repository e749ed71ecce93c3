"""Tables at month grain and member tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesgrain.functions import text
from salesgrain.functions.numbers import half_up, ratio, zero_if_null

PLACE = ["location_id", "ym", "channel"]


def _place_of_order(t) -> DataFrame:
    return t.base.orders.select("order_id", *PLACE)


def option_monthly(t) -> DataFrame:
    """A6. Picks, paid picks and paid money per option choice."""
    paid = F.col("is_paid_upsell")
    return (
        t.base.options.join(_place_of_order(t), "order_id")
        .groupBy(*PLACE, "modifier_group", "choice_th")
        .agg(
            F.count("*").alias("picks"),
            F.count_if(paid).alias("paid_picks"),
            zero_if_null(F.sum(F.when(paid, F.col("paid_price_thb") * F.col("choice_qty")))).alias("paid_thb"),
        )
    )


def option_by_dish(t) -> DataFrame:
    """A7. Picks per option choice and dish."""
    return (
        t.base.options.join(_place_of_order(t), "order_id")
        .groupBy(*PLACE, "dish_th", "modifier_group", "choice_th")
        .agg(F.count("*").alias("picks"))
    )


def topping_route(t) -> DataFrame:
    """A8. The same topping picked as an option and ordered as a menu line."""
    rules = t.params.rules
    picked = (
        t.base.options.where(F.col("modifier_group").rlike(rules.topping_group_re))
        .join(_place_of_order(t), "order_id")
        .groupBy(*PLACE, text.topping_key(F.col("choice_th"), rules).alias("topping"))
        .agg(
            F.sum("choice_qty").alias("as_option_units"),
            F.sum(F.col("paid_price_thb") * F.col("choice_qty")).alias("as_option_thb"),
        )
    )
    ordered = (
        t.base.lines.where(F.col("tree_category") == "topping")
        .join(_place_of_order(t), "order_id")
        .groupBy(*PLACE, text.topping_key(F.col("name_th"), rules).alias("topping"))
        .agg(F.sum("qty").alias("as_menu_units"), F.sum("gross_inc_vat_thb").alias("as_menu_thb"))
    )
    measures = ["as_option_units", "as_option_thb", "as_menu_units", "as_menu_thb"]
    both = picked.join(ordered, [*PLACE, "topping"], "full_outer").select(
        *PLACE, "topping", *[zero_if_null(F.col(m)).alias(m) for m in measures]
    )
    return both.where(F.col("as_option_units") + F.col("as_menu_units") > 0)


def party_bucket(persons: Column) -> Column:
    return (
        F.when(persons < 1.5, "1").when(persons < 2.5, "2").when(persons < 4.5, "3-4").otherwise("5+")
    )


def party_size(t) -> DataFrame:
    """A10. Parties by size. A party is a master bill with its split children, or one bill.

    Bills are read once and summed by party. A party whose master is not a kept order, or itself a
    child, takes the attributes of its lowest order id.
    """
    base = t.base
    place = ["location_id", "ym", "channel", "daypart"]
    split = base.split_children if base.stage.keeps("split_children") else base.split_tabs
    is_child = F.col("master_id").isNotNull() & (F.col("channel") == "dine_in")
    here = F.struct(*place)
    whole = (
        base.order_meals.select("order_id", *place, "total_thb", "main_units", "meals")
        .join(split, "order_id", "left")
        .groupBy(F.when(is_child, F.col("master_id")).otherwise(F.col("order_id")).alias("party_id"))
        .agg(
            F.max(F.when(~is_child, here)).alias("own"),
            F.min_by(here, F.when(is_child, F.col("order_id"))).alias("first"),
            zero_if_null(F.sum("total_thb")).alias("net"),
            zero_if_null(F.sum("main_units")).alias("mains"),
            zero_if_null(F.sum("meals")).alias("persons"),
        )
        .select(F.coalesce("own", "first").alias("at"), "net", "mains", "persons")
        .select("at.*", "net", "mains", "persons")
    )
    bucket = F.when(F.col("channel") != "dine_in", "n/a").otherwise(party_bucket(F.col("persons")))
    return whole.groupBy(*place, bucket.alias("pax_bucket")).agg(
        F.count("*").alias("bills"),
        F.sum("net").alias("net_thb"),
        F.sum("mains").alias("main_units"),
    )


def ticket_hist(t) -> DataFrame:
    """A11. Bills by size of the amount paid."""
    paid = F.col("total_thb")
    bucket = (
        F.when(paid < 150, "<150").when(paid < 250, "150-249").when(paid < 400, "250-399")
        .when(paid < 600, "400-599").otherwise("600+")
    )
    return t.base.orders.groupBy(*PLACE, bucket.alias("thb_bucket")).agg(F.count("*").alias("bills"))


def _member() -> Column:
    """A real member id; the till writes 0 or NULL for none."""
    return F.nullif(F.col("customerid"), F.lit(0).cast("bigint"))


def members_monthly(t) -> DataFrame:
    """A12. Bills, member bills and distinct members."""
    return t.base.orders.groupBy("location_id", "ym").agg(
        F.count("*").alias("bills"),
        F.count(_member()).alias("member_bills"),
        F.count_distinct(_member()).alias("distinct_members"),
    )


def member_visits(t) -> DataFrame:
    """A13. Visits of each member under a hashed key; no customer id leaves the job."""
    by_recency = F.struct("business_date", "order_id")
    visits = (
        t.base.orders.where(_member().isNotNull())
        .groupBy("customerid")
        .agg(
            F.max_by("location_id", by_recency).alias("last_location_id"),
            F.count("*").alias("visits"),
            F.min("business_date").alias("first_date"),
            F.max("business_date").alias("last_date"),
            F.sum("total_thb").alias("net"),
        )
    )
    return visits.select(
        F.md5(F.col("customerid").cast("string")).alias("member_key"),
        "last_location_id", "visits", "first_date", "last_date",
        F.datediff(F.lit(t.params.as_of), "last_date").alias("days_since"),
        half_up(ratio(F.col("net"), F.col("visits")), 0).alias("avg_thb"),
    )


def set_monthly(t) -> DataFrame:
    """A15. Set menus by name."""
    name = F.col("name_th")
    starts = [name.ilike(f"{prefix}%") for prefix in t.params.rules.set_name_prefixes]
    is_set = reduce(lambda a, b: a | b, starts)
    return (
        t.base.lines.where(is_set)
        .join(_place_of_order(t), "order_id")
        .groupBy(*PLACE, name.alias("set_name"))
        .agg(F.sum("qty").alias("units"), F.sum("gross_inc_vat_thb").alias("thb"))
    )
