"""The monthly models: what goes with attach, and what the calendar does to a day's net.

They describe and belong to no daily table. Terms are written out, and a term that the others already tell has
NULLs, so nothing depends on the order in which a solver meets collinear columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesgrain.functions import text
from salesgrain.functions.numbers import zero_if_null
from salesgrain.operators.regression import linear_regression, logistic_regression

ATTACH_LEVERS = ("side", "bev_paid", "bev_premium", "dessert", "topping")
FAMILIES = 10  # told apart by name; the others are one level
OTHER, NO_MAIN = "other", "no main"
BASES = {"channel": "dine_in", "daypart": "lunch", "group": "1", "main": OTHER}


def attach_regression(t) -> DataFrame:
    """D35. Per branch and lever: log odds that an in-store bill holds the lever, by channel, daypart, group size
    and main family.

    Bills are read once and counted per combination of levels. A bill's main is the family it has most of, ties
    by name; the leading families of the chain have levels of their own.
    """
    p, base, rules = t.params, t.base, t.params.rules
    is_main = F.col("tree_category") == "main"
    lever = F.when(F.col("tree_category").isin("side", "dessert", "topping"), F.col("tree_category")).when(
        F.col("bev_tier").isin("paid", "premium"), F.concat(F.lit("bev_"), F.col("bev_tier"))
    )
    sold = base.sold_rows.where("is_unit").withColumn("lever", F.when(F.col("source") != "set", lever))
    family = text.dish_family(F.col("item_name"), rules)
    per_order = (
        sold.groupBy("order_id", F.when(is_main, family).alias("family"))
        .agg(
            F.sum(F.when(F.col("tree_category").isin("main", "set"), F.col("qty"))).alias("meals"),
            F.sum(F.when(is_main, F.col("qty"))).alias("mains"),
            F.collect_set("lever").alias("levers"),
        )
        .groupBy("order_id")
        .agg(
            F.sum("meals").alias("meals"),
            F.max_by("family", F.when(F.col("family").isNotNull(), F.struct(F.col("mains"), F.col("family")))).alias("family"),
            F.flatten(F.collect_list("levers")).alias("levers"),
        )
    )
    persons = zero_if_null(F.col("meals"))
    group = F.when(persons <= 1, "1").when(persons == 2, "2").when(persons <= 4, "3-4").otherwise("5+")
    window = F.col("channel").isin(*rules.in_store) & base.full_days("business_date", p.own_best_days)
    holds = [F.coalesce(F.array_contains("levers", g), F.lit(False)) for g in ATTACH_LEVERS]
    place = ["location_id", "channel", "daypart"]
    # one row per combination of levels, then the families of the chain by their bills
    cells = (
        base.orders.where(window).select("order_id", *place).join(per_order, "order_id", "left")
        .groupBy(*place, group.alias("group"), F.coalesce("family", F.lit(NO_MAIN)).alias("family"), *[
            h.alias(g) for g, h in zip(ATTACH_LEVERS, holds)
        ])
        .agg(F.count("*").alias("bills"))
    )
    families = cells.groupBy("family").agg(F.sum("bills").alias("bills")).where(F.col("family") != NO_MAIN)
    leading = families.orderBy(F.desc("bills"), "family").limit(FAMILIES).select("family", F.lit(True).alias("leads"))
    named = F.when((F.col("family") == NO_MAIN) | F.col("leads"), F.col("family")).otherwise(OTHER)
    levered = F.array(*[F.struct(F.lit(g).alias("lever"), F.col(g).alias("held")) for g in ATTACH_LEVERS])
    told = (
        cells.join(leading, "family", "left")
        .select(*place, "group", named.alias("main"), "bills", F.inline(levered))
    )
    return logistic_regression(
        told, ["location_id", "lever"], F.col("held"), {c: F.col(c) for c in BASES}, BASES, F.col("bills")
    ).withColumn("odds_ratio", F.exp("coefficient"))


def calendar_terms(day: Column, is_off: Column, next_off: Column, last_off: Column, rain_mm: Column) -> dict[str, Column]:
    """Weekday against Monday, week of month against the first, paydays, holidays, bridge days, rain."""
    weekday, dom = F.weekday(day), F.dayofmonth(day)
    names = ("tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
    off = F.coalesce(is_off, F.lit(False))
    bridge = ~off & (
        ((weekday == 4) & F.coalesce(last_off, F.lit(False))) | ((weekday == 0) & F.coalesce(next_off, F.lit(False)))
    )
    return {
        **{name: (weekday == i).cast("int") for i, name in enumerate(names, 1)},
        **{f"week {k}": (F.floor((dom - 1) / 7) + 1 == k).cast("int") for k in (2, 3, 4, 5)},
        "first of month": (dom == 1).cast("int"), "fifteenth": (dom == 15).cast("int"),
        "end of month": (day == F.last_day(day)).cast("int"),
        "holiday": off.cast("int"), "bridge day": bridge.cast("int"),
        "rain": F.log1p(F.greatest(F.coalesce(rain_mm, F.lit(0.0)), F.lit(0.0))),
        "rain unknown": rain_mm.isNull().cast("int"),
    }


def calendar_regression(t) -> DataFrame:
    """D35. Per branch and channel: net of a full day on weekday, week of month, paydays, holidays, bridge days
    (a Friday after, or a Monday before, a holiday) and the logarithm of rain."""
    p, base = t.params, t.base
    day = F.col("business_date")
    days = base.orders.where(base.full_days("business_date", p.window_days)).groupBy("location_id", "channel", "business_date").agg(
        F.sum("total_thb").alias("net")
    )
    holidays = t.rel["holidays"].select(F.col("d").alias("_d")).where("_d IS NOT NULL").distinct()
    near = F.array(*[F.struct(F.date_add("_d", n).alias("business_date"), F.lit(name).alias("which")) for n, name in (
        (0, "is_off"), (-1, "next_off"), (1, "last_off"),
    )])
    marks = holidays.select(F.inline(near)).groupBy("business_date").agg(
        *[F.bool_or(F.col("which") == name).alias(name) for name in ("is_off", "next_off", "last_off")]
    )
    rain = t.rel["weather_daily"].groupBy(F.col("d").alias("business_date")).agg(F.max("rain_mm").cast("double").alias("rain_mm"))
    described = days.join(marks, "business_date", "left").join(rain, "business_date", "left")
    terms = calendar_terms(day, F.col("is_off"), F.col("next_off"), F.col("last_off"), F.col("rain_mm"))
    return linear_regression(described, ["location_id", "channel"], F.col("net"), terms)


MODELS: dict[str, Callable[..., DataFrame]] = {f.__name__: f for f in (attach_regression, calendar_regression)}
