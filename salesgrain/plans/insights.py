"""Dashboard analytics over the derived tables, for a chosen view of branches, channels and days."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesgrain.functions.numbers import half_up, ratio, zero_if_null
from salesgrain.functions.times import MINUTE, clock_micros
from salesgrain.operators.median import exact_percentiles
from salesgrain.operators.ranks import best_other, top_rows
from salesgrain.plans import feeds

ATTACH = ("side", "bev_paid", "bev_premium", "dessert", "topping")
OCCUPANCY_FULL, OCCUPANCY_MEDIUM = 80, 50
TRUST_DAYS_FLOOR = 70
GAP_LOW, GAP_HIGH = -15, 15
UNPOPULAR_SHARE = 2
PARITY_GAP = 5
MISSING_RATE_ALERT = 1
RAIN_MM = 1
QUIET_BAND = (16, 20)
CEILINGS = (40, 50, 60)
SCRIPTS_SHOWN = 10
TOP_ITEMS = 10
DIGEST_ROWS = 3
MONTH_DAYS = 30


@dataclass(frozen=True)
class View:
    """D34. What the reader has chosen; None means everything."""

    branches: tuple[str, ...] | None = None
    channels: tuple[str, ...] | None = None
    date_from: dt.date | None = None
    date_to: dt.date | None = None
    day_type: str = "all"  # all, weekday, weekend, holiday

    def of(self, t, rows: DataFrame, day: str = "business_date") -> DataFrame:
        if self.branches is not None:
            rows = rows.where(F.col("location_id").isin(*self.branches))
        if self.channels is not None and "channel" in rows.columns:
            rows = rows.where(F.col("channel").isin(*self.channels))
        if self.date_from is not None:
            rows = rows.where(F.col(day) >= F.lit(self.date_from))
        if self.date_to is not None:
            rows = rows.where(F.col(day) <= F.lit(self.date_to))
        if self.day_type == "weekday":
            rows = rows.where(F.weekday(day) < 5)
        elif self.day_type == "weekend":
            rows = rows.where(F.weekday(day) >= 5)
        elif self.day_type == "holiday":
            off = t.rel["holidays"].select(F.col("d").alias(day))
            rows = rows.join(off, day, "left_semi")
        return rows


EVERYTHING = View()


def percent(top: Column, bottom: Column, digits: int = 2) -> Column:
    return half_up(ratio(top, bottom) * 100, digits)


def quotient(top: Column, bottom: Column, digits: int = 2) -> Column:
    return half_up(ratio(top, bottom), digits)


def _c(name: str) -> Column:
    return F.col(name)


def _meals() -> Column:
    return _c("main_units") + _c("set_units")


# ---- section 1: driver tree ------------------------------------------------------------------
def driver_tree(t, view: View = EVERYTHING) -> DataFrame:
    """D1, D2. Net = volume x ticket by branch, daypart and channel, with totals on every level.

    Customers are keyed guests on believed branch-days and main occasions elsewhere.
    """
    trust = t["pax_trust"].select("location_id", "business_date", "trusted")
    keyed = F.coalesce("trusted", F.lit(False)) & (_c("channel") == "dine_in")
    rows = (
        view.of(t, t["tree_daily"]).join(trust, ["location_id", "business_date"], "left")
        .withColumn("customers", F.when(keyed, F.coalesce(_c("pax_keyed"), _meals())).otherwise(_meals()))
        .withColumn("drinks", _c("bev_paid_units") + _c("bev_premium_units"))
    )
    sums = rows.rollup("location_id", "daypart", "channel").agg(
        F.sum("orders").alias("orders"),
        *[F.sum(c).alias(c) for c in (
            "customers", "net_thb", "gross_thb", "discount_thb", "main_units", "set_units",
            "drinks", "side_units", "topping_units", "dessert_units",
        )],
    )
    meals = _meals()
    return sums.select(
        *[F.coalesce(c, F.lit("all")).alias(c) for c in ("location_id", "daypart", "channel")],
        "orders", "customers", "net_thb",
        quotient(_c("net_thb"), _c("orders")).alias("ticket_per_bill"),
        quotient(_c("net_thb"), _c("customers")).alias("ticket_per_head"),
        quotient(meals, _c("customers")).alias("bowls_per_customer"),
        percent(_c("drinks"), meals).alias("drink_attach_pct"),
        percent(_c("side_units"), meals).alias("side_attach_pct"),
        percent(_c("topping_units"), meals).alias("topping_attach_pct"),
        percent(_c("dessert_units"), meals).alias("dessert_attach_pct"),
        percent(_c("discount_thb"), _c("gross_thb")).alias("discount_pct"),
    )


def trust_strip(t, view: View = EVERYTHING) -> DataFrame:
    """D3. How many days the keyed guest count is believed."""
    sums = view.of(t, t["pax_trust"]).groupBy("location_id").agg(
        F.count("*").alias("days"),
        F.count_if("trusted").alias("trusted_days"),
        F.sum(_c("ratio").cast("decimal(18,2)")).alias("_sum"),
        F.count("ratio").alias("_n"),
    )
    trusted = ratio(_c("trusted_days"), _c("days")) * 100
    return sums.select(
        "location_id", "days", "trusted_days", half_up(trusted, 1).alias("trusted_pct"),
        quotient(_c("_sum"), _c("_n")).alias("mean_ratio"),
        (trusted < TRUST_DAYS_FLOOR).alias("keying_alert"),
    )


# ---- section 2: volume -------------------------------------------------------------------------
def _trading_days(rows: DataFrame) -> DataFrame:
    return rows.groupBy("location_id").agg(F.count_distinct("business_date").alias("days"))


def density(t, view: View = EVERYTHING) -> DataFrame:
    """D4. Orders and net per trading day by branch and hour, and each hour's share of the branch."""
    rows = view.of(t, t["hourly"])
    branch = Window.partitionBy("location_id")
    return (
        rows.groupBy("location_id", "hour")
        .agg(F.sum("orders").alias("orders"), F.sum("net_thb").alias("net_thb"))
        .join(_trading_days(rows), "location_id")
        .select(
            "location_id", "hour", "days", "orders",
            quotient(_c("orders"), _c("days"), 3).alias("orders_per_day"),
            quotient(_c("net_thb"), _c("days")).alias("net_per_day"),
            percent(_c("orders"), F.sum("orders").over(branch), 4).alias("orders_share_pct"),
            percent(_c("net_thb"), F.sum("net_thb").over(branch), 4).alias("net_share_pct"),
        )
    )


def _seated(t, view: View) -> DataFrame:
    """Occupancy cells summed per branch and hour, with seats and open days."""
    dine_in = view.of(t, t["tree_daily"]).where((_c("channel") == "dine_in") & (_c("orders") > 0))
    seats = t.rel["seats"].where("seats > 0").select("location_id", "seats")
    return (
        view.of(t, t["occupancy_hourly"]).groupBy("location_id", "hour")
        .agg(
            F.sum("persons_opened").alias("persons"), F.sum("turns").alias("turns"),
            F.sum("imputed_bills").alias("imputed"), F.sum("peak_persons").alias("peak"),
            F.sum(_c("seat_minutes").cast("decimal(18,1)")).alias("seat_minutes"),
            F.sum(_c("dwell_min_sum").cast("decimal(18,1)")).alias("dwell_minutes"),
        )
        .join(_trading_days(dine_in), "location_id")
        .join(seats, "location_id")
    )


def occupancy(t, view: View = EVERYTHING) -> DataFrame:
    """D5. Persons opened per seat and open day, the one-hour rule, with its band."""
    raw = ratio(_c("persons"), _c("seats") * _c("days")) * 100
    band = (
        F.when(raw >= OCCUPANCY_FULL, "full").when(raw >= OCCUPANCY_MEDIUM, "medium").otherwise("quiet")
    )
    return _seated(t, view).select(
        "location_id", "hour", "seats", "days", "persons", half_up(raw, 2).alias("raw_pct"),
        F.least(half_up(raw, 2), F.lit(100.0)).alias("occupancy_pct"), band.alias("band"),
        quotient(_c("persons"), _c("days"), 3).alias("served_per_day"),
        half_up(_c("seats").cast("double") - ratio(_c("persons"), _c("days")), 3).alias("gap_per_day"),
    )


def seat_time(t, view: View = EVERYTHING) -> DataFrame:
    """D6. The measured diagnostic: share of seat minutes used, peak share, turns per seat."""
    room = _c("seats") * _c("days")
    return _seated(t, view).select(
        "location_id", "hour",
        percent(_c("seat_minutes"), room * 60).alias("seat_time_pct"),
        percent(_c("peak"), room).alias("peak_pct"),
        quotient(_c("turns"), room, 4).alias("turns_per_seat"),
        "imputed",
    )


def dwell_by_hour(t, view: View = EVERYTHING) -> DataFrame:
    """D7. Mean stay of the bills opened in an hour."""
    sums = view.of(t, t["occupancy_hourly"]).groupBy("location_id", "hour").agg(
        F.sum("turns").alias("turns"), F.sum(_c("dwell_min_sum").cast("decimal(18,1)")).alias("minutes")
    )
    return sums.where("turns > 0").select(
        "location_id", "hour", "turns", quotient(_c("minutes"), _c("turns"), 1).alias("dwell_min")
    )


def quiet_band(t, view: View = EVERYTHING) -> DataFrame:
    """D8. Net by hour as a share of the day, and the share of the afternoon band."""
    branch = Window.partitionBy("location_id")
    whole = F.sum("net_thb").over(branch)
    inside = _c("hour").between(*QUIET_BAND)
    return (
        view.of(t, t["hourly"]).groupBy("location_id", "hour").agg(F.sum("net_thb").alias("net_thb"))
        .select(
            "location_id", "hour", "net_thb", F.coalesce(inside, F.lit(False)).alias("in_band"),
            percent(_c("net_thb"), whole, 4).alias("share_pct"),
            percent(F.sum(F.when(inside, _c("net_thb"))).over(branch), whole, 4).alias("band_share_pct"),
        )
    )


def ceilings(t, view: View = EVERYTHING) -> DataFrame:
    """D9. What filling every hour to a ceiling would be worth, scaled to 30 days."""
    tree = view.of(t, t["tree_daily"])
    span = tree.agg((F.datediff(F.max("business_date"), F.min("business_date")) + 1).alias("n")).scalar()
    ticket = tree.where(_c("channel") == "dine_in").groupBy("location_id").agg(
        ratio(F.sum("net_thb"), F.sum(_meals())).alias("ticket")
    )
    rows = _seated(t, view).withColumn("target_pct", F.explode(F.array(*[F.lit(c) for c in CEILINGS])))
    # exact: persons short of the ceiling over all open days, in hundredths of a seat
    short = F.greatest(_c("target_pct") * _c("seats") * _c("days") - _c("persons") * 100, F.lit(0))
    return (
        rows.groupBy("location_id", "target_pct").agg(F.sum(short).alias("short"), F.max("days").alias("days"))
        .join(ticket, "location_id")
        .select(
            "location_id", "target_pct",
            quotient(_c("short"), _c("days") * 100).alias("persons_per_day"),
            half_up(ratio(_c("short"), _c("days") * 100) * _c("ticket"), 2).alias("thb_per_day"),
            half_up(ratio(_c("short"), F.lit(100)) * _c("ticket") * MONTH_DAYS / span, 0).alias("thb_per_month"),
        )
    )


def gap_days(t, view: View = EVERYTHING) -> DataFrame:
    """D10. Days well below or above their same-weekday baseline."""
    gap = _c("gap_pct")
    return view.of(t, t["calendar_daily"]).where((gap < GAP_LOW) | (gap > GAP_HIGH)).select(
        "location_id", "business_date", "channel", "net_thb", "expected_thb", "gap_pct",
        F.when(gap < GAP_LOW, "below").otherwise("above").alias("flag"), "is_holiday", "rain_mm",
    )


# ---- section 3: ticket ---------------------------------------------------------------------------
def attach_layers(t, view: View = EVERYTHING) -> DataFrame:
    """D11. Attach per main occasion in three layers, against the best branch; water has no layers."""
    sums = view.of(t, t["tree_daily"]).groupBy("location_id", "channel").agg(
        F.sum(_meals()).alias("meals"),
        F.sum("bev_water_units").alias("bev_water_all"),
        *[F.sum(f"{g}_units").alias(f"{g}_all") for g in ATTACH],
        *[F.sum(f"{g}_set_units").alias(f"{g}_in_set") for g in ATTACH],
    )
    for g in ATTACH:
        sums = sums.withColumn(f"{g}_upsell", _c(f"{g}_all") - _c(f"{g}_in_set"))
    cells = sums.unpivot(
        ["location_id", "channel", "meals"],
        ["bev_water_all", *(f"{g}_{layer}" for g in ATTACH for layer in ("all", "upsell", "in_set"))], "cell", "units",
    )
    best = Window.partitionBy("channel", "cell")
    rate = ratio(_c("units"), _c("meals"))
    return cells.select(
        "location_id", "channel", "cell", "meals", "units",
        half_up(rate * 100, 2).alias("attach_pct"),
        half_up(F.max(rate).over(best) * 100, 2).alias("best_pct"),
    )


def menu_scripts(t, view: View = EVERYTHING) -> DataFrame:
    """D12. The ten most valuable gaps to the best other branch in menu-pair attach, over all branches."""
    p = t.params
    rows = view.of(t, t["pair_attach"], "week_start")
    days = rows.agg(
        (F.datediff(F.max("week_start"), F.min("week_start")) + 7).alias("n")
    ).scalar()
    mains = (
        rows.select("location_id", "channel", "week_start", "main_family", "bills_main").distinct()
        .groupBy("location_id", "main_family").agg(F.sum("bills_main").alias("bills_main"))
        .where(_c("bills_main") >= p.script_compare_min_bills)
        .where(~_c("location_id").isin(*p.peerless))
    )
    both = rows.groupBy("location_id", "main_family", "item").agg(
        F.sum("bills_both").alias("bills_both"), F.sum("thb_both").alias("thb_both")
    )
    key = ["main_family", "item"]
    cells = (
        mains.join(both.select(*key).distinct(), "main_family")
        .join(both, ["location_id", *key], "left")
        .withColumn("rate", F.coalesce(ratio(_c("bills_both"), _c("bills_main")), F.lit(0.0)))
        .withColumn("price", ratio(_c("thb_both"), _c("bills_both")))
    )
    prices = both.select(
        F.col("location_id").alias("best_who"), *key, ratio(_c("thb_both"), _c("bills_both")).alias("best_price")
    )
    pool = cells.select("location_id", *key, "rate")
    gaps = (
        best_other(cells, pool, key, "location_id", "rate")
        .where(_c("best_rate") > _c("rate"))
        .join(prices, ["best_who", *key], "left")
        .withColumn(
            "thb_per_month",
            half_up(
                (_c("best_rate") - _c("rate")) * _c("bills_main")
                * F.coalesce("best_price", "price") * MONTH_DAYS / days, 0,
            ),
        )
    )
    order = [F.desc_nulls_last("thb_per_month"), F.asc("location_id"), F.asc("main_family"), F.asc("item")]
    return gaps.orderBy(*order).limit(SCRIPTS_SHOWN).select(
        "location_id", "main_family", "item", "bills_main",
        half_up(_c("rate") * 100, 2).alias("rate_pct"), F.col("best_who").alias("best_location"),
        half_up(_c("best_rate") * 100, 2).alias("best_pct"), "thb_per_month",
    )


def _share_of(rows: DataFrame, group: list[str], cell: list[str], value: str) -> DataFrame:
    sums = rows.groupBy(*group, *cell).agg(F.sum(value).alias(value))
    whole = F.sum(value).over(Window.partitionBy(*group))
    return sums.select(*group, *cell, value, percent(_c(value), whole, 4).alias("share_pct"))


def party_mix(t) -> DataFrame:
    """D13. Party sizes as a share of a branch's dine-in parties."""
    rows = t["party_size"].where(_c("channel") == "dine_in")
    return _share_of(rows, ["location_id"], ["pax_bucket"], "bills")


def ticket_mix(t) -> DataFrame:
    """D13. Bill sizes as a share of a branch's bills."""
    return _share_of(t["ticket_hist"], ["location_id"], ["thb_bucket"], "bills")


# ---- section 4: options --------------------------------------------------------------------------
def choice_share(t) -> DataFrame:
    """D14. Share of each choice in its option group, and the unpopular tail."""
    shares = _share_of(t["option_monthly"], ["location_id", "modifier_group"], ["choice_th"], "picks")
    return shares.withColumn("unpopular", _c("share_pct") < UNPOPULAR_SHARE)


def topping_parity(t) -> DataFrame:
    """D15. Toppings whose price as an option differs from the menu price."""
    sums = t["topping_route"].groupBy("location_id", "topping").agg(
        *[F.sum(c).alias(c) for c in ("as_option_units", "as_option_thb", "as_menu_units", "as_menu_thb")]
    )
    option = ratio(_c("as_option_thb"), _c("as_option_units"))
    menu = ratio(_c("as_menu_thb"), _c("as_menu_units"))
    return sums.where((_c("as_option_units") > 0) & (_c("as_menu_units") > 0)).select(
        "location_id", "topping", "as_option_units", "as_menu_units",
        half_up(option, 2).alias("option_price"), half_up(menu, 2).alias("menu_price"),
        (F.abs(menu - option) > PARITY_GAP).alias("mismatch"),
    )


def dish_options(t) -> DataFrame:
    """D16. Share of each choice in its group, per dish."""
    return _share_of(t["option_by_dish"], ["dish_th", "modifier_group"], ["choice_th"], "picks")


# ---- section 5: members ----------------------------------------------------------------------------
def member_attach(t) -> DataFrame:
    """D17. Share of bills with a member."""
    return t["members_monthly"].select(
        "location_id", "ym", "bills", "member_bills", "distinct_members",
        percent(_c("member_bills"), _c("bills")).alias("member_attach_pct"),
    )


# ---- section 6: menu and promotions ----------------------------------------------------------------
def menu_matrix(t, view: View = EVERYTHING) -> DataFrame:
    """D18. Items by popularity and price quartile: star, plowhorse, puzzle or dog."""
    sums = view.of(t, t["item_daily"]).groupBy("location_id", "item_name").agg(
        F.sum("units").alias("units"), F.sum("thb").alias("thb")
    ).where("units > 0")
    priced = sums.withColumn("price", quotient(_c("thb"), _c("units")))
    branch = Window.partitionBy("location_id")
    popular = F.ntile(4).over(branch.orderBy("units", "item_name")).alias("units_quartile")
    dear = F.ntile(4).over(branch.orderBy("price", "item_name")).alias("price_quartile")
    many, high = _c("units_quartile") >= 3, _c("price_quartile") >= 3
    label = (
        F.when(many & high, "star").when(many, "plowhorse").when(high, "puzzle").otherwise("dog")
    )
    return priced.select("*", popular, dear).withColumn("menu_class", label)


def item_trend(t, view: View = EVERYTHING) -> DataFrame:
    """D19. An item day by day over the feed window: units, money, and the split over channels."""
    recent = t["item_daily"].where(_c("business_date") >= F.lit(t.params.days_ago(t.params.feed_days)))
    sums = view.of(t, recent).groupBy("item_name", "business_date", "channel").agg(
        F.sum("units").alias("units"), F.sum("thb").alias("thb")
    )
    whole = F.sum("units").over(Window.partitionBy("item_name", "business_date"))
    return sums.select("*", percent(_c("units"), whole, 4).alias("channel_share_pct"))


def item_partners(t) -> DataFrame:
    """D19. All pairs an item appears in, whatever side of the pair it is on, the highest lift first."""
    sides = t["pair_lift"].select("location_id", F.explode(F.array(
        F.struct(_c("item_a").alias("item"), _c("item_b").alias("partner")),
        F.struct(_c("item_b").alias("item"), _c("item_a").alias("partner")),
    )).alias("p"), "bills_ab", "lift").select("location_id", "p.*", "bills_ab", "lift")
    best_first = Window.partitionBy("location_id", "item").orderBy(F.desc("lift"), F.desc("bills_ab"), F.asc("partner"))
    return sides.withColumn("place", F.row_number().over(best_first))


def set_uptake(t, view: View = EVERYTHING) -> DataFrame:
    """D20. Sets against a-la-carte mains, and attach with and without what sets include."""
    month = F.date_format("business_date", "yyyy-MM").alias("ym")
    sums = view.of(t, t["tree_daily"]).groupBy("location_id", month).agg(
        F.sum("set_units").alias("set_units"), F.sum("main_units").alias("main_units"),
        F.sum(reduce(lambda a, b: a + b, [_c(f"{g}_units") for g in ATTACH])).alias("extras"),
        F.sum(reduce(lambda a, b: a + b, [_c(f"{g}_set_units") for g in ATTACH])).alias("in_sets"),
    )
    return sums.select(
        "location_id", "ym", "set_units", "main_units",
        percent(_c("set_units"), _meals()).alias("set_uptake_pct"),
        percent(_c("extras"), _meals()).alias("attach_all_pct"),
        percent(_c("extras") - _c("in_sets"), _meals()).alias("attach_upsell_pct"),
    )


def promo_effect(t, view: View = EVERYTHING) -> DataFrame:
    """D21. Mains and net per bill with a promotion against bills without."""
    rows = view.of(t, t["promo_daily"])
    none = _c("promo") == t.params.rules.no_promo
    sums = rows.groupBy("location_id", none.alias("without_promo")).agg(
        F.sum("bills").alias("bills"), F.sum("main_units").alias("mains"), F.sum("net_thb").alias("net_thb")
    )
    return sums.select(
        "location_id", "without_promo", "bills",
        quotient(_c("mains"), _c("bills"), 4).alias("mains_per_bill"),
        quotient(_c("net_thb"), _c("bills")).alias("net_per_bill"),
    )


def combo_uptake(t) -> DataFrame:
    """D22. How often the second item joins when the first is ordered."""
    return t["pair_lift"].select(
        "location_id", "item_a", "item_b", "bills_ab", "lift",
        percent(_c("bills_ab"), _c("bills_a")).alias("uptake_of_a_pct"),
        percent(_c("bills_ab"), _c("bills_b")).alias("uptake_of_b_pct"),
    )


# ---- section 7: calendar and context ---------------------------------------------------------------
def calendar_effects(t, view: View = EVERYTHING) -> DataFrame:
    """D23. Mean net of a kind of day against the branch mean, per channel."""
    dom = _c("dom")
    band = F.when(dom <= 7, "1-7").when(dom <= 14, "8-14").when(dom <= 21, "15-21").otherwise("22-end")
    wet = F.when(_c("rain_mm") >= RAIN_MM, "rain").when(_c("rain_mm").isNotNull(), "dry")
    off = F.when(_c("is_holiday"), "holiday").otherwise("normal")
    factors = F.array(
        F.struct(F.lit("weekday").alias("factor"), _c("dow").cast("string").alias("level")),
        F.struct(F.lit("month band").alias("factor"), band.alias("level")),
        F.struct(F.lit("holiday").alias("factor"), off.alias("level")),
        F.struct(F.lit("rain").alias("factor"), wet.alias("level")),
    )
    rows = view.of(t, t["calendar_daily"])
    mean = rows.groupBy("location_id", "channel").agg(ratio(F.sum("net_thb"), F.count("*")).alias("mean"))
    return (
        rows.select("location_id", "channel", "net_thb", F.explode(factors).alias("f"))
        .where(_c("f.level").isNotNull())
        .groupBy("location_id", "channel", _c("f.factor").alias("factor"), _c("f.level").alias("level"))
        .agg(F.count("*").alias("days"), ratio(F.sum("net_thb"), F.count("*")).alias("net"))
        .join(mean, ["location_id", "channel"])
        .select(
            "location_id", "channel", "factor", "level", "days", half_up("net", 2).alias("net_per_day"),
            half_up((_c("net") / F.nullif(_c("mean"), F.lit(0.0)) - 1) * 100, 2).alias("vs_mean_pct"),
        )
    )


def context_attach(t) -> DataFrame:
    """D24. Parties by daypart and size, next to the attach of that daypart."""
    party = t["party_size"].where(_c("channel") == "dine_in").groupBy("daypart", "pax_bucket").agg(
        F.sum("bills").alias("parties"), F.sum("net_thb").alias("net"), F.sum("main_units").alias("mains")
    )
    tree = t["tree_daily"].where(_c("channel") == "dine_in").groupBy("daypart").agg(
        F.sum(_meals()).alias("meals"), *[F.sum(f"{g}_units").alias(g) for g in ATTACH]
    )
    return party.join(tree, "daypart").select(
        "daypart", "pax_bucket", "parties",
        quotient(_c("net"), _c("parties")).alias("net_per_party"),
        quotient(_c("mains"), _c("parties"), 4).alias("mains_per_party"),
        *[percent(_c(g), _c("meals")).alias(f"{g}_attach_pct") for g in ATTACH],
    )


# ---- section 8: digest -----------------------------------------------------------------------------
def digest(t) -> DataFrame:
    """D25. The three best opportunities, a line per branch for its dead hours, and the three worst gaps
    of the last seven days."""
    p = t.params
    levers = t["opportunity"].select(
        F.when(_c("lever") == "dead_hours", "dead_hours").otherwise("opportunity").alias("kind"),
        "location_id", "channel", _c("lever").alias("what"), _c("uplift_thb_month").alias("value"),
    )
    best = levers.where(_c("kind") == "opportunity").orderBy(
        F.desc_nulls_last("value"), "location_id", "channel", "what"
    ).limit(DIGEST_ROWS)
    worst = t["calendar_daily"].where(
        _c("business_date").between(F.lit(p.days_ago(7)), F.lit(p.data_through)) & _c("gap_pct").isNotNull()
    ).orderBy("gap_pct", "location_id", "channel", "business_date").limit(DIGEST_ROWS)
    return best.unionByName(levers.where(_c("kind") == "dead_hours")).unionByName(worst.select(
        F.lit("gap").alias("kind"), "location_id", "channel",
        F.date_format("business_date", "yyyy-MM-dd").alias("what"), _c("gap_pct").alias("value"),
    ))


def day_types(t) -> DataFrame:
    """D34. The same totals under each day-type filter."""
    parts = []
    for kind in ("all", "weekday", "weekend", "holiday"):
        rows = View(day_type=kind).of(t, t["tree_daily"])
        parts.append(rows.groupBy("location_id").agg(
            F.sum("orders").alias("orders"), F.sum("net_thb").alias("net_thb")
        ).withColumn("day_type", F.lit(kind)))
    return reduce(DataFrame.unionByName, parts)


# ---- section 9: the delivery platform ----------------------------------------------------------------
def payout(t) -> DataFrame:
    """D26. From gross to what is kept, per branch."""
    orders = t["grab_orders"]
    paid = orders.where(_c("category") == "payment").groupBy("location_id").agg(
        *[F.sum(c).alias(c) for c in (
            "gross_thb", "merchant_discount_thb", "commission_thb", "marketing_fee_thb", "payout_thb",
        )],
        F.count("*").alias("orders"),
    )

    def of(category: str) -> Column:
        return zero_if_null(F.sum(F.when(_c("category") == category, _c("payout_thb"))))

    fees = orders.groupBy("location_id").agg(of("ads").alias("ads_thb"), of("adjustment").alias("adjust_thb"))
    kept = _c("payout_thb") + _c("ads_thb") + _c("adjust_thb")
    return paid.join(fees, "location_id").select(
        *paid.columns, "ads_thb", "adjust_thb", kept.alias("kept_thb"),
        percent(kept, _c("gross_thb")).alias("kept_pct"),
    )


def ads_brand(t) -> DataFrame:
    """D27. Own-brand against generic search: cost per order and orders per 100 spent."""
    return t["grab_keywords"].groupBy("is_brand").agg(
        *[F.sum(c).alias(c) for c in ("impressions", "clicks", "orders", "spend_thb", "revenue_thb")]
    ).select(
        "*", quotient(_c("spend_thb"), _c("orders")).alias("thb_per_order"),
        quotient(_c("orders") * 100, _c("spend_thb"), 4).alias("orders_per_100"),
    )


def ads_funnel(t) -> DataFrame:
    """D27. Impression to visit to cart to order, per campaign."""
    steps = ("impressions", "menu_visits", "add_to_cart", "orders")
    sums = t["grab_ads_hourly"].groupBy("campaign").agg(*[F.sum(c).alias(c) for c in steps])
    return sums.select(
        "*", *[percent(_c(b), _c(a)).alias(f"{b}_pct") for a, b in zip(steps, steps[1:])]
    )


def ads_hours(t) -> DataFrame:
    """D27. Where advertising money goes by hour, next to where orders come."""
    spend = t["grab_ads_hourly"].groupBy("hour").agg(F.sum("spend_thb").alias("spend_thb"))
    orders = t["grab_peak"].groupBy("hour").agg(F.sum("orders").alias("orders"))
    everything = Window.partitionBy()
    return spend.join(orders, "hour", "full_outer").select(
        "hour", zero_if_null(_c("spend_thb")).alias("spend_thb"),
        F.coalesce("orders", F.lit(0).cast("bigint")).alias("orders"),
        percent(zero_if_null(_c("spend_thb")), F.sum("spend_thb").over(everything), 4).alias("spend_share_pct"),
        percent(F.coalesce("orders", F.lit(0)), F.sum("orders").over(everything), 4).alias("orders_share_pct"),
    )


def campaigns(t) -> DataFrame:
    """D28. Campaign payback, and the branch's mean orders on campaign days and on other days."""
    runs = t["grab_offers"]
    cost = runs.groupBy("location_id", "campaign").agg(
        F.count_distinct("business_date").alias("days"), F.sum("orders").alias("orders"),
        F.sum("spend_thb").alias("spend_thb"), F.sum("net_thb").alias("net_thb"),
    )
    day = ["location_id", "business_date"]
    daily = t["grab_daily"].select(*day, "orders")
    on = daily.join(runs.select(*day).distinct(), day, "left_semi")
    off = daily.join(runs.select(*day).distinct(), day, "left_anti")

    def mean(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("location_id").agg(quotient(F.sum("orders"), F.count("*"), 4).alias(name))

    return (
        cost.join(mean(on, "orders_on_campaign_days"), "location_id", "left")
        .join(mean(off, "orders_on_other_days"), "location_id", "left")
        .select(
            *cost.columns, quotient(_c("spend_thb"), _c("orders")).alias("thb_per_order"),
            quotient(_c("net_thb"), _c("spend_thb"), 4).alias("net_per_thb"),
            "orders_on_campaign_days", "orders_on_other_days",
        )
    )


def lost_orders(t) -> DataFrame:
    """D29. Cancelled orders by reason and hour with the estimated loss."""
    return feeds.platform_cancels(t).groupBy("loc", "reason", "hr").agg(
        F.count("*").alias("orders"), F.sum(_c("est_thb").cast("decimal(18,2)")).alias("lost_thb")
    )


def rating_risk(t) -> DataFrame:
    """D30. Rating, unanswered reviews and missing-item rate by branch and month."""
    month = F.date_format("business_date", "yyyy-MM").alias("ym")
    rating = t["grab_daily"].groupBy("location_id", month).agg(
        quotient(F.sum("rating"), F.count("rating")).alias("rating")
    )
    reviews = t["grab_reviews"].groupBy(
        "location_id", F.date_format("review_date", "yyyy-MM").alias("ym")
    ).agg(F.count("*").alias("reviews"), F.count_if(~_c("replied")).alias("unanswered"))
    missing = t["grab_miwi_daily"].groupBy("location_id", month).agg(
        F.sum("total_reported").alias("reported"), F.sum("completed_orders").alias("completed")
    )
    rate = ratio(_c("reported"), _c("completed")) * 100
    key = ["location_id", "ym"]
    return rating.join(reviews, key, "full_outer").join(missing, key, "full_outer").select(
        *key, "rating", F.coalesce("reviews", F.lit(0).cast("bigint")).alias("reviews"),
        F.coalesce("unanswered", F.lit(0).cast("bigint")).alias("unanswered"),
        half_up(rate, 2).alias("missing_pct"),
        F.coalesce(rate > MISSING_RATE_ALERT, F.lit(False)).alias("missing_alert"),
    )


def unanswered_reviews(t) -> DataFrame:
    """D30. The reviews nobody has replied to, newest first."""
    open_ = t["grab_reviews"].where(~F.coalesce("replied", F.lit(False)))
    return open_.select("review_date", "location_id", "rating", "review").orderBy(
        F.desc("review_date"), "location_id", "rating", "review"
    )


def hour_curves(t) -> DataFrame:
    """D31. Share of orders by hour, platform next to in-store."""
    store = t["hourly"].where(_c("channel").isin(*t.params.rules.in_store)).where("hour IS NOT NULL")
    sides = [
        _share_of(rows, ["location_id"], ["hour"], "orders").select(
            "location_id", "hour", _c("orders").alias(f"{name}_orders"), _c("share_pct").alias(f"{name}_share_pct")
        )
        for name, rows in (("store", store), ("platform", t["grab_peak"]))
    ]
    return sides[0].join(sides[1], ["location_id", "hour"], "full_outer")


def top_items(t, places: int = TOP_ITEMS) -> DataFrame:
    """D31. The best-selling items of each side, place by place, down to the place asked for."""
    store = t["item_daily"].where(_c("channel").isin(*t.params.rules.in_store) & (_c("source") == "menu")).select(
        "location_id", _c("item_name").alias("item"), "units"
    )
    sides = []
    for name, rows in (("store", store), ("platform", t["grab_menu_daily"])):
        sums = rows.groupBy("location_id", "item").agg(F.sum("units").alias("units"))
        best = top_rows(sums, ["location_id"], [F.desc("units"), F.asc("item")], places)
        sides.append(best.select(
            "location_id", _c("_rank").alias("place"), _c("item").alias(f"{name}_item"), _c("units").alias(f"{name}_units")
        ))
    return sides[0].join(sides[1], ["location_id", "place"], "full_outer")


def platform_attach(t) -> DataFrame:
    """D31. Attach per main occasion on matched platform bills against in-store."""
    basket = feeds.platform_basket(t).groupBy(_c("loc").alias("location_id")).agg(*[
        F.sum(c).alias(c) for c in ("mains", "sets", "sides", "bev_paid", "bev_prem", "dessert", "topping")
    ])
    store = t["tree_daily"].where(_c("channel").isin(*t.params.rules.in_store)).groupBy("location_id").agg(
        F.sum(_meals()).alias("meals"), *[F.sum(f"{g}_units").alias(f"store_{g}") for g in ATTACH]
    )
    meals = _c("mains") + _c("sets")
    pairs = (("side", "sides"), ("bev_paid", "bev_paid"), ("bev_premium", "bev_prem"),
             ("dessert", "dessert"), ("topping", "topping"))
    joined = basket.join(store, "location_id", "full_outer")
    out = []
    for name, column in pairs:
        out += [percent(_c(column), meals).alias(f"platform_{name}_pct"),
                percent(_c(f"store_{name}"), _c("meals")).alias(f"store_{name}_pct")]
    return joined.select("location_id", *out)


def match_strip(t) -> DataFrame:
    """D32. Share of platform orders that have a bill."""
    return feeds.match_coverage(t).select(
        "loc", "ym", "orders", "matched", percent(_c("matched"), _c("orders")).alias("coverage_pct")
    )


def keying_lag(t) -> DataFrame:
    """D33. Minutes from the platform order to the till entry: median and 90th percentile."""
    made = t["grab_orders"].where(_c("category") == "payment").select("booking_id", "created_at")
    keyed = t.rel["pos_sale_tabs"].select(_c("order_id").alias("bill_id"), "starttime")
    lags = (
        t["grab_match"].select("booking_id", "location_id", "business_date", "bill_id")
        .join(made, "booking_id").join(keyed, "bill_id")
        .withColumn("lag_us", clock_micros(_c("starttime"), _c("business_date"))
                    - clock_micros(_c("created_at"), _c("business_date")))
    )
    spread = exact_percentiles(lags, ["location_id"], "lag_us", {"mid": 0.5, "late": 0.9}, "matches")
    return spread.select(
        "location_id", "matches", quotient(_c("mid"), F.lit(MINUTE)).alias("median_min"),
        quotient(_c("late"), F.lit(MINUTE)).alias("p90_min"),
    )


INSIGHTS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (
        driver_tree, trust_strip, density, occupancy, seat_time, dwell_by_hour, quiet_band, ceilings,
        gap_days, attach_layers, menu_scripts, party_mix, ticket_mix, choice_share, topping_parity,
        dish_options, member_attach, menu_matrix, item_trend, item_partners, set_uptake, promo_effect,
        combo_uptake, calendar_effects, context_attach, digest, day_types, payout, ads_brand, ads_funnel,
        ads_hours, campaigns, lost_orders, rating_risk, unanswered_reviews, hour_curves, top_items, platform_attach,
        match_strip, keying_lag,
    )
}
