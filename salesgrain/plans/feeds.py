"""The read side: narrow, ordered feeds a dashboard payload is made of."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesgrain.functions import fixed_values as fv
from salesgrain.functions import text
from salesgrain.functions.numbers import half_up, ratio
from salesgrain.operators.ranks import top_rows
from salesgrain.plans.base import on_line


@dataclass(frozen=True)
class Plain:
    """A feed that only selects, filters by recency and sorts one table.

    columns: "column" or "column:alias"; a date column ends with "@" and becomes YYYY-MM-DD text.
    recent: "days" keeps the daily window, "months" the monthly one.
    order: table columns, "-" in front for descending.
    """

    table: str
    columns: str
    order: str
    recent: str | None = None

    def __call__(self, t) -> DataFrame:
        rows = recent_rows(t, t[self.table], self.recent)
        keys = [F.desc_nulls_last(o[1:]) if o.startswith("-") else F.asc_nulls_last(o) for o in self.order.split()]
        return rows.orderBy(*keys).select(*[_feed_column(c) for c in self.columns.split()])


def _feed_column(spec: str) -> Column:
    name, _, alias = spec.partition(":")
    if name.endswith("@"):
        name = name[:-1]
        return iso_day(name).alias(alias or name)
    return F.col(name).alias(alias or name)


def iso_day(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd")


def month_of(name: str) -> Column:
    return F.date_format(name, "yyyy-MM")


def recent_rows(t, rows: DataFrame, recent: str | None) -> DataFrame:
    p = t.params
    if recent == "days":
        return rows.where(F.col("business_date") >= F.lit(p.days_ago(p.feed_days)))
    if recent == "months":
        return rows.where(F.col("ym") >= p.first_feed_month)
    return rows


PLACE_DAY = "location_id:loc business_date@:d"

PLAIN: dict[str, Plain] = {
    "tree": Plain(
        "tree_daily",
        f"{PLACE_DAY} daypart channel orders pax_keyed:pax main_units:main bev_units:bev "
        "bev_water_units:bev_w bev_paid_units:bev_p bev_premium_units:bev_pr side_units:side "
        "topping_units:top dessert_units:des paid_option_picks:opt_n paid_option_thb:opt_thb "
        "gross_thb:gross discount_thb:disc net_thb:net main_thb bev_thb side_thb topping_thb:top_thb "
        "dessert_thb:des_thb bev_paid_thb bev_premium_thb set_units:set set_thb side_set_units:side_s "
        "bev_paid_set_units:bev_p_s bev_premium_set_units:bev_pr_s dessert_set_units:des_s "
        "topping_set_units:top_s",
        "business_date location_id daypart channel", "days",
    ),
    "hourly": Plain(
        "hourly", f"{PLACE_DAY} hour channel orders pax_keyed:pax net_thb:net main_units:main",
        "business_date location_id hour channel", "days",
    ),
    "dwell": Plain(
        "dwell", f"{PLACE_DAY} daypart sessions avg_dwell_min:avg_min avg_party",
        "business_date location_id daypart", "days",
    ),
    "occupancy": Plain(
        "occupancy_hourly",
        f"{PLACE_DAY} hour seat_minutes:seat_min bills_open turns dwell_min_sum:dwell_sum "
        "persons_opened imputed_bills peak_persons peak_slot",
        "business_date location_id hour", "days",
    ),
    "pax_trust": Plain(
        "pax_trust", f"{PLACE_DAY} bowls keyed_pax:keyed ratio trusted", "business_date location_id", "days"
    ),
    "items": Plain(
        "item_daily",
        f"{PLACE_DAY} channel item_name:item main_category:cat sub_category:sub bev_tier:tier units "
        "thb bills avg_price:price source:src",
        "business_date location_id channel item_name", "days",
    ),
    "options": Plain(
        "option_monthly",
        "location_id:loc ym channel modifier_group:group choice_th:choice picks paid_picks paid_thb",
        "ym location_id channel modifier_group -picks", "months",
    ),
    "topping_route": Plain(
        "topping_route",
        "location_id:loc ym channel topping as_option_units:opt_u as_option_thb:opt_thb "
        "as_menu_units:menu_u as_menu_thb:menu_thb",
        "ym location_id channel topping", "months",
    ),
    "party": Plain(
        "party_size",
        "location_id:loc ym channel daypart pax_bucket:bucket bills net_thb:net main_units:main",
        "ym location_id channel daypart pax_bucket", "months",
    ),
    "ticket": Plain(
        "ticket_hist", "location_id:loc ym channel thb_bucket:bucket bills",
        "ym location_id channel thb_bucket", "months",
    ),
    "members.monthly": Plain(
        "members_monthly", "location_id:loc ym bills member_bills distinct_members:members",
        "ym location_id", "months",
    ),
    "promo": Plain(
        "promo_daily", f"{PLACE_DAY} channel promo bills main_units:main net_thb:net",
        "business_date location_id channel promo", "days",
    ),
    "sets": Plain(
        "set_monthly", "location_id:loc ym channel set_name:name units thb",
        "ym location_id channel set_name", "months",
    ),
    "calendar": Plain(
        "calendar_daily",
        f"{PLACE_DAY} channel orders net_thb:net dow dom wom is_holiday:hol rain_mm:rain "
        "expected_thb:expected gap_pct:gap",
        "business_date location_id channel",
    ),
    "opportunity": Plain(
        "opportunity",
        "location_id:loc channel lever current_rate:rate peer_target:peer peer_best_loc:peer_loc "
        "own_best:own own_best_window@:own_win target_used:target gap_pp meals_30d:meals30 "
        "value_per_unit_thb:value uplift_thb_month:uplift note",
        "-uplift_thb_month",
    ),
    "set_inc": Plain(
        "set_incremental",
        "location_id:loc set_bills nonset_bills incremental_thb_per_set:value diff_per_meal_thb:diff "
        "persons_per_set_bill:persons sets_per_set_bill:sets",
        "location_id",
    ),
    "dead_hours": Plain(
        "dead_hours",
        "location_id:loc hour occ peer_target:peer peer_loc own_best:own own_best_window@:own_win "
        "target_used:target dwell_min:dwell persons_day:persons thb_day open_days:days ticket_thb:ticket",
        "location_id hour",
    ),
    "grab.daily": Plain(
        "grab_daily", f"{PLACE_DAY} gross_thb:gross net_thb:net orders avg_order_thb:avg rating",
        "business_date location_id",
    ),
    "grab.menu": Plain("grab_menu_daily", f"{PLACE_DAY} item units thb", "business_date location_id item"),
    "grab.offers": Plain(
        "grab_offers", f"{PLACE_DAY} campaign gross_thb:gross net_thb:net orders spend_thb:spend",
        "business_date location_id campaign",
    ),
    "grab.peak": Plain("grab_peak", f"{PLACE_DAY} hour orders", "business_date location_id hour"),
    "grab.ads": Plain(
        "grab_ads_hourly",
        "d@ hour campaign spend_thb:spend impressions:impr clicks menu_visits:visits add_to_cart:cart "
        f"orders revenue_thb:{fv.KEY_AD_REVENUE}",
        "d hour campaign",
    ),
    "grab.keywords": Plain(
        "grab_keywords",
        f"ym keyword:kw is_brand:brand impressions:impr clicks spend_thb:spend orders revenue_thb:{fv.KEY_AD_REVENUE}",
        "ym -impressions", "months",
    ),
    "grab.miwi": Plain(
        "grab_miwi_daily",
        f"{PLACE_DAY} wrong missing total_reported:reported completed_orders:completed",
        "business_date location_id",
    ),
    "grab.reviews": Plain(
        "grab_reviews",
        "location_id:loc review_date@:d rating review:text replied service_type:service",
        "-review_date location_id",
    ),
    "grab.combos": Plain("grab_combos", "location_id:loc as_of@ combo n", "as_of location_id -n"),
    "grab.match": Plain(
        "grab_match", "booking_id:booking " + PLACE_DAY + " gf_no:gf bill_id:bill ambiguous",
        "business_date location_id gf_no",
    ),
}


def branches(t) -> DataFrame:
    """P1. Live, active, real branches; opening hours come from the seat list when it has them."""
    real = t.rel["locations"].where(
        (F.col("location_type") == "branch") & F.col("is_active") & F.col("is_confirmed_live")
        & ~F.col("is_suspected_test")
    )
    seats = t.rel["seats"].select(
        "location_id", "seats", F.col("open_hour").alias("_open"), F.col("close_hour").alias("_close")
    )
    label = F.col("location_id")
    for location, shown in t.params.rules.branch_labels.items():
        label = F.when(F.col("location_id") == location, shown).otherwise(label)
    return real.join(seats, "location_id", "left").orderBy("branchid").select(
        F.col("location_id").alias("id"), label.alias("th"), "seats",
        F.coalesce("_open", "open_hour").alias("open"), F.coalesce("_close", "close_hour").alias("close"),
    )


def holidays(t) -> DataFrame:
    """P2."""
    return t.rel["holidays"].orderBy("d").select(iso_day("d").alias("d"))


def option_by_dish(t) -> DataFrame:
    """P10. Picks per dish without the long tail."""
    rows = recent_rows(t, t["option_by_dish"], "months").where(F.col("picks") > t.params.dish_min_picks)
    return rows.orderBy(
        "ym", "location_id", "channel", "dish_th", "modifier_group", F.desc("picks")
    ).select(
        F.col("location_id").alias("loc"), "ym", "channel", F.col("dish_th").alias("dish"),
        F.col("modifier_group").alias("group"), F.col("choice_th").alias("choice"), "picks",
    )


def pairs(t) -> DataFrame:
    """P12. The strongest pairs of each branch."""
    p = t.params
    strong = t["pair_lift"].where(F.col("lift") >= F.lit(float(p.pairs_min_lift)))
    order = [F.desc("lift"), F.desc("bills_ab"), F.asc("item_a"), F.asc("item_b")]
    return top_rows(strong, ["location_id"], order, p.pairs_per_branch).orderBy("location_id", "_rank").select(
        F.col("location_id").alias("loc"), F.col("item_a").alias("a"), F.col("item_b").alias("b"),
        F.col("bills_ab").alias("ab"), F.col("bills_a").alias("na"), F.col("bills_b").alias("nb"),
        F.col("total_bills").alias("n"), "lift",
    )


def winback(t) -> DataFrame:
    """P16. Regular members who have stayed away, best first."""
    p = t.params
    away = t["member_visits"].where(
        (F.col("visits") >= p.winback_min_visits) & (F.col("days_since") >= p.winback_min_days)
    )
    return away.orderBy(F.desc("visits"), F.desc("avg_thb"), "member_key").limit(p.winback_rows).select(
        F.col("member_key").alias("key"), F.col("last_location_id").alias("loc"), "visits",
        iso_day("last_date").alias("last_date"), "days_since", "avg_thb",
    )


def pairs_menu(t) -> DataFrame:
    """P23. Weekly menu pairs. An item among the best of any branch is kept at every branch."""
    p = t.params
    week = ["location_id", "main_family", "week_start"]
    rows = t["pair_attach"]
    main_bills = (
        rows.select(*week, "channel", "bills_main").distinct()
        .groupBy(*week).agg(F.sum("bills_main").alias("_bills"))
        .where(F.col("_bills") >= p.script_min_bills)
    )
    kept = rows.join(main_bills.select(*week), week, "left_semi").where(
        (F.col("bills_both") >= 1) & (F.col("week_start") >= F.lit(p.days_ago(p.script_weeks_days)))
    )
    if p.script_top_items is not None:
        best = Window.partitionBy("location_id", "main_family").orderBy(F.desc("_both"))
        top = (
            kept.groupBy("location_id", "main_family", "item").agg(F.sum("bills_both").alias("_both"))
            .withColumn("_rank", F.rank().over(best))
            .where(F.col("_rank") <= p.script_top_items)
            .select("main_family", "item").distinct()
        )
        kept = kept.join(top, ["main_family", "item"], "left_semi")
    return kept.orderBy("week_start", "location_id", "main_family", "item", "channel").select(
        F.col("location_id").alias("loc"), F.col("channel").alias("ch"), iso_day("week_start").alias("week"),
        F.col("main_family").alias("family"), "item", "bills_main", "bills_both", "thb_both",
    )


# ---- platform feeds with logic --------------------------------------------------------------
def platform_orders(t) -> DataFrame:
    """P25. Payment rows with their hour."""
    paid = t["grab_orders"].where(F.col("category") == "payment")
    return paid.orderBy("business_date", "location_id", "created_at").select(
        F.col("booking_id").alias("booking"), F.col("location_id").alias("loc"),
        iso_day("business_date").alias("d"), F.col("gf_no").alias("gf"), F.hour("created_at").alias("hr"),
        F.col("gross_thb").alias("gross"), F.col("merchant_discount_thb").alias("disc"),
        F.col("net_thb").alias("net"), F.col("commission_thb").alias("comm"),
        F.col("marketing_fee_thb").alias("mkt"), F.col("payout_thb").alias("payout"), "status", "cancel_reason",
    )


def platform_cancels(t) -> DataFrame:
    """P26. Cancelled orders, each valued at its branch-month's average order."""
    usual = t["grab_daily"].groupBy("location_id", month_of("business_date").alias("ym")).agg(
        half_up(ratio(F.sum("gross_thb"), F.sum("orders")), 2).alias("est_thb")
    )
    lost = t["grab_orders"].where(
        (F.col("category") == "other") & (F.col("status") == t.params.rules.cancelled_status)
    ).withColumn("ym", month_of("business_date"))
    return lost.join(usual, ["location_id", "ym"], "left").orderBy(
        "business_date", "location_id", "created_at"
    ).select(
        F.col("location_id").alias("loc"), iso_day("business_date").alias("d"), F.hour("created_at").alias("hr"),
        F.col("gf_no").alias("gf"), F.col("cancel_reason").alias("reason"), "cancelled_by", "est_thb",
    )


def platform_fees(t) -> DataFrame:
    """P27. Advertising, adjustments and unpaid orders per branch-month."""

    def paid_out(category: str) -> Column:
        amount = F.when(F.col("category") == category, F.col("payout_thb"))
        return F.coalesce(F.sum(amount), F.lit(0).cast("decimal(18,4)"))

    unpaid = (F.col("category") == "payment") & (F.col("status") == t.params.rules.unpaid_status)
    return (
        t["grab_orders"].groupBy(F.col("location_id").alias("loc"), month_of("business_date").alias("ym"))
        .agg(paid_out("ads").alias("ads_thb"), paid_out("adjustment").alias("adjust_thb"),
             F.count_if(unpaid).alias("unpaid_rows"))
        .orderBy("ym", "loc")
    )


def _recent_matches(t) -> DataFrame:
    matched = t["grab_match"].select("location_id", month_of("business_date").alias("ym"), "bill_id")
    return recent_rows(t, matched, "months")


def platform_options(t) -> DataFrame:
    """P36. Option picks on matched bills."""
    picks = t.base.windowed("sold_options").select(F.col("order_id").alias("bill_id"), "modifier_group", "choice_th")
    return (
        _recent_matches(t).join(picks, "bill_id")
        .groupBy(F.col("location_id").alias("loc"), "ym", F.col("modifier_group").alias("group"),
                 F.col("choice_th").alias("choice"))
        .agg(F.count("*").alias("picks"))
        .orderBy("ym", "loc", "group", F.desc("picks"))
    )


def match_coverage(t) -> DataFrame:
    """P38. Payment rows and how many of them have a bill, per branch-month."""
    paid = t["grab_orders"].where(F.col("category") == "payment").select(
        "location_id", month_of("business_date").alias("ym"), "booking_id"
    )
    hits = t["grab_match"].select("booking_id").distinct().withColumn("_hit", F.lit(True))
    return (
        recent_rows(t, paid, "months").join(hits, "booking_id", "left")
        .groupBy(F.col("location_id").alias("loc"), "ym")
        .agg(F.count("*").alias("orders"), F.count("_hit").alias("matched"))
        .orderBy("ym", "loc")
    )


def platform_basket(t) -> DataFrame:
    """P39. What matched platform bills hold, lines and item options alike."""
    p, base = t.params, t.base
    rules = p.rules
    bills = _recent_matches(t).distinct().withColumnRenamed("bill_id", "order_id")
    lines = base.described_lines.select(
        "order_id", "line_id", "tree_category", F.col("unit_price_inc_vat_thb").alias("price"), "qty",
        F.lit(True).alias("is_line"), "is_free",
    )
    picked = base.item_options(base.windowed("sold_options")).join(base.item_choices, "choice_key").select(
        "order_id", "line_id", "tree_category", F.col("retail_price_thb").alias("price"),
        (F.col("choice_qty") * F.col("qty_mult")).cast("decimal(18,4)").alias("qty"),
        F.lit(False).alias("is_line"), F.lit(False).alias("is_free"),
    )
    # lines and options lie by order, where an option sees its line, and meet the bills there once
    held = (
        lines.unionByName(picked).repartition("order_id")
        .withColumn("hangs", on_line(F.col("is_line")))
        .where(F.col("hangs") & ~F.col("is_free"))
        .join(bills, "order_id")
    )
    category, price = F.col("tree_category"), F.col("price")
    drink = category == "beverage"
    low, high = F.lit(rules.water_max), F.lit(rules.paid_bev_max)

    def units(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col("qty"))).alias(name)

    return (
        held.groupBy(F.col("location_id").alias("loc"), "ym")
        .agg(
            units(category == "main", "mains"), units(category == "side", "sides"),
            units(drink & (price > low) & (price <= high), "bev_paid"), units(drink & (price > high), "bev_prem"),
            units(category == "dessert", "dessert"), units(category == "topping", "topping"),
            F.lit(0).alias("paid_opt"),
            F.count_distinct("order_id").alias("orders"),
            F.coalesce(F.sum(F.when(category == "set", F.col("qty"))), F.lit(0).cast("decimal(18,4)")).alias("sets"),
        )
        .orderBy("ym", "loc")
    )


def platform_months(t) -> DataFrame:
    """P40. Months with any platform data."""
    months = [t[name].select(month_of("business_date").alias("ym")) for name in ("grab_daily", "grab_orders")]
    return months[0].union(months[1]).distinct().orderBy("ym")


FEEDS: dict[str, Callable[..., DataFrame]] = {
    "branches": branches,
    "holidays": holidays,
    **PLAIN,
    "option_by_dish": option_by_dish,
    "pairs": pairs,
    "members.winback": winback,
    "pairs_menu": pairs_menu,
    "grab.orders": platform_orders,
    "grab.cancels": platform_cancels,
    "grab.fees": platform_fees,
    "grab.options": platform_options,
    "grab.match_cov": match_coverage,
    "grab.basket": platform_basket,
    "grab.months": platform_months,
}
DAILY_FEEDS = (
    "tree", "hourly", "dwell", "occupancy", "pax_trust", "items", "promo", "calendar", "grab.daily",
    "grab.orders", "grab.menu", "grab.offers", "grab.peak", "grab.miwi", "grab.match",
)


def today_partial(t, feeds: dict[str, DataFrame] | None = None) -> DataFrame:
    """P41. Does any daily feed hold a row later than the last full day? One row."""
    through = t.params.data_through.isoformat()
    latest = None
    for name in DAILY_FEEDS:
        feed = feeds[name] if feeds else FEEDS[name](t)
        one = feed.agg(F.max("d").alias("d"))
        latest = one if latest is None else latest.unionByName(one)
    return latest.agg(F.coalesce(F.max("d") > through, F.lit(False)).alias("today_partial"))
