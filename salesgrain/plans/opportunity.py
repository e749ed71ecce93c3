"""The opportunity calculator: lever rates, unit values, two benchmarks, and what a gap is worth.

Every table here starts from _till_cells(): sold rows are read once, summed per order, and each order goes
to the few cells it counts in (its day, its party size, the bowls on it) for one aggregation. Rates, prices,
set values, own windows and peers are sums and windows over these cells, so a lazy plan reads no fact twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesgrain.functions import fixed_values as fv
from salesgrain.functions import text
from salesgrain.functions.numbers import MONEY, half_up, ratio, zero_if_null
from salesgrain.operators.ranks import in_rolling_windows, smaller_target, with_peers

MEAL_LEVERS = ("side", "bev_paid", "bev_premium", "dessert", "topping", "set")
PRICED_LEVERS = ("side", "dessert", "topping", "bev_paid", "bev_premium")
BUCKETS = ("1", "2", "3-4", "5+")
EXACT = "decimal(38,10)"


def _lever_of_units() -> Column:
    """The lever a unit row counts for, NULL when none; picks inside a set count for none."""
    category, tier = F.col("tree_category"), F.col("bev_tier")
    lever = F.when(category.isin("side", "dessert", "topping", "set"), category).when(
        tier.isin("paid", "premium"), F.concat(F.lit("bev_"), tier)
    )
    return F.when(F.col("source") != "set", lever)


def _till_cells(t) -> DataFrame:
    """In-store orders summed at three grains, from one reading of the sold rows.

    day: branch, channel and day, with units and money per lever. set: branch, party size and whether the
    bill has a set. bowl: branch, channel, day and menu item. Units of a lever stay NULL where none was sold.
    """
    p, base = t.params, t.base
    levered = F.col("lever")
    dish = F.col("tree_category").isin("main", "set")
    bowl = (F.col("tree_category") == "main") & (F.col("source") == "menu") & F.col("is_unit")

    def money(value: Column) -> Column:
        return value.cast(MONEY)

    per_order = (
        base.sold_rows.withColumn("lever", _lever_of_units())
        .groupBy("order_id")
        .agg(
            *[money(F.sum(F.when(levered == g, F.col("qty")))).alias(g) for g in MEAL_LEVERS],
            *[money(F.sum(F.when(levered == g, F.col("thb")))).alias(f"{g}_thb") for g in PRICED_LEVERS],
            money(F.sum(F.when(dish, F.col("qty")))).alias("meals"),
            money(F.sum(F.when(F.col("tree_category") == "set", F.col("qty")))).alias("sets"),
            F.collect_list(F.when(bowl, F.struct("itemid", "qty"))).alias("bowls"),  # of one order
        )
    )
    persons, sets = zero_if_null(F.col("meals")), zero_if_null(F.col("sets"))
    bucket = F.when(persons <= 1, "1").when(persons == 2, "2").when(persons <= 4, "3-4").otherwise("5+")
    rated = base.full_days("business_date", max(p.own_best_days, p.opp_days))
    sized = base.full_days("business_date", p.set_inc_days) & (persons > 0)

    def cell(grain: str, bucket: Column | None = None, has_set: Column | None = None, itemid: Column | None = None,
             qty: Column | None = None) -> Column:
        def typed(c: Column | None, kind: str) -> Column:
            return (F.lit(None) if c is None else c).cast(kind)

        return F.struct(
            F.lit(grain).alias("grain"), typed(bucket, "string").alias("bucket"), typed(has_set, "boolean").alias("has_set"),
            typed(itemid, "bigint").alias("itemid"), typed(qty, MONEY).alias("qty"),
        )

    with_set = F.when(sets > 0, True).when(sets == 0, False)
    items = F.transform(F.coalesce("bowls", F.array()), lambda b: cell("bowl", itemid=b["itemid"], qty=b["qty"]))
    none = F.slice(F.array(cell("day")), 1, 0)
    cells = F.concat(
        F.when(rated, F.concat(F.array(cell("day")), items)).otherwise(none),
        F.when(sized, F.array(cell("set", bucket, with_set))).otherwise(none),
    )
    measures = [*MEAL_LEVERS, *[f"{g}_thb" for g in PRICED_LEVERS], "meals", "sets"]
    not_bowl, not_set = F.col("grain") != "bowl", F.col("grain") != "set"
    longest = max(p.own_best_days, p.opp_days, p.set_inc_days)
    orders = base.orders.where(F.col("channel").isin(*p.rules.in_store) & base.full_days("business_date", longest))
    summed = (
        orders.select("order_id", "location_id", "channel", "business_date", "total_thb")
        .join(per_order, "order_id", "left")
        .select("location_id", "channel", "business_date", "total_thb", *measures, F.inline(cells))
        .groupBy(
            "grain", "location_id", F.when(not_set, F.col("channel")).alias("channel"),
            F.when(not_set, F.col("business_date")).alias("business_date"), "bucket", "has_set", "itemid",
        )
        .agg(
            F.count_if(not_bowl).alias("bills"), F.sum(F.when(not_bowl, F.col("total_thb"))).alias("net"),
            *[F.sum(F.when(not_bowl, F.col(c))).alias(c) for c in measures], F.sum("qty").alias("qty"),
        )
    )
    return base.stage.keep("till_cells", summed)


def _bucket_sums() -> list[Column]:
    """The sums of a party size, by whether its bills have a set."""
    return [
        F.sum(F.when(F.col("has_set") == has, F.col(c))).alias(f"{name}_{end}")
        for name, c in (("n", "bills"), ("net", "net"), ("persons", "meals"), ("sets", "sets"))
        for end, has in (("with", True), ("without", False))
    ]


def _set_sums() -> list[Column]:
    """Of the party sizes of a branch: what a set adds per meal, weighted by bills with a set, and totals."""
    diff = ratio(F.col("net_with"), F.col("persons_with")) - ratio(F.col("net_without"), F.col("persons_without"))
    # weighted in a fixed bucket order, so the double sum is reproducible
    weighted = [
        F.coalesce(F.max(F.when(F.col("bucket") == b, F.coalesce("n_with", F.lit(0)) * diff)), F.lit(0.0)) for b in BUCKETS
    ]
    return [
        F.sum(F.coalesce("n_with", F.lit(0))).alias("set_bills"), F.sum(F.coalesce("n_without", F.lit(0))).alias("nonset_bills"),
        (weighted[0] + weighted[1] + weighted[2] + weighted[3]).alias("weighted"),
        F.sum(F.when(diff.isNotNull(), F.coalesce("n_with", F.lit(0)))).alias("weight"),
        F.sum("persons_with").alias("persons"), F.sum("sets_with").alias("sets"),
    ]


def _set_values() -> dict[str, Column]:
    """From the set sums of a branch: the value of a set and what it rests on."""
    diff = F.when(F.col("weight") > 0, F.col("weighted") / F.col("weight"))
    per_bill = ratio(F.col("persons"), F.col("set_bills"))
    sets_per_bill = ratio(F.col("sets"), F.col("set_bills"))
    floored = F.greatest(F.coalesce(diff, F.lit(0.0)), F.lit(0.0))
    value = F.try_divide(floored * F.coalesce(per_bill, F.lit(0.0)), sets_per_bill)
    return {
        "incremental_thb_per_set": half_up(value, 2), "diff_per_meal_thb": half_up(diff, 2),
        "persons_per_set_bill": half_up(per_bill, 2), "sets_per_set_bill": half_up(sets_per_bill, 2),
    }


def set_incremental(t) -> DataFrame:
    """A18. What a set adds: net per meal on bills with a set minus bills without, by party size."""
    values = _set_values()
    per_branch = (
        _till_cells(t).where(F.col("grain") == "set")
        .groupBy("location_id", "bucket").agg(*_bucket_sums())
        .groupBy("location_id").agg(*_set_sums())
    )
    return per_branch.select(
        "location_id", "set_bills", "nonset_bills",
        values.pop("incremental_thb_per_set").alias("incremental_thb_per_set"),
        F.lit(fv.SET_VALUE_METHOD.format(days=t.params.set_inc_days)).alias("method"),
        *[c.alias(name) for name, c in values.items()],
    )


def _variant_names(t) -> DataFrame:
    """Menu items that are a variant of a family, with both parts of the name."""
    rules = t.params.rules
    return t.rel["items"].select(
        "itemid", "tree_category", "retail_price_thb",
        text.dish_family(F.col("name_th"), rules).alias("family"),
        text.dish_variant(F.col("name_th"), rules).alias("variant"),
    ).where(F.col("variant").isNotNull())


def _variants(t) -> DataFrame:
    """Variant items: is it the top or the info variant, does the family have the top one as a main dish, and
    the list price step of the family, NULL when it lacks one of the two variants."""
    rules = t.params.rules
    family = Window.partitionBy("family")
    top = F.col("variant") == rules.top_variant
    listed = (F.col("tree_category") == "main") & (F.col("retail_price_thb") > 0)

    def list_price(variant: str) -> Column:
        here = listed & (F.col("variant") == variant)
        return ratio(F.sum(F.when(here, F.col("retail_price_thb"))).over(family), F.count_if(here).over(family))

    step = half_up(list_price(rules.top_variant) - list_price(rules.base_variant), 6).cast("decimal(18,6)")
    loaded = F.coalesce(F.bool_or(top & (F.col("tree_category") == "main")).over(family), F.lit(False))
    return _variant_names(t).select(
        "itemid", "variant", top.alias("is_top"), (F.col("variant") == rules.info_variant).alias("is_info"),
        loaded.alias("is_loaded"), step.alias("step"),
    )


def _lever_cells(t) -> DataFrame:
    """One row per cell and lever: numerator n and denominator d of its rate, money and units of its price.

    Of a bowl: d and n count those of loaded families, all and with the top variant, info those with the
    info variant; its price is the step of its family. Rows of the set grain keep the sums of a party size.
    """

    def entry(lever: str, n=None, d=None, info=None, money=None, units=None) -> Column:
        columns = {"n": n, "d": d, "info": info, "money": money, "units": units}
        return F.struct(
            F.lit(lever).alias("lever"), *[(F.lit(None) if c is None else c).cast(EXACT).alias(k) for k, c in columns.items()]
        )

    meals = zero_if_null(F.col("meals"))
    of_day = [
        entry(g, zero_if_null(F.col(g)), meals, money=F.col(f"{g}_thb") if g in PRICED_LEVERS else None,
              units=F.col(g) if g in PRICED_LEVERS else None)
        for g in MEAL_LEVERS
    ]
    qty = F.col("qty")
    of_bowl = entry(
        "tradeup", F.when(F.col("is_loaded"), F.when(F.col("is_top"), qty).otherwise(0)), F.when(F.col("is_loaded"), qty),
        F.when(F.col("is_loaded") & F.col("is_info"), qty), qty * F.col("step"), F.when(F.col("step").isNotNull(), qty),
    )
    grain = F.col("grain")
    entries = (
        F.when(grain == "day", F.array(*of_day))
        .when(grain == "set", F.array(entry("set")))
        .when(F.col("variant").isNotNull(), F.array(of_bowl))
    )
    return _till_cells(t).join(_variants(t), "itemid", "left").select(
        "grain", "location_id", "channel", "business_date", "bucket", "has_set", "bills", "net", "meals", "sets", F.inline(entries)
    )


def lever_daily(t) -> DataFrame:
    """A20. Daily numerator and denominator of every lever, the grain own-best windows need."""
    daily = _lever_cells(t).where(F.col("d").isNotNull() & t.base.full_days("business_date", t.params.own_best_days))
    return daily.groupBy("location_id", "channel", "business_date", "lever").agg(
        F.sum("n").cast(MONEY).alias("n"), F.sum("d").cast(MONEY).alias("d")
    )


def _water_price(t) -> Column:
    """List price of plain water, read once as a scalar."""
    rules = t.params.rules
    price = (
        t.rel["items"].where(F.col("item_code") == rules.water_item_code)
        .agg(F.min_by("retail_price_thb", "itemid").alias("p"))
    )
    return F.coalesce(price.scalar(), F.lit(rules.water_default_price).cast(MONEY)).cast("double")


def _value(t, set_value: Column) -> Column:
    """What one more unit of a lever is worth, from money and units of the lever at a branch."""
    price = ratio(F.col("money"), F.col("units"))
    from_water = F.greatest(price - _water_price(t), F.lit(0.0))
    lever = F.col("lever")
    return F.when(lever == "set", set_value).when(lever.startswith("bev_"), from_water).otherwise(price)


def lever_value(t) -> DataFrame:
    """A21. What one more unit of a lever is worth to a branch."""
    recent = t.base.full_days("business_date", t.params.opp_days)
    priced = (recent & F.col("units").isNotNull()) | (F.col("grain") == "set")
    per_branch = (
        _lever_cells(t).where(priced)
        .groupBy("location_id", "lever", "bucket").agg(F.sum("money").alias("money"), F.sum("units").alias("units"), *_bucket_sums())
        .groupBy("location_id", "lever").agg(F.sum("money").alias("money"), F.sum("units").alias("units"), *_set_sums())
    )
    return per_branch.select("location_id", "lever", _value(t, _set_values()["incremental_thb_per_set"]).alias("value"))


def _lever_rows(t) -> DataFrame:
    """Calculator rows without the dead-hours roll-up: one pipeline over the lever cells.

    Cells go to the rolling windows they lie in, the current days and the party sizes to a NULL window;
    what a row takes from its branch (meals, prices, the set value) are sums in windows over these rows.
    """
    p, base = t.params, t.base
    row = ["location_id", "channel", "lever"]
    recent, in_own = base.since("business_date", p.opp_days), base.since("business_date", p.own_best_days)
    is_now = F.col("window_start").isNull()

    def now(column: str, condition: Column | None = None) -> Column:
        kept = is_now if condition is None else is_now & condition
        return F.sum(F.when(kept, F.col(column)))

    sums = {
        "n": now("n", in_own), "d": now("d", in_own), "info": now("info"), "bowls": now("d"),
        "money": now("money"), "units": now("units"),
        "own_n": F.sum(F.when(~is_now, F.col("n"))), "own_d": F.sum(F.when(~is_now, F.col("d"))),
    }
    per_window = (
        in_rolling_windows(
            _lever_cells(t), "business_date", p.as_of, p.own_best_span, p.own_best_step, p.last_own_window,
            also=recent | (F.col("grain") == "set"),
        )
        .groupBy(*row, "bucket", "window_start")
        .agg(*[c.alias(name) for name, c in sums.items()], *_bucket_sums())
    )
    best = F.max(F.when(
        F.col("own_d") >= p.opp_min_meals,
        F.struct(ratio(F.col("own_n"), F.col("own_d")).alias("rate"), F.col("window_start").alias("start")),
    ))
    per_lever = per_window.groupBy(*row).agg(
        best.alias("best"), *[F.sum(c).alias(c) for c in ("n", "d", "info", "bowls", "money", "units")], *_set_sums()
    )
    of_branch, of_lever = Window.partitionBy("location_id"), Window.partitionBy("location_id", "lever")
    of_channel = Window.partitionBy("location_id", "channel")
    set_value = F.when(F.col("channel").isNull(), _set_values()["incremental_thb_per_set"])
    valued = (
        per_lever.withColumn("set_value", F.max(set_value).over(of_branch))
        .withColumns({c: F.sum(c).over(of_lever) for c in ("money", "units")})
        .withColumn("meals", F.max(F.when(F.col("lever") == "side", F.col("d"))).over(of_channel))
        .where(F.col("channel").isNotNull() & (F.col("meals") >= p.opp_min_meals) & (F.col("d") > 0))
        .withColumn("rate", ratio(F.col("n"), F.col("d")))
        .withColumn("value", _value(t, F.col("set_value")))
    )
    peerless = F.col("location_id").isin(*p.peerless)
    pool = ~peerless & (F.col("d") >= p.opp_min_meals)
    qualified = pool & (F.col("meals") >= p.peer_min_meals)
    peered = with_peers(valued, ["channel", "lever"], "location_id", "rate", pool, qualified, p.peer_min_branches)

    def unless_peerless(c: Column) -> Column:
        return F.when(~peerless, c)

    has_runner_up = F.col("peer_who").isNotNull()
    share = half_up(ratio(F.col("info"), F.col("bowls")) * 100, 0).cast("bigint")
    return (
        peered.withColumn("peer", unless_peerless(F.when(has_runner_up, F.col("peer_rate")).otherwise(F.col("best_rate"))))
        .withColumn("peer_loc", unless_peerless(F.when(has_runner_up, F.col("peer_who")).otherwise(F.col("best_who"))))
        .withColumn("own_rate", F.col("best.rate"))
        .withColumn("own_best_window", F.col("best.start"))
        .withColumn("target", smaller_target(F.col("rate"), F.col("peer"), F.col("own_rate")))
        .withColumn("base", F.when(F.col("lever") == "tradeup", F.col("d")).otherwise(F.col("meals")))
        .withColumn("share", share)
        .withColumn("has_share", (F.col("lever") == "tradeup") & F.col("bowls").isNotNull())
    )


def opportunity_notes(t) -> DataFrame:
    """A23. Calculator rows; trade-up rows also state the share of the second variant."""
    rules = t.params.rules
    gap = F.coalesce(F.col("target") - F.col("rate"), F.lit(0.0))
    value = F.coalesce("value", F.lit(0.0))
    no_target = F.col("target").isNull()
    status = (
        F.when(F.col("peer").isNull() & F.col("own_rate").isNull(), fv.NOTE_NO_TARGET)
        .when(no_target, fv.NOTE_AT_TARGET)
        .otherwise("")
    )
    prefix, suffix = fv.NOTE_BASE.format(n="|", variant=rules.top_variant).split("|")
    bowls = half_up("base", 0).cast("bigint").cast("string")
    base_note = F.when(
        F.col("lever") == "tradeup",
        F.concat(F.when(no_target, fv.NOTE_SEPARATOR).otherwise(""), F.lit(prefix), bowls, F.lit(suffix)),
    ).otherwise("")
    note = F.concat(status, base_note)
    longer = F.concat(note, F.lit(f"{fv.NOTE_SEPARATOR}{rules.info_variant} "), F.col("share").cast("string"), F.lit("%"))
    return _lever_rows(t).select(
        "location_id", "channel", "lever",
        half_up("rate", 4).alias("current_rate"),
        half_up("peer", 4).alias("peer_target"),
        F.col("peer_loc").alias("peer_best_loc"),
        half_up("own_rate", 4).alias("own_best"),
        "own_best_window",
        half_up("target", 4).alias("target_used"),
        half_up(gap * 100, 2).alias("gap_pp"),
        F.col("base").cast("double").alias("meals_30d"),
        half_up(value, 2).alias("value_per_unit_thb"),
        half_up(gap * F.col("base").cast("double") * value, 0).alias("uplift_thb_month"),
        F.when(F.col("has_share"), longer).otherwise(note).alias("note"),
    )


def dead_hours_rollup(t) -> DataFrame:
    """A25. One calculator row per branch from its off-peak hours."""
    hour = F.col("hour").cast("string")
    has_target = F.col("target_used").isNotNull()

    def mean(c: str, condition: Column | None = None) -> Column:
        exact = F.col(c).cast("decimal(18,4)")
        kept = exact if condition is None else F.when(condition, exact)
        return ratio(F.sum(kept), F.count(kept))

    gap = F.col("target_used").cast("decimal(18,4)") - F.col("occ").cast("decimal(18,4)")
    worth = F.when(F.col("thb_day") > 0, F.struct(F.col("hour"), hour.alias("text")))
    rolled = t["dead_hours"].groupBy("location_id").agg(
        half_up(mean("occ"), 4).alias("current_rate"),
        half_up(mean("peer_target"), 4).alias("peer_target"),
        half_up(mean("own_best"), 4).alias("own_best"),
        half_up(mean("target_used", has_target), 4).alias("target_used"),
        half_up(ratio(F.sum(gap) * 100, F.count(gap)), 2).alias("gap_pp"),
        F.sum(F.col("persons_day").cast("decimal(18,2)")).alias("persons"),
        F.sum(F.col("thb_day").cast("decimal(18,2)")).alias("thb"),
        F.max("open_days").alias("days"),
        F.max("ticket_thb").alias("value_per_unit_thb"),
        F.array_sort(F.collect_set(worth)).alias("worth"),
    )
    hours = F.when(
        F.size("worth") > 0,
        F.concat(F.lit("hours "), F.array_join(F.transform("worth", lambda w: w["text"]), ",")),
    ).otherwise(fv.NOTE_AT_TARGET)
    return rolled.select(
        "location_id", F.lit("dine_in").alias("channel"), F.lit("dead_hours").alias("lever"),
        "current_rate", "peer_target", F.lit(None).cast("string").alias("peer_best_loc"), "own_best",
        F.lit(None).cast("date").alias("own_best_window"), "target_used", "gap_pp",
        half_up(F.col("persons") * F.col("days"), 0).cast("double").alias("meals_30d"),
        "value_per_unit_thb",
        half_up(F.col("thb") * F.col("days"), 0).cast("double").alias("uplift_thb_month"),
        F.concat(hours, F.lit(fv.NOTE_SEPARATOR), F.col("days").cast("string"), F.lit(fv.NOTE_OPEN_DAYS)).alias("note"),
    )


def opportunity(t) -> DataFrame:
    """A22. The full calculator table."""
    return t["opportunity_notes"].unionByName(t["dead_hours_rollup"])
