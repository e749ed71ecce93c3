"""Seat occupancy: bill intervals, then hour cells and ten-minute peaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesgrain.functions.numbers import MONEY, half_up, ratio, zero_if_null
from salesgrain.functions.times import HOUR, MINUTE, clock_micros
from salesgrain.operators.median import exact_percentiles
from salesgrain.operators.ranks import in_rolling_windows, smaller_target, with_peers

SLOTS = 6
SLOT = 10 * MINUTE
ALL_DAY = -1


def _bills(t, facts: DataFrame) -> DataFrame:
    """Dine-in orders of facts with start and end in microseconds of the business date.

    recorded: it sat in the branch and both ends are known. late: it was opened at payment.
    """
    p, base = t.params, t.base
    sessions = (
        base.windowed("table_sessions").where(~F.coalesce("is_cancelled", F.lit(False)))
        .groupBy("order_id")
        .agg(F.min("seated_at").alias("seated_at"), F.max("left_at").alias("left_at"))
    )
    opened = base.windowed("orders", p.tab_extra_days).select(
        F.col("order_id").alias("master_id"), F.col("opened_at").alias("master_open")
    )
    split = base.split_children if base.stage.keeps("split_children") else base.split_tabs
    masters = split.join(opened, "master_id").select("order_id", "master_open", F.lit(True).alias("is_child"))
    timed = F.col("opened_at").isNotNull() & F.col("closed_at").isNotNull()
    first_open = F.least(F.coalesce("master_open", "opened_at"), F.col("opened_at"))
    day = F.col("business_date")
    own = [c for c in facts.columns if c not in ("opened_at", "closed_at", "taken_home")]
    return (
        facts.join(sessions, "order_id", "left")
        .join(masters, "order_id", "left")
        .select(
            *own, "taken_home",
            clock_micros(F.when(timed, first_open).otherwise(F.col("seated_at")), day).alias("start_us"),
            clock_micros(F.when(timed, F.col("closed_at")).otherwise(F.col("left_at")), day).alias("end_us"),
            (
                timed
                & F.col("is_child").isNull()
                & (clock_micros(F.col("closed_at"), day) - clock_micros(F.col("opened_at"), day)
                   < p.dwell_min * MINUTE)
            ).alias("late"),
        )
        .withColumn("recorded", ~F.col("taken_home") & F.col("start_us").isNotNull() & F.col("end_us").isNotNull())
        .withColumn("dwell_us", F.col("end_us") - F.col("start_us"))
        .withColumn("start_hour", F.pmod(F.floor(F.col("start_us") / HOUR), F.lit(24)).cast("int"))
        .drop("taken_home")
    )


def _believable(p):
    return F.col("dwell_us").between(p.dwell_min * MINUTE, p.dwell_max * MINUTE)


def _usual_stays(t, bills: DataFrame) -> DataFrame:
    """Per branch a map from opening hour, or ALL_DAY, to the median stay and how many bills it rests on."""
    p = t.params
    normal = bills.where(F.col("recorded") & ~F.col("late") & _believable(p) & t.base.since("business_date", p.impute_days))
    # a bill counts for its branch-hour and, under ALL_DAY, for its branch
    grouped = normal.withColumn("at", F.explode(F.array("start_hour", F.lit(ALL_DAY))))
    medians = exact_percentiles(grouped, ["location_id", "at"], "dwell_us", {"median_us": 0.5}, "n")
    return medians.groupBy("location_id").agg(
        F.map_from_entries(F.collect_list(F.struct("at", F.struct("median_us", "n").alias("m")))).alias("usual")
    )  # 25 entries at most


def _intervals(t) -> DataFrame:
    """Dine-in bills with persons, meals and net, and where recorded when they sat.

    imputed: the bill was opened at payment, so its start is its end minus the usual dwell.
    sit: long enough and short enough to count as seat time.
    """
    p, base = t.params, t.base
    place = ("order_id", "location_id", "business_date", "opened_at", "closed_at", "taken_home")
    dine_in = F.col("channel") == "dine_in"
    bills = base.stage.keep("recorded_stays", _bills(t, base.order_meals.where(dine_in).select(*place, "meals", "total_thb")))
    # what is usual needs no meals, so a lazy plan reads no options for it
    stays = bills if base.stage.keeps("recorded_stays") else _bills(t, base.order_taken_home.where(dine_in).select(*place))
    at_hour, all_day = F.col("usual")[F.col("start_hour")], F.col("usual")[F.lit(ALL_DAY)]
    usual = F.coalesce(
        F.when(at_hour["n"] >= p.impute_min_hour, F.floor(at_hour["median_us"])),
        F.when(all_day["n"] >= p.impute_min_all, F.floor(all_day["median_us"])),
        F.lit(p.impute_fallback * MINUTE),
    ).cast("bigint")
    late = F.col("late")
    dwell = F.when(late, usual).otherwise(F.col("dwell_us"))
    return bills.join(_usual_stays(t, stays), "location_id", "left").select(
        "order_id", "location_id", "business_date", "recorded", "meals", "total_thb",
        F.when(late, F.col("end_us") - dwell).otherwise(F.col("start_us")).alias("start_us"),
        "end_us", dwell.alias("dwell_us"), F.greatest(F.col("meals"), F.lit(1).cast(MONEY)).alias("persons"),
        late.alias("imputed"), (late | _believable(p)).alias("sit"),
    )


def bill_intervals(t) -> DataFrame:
    """A27. When each dine-in bill sat, in minutes of its business date."""

    def minutes(name: str):
        return F.col(name).cast("double") / MINUTE

    return _intervals(t).where("recorded").select(
        "order_id", "location_id", "business_date", "persons",
        minutes("start_us").alias("start_min"),
        minutes("end_us").alias("end_min"),
        minutes("dwell_us").alias("dwell_min"),
        "imputed", "sit",
    )


def _seat_days(t) -> DataFrame:
    """One row per branch and day with dine-in orders: net, meals, and the sums of each hour cell.

    A bill is exploded into its day and the open hours it overlaps, at most one per open hour, and one
    aggregation per cell does the rest. No interval is joined with another.
    """
    p = t.params
    first = F.greatest(F.coalesce("open_hour", F.lit(p.first_hour)), F.lit(p.first_hour))
    last = F.least(F.coalesce("close_hour", F.lit(p.last_hour)), F.lit(p.last_hour))
    hours = t.rel["seats"].select("location_id", "seats", first.alias("first"), last.alias("last")).where("first <= last")
    enter = F.greatest(F.floor(F.col("start_us") / HOUR), F.col("first")).cast("int")
    leave = F.least(F.ceil(F.col("end_us") / HOUR) - 1, F.col("last")).cast("int")
    cell_start = F.col("hour").cast("bigint") * HOUR
    cell_end = cell_start + HOUR
    overlap = F.least(F.col("end_us"), cell_end) - F.greatest(F.col("start_us"), cell_start)
    is_day = F.col("hour") == ALL_DAY
    opened_here = ~is_day & (F.col("start_us") >= cell_start) & (F.col("start_us") < cell_end)
    seated = ~is_day & F.col("sit")
    sat = F.when(F.col("recorded") & (enter <= leave), F.sequence(enter, leave)).otherwise(F.array().cast("array<int>"))

    def at_slot(k: int):
        instant = cell_start + k * SLOT
        there = seated & (F.col("start_us") <= instant) & (F.col("end_us") > instant)
        return zero_if_null(F.sum(F.when(there, F.col("persons")))).alias(f"slot_{k}")

    day = ["location_id", "business_date", "seats", "first", "last"]
    cells = (
        _intervals(t)
        .join(hours, "location_id")
        .withColumn("hour", F.explode(F.concat(F.array(F.lit(ALL_DAY)), sat)))
        .groupBy(*day, "hour")
        .agg(
            F.sum(F.when(is_day, F.col("total_thb"))).alias("net"),
            F.sum(F.when(is_day, F.col("meals"))).alias("meals"),
            F.sum(F.when(seated, F.col("persons") * overlap)).alias("person_us"),
            F.count_if(seated).alias("bills_open"),
            F.count_if(seated & opened_here).alias("turns"),
            F.sum(F.when(seated & opened_here, F.col("dwell_us"))).alias("opened_us"),
            F.sum(F.when(opened_here, F.col("persons"))).alias("persons_opened"),
            F.count_if(~is_day & F.col("imputed")).alias("imputed_bills"),
            *[at_slot(k) for k in range(SLOTS)],
        )
    )
    sums = F.struct("person_us", "bills_open", "turns", "opened_us", "persons_opened", "imputed_bills",
                    *[f"slot_{k}" for k in range(SLOTS)])
    days = cells.groupBy(*day).agg(
        F.max("net").alias("net"), F.max("meals").alias("meals"),
        F.map_from_entries(F.collect_list(F.when(~is_day, F.struct("hour", sums.alias("sums"))))).alias("cells"),
    )  # 24 entries at most
    return t.base.stage.keep("seat_days", days)


def _cell_measures(cell) -> dict:
    """The columns of an hour cell from its sums, which are NULL where no bill sat."""
    slots = [zero_if_null(cell[f"slot_{k}"]) for k in range(SLOTS)]
    peak = F.greatest(*slots)
    peak_slot = F.lit(0)
    for k in reversed(range(SLOTS)):
        peak_slot = F.when(slots[k] == peak, F.lit(k)).otherwise(peak_slot)

    def minutes(name: str):
        return half_up(F.coalesce(ratio(cell[name], F.lit(MINUTE)), F.lit(0.0)), 1)

    def count(name: str):
        return F.coalesce(cell[name], F.lit(0).cast("bigint"))

    return {
        "seat_minutes": minutes("person_us"), "bills_open": count("bills_open"), "turns": count("turns"),
        "dwell_min_sum": minutes("opened_us"),
        "persons_opened": half_up(zero_if_null(cell["persons_opened"]), 0).cast("bigint"),
        "imputed_bills": count("imputed_bills"), "peak_persons": peak, "peak_slot": peak_slot.cast("smallint"),
    }


def occupancy_hourly(t) -> DataFrame:
    """A26. Seat minutes, turns, persons opened and the busiest ten-minute slot per hour cell."""
    grid = _seat_days(t).withColumn("hour", F.explode(F.sequence("first", "last")))
    measures = _cell_measures(F.col("cells")[F.col("hour")])
    return grid.select("location_id", "business_date", "hour", *[c.alias(name) for name, c in measures.items()])


def dead_hours(t) -> DataFrame:
    """A24. Off-peak weekday hours: occupancy now, the two benchmarks, and what the gap is worth.

    One pipeline over the seat days: a day goes to its off-peak hours and, under ALL_DAY, to the branch's
    ticket; every hour goes to the windows it lies in, the recent days among them as NULL; the windows
    of an hour, as many as there are steps, are then looked at side by side.
    """
    p, base = t.params, t.base
    windows = (p.as_of, p.own_best_span, p.own_best_step, p.last_own_window)
    holidays = t.rel["holidays"].select(F.col("d").alias("business_date")).distinct().withColumn("holiday", F.lit(True))
    off_peak = (
        base.full_days("business_date", p.own_best_days)
        & (F.weekday("business_date") < 5)
        & ~F.col("location_id").isin(*p.dead_skip)
        & F.col("holiday").isNull()
    )
    none = F.array().cast("array<int>")
    of_day = F.when(off_peak, F.filter(F.sequence("first", "last"), lambda h: h.isin(*p.dead_hours))).otherwise(none)
    of_month = F.when(base.full_days("business_date", p.opp_days), F.array(F.lit(ALL_DAY))).otherwise(none)
    is_day = F.col("hour") == ALL_DAY
    measures = _cell_measures(F.col("cells")[F.col("hour")])
    rows = (
        _seat_days(t).where(F.col("seats") > 0)
        .join(holidays, "business_date", "left")
        .withColumn("hour", F.explode(F.concat(of_month, of_day)))
        .select(
            "location_id", "business_date", "hour", "seats",
            *[F.when(is_day, F.col(c)).alias(c) for c in ("net", "meals")],
            *[F.when(~is_day, measures[c]).alias(c) for c in ("persons_opened", "turns", "dwell_min_sum")],
        )
    )
    recent = is_day | (F.col("business_date") >= F.lit(p.days_ago(p.opp_days)))
    sums = ("days", "seats", "opened", "turns", "minutes", "net", "meals")
    hours = (
        in_rolling_windows(rows, "business_date", *windows, also=recent)
        .groupBy("location_id", "hour", "window_start")
        .agg(
            F.count("*").alias("days"),
            F.max("seats").alias("seats"),
            F.sum("persons_opened").alias("opened"),
            F.sum("turns").alias("turns"),
            F.sum(F.col("dwell_min_sum").cast("decimal(18,1)")).alias("minutes"),
            F.sum("net").alias("net"),
            F.sum("meals").alias("meals"),
        )
        .groupBy("location_id", "hour")
        .agg(F.collect_list(F.struct("window_start", *sums)).alias("sums"))
    )
    this_month = F.filter("sums", lambda x: x["window_start"].isNull())[0]
    whole = F.filter("sums", lambda x: x["window_start"].isNotNull() & (x["days"] >= p.dead_own_min_days))
    own = F.array_max(F.transform(whole, lambda x: F.struct(
        ratio(x["opened"], x["seats"] * x["days"]).alias("occ"), x["window_start"].alias("window_start"),
    )))
    branch = Window.partitionBy("location_id")
    usual_dwell = ratio(F.sum("minutes").over(branch), F.sum("turns").over(branch))
    now = (
        hours.select("location_id", "hour", own.alias("own"), this_month.alias("sums"))
        .where(F.col("sums").isNotNull())
        .select("location_id", "hour", "sums.*", F.col("own.occ").alias("own_occ"),
                F.col("own.window_start").alias("own_best_window"))
        .withColumnRenamed("days", "open_days")
        .withColumn("ticket", F.max(F.when(is_day, ratio(F.col("net"), F.col("meals")))).over(branch))
        .withColumn("occ", ratio(F.col("opened"), F.col("seats") * F.col("open_days")))
        .withColumn(
            "dwell",
            F.when(F.col("turns") >= F.col("open_days"), ratio(F.col("minutes"), F.col("turns"))).otherwise(usual_dwell),
        )
        .where(~is_day)
    )
    pool = (F.col("open_days") >= p.dead_peer_min_days) & ~F.col("location_id").isin(*p.peerless)
    peered = with_peers(now, ["hour"], "location_id", "occ", pool, pool, p.peer_min_branches)
    peer = F.coalesce("peer_rate", "best_rate")
    persons = F.coalesce(F.col("target") - F.col("occ"), F.lit(0.0)) * F.col("seats")
    return (
        peered.withColumn("target", smaller_target(F.col("occ"), peer, F.col("own_occ")))
        .select(
            "location_id", "hour", half_up("occ", 4).alias("occ"),
            half_up(peer, 4).alias("peer_target"),
            F.coalesce("peer_who", "best_who").alias("peer_loc"),
            half_up("own_occ", 4).alias("own_best"), "own_best_window",
            half_up("target", 4).alias("target_used"),
            half_up("dwell", 1).alias("dwell_min"),
            half_up(persons, 2).alias("persons_day"),
            half_up(persons * F.col("ticket"), 2).alias("thb_day"),
            "open_days",
            half_up("ticket", 2).alias("ticket_thb"),
        )
    )
