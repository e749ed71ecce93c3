"""Benchmarks between branches and between periods, on already aggregated rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n)


def best_other(df: DataFrame, pool: DataFrame, keys: list[str], who: str, rate: str) -> DataFrame:
    """Adds best_rate / best_who: the highest pool row of the group that is another branch.

    Only the two leading pool rows of a group can matter: whoever is not first meets the first,
    the first meets the second.
    """
    leaders = top_rows(pool, keys, [F.desc_nulls_last(rate), F.asc(who)], 2)
    pair = leaders.groupBy(*keys).agg(
        F.max(F.when(F.col("_rank") == 1, F.col(who))).alias("_who1"),
        F.max(F.when(F.col("_rank") == 1, F.col(rate))).alias("_rate1"),
        F.max(F.when(F.col("_rank") == 2, F.col(who))).alias("_who2"),
        F.max(F.when(F.col("_rank") == 2, F.col(rate))).alias("_rate2"),
    )
    is_first = F.col(who) == F.col("_who1")
    return (
        df.join(pair, keys, "left")
        .withColumn("best_who", F.when(is_first, F.col("_who2")).otherwise(F.col("_who1")))
        .withColumn("best_rate", F.when(is_first, F.col("_rate2")).otherwise(F.col("_rate1")))
        .drop("_who1", "_rate1", "_who2", "_rate2")
    )


def with_peers(
    df: DataFrame, keys: list[str], who: str, rate: str, pool: Column, qualified: Column, at_least: int
) -> DataFrame:
    """Adds best_rate / best_who, as best_other() of the rows in the pool, and peer_rate / peer_who: the
    runner-up of the qualified rows of a group with `at_least` of them. All in windows over one reading."""
    group = Window.partitionBy(*keys)
    order = [F.desc_nulls_last(rate), F.asc(who)]

    def place(condition: Column) -> Column:
        return F.when(condition, F.row_number().over(group.orderBy(F.when(condition, 0).otherwise(1), *order)))

    def holder(rank: str, n: int, column: str) -> Column:
        return F.max(F.when(F.col(rank) == n, F.col(column))).over(group)

    ranked = df.withColumn("_pool", place(pool)).withColumn("_rank", place(qualified))
    is_first = F.coalesce(F.col(who) == holder("_pool", 1, who), F.lit(False))
    enough = F.count("_rank").over(group) >= at_least

    def other(column: str) -> Column:
        return F.when(is_first, holder("_pool", 2, column)).otherwise(holder("_pool", 1, column))

    return ranked.withColumns({
        "best_who": other(who), "best_rate": other(rate),
        "peer_who": F.when(enough, holder("_rank", 2, who)), "peer_rate": F.when(enough, holder("_rank", 2, rate)),
    }).drop("_pool", "_rank")


def in_rolling_windows(
    df: DataFrame, day: str, as_of: dt.date, span: int, step: int, last_window: int, also: Column | None = None
) -> DataFrame:
    """One row per window a day falls into, with the window's first day as `window_start`.

    Window k runs from as_of - span - step*k to as_of - 1 - step*k. The few windows of a day are
    computed from its age, so nothing is joined. Days that meet the condition `also` get one more
    row, with a NULL window_start.
    """
    age = F.datediff(F.lit(as_of), F.col(day))
    first = F.greatest(F.lit(0), F.ceil((age - span) / step)).cast("int")
    last = F.least(F.lit(last_window), F.floor((age - 1) / step)).cast("int")
    none = F.array().cast("array<int>")
    numbers = F.when((age >= 1) & (first <= last), F.sequence(first, F.greatest(first, last))).otherwise(none)
    starts = F.transform(numbers, lambda k: F.date_sub(F.lit(as_of), F.lit(span) + k * step))
    if also is not None:
        starts = F.concat(starts, F.when(also, F.array(F.lit(None).cast("date"))).otherwise(F.array().cast("array<date>")))
    return df.withColumn("window_start", F.explode(starts))


def smaller_target(current: Column, *targets: Column) -> Column:
    """The lowest target above the current rate, NULL when none is."""
    return F.least(*[F.when(t > current, t) for t in targets])
