"""Invariants between tables: how many rows break each of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesgrain.functions import text
from salesgrain.plans.insights import ticket_mix


def _broken(name: str, rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")


def net_by_day(t) -> DataFrame:
    """C1. Days on which tree, hourly and orders disagree on net."""
    day = ["location_id", "business_date"]

    def net(rows: DataFrame, column: str, name: str) -> DataFrame:
        return rows.groupBy(*day).agg(F.sum(column).alias(name))

    joined = (
        net(t["tree_daily"], "net_thb", "tree")
        .join(net(t["hourly"], "net_thb", "hours"), day, "full_outer")
        .join(net(t.base.orders, "total_thb", "orders"), day, "full_outer")
    )
    same = F.col("tree").eqNullSafe(F.col("hours")) & F.col("tree").eqNullSafe(F.col("orders"))
    return _broken("net_by_day", joined.where(~same))


def party_net(t) -> DataFrame:
    """C2. Parties and bills must hold the same money."""
    parties = t["party_size"].groupBy("ym").agg(F.sum("net_thb").alias("parties"))
    # a child keeps its master's month: they share a day
    bills = t.base.orders.groupBy("ym").agg(F.sum("total_thb").alias("bills"))
    joined = parties.join(bills, "ym", "full_outer")
    return _broken("party_net", joined.where(~F.col("parties").eqNullSafe(F.col("bills"))))


def no_free_items(t) -> DataFrame:
    """C4. Menu rows of the item table that are give-aways."""
    codes = t.rel["items"].select(F.col("itemid").alias("item_id"), "item_code")
    rows = t["item_daily"].where(F.col("source") == "menu").join(codes, "item_id", "left")
    free = text.is_free_item(F.col("item_code"), F.col("item_name"), t.params.rules)
    return _broken("no_free_items", rows.where(free))


def shares_sum(t) -> DataFrame:
    """C5. Branches whose ticket shares do not add up to 100."""
    sums = ticket_mix(t).groupBy("location_id").agg(F.sum("share_pct").alias("total"))
    return _broken("shares_sum", sums.where(F.abs(F.col("total") - 100) > 0.001))


def forced_picks_unpaid(t) -> DataFrame:
    """C6. Set-mandatory groups with a paid pick."""
    forced = F.col("modifier_group").rlike(t.params.rules.set_mandatory_re)
    return _broken("forced_picks_unpaid", t["option_monthly"].where(forced & (F.col("paid_picks") > 0)))


CHECKS = (net_by_day, party_net, no_free_items, shares_sum, forced_picks_unpaid)


def quality_checks(t) -> DataFrame:
    """One row per invariant with the number of violations; all zero on sound data."""
    return reduce(DataFrame.unionByName, [check(t) for check in CHECKS])
