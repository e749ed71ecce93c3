"""Every query by name over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesgrain.functions.numbers import plain_numbers
from salesgrain.plans.base import FACT_COLUMNS
from salesgrain.plans.catalog import BUILDERS, HELPERS, Tables
from salesgrain.plans.checks import quality_checks
from salesgrain.plans.feeds import FEEDS, today_partial
from salesgrain.plans.insights import INSIGHTS
from salesgrain.plans.models import MODELS
from salesgrain.sources.driver_tables import PARAMS, driver_relations

Query = Callable[[SparkSession, str], DataFrame]


def base_orders(t: Tables) -> DataFrame:
    return t.base.orders.drop("opened_at", "closed_at")


def base_lines(t: Tables) -> DataFrame:
    kept = t.base.orders.select("order_id")
    return t.base.lines.drop("base_price_thb").join(kept, "order_id", "left_semi")


def base_options(t: Tables) -> DataFrame:
    return t.base.options.join(t.base.orders.select("order_id"), "order_id", "left_semi")


def base_units(t: Tables) -> DataFrame:
    return t.base.units.drop("hr")


def base_order_facts(t: Tables) -> DataFrame:
    return t.base.order_facts.select(
        "order_id", "location_id", "business_date", "channel", "daypart", *FACT_COLUMNS
    )


def base_promo(t: Tables) -> DataFrame:
    return t.base.order_meals.groupBy("promo").agg(F.count("*").alias("orders"))


def base_party(t: Tables) -> DataFrame:
    return t.base.party


def lever_value(t: Tables) -> DataFrame:
    return t.build("lever_value").withColumn("value", F.round("value", 6))


BASE = (base_orders, base_lines, base_options, base_units, base_order_facts, base_promo, base_party)


def driver_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(driver_relations(spark, sf_dir), PARAMS)


def _query(build: Callable[[Tables], DataFrame]) -> Query:
    """One lazy plan from the raw tables: making it starts no job and keeps nothing."""
    return lambda spark, sf_dir: plain_numbers(build(driver_tables(spark, sf_dir)))


def _table(name: str) -> Query:
    return _query(lambda t: t.build(name))


def all_queries() -> dict[str, Query]:
    out = {f.__name__: _query(f) for f in BASE}
    out |= {name: _table(name) for name in (*BUILDERS, *HELPERS)}
    out["lever_value"] = _query(lever_value)
    out["unmapped_choices"] = _query(lambda t: t.base.unmapped_choices())
    out |= {f"feed_{name.replace('.', '_')}": _query(f) for name, f in FEEDS.items()}
    out["quality_checks"] = _query(quality_checks)
    out["feed_today_partial"] = _query(today_partial)
    out |= {f"insight_{name}": _query(f) for name, f in INSIGHTS.items()}
    out |= {f"model_{name}": _query(f) for name, f in MODELS.items()}  # solved, so without SQL counterpart
    return out
