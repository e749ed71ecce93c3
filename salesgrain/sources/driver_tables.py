"""The benchmark tables (orders, lineitem, part, ...) read as the domain relations.

Regions play branches, orders play bills, line items 1-5 play menu lines, 6 and 7 play option
picks, events play table sessions, and low-priority orders play the delivery platform. Every
attribute is computed from columns of the given tables, so all work grows with them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesgrain.params import Params, Rules
from salesgrain.sources.relations import Relations

AS_OF = dt.date(2001, 8, 2)
FIRST_DAY = dt.date(1995, 1, 1)
HISTORY_DAYS = (AS_OF - FIRST_DAY).days

RULES = Rules(
    water_max=933,
    paid_bev_max=966,
    free_codes=("P2", "P4", "P13"),
    free_name_part="anvil",
    set_mandatory_re=" set$",
    option_item_groups_re="^Brand#(1|2)",
    variant_words=("small", "hot", "large"),
    base_variant="small",
    info_variant="hot",
    top_variant="large",
    water_item_code="P30",
    set_name_prefixes=("r4", "b4"),
    brand_words=("kw1", "kw7"),
)
# Thresholds sized for the benchmark tables; every window spans the whole history.
PARAMS = Params(
    as_of=AS_OF,
    window_days=HISTORY_DAYS,
    pair_days=HISTORY_DAYS,
    pair_min_bills=5,
    opp_days=HISTORY_DAYS,
    own_best_days=HISTORY_DAYS,
    own_best_span=560,
    own_best_step=140,
    set_inc_days=HISTORY_DAYS,
    peer_min_meals=700,
    opp_min_meals=20,
    peerless=("R4",),
    dead_peer_min_days=20,
    dead_own_min_days=15,
    dead_skip=("R4",),
    impute_days=HISTORY_DAYS,
    feed_days=HISTORY_DAYS,
    feed_months=80,
    script_weeks_days=HISTORY_DAYS,
    script_min_bills=1,
    dish_min_picks=0,
    script_top_items=10,
    script_compare_min_bills=30,
    winback_min_visits=2,
    rules=RULES,
)

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
}

MIDNIGHT = "CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP_NTZ)"
NOUN = "substring_index(p_name, ' ', -1)"
# 'small ring' becomes 'R4 ring small': a menu code, the dish, its variant
ITEM_NAME = (
    f"concat(upper(substring({NOUN}, 1, 1)), length({NOUN}), ' ', {NOUN}, ' ', "
    "substring_index(p_name, ' ', 1))"
)
CATEGORY = """CASE p_type WHEN 'STANDARD' THEN 'main' WHEN 'SMALL' THEN 'side'
    WHEN 'MEDIUM' THEN 'beverage' WHEN 'LARGE' THEN 'topping' WHEN 'ECONOMY' THEN 'dessert'
    WHEN 'PROMO' THEN 'set' END"""
GIVEN_AWAY = "l_linenumber = 3 AND l_discount = 0.05"
# a split copy sits on a late line and carries neither tax nor discount
SPLIT_COPY = "l_tax = 0 AND l_discount = 0 AND l_linenumber IN (4, 5)"
ONE_PER_MEAL = "CASE WHEN category IN ('main', 'set') THEN 1 ELSE l_quantity END"


def money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,4))"


def share(percent: str) -> str:
    """A percentage of the bill, exact to four decimals."""
    return money(f"total_thb * CAST({percent} AS DECIMAL(3,2))")


def minutes(expr: str) -> str:
    return f"make_dt_interval(0, 0, CAST({expr} AS INT))"


BRANCH_ORDERS = [
    "o_orderkey AS order_id",
    "concat('R', n_regionkey) AS location_id",
    "n_regionkey AS branchid",
    "CAST(o_orderdate AS DATE) AS business_date",
    f"{MIDNIGHT} AS midnight",
    """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'dine_in'
            WHEN o_orderpriority = '5-LOW' THEN 'delivery' ELSE 'take_away' END AS channel""",
    f"{money('o_totalprice')} AS total_thb",
    "o_custkey",
    "(o_orderkey % 14 + 9) * 60 + (o_orderkey div 14) % 60 AS closed_minute",
    "CASE WHEN o_orderkey % 10 = 7 THEN 1 ELSE (o_orderkey * 37) % 257 END AS stay",
    "o_totalprice >= 1000 AS is_finalized",
    "o_orderstatus = 'P' AS is_voided",
]
ORDERS = [
    "order_id", "location_id", "business_date", "channel",
    f"CASE WHEN order_id % 17 <> 0 THEN {money('order_id % 2 + 1')} END AS pax",
    "total_thb",
    f"CASE WHEN order_id % 5 = 0 THEN {share('0.05')} ELSE {money('0')} END AS discount_thb",
    "CASE order_id % 10 WHEN 3 THEN NULL WHEN 4 THEN 0 ELSE o_custkey END AS customerid",
    f"CASE WHEN order_id % 23 <> 0 THEN midnight + {minutes('closed_minute - stay')} END AS opened_at",
    f"CASE WHEN order_id % 101 <> 0 THEN midnight + {minutes('closed_minute')} END AS closed_at",
    "is_finalized", "is_voided",
]
ITEMS = [
    "p_partkey AS itemid", "concat('P', p_partkey) AS item_code", f"{ITEM_NAME} AS name_th",
    f"{CATEGORY} AS tree_category", f"{money('p_retailprice')} AS retail_price_thb",
    "p_brand AS vendor_category",
]
ORDER_LINES = [
    "l_orderkey AS order_id", "l_orderkey * 8 + l_linenumber AS line_id", "l_partkey AS itemid",
    "concat('P', l_partkey) AS item_code", "name_th",
    "CASE WHEN p_size <> 50 THEN category END AS tree_category",
    f"{money(ONE_PER_MEAL)} AS qty",
    f"CASE WHEN {GIVEN_AWAY} THEN {money('0')} ELSE {money('l_extendedprice')} END AS gross_inc_vat_thb",
    "price AS unit_price_inc_vat_thb", "price AS base_price_thb",
    f"""CASE WHEN {GIVEN_AWAY} THEN {money('0')}
        ELSE {money(f"{money('l_extendedprice')} * CAST(l_discount AS DECIMAL(4,2))")} END AS discount_thb""",
    "l_tax < 0.08 AS is_active", "l_quantity = 50 AS is_special_line",
    "CASE WHEN l_tax <> 0.02 THEN l_returnflag = 'R' END AS is_take_home",
    f"{SPLIT_COPY} AS is_split_copy",
]
SOLD_OPTIONS = [
    "l_orderkey AS order_id", "l_orderkey * 8 + l_linenumber - 5 AS line_id",
    "concat('dish ', l_suppkey % 10) AS dish_th",
    """concat(p_brand, CASE WHEN category = 'topping' THEN ' topping' ELSE '' END,
        CASE WHEN l_linenumber = 7 THEN ' set' ELSE ' add' END) AS modifier_group""",
    "concat(name_th, CASE WHEN l_returnflag = 'A' THEN ' **' ELSE '' END) AS choice_th",
    f"{money('CAST(l_quantity AS INT) % 3 + 1')} AS choice_qty",
    f"""CASE WHEN l_discount > 0 THEN {money('price * CAST(0.01 AS DECIMAL(3,2))')}
        ELSE {money('0')} END AS paid_price_thb""",
    "l_discount > 0 AS is_paid_option",
]
DIGITS_3 = "lpad(CAST(order_id % 900 AS STRING), 3, '0')"
DIGITS_4 = "lpad(CAST(order_id % 9000 AS STRING), 4, '0')"
TABS = [
    "order_id", "branchid", "(order_id div 2) % 2 AS fbtableid",
    "CASE WHEN channel = 'dine_in' THEN order_id % 2 ELSE 0 END AS parentsaletabid",
    "CASE WHEN channel = 'dine_in' THEN concat('Split#', order_id % 2 + 1) END AS splittabname",
    f"""midnight + CASE channel
        WHEN 'dine_in' THEN make_dt_interval(0, 0, 0, (order_id * 7919) % 86400)
        WHEN 'delivery' THEN {minutes('(order_id % 14 + 9) * 60 + order_id % 50 + order_id % 31')}
        ELSE {minutes('(order_id % 14 + 9) * 60')} END AS starttime""",
    f"""CASE WHEN channel <> 'delivery' THEN NULL
        WHEN order_id % 4 = 0 THEN concat('GF-', {DIGITS_3})
        WHEN order_id % 4 = 1 THEN concat(' gf ', CASE WHEN (order_id div 4) % 2 = 0 THEN {DIGITS_4}
            ELSE right({DIGITS_4}, 3) END) END AS refdeliveryorder""",
    f"""CASE WHEN channel = 'delivery' AND order_id % 4 = 2 THEN {DIGITS_3}
        WHEN channel <> 'dine_in' THEN 'TakeAway1' END AS takehomename""",
]
SESSIONS = [
    "event_id AS order_id", f"{money('user_id % 4 + 1')} AS pax", f"{money('value')} AS dwell_minutes",
    "seated_at", "seated_at + make_dt_interval(0, 0, 0, round(value * 60, 0)) AS left_at",
    "CASE event_type WHEN 'error' THEN true WHEN 'signup' THEN false END AS is_cancelled",
]
PLATFORM_ROWS = [
    "order_id", "concat('T', order_id) AS row_id", "concat('B', order_id) AS booking_id", "location_id",
    "business_date",
    f"midnight + {minutes('(order_id % 14 + 9) * 60 + order_id % 50')} AS created_at",
    f"CASE WHEN order_id % 4 = 1 THEN {DIGITS_4} ELSE {DIGITS_3} END AS gf_no",
    """CASE (order_id div 16) % 12 WHEN 0 THEN 'ads' WHEN 1 THEN 'adjustment' WHEN 2 THEN 'other'
        ELSE 'payment' END AS category""",
    f"""CASE WHEN (order_id div 16) % 12 = 2 THEN '{RULES.cancelled_status}'
        WHEN (order_id div 32) % 9 = 0 THEN '{RULES.unpaid_status}' ELSE 'paid' END AS status""",
    "'delivery' AS order_type", "total_thb AS gross_thb", f"{share('0.10')} AS merchant_discount_thb",
    f"{money('total_thb - ' + share('0.10'))} AS net_thb", f"{money('-' + share('0.20'))} AS commission_thb",
    f"{money('-' + share('0.02'))} AS marketing_fee_thb",
    f"""{money('CASE WHEN (order_id div 16) % 12 < 2 THEN -' + share('0.01')
        + ' ELSE total_thb - ' + share('0.32') + ' END')} AS payout_thb""",
    "CASE WHEN (order_id div 16) % 12 = 2 THEN concat('reason ', order_id % 3) END AS cancel_reason",
    """CASE WHEN (order_id div 16) % 12 <> 2 THEN NULL WHEN order_id % 2 = 0 THEN 'customer'
        ELSE 'shop' END AS cancelled_by""",
]
YEARLY_HOLIDAYS = "WHEN '01-01' THEN 'new year' WHEN '05-01' THEN 'labour day' WHEN '12-05' THEN 'fathers day'"
EVENT_SUMS = [
    f"sum({money('value')}) AS spend_thb",
    "CAST(count(*) AS INT) AS impressions",
    "CAST(count_if(event_type = 'click') AS INT) AS clicks",
    "CAST(count_if(event_type = 'view') AS INT) AS menu_visits",
    "CAST(count_if(event_type = 'signup') AS INT) AS add_to_cart",
    "CAST(count_if(event_type = 'purchase') AS INT) AS orders",
    f"coalesce(sum(CASE WHEN event_type = 'purchase' THEN {money('value')} * 10 END), 0) AS revenue_thb",
]
REVIEWS = [
    "md5(CAST(event_id AS STRING)) AS review_key", "concat('R', user_id % 5) AS location_id",
    "CAST(ts AS DATE) AS review_date", "CAST(event_id % 5 + 1 AS INT) AS rating", "props AS review",
    "user_id % 3 = 0 AS replied", "'delivery' AS service_type",
]


def _sums(df: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    named = [F.expr(k) for k in keys]
    return df.groupBy(*named).agg(*[F.expr(x) for x in sums])


def driver_relations(spark: SparkSession, sf_dir: str) -> Relations:
    def table(name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    def branch_orders() -> DataFrame:
        """Orders with their region and their clock times."""
        customer = table("customer").selectExpr("c_custkey AS o_custkey", "c_nationkey AS n_nationkey")
        return (
            table("orders").join(customer, "o_custkey").join(table("nation"), "n_nationkey")
            .selectExpr(*BRANCH_ORDERS)
        )

    def named_parts() -> DataFrame:
        return table("part").selectExpr(
            "p_partkey AS l_partkey", "p_brand", "p_size", f"{ITEM_NAME} AS name_th",
            f"{CATEGORY} AS category", f"{money('p_retailprice')} AS price",
        )

    def lines_of(slots: str) -> DataFrame:
        return table("lineitem").where(slots).join(named_parts(), "l_partkey")

    def orders() -> DataFrame:
        return branch_orders().selectExpr(*ORDERS)

    def locations() -> DataFrame:
        return table("region").selectExpr(
            "concat('R', r_regionkey) AS location_id", "r_regionkey AS branchid",
            "'branch' AS location_type", "true AS is_confirmed_live", "true AS is_active",
            "r_regionkey = 4 AS is_suspected_test", "r_regionkey % 3 + 9 AS open_hour",
            "r_regionkey + 17 AS close_hour",
        )

    def seats() -> DataFrame:
        return table("region").selectExpr(
            "concat('R', r_regionkey) AS location_id",
            "CASE WHEN r_regionkey <> 3 THEN r_regionkey * 2 + 1 END AS seats",
            "CASE WHEN r_regionkey <> 2 THEN r_regionkey % 3 + 9 END AS open_hour",
            "CASE WHEN r_regionkey <> 1 THEN r_regionkey + 16 END AS close_hour",
        )

    def items() -> DataFrame:
        return table("part").selectExpr(*ITEMS)

    def order_lines() -> DataFrame:
        return lines_of("l_linenumber <= 5").selectExpr(*ORDER_LINES)

    def sold_options() -> DataFrame:
        return lines_of("l_linenumber >= 6").selectExpr(*SOLD_OPTIONS)

    def map_option_item() -> DataFrame:
        named = table("part").where("NOT p_name LIKE '% gear'")
        return _sums(named, ["p_name"], ["min(p_partkey) AS first_part"]).selectExpr(
            f"{ITEM_NAME} AS choice_key", "concat('P', first_part) AS item_code",
            f"CASE WHEN p_name LIKE 'new %' THEN {money('2')} ELSE {money('1')} END AS qty_mult",
        )

    def split_dupe_lines() -> DataFrame:
        copies = table("lineitem").where(SPLIT_COPY)
        return copies.selectExpr("l_orderkey * 8 + l_linenumber AS line_id")

    def table_sessions() -> DataFrame:
        days = table("orders").selectExpr("o_orderkey AS event_id", f"{MIDNIGHT} AS midnight")
        time_of_day = "ts - CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ)"
        seated = table("events").join(days, "event_id").withColumn("seated_at", F.expr(f"midnight + ({time_of_day})"))
        return seated.selectExpr(*SESSIONS)

    def pos_sale_tabs() -> DataFrame:
        return branch_orders().selectExpr(*TABS)

    def holidays() -> DataFrame:
        """The days with orders that fall on a yearly holiday."""
        days = table("orders").selectExpr("CAST(o_orderdate AS DATE) AS d").distinct()
        return days.selectExpr("d", f"CASE date_format(d, 'MM-dd') {YEARLY_HOLIDAYS} END AS name_th").where("name_th IS NOT NULL")

    def weather_daily() -> DataFrame:
        day = f"date_add(DATE '{FIRST_DAY}', CAST(id AS INT))"
        return spark.range(HISTORY_DAYS + 1).where(f"day({day}) <> 13").selectExpr(
            f"{day} AS d",
            f"{money('greatest(id % 11 - 5, 0) * CAST(0.5 AS DECIMAL(2,1))')} AS rain_mm",
            f"{money('id % 8 + 28')} AS tmax_c",
        )

    # ---- the delivery platform's side of low-priority orders ----
    def platform_rows() -> DataFrame:
        return branch_orders().where("channel = 'delivery'").selectExpr(*PLATFORM_ROWS)

    def paid_rows() -> DataFrame:
        return platform_rows().where("category = 'payment'")

    def grab_orders() -> DataFrame:
        return platform_rows().drop("order_id")

    branch_day = ["location_id", "business_date"]
    order_count = "CAST(count(*) AS INT) AS orders"

    def grab_daily() -> DataFrame:
        sums = _sums(paid_rows(), branch_day, [
            f"{money('sum(gross_thb)')} AS gross_thb", f"{money('sum(net_thb)')} AS net_thb", order_count,
        ])
        return sums.selectExpr(
            "*", f"{money('CAST(gross_thb AS DOUBLE) / orders')} AS avg_order_thb",
            f"CASE WHEN day(business_date) % 7 <> 0 THEN {money('day(business_date) % 3 + 3')} END AS rating",
        )

    def grab_menu_daily() -> DataFrame:
        lines = lines_of("l_linenumber <= 5").selectExpr(
            "l_orderkey AS order_id", "name_th AS item", f"{money('l_quantity')} AS units",
            f"{money('l_extendedprice')} AS thb",
        )
        placed = paid_rows().select("order_id", *branch_day).join(lines, "order_id")
        return _sums(placed, [*branch_day, "item"], ["sum(units) AS units", "sum(thb) AS thb"])

    def grab_offers() -> DataFrame:
        return _sums(
            paid_rows().where("gross_thb >= 250000"),
            [*branch_day, "concat('offer ', order_id % 5) AS campaign"],
            ["sum(gross_thb) AS gross_thb", "sum(net_thb) AS net_thb", order_count,
             "sum(merchant_discount_thb) AS spend_thb"],
        )

    def grab_peak() -> DataFrame:
        return _sums(paid_rows(), [*branch_day, "hour(created_at) AS hour"], [order_count])

    def grab_ads_hourly() -> DataFrame:
        return _sums(
            table("events"),
            ["CAST(ts AS DATE) AS d", "hour(ts) AS hour", "concat('ads ', user_id % 4) AS campaign"],
            EVENT_SUMS,
        )

    def grab_keywords() -> DataFrame:
        brand = " OR ".join(f"contains(keyword, '{w}')" for w in RULES.brand_words)
        words = _sums(
            table("events"),
            ["date_format(ts, 'yyyy-MM') AS ym", "concat('kw', user_id % 20) AS keyword"],
            EVENT_SUMS,
        )
        return words.withColumn("is_brand", F.expr(brand)).drop("menu_visits", "add_to_cart")

    def grab_miwi_daily() -> DataFrame:
        return _sums(paid_rows(), branch_day, [
            "CAST(count_if(order_id % 37 = 0) AS INT) AS wrong",
            "CAST(count_if(order_id % 29 = 0) AS INT) AS missing",
            "CAST(count_if(order_id % 37 = 0) + count_if(order_id % 29 = 0) AS INT) AS total_reported",
            "CAST(count(*) AS INT) AS completed_orders",
        ])

    def grab_reviews() -> DataFrame:
        return table("events").where("event_type = 'view'").selectExpr(*REVIEWS)

    def grab_combos() -> DataFrame:
        return _sums(
            paid_rows(),
            ["location_id", "last_day(business_date) AS as_of", "concat('combo ', order_id % 6) AS combo"],
            ["CAST(count(*) AS INT) AS n"],
        )

    builders: dict[str, Callable[[], DataFrame]] = {
        f.__name__: f
        for f in (
            orders, locations, order_lines, items, sold_options, map_option_item, split_dupe_lines,
            table_sessions, pos_sale_tabs, seats, holidays, weather_daily, grab_orders, grab_daily,
            grab_menu_daily, grab_offers, grab_peak, grab_ads_hourly, grab_keywords,
            grab_miwi_daily, grab_reviews, grab_combos,
        )
    }
    return Relations(spark, builders)
