"""The upstream relations, their declared schemas and the reader for Parquet copies of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesgrain.functions.times import wall_clock

SCHEMAS: dict[str, str] = {
    "orders": """order_id string, location_id string, business_date date, channel string,
        pax decimal(18,4), total_thb decimal(18,4), discount_thb decimal(18,4), customerid bigint,
        opened_at timestamp, closed_at timestamp, is_finalized boolean, is_voided boolean""",
    "locations": """location_id string, branchid int, location_type string,
        is_confirmed_live boolean, is_active boolean, is_suspected_test boolean,
        open_hour int, close_hour int""",
    "order_lines": """order_id string, line_id bigint, itemid bigint, name_th string,
        tree_category string, qty decimal(18,4), gross_inc_vat_thb decimal(18,4),
        unit_price_inc_vat_thb decimal(18,4), base_price_thb decimal(18,4),
        discount_thb decimal(18,4), is_active boolean, is_special_line boolean,
        is_take_home boolean""",
    "items": """itemid bigint, item_code string, name_th string, tree_category string,
        retail_price_thb decimal(18,4), vendor_category string""",
    "sold_options": """order_id string, line_id bigint, dish_th string, modifier_group string,
        choice_th string, choice_qty decimal(18,4), paid_price_thb decimal(18,4),
        is_paid_option boolean""",
    "map_option_item": "choice_key string, item_code string, qty_mult decimal(18,4)",
    "split_dupe_lines": "line_id bigint",
    "table_sessions": """order_id string, pax decimal(18,4), dwell_minutes decimal(18,4),
        seated_at timestamp, left_at timestamp, is_cancelled boolean""",
    "pos_sale_tabs": """branchid int, saletabid bigint, saleid bigint, fbtableid bigint,
        parentsaletabid bigint, splittabname string, starttime timestamp_ntz,
        refdeliveryorder string, takehomename string""",
    "seats": """location_id string, seats int, open_hour int, close_hour int, tables int,
        bar_seats int, stool_seats int, note string""",
    "holidays": "d date, name_th string",
    "weather_daily": "d date, rain_mm decimal(18,4), tmax_c decimal(18,4)",
    "grab_orders": """row_id string, booking_id string, location_id string, business_date date,
        created_at timestamp_ntz, gf_no string, category string, status string,
        order_type string, gross_thb decimal(18,4), merchant_discount_thb decimal(18,4),
        net_thb decimal(18,4), commission_thb decimal(18,4), marketing_fee_thb decimal(18,4),
        payout_thb decimal(18,4), cancel_reason string, cancelled_by string""",
    "grab_daily": """location_id string, business_date date, gross_thb decimal(18,4),
        net_thb decimal(18,4), orders int, avg_order_thb decimal(18,4), rating decimal(18,4)""",
    "grab_menu_daily": """location_id string, business_date date, item string,
        units decimal(18,4), thb decimal(18,4)""",
    "grab_offers": """location_id string, business_date date, campaign string,
        gross_thb decimal(18,4), net_thb decimal(18,4), orders int, spend_thb decimal(18,4)""",
    "grab_peak": "location_id string, business_date date, hour int, orders int",
    "grab_ads_hourly": """d date, hour int, campaign string, spend_thb decimal(18,4),
        impressions int, clicks int, menu_visits int, add_to_cart int, orders int,
        revenue_thb decimal(18,4)""",
    "grab_keywords": """ym string, keyword string, is_brand boolean, impressions int, clicks int,
        spend_thb decimal(18,4), orders int, revenue_thb decimal(18,4)""",
    "grab_miwi_daily": """location_id string, business_date date, wrong int, missing int,
        total_reported int, completed_orders int""",
    "grab_reviews": """review_key string, location_id string, review_date date, rating int,
        review string, replied boolean, service_type string""",
    "grab_combos": "location_id string, as_of date, combo string, n int",
}
# what Parquet copies of these carry beside, as their partition column: the day of their order
DATED = {name: "business_date date" for name in ("order_lines", "sold_options", "table_sessions")}
PLATFORM_TABLES = tuple(name for name in SCHEMAS if name.startswith("grab_"))


class Relations:
    """Named DataFrames, each built at most once and only when somebody asks for it."""

    def __init__(self, spark: SparkSession, builders: dict[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = normalize(name, self._builders[name]())
        return self._built[name]

    def __contains__(self, name: str) -> bool:
        return name in self._builders


def normalize(name: str, df: DataFrame) -> DataFrame:
    """Wall-clock times everywhere, and tabs that carry the order id they belong to."""
    if name == "orders":
        return wall_clock(df, "opened_at", "closed_at")
    if name == "table_sessions":
        return wall_clock(df, "seated_at", "left_at")
    if name == "pos_sale_tabs" and "order_id" not in df.columns:
        return df.withColumn("order_id", F.concat_ws("-", "branchid", "saleid"))
    return df


def stored_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns of a folder's files and partition folders; none where it has no files."""
    try:
        return spark.read.parquet(path).columns
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return []


def parquet_relations(spark: SparkSession, root: str) -> Relations:
    """One folder per relation under `root`, read with its declared schema.

    Orders, order_lines, sold_options and table_sessions are to be partitioned by business_date, the day
    of their order: windows reach the scan as partition filters. Copies without that day are read whole.
    """

    def reader(name: str) -> Callable[[], DataFrame]:
        def read() -> DataFrame:
            path = f"{root}/{name}"
            dated = name in DATED and "business_date" in stored_columns(spark, path)
            return spark.read.schema(", ".join([SCHEMAS[name], *([DATED[name]] if dated else [])])).parquet(path)

        return read

    return Relations(spark, {name: reader(name) for name in SCHEMAS})


def frame_relations(spark: SparkSession, frames: dict[str, DataFrame]) -> Relations:
    """Relations from DataFrames at hand; relations left out are empty."""

    def builder(name: str) -> Callable[[], DataFrame]:
        if name in frames:
            return lambda: frames[name]
        return lambda: spark.createDataFrame([], SCHEMAS[name])

    return Relations(spark, {name: builder(name) for name in SCHEMAS})
