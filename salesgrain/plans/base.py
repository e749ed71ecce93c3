"""The shared base: kept orders, kept lines and options, units, per-order facts, parties."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesgrain.functions import text, times
from salesgrain.functions.numbers import MONEY, zero_if_null
from salesgrain.operators.asof import latest_at_or_before
from salesgrain.params import Params
from salesgrain.plans.staging import Stage
from salesgrain.sources.relations import Relations

UNIT_GROUPS = ("main", "bev", "bev_water", "bev_paid", "bev_premium", "side", "topping", "dessert", "set")
THB_GROUPS = tuple(g for g in UNIT_GROUPS if g != "bev_water")
SET_LAYER_GROUPS = ("side", "bev_paid", "bev_premium", "dessert", "topping")
FACT_COLUMNS = (
    [f"{g}_units" for g in UNIT_GROUPS]
    + [f"{g}_thb" for g in THB_GROUPS]
    + [f"{g}_set_units" for g in SET_LAYER_GROUPS]
    + [f"{g}_set_thb" for g in SET_LAYER_GROUPS]
)


def on_line(value: Column) -> Column:
    """The largest value over all rows of a line."""
    return F.max(value).over(Window.partitionBy("order_id", "line_id"))


def group_condition(group: str) -> str:
    """Does a unit row belong to a unit group: a category, all drinks, or one drink tier."""
    if group == "bev":
        return "tree_category = 'beverage'"
    if group.startswith("bev_"):
        return f"bev_tier = '{group.removeprefix('bev_')}'"
    return f"tree_category = '{group}'"


def unit_column(column: str) -> str:
    """The SQL value a fact column sums, e.g. side_set_thb: money of sides picked inside sets."""
    group, measure = column.rsplit("_", 1)
    condition = group_condition(group.removesuffix("_set"))
    if group.endswith("_set"):
        condition = f"source = 'set' AND {condition}"
    return f"CASE WHEN {condition} THEN {'qty' if measure == 'units' else 'thb'} END"


class Base:
    def __init__(self, rel: Relations, params: Params, stage: Stage):
        self.rel = rel
        self.params = params
        self.rules = params.rules
        self.stage = stage

    @property
    def spark(self) -> SparkSession:
        return self.rel.spark

    def since(self, column: str, days: int) -> Column:
        return F.col(column) >= F.lit(self.params.days_ago(days))

    def full_days(self, column: str, days: int) -> Column:
        """The last `days` full days: today is left out."""
        return F.col(column).between(
            F.lit(self.params.days_ago(days)), F.lit(self.params.data_through)
        )

    # ---- B1 ------------------------------------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        """Finalized, non-voided orders of live branches in the window."""
        live = self.rel["locations"].where(
            F.col("is_confirmed_live") & (F.col("location_type") == "branch")
        )
        hour = F.hour("closed_at")
        kept = (
            self.rel["orders"]
            .where(
                F.col("is_finalized")
                & ~F.col("is_voided")
                & self.since("business_date", self.params.window_days)
            )
            .join(live.select("location_id"), "location_id", "left_semi")
            .select(
                "order_id", "location_id", "business_date", "channel", "pax", "total_thb",
                "discount_thb", "customerid", "opened_at", "closed_at",
                hour.alias("hr"),
                times.daypart(hour).alias("daypart"),
                times.month_key(F.col("business_date")).alias("ym"),
            )
        )
        return self.stage.keep("orders", kept)

    def windowed(self, name: str, extra_days: int = 0) -> DataFrame:
        """A relation cut to the window by its partition column, where it carries one."""
        df = self.rel[name]
        if "business_date" not in df.columns:
            return df
        return df.where(self.since("business_date", self.params.window_days + extra_days))

    # ---- B2 ------------------------------------------------------------------------------
    @cached_property
    def counted_lines(self) -> DataFrame:
        """Active, non-special lines of any order."""
        return self.windowed("order_lines").where(F.col("is_active") & ~F.col("is_special_line"))

    def _described(self, lines: DataFrame) -> DataFrame:
        """Lines with item code, drink tier and give-away flag."""
        if "item_code" not in lines.columns:
            lines = lines.join(self.rel["items"].select("itemid", "item_code"), "itemid", "left")
        tier = F.when(
            F.col("tree_category") == "beverage", text.drink_tier(F.col("unit_price_inc_vat_thb"), self.rules)
        )
        free = text.is_free_item(F.col("item_code"), F.col("name_th"), self.rules)
        return lines.withColumns({"bev_tier": tier, "is_free": free})

    @property
    def described_lines(self) -> DataFrame:
        """Counted lines, split copies among them, with drink tier and give-away flag."""
        return self._described(self.counted_lines)

    @cached_property
    def flagged_lines(self) -> DataFrame:
        """Counted lines, described, with is_split_copy: listed as made when a bill was split.

        A relation that flags its copies itself spares the join with their list.
        """
        lines = self._described(self.counted_lines)
        if "is_split_copy" in lines.columns:
            return lines
        copies = self.rel["split_dupe_lines"].select("line_id").distinct().withColumn("is_split_copy", F.lit(True))
        return lines.join(copies, "line_id", "left")

    @cached_property
    def lines(self) -> DataFrame:
        """Counted lines without split-bill copies, with drink tier and give-away flag.

        A line is a copy when any row of its id is. Rows lie by order afterwards.
        """
        is_copy = on_line(F.coalesce("is_split_copy", F.lit(False)))
        dealt = self.flagged_lines.repartition("order_id").withColumn("is_copy", is_copy)
        kept = dealt.where(~F.col("is_copy")).select(
            "order_id", "line_id", "itemid", "item_code", "name_th", "tree_category", "qty",
            "gross_inc_vat_thb", "unit_price_inc_vat_thb", "base_price_thb", "discount_thb", "bev_tier", "is_free",
        )
        return self.stage.keep("lines", kept)

    # ---- B3 ------------------------------------------------------------------------------
    @cached_property
    def sold_options(self) -> DataFrame:
        """Options of any line; a pick forced by a set is no paid upsell."""
        forced = F.col("modifier_group").rlike(self.rules.set_mandatory_re)
        return self.windowed("sold_options").select(
            "order_id", "line_id", "dish_th", "modifier_group", "choice_th", "choice_qty",
            "paid_price_thb", "is_paid_option",
            (F.col("is_paid_option") & ~forced).alias("is_paid_upsell"),
        )

    def hanging(self, options: DataFrame) -> DataFrame:
        """Those options whose line is a kept one.

        Lines and options are dealt by order once, which also serves the join with orders, and meet
        there in a window per line; no join of facts with facts is needed.
        """
        lines = self.flagged_lines.select(
            "order_id", "line_id", F.lit(True).alias("is_line"), F.coalesce("is_split_copy", F.lit(False)).alias("is_copy")
        )
        marked = options.withColumn("is_line", F.lit(False)).withColumn("is_copy", F.lit(False))
        both = marked.unionByName(lines, allowMissingColumns=True).repartition("order_id")
        hangs = on_line(F.col("is_line")) & ~on_line(F.col("is_copy"))
        return both.withColumn("hangs", hangs).where(F.col("hangs") & ~F.col("is_line")).select(*options.columns)

    @cached_property
    def options(self) -> DataFrame:
        """Options that hang on a kept line."""
        return self.stage.keep("options", self.hanging(self.sold_options))

    @cached_property
    def item_choices(self) -> DataFrame:
        """Option choice key -> the menu item it stands for. One item per code, so no fan-out."""
        one_per_code = (
            self.rel["items"]
            .groupBy("item_code")
            .agg(F.min_by(F.struct("itemid", "name_th", "tree_category", "retail_price_thb"), "itemid").alias("i"))
            .select("item_code", "i.*")
        )
        return self.rel["map_option_item"].join(one_per_code, "item_code")

    def item_options(self, options: DataFrame) -> DataFrame:
        """Options of the groups whose choices are menu items, with the map key."""
        return options.where(
            F.col("modifier_group").rlike(self.rules.option_item_groups_re)
        ).withColumn("choice_key", text.choice_key(F.col("choice_th")))

    # ---- B4 ------------------------------------------------------------------------------
    @cached_property
    def sold_rows(self) -> DataFrame:
        """Menu lines and the item options that hang on a kept one, dealt by order, in one pass.

        Give-away lines and split copies stay, with NULL units: the promotion tag reads the first,
        the take-home flag both.
        """
        gifted = (
            (F.col("base_price_thb") >= F.lit(self.rules.buy2get1_min_price))
            & (F.col("gross_inc_vat_thb") <= F.lit(self.rules.near_zero).cast(MONEY))
            & (zero_if_null(F.col("discount_thb")) <= F.lit(self.rules.near_zero).cast(MONEY))
        )
        dish = F.col("tree_category").isin("main", "set")
        menu = self.flagged_lines.select(
            "order_id", "line_id", "itemid", "item_code", F.col("name_th").alias("item_name"),
            "tree_category", "bev_tier", F.lit("menu").alias("source"), "qty",
            F.col("gross_inc_vat_thb").alias("thb"),
            "is_free", gifted.alias("is_gift"),
            F.when(dish, F.coalesce("is_take_home", F.lit(False))).alias("is_taken"),
            F.coalesce("is_split_copy", F.lit(False)).alias("is_copy"),
        )
        forced = F.col("modifier_group").rlike(self.rules.set_mandatory_re)
        picks = self.item_options(self.sold_options).join(self.item_choices, "choice_key").select(
            "order_id", "line_id", "itemid", "item_code", F.col("name_th").alias("item_name"),
            "tree_category",
            F.when(
                F.col("tree_category") == "beverage",
                text.drink_tier(F.col("retail_price_thb"), self.rules),
            ).alias("bev_tier"),
            F.when(forced, "set").otherwise("option").alias("source"),
            (F.col("choice_qty") * F.col("qty_mult")).cast(MONEY).alias("qty"),
            (zero_if_null(F.col("paid_price_thb")) * F.col("choice_qty")).cast(MONEY).alias("thb"),
            F.lit(False).alias("is_free"), F.lit(False).alias("is_gift"),
            F.lit(None).cast("boolean").alias("is_taken"), F.lit(False).alias("is_copy"),
        )
        is_menu = F.col("source") == "menu"
        met = menu.unionByName(picks).repartition("order_id").withColumns(
            {"on_menu": on_line(is_menu), "on_copy": on_line(F.col("is_copy"))}
        )
        rows = met.where(is_menu | (F.col("on_menu") & ~F.col("on_copy")))
        is_unit = ~F.col("on_copy") & ~F.col("is_free")
        sold = rows.select(
            "order_id", "line_id", "itemid", "item_code", "item_name", "tree_category", "bev_tier", "source",
            F.when(is_unit, F.col("qty")).alias("qty"), F.when(is_unit, F.col("thb")).alias("thb"),
            is_unit.alias("is_unit"), (F.col("is_gift") & ~F.col("on_copy")).alias("is_gift"), "is_taken",
        )
        return self.stage.keep("sold_rows", sold)

    @cached_property
    def units(self) -> DataFrame:
        """Every unit sold: one row per menu line, item option or set pick of a kept order."""
        place = self.orders.select(
            "order_id", "location_id", "business_date", "hr", "daypart", "channel"
        )
        placed = (
            self.sold_rows.where("is_unit")
            .drop("line_id", "is_unit", "is_gift", "is_taken")
            .join(place, "order_id")
        )
        return self.stage.keep("units", placed)

    # ---- B5, B6 --------------------------------------------------------------------------
    def _per_order(self, sums: list[str]) -> DataFrame:
        """Kept orders with sums over their sold rows; an order without rows gets zeros.

        Lines are summed to the order before they meet order scalars, so no scalar is ever
        multiplied by a line count. They already lie and are sorted by order, so windows sum them as
        they pass: nothing is shuffled or sorted again, and a task holds the rows of one order and
        no table of all its orders.
        taken_home: every main and set on the bill was.
        """
        exact = "CAST(sum({value}) OVER (PARTITION BY order_id) AS DECIMAL(18,4)) AS {name}"
        whole = Window.partitionBy("order_id")
        numbered = self.sold_rows.withColumn("_nth", F.row_number().over(whole.orderBy("line_id")))
        per_order = numbered.select(
            "order_id", "_nth",
            *[F.expr(exact.format(value=unit_column(c), name=c)) for c in sums],
            F.bool_or("is_gift").over(whole).alias("_gift"),
            F.bool_and("is_taken").over(whole).alias("_taken"),
        ).where("_nth = 1").drop("_nth")
        zeros = {c: 0 for c in sums}
        promo = F.when(F.col("_gift"), self.rules.buy2get1_promo).otherwise(self.rules.no_promo)
        return (
            self.orders.join(per_order, "order_id", "left")
            .fillna(zeros)
            .withColumn("promo", promo)
            .withColumn("taken_home", F.coalesce("_taken", F.lit(False)))
            .drop("_gift", "_taken")
        )

    def facts(self, columns: list[str]) -> DataFrame:
        """Kept orders with some of the fact columns; what nobody reads is not summed."""
        return self._per_order(columns)

    @cached_property
    def order_facts(self) -> DataFrame:
        """One row per order with every unit group, the set layer and the promotion tag."""
        return self.facts(FACT_COLUMNS)

    @cached_property
    def order_meals(self) -> DataFrame:
        """One row per order with its main and set units; meals are the two together."""
        facts = self._per_order(["main_units", "set_units"])
        meals = (F.col("main_units") + F.col("set_units")).cast(MONEY)
        return self.stage.keep("order_meals", facts.withColumn("meals", meals))

    @cached_property
    def order_taken_home(self) -> DataFrame:
        """Kept orders with taken_home alone: the lines of dishes tell, options are not read."""
        dishes = self.counted_lines.where(F.col("tree_category").isin("main", "set"))
        per_order = dishes.groupBy("order_id").agg(F.bool_and(F.coalesce("is_take_home", F.lit(False))).alias("_taken"))
        joined = self.orders.join(per_order, "order_id", "left")
        return joined.withColumn("taken_home", F.coalesce("_taken", F.lit(False))).drop("_taken")

    # ---- B7 ------------------------------------------------------------------------------
    @property
    def split_tabs(self) -> DataFrame:
        """Tabs split off another bill: order_id -> master_id.

        The master is the latest master tab on the same branch, table and day opened at or
        before the child; the child's own parent pointer is not used.
        """
        since = self.params.days_ago(self.params.window_days + self.params.tab_extra_days)
        tabs = (
            self.rel["pos_sale_tabs"]
            .where(
                F.col("splittabname").startswith(self.rules.split_tab_prefix)
                & (F.col("starttime") >= F.lit(since).cast("timestamp_ntz"))
            )
            .select("order_id", "branchid", "fbtableid", "parentsaletabid", "starttime",
                    F.col("starttime").cast("date").alias("tab_day"))
        )
        found = latest_at_or_before(
            tabs, ["branchid", "fbtableid", "tab_day"], "starttime",
            F.col("parentsaletabid") == 0, "order_id", "master_id",
        )
        return found.where((F.col("parentsaletabid") > 0) & F.col("master_id").isNotNull()).select("order_id", "master_id")

    @cached_property
    def split_children(self) -> DataFrame:
        """Kept dine-in orders split off another bill: order_id -> master_id."""
        dine_in = self.orders.where(F.col("channel") == "dine_in").select("order_id")
        return self.stage.keep("split_children", self.split_tabs.join(dine_in, "order_id", "left_semi"))

    @cached_property
    def party(self) -> DataFrame:
        """Every kept order and the party it belongs to; an unsplit order is its own party."""
        return (
            self.orders.select("order_id")
            .join(self.split_children, "order_id", "left")
            .select("order_id", F.coalesce("master_id", "order_id").alias("party_id"))
        )

    # ---- S23 -----------------------------------------------------------------------------
    def unmapped_choices(self) -> DataFrame:
        """Choices of covered option groups that no item stands for, most frequent first."""
        kept = self.item_options(self.options).join(self.orders.select("order_id"), "order_id", "left_semi")
        return (
            kept.join(self.item_choices.select("choice_key"), "choice_key", "left_anti")
            .groupBy("modifier_group", "choice_th")
            .agg(F.count("*").alias("picks"))
            .orderBy(F.desc("picks"), "modifier_group", "choice_th")
        )
