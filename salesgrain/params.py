"""Everything a run can vary: the as-of date, the windows and thresholds, the domain rules."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from salesgrain.functions import fixed_values as fv


@dataclass(frozen=True)
class Rules:
    """How names, codes and prices are read. Defaults are the noodle-chain values."""

    tree_categories: tuple[str, ...] = fv.TREE_CATEGORIES
    in_store: tuple[str, ...] = fv.IN_STORE
    water_max: float = fv.WATER_MAX
    paid_bev_max: float = fv.PAID_BEV_MAX
    free_codes: tuple[str, ...] = fv.FREE_ITEM_CODES
    free_name_part: str = fv.FREE_NAME_PART
    set_mandatory_re: str = fv.SET_MANDATORY_RE
    option_item_groups_re: str = fv.OPTION_ITEM_GROUPS_RE
    topping_group_re: str = fv.TOPPING_GROUP_RE
    topping_aliases: dict[str, str] = field(default_factory=lambda: dict(fv.TOPPING_ALIASES))
    variant_words: tuple[str, ...] = fv.VARIANT_WORDS
    base_variant: str = fv.BASE_VARIANT
    info_variant: str = fv.INFO_VARIANT
    top_variant: str = fv.TOP_VARIANT
    water_item_code: str = fv.WATER_ITEM_CODE
    water_default_price: str = fv.WATER_DEFAULT_PRICE
    set_name_prefixes: tuple[str, ...] = fv.SET_NAME_PREFIXES
    no_promo: str = fv.NO_PROMO
    buy2get1_promo: str = fv.BUY2GET1_PROMO
    buy2get1_min_price: float = 99
    near_zero: str = "0.01"
    order_number_re: str = fv.ORDER_NUMBER_RE
    split_tab_prefix: str = fv.SPLIT_TAB_PREFIX
    cancelled_status: str = fv.CANCELLED_STATUS
    unpaid_status: str = fv.UNPAID_STATUS
    # words that mark a search keyword as the chain's own brand; a caller must supply them
    brand_words: tuple[str, ...] = ()
    store_names: dict[str, str] = field(default_factory=lambda: dict(fv.STORE_NAMES))
    branch_labels: dict[str, str] = field(default_factory=lambda: dict(fv.BRANCH_LABELS))


@dataclass(frozen=True)
class Params:
    """Windows and thresholds. `as_of` is "today": the last, still partial, business date."""

    as_of: dt.date
    window_days: int = 120
    pair_days: int = 90
    pair_min_item_bills: int = 30
    pair_min_bills: int = 10
    baseline_from_days: int = 56
    baseline_to_days: int = 7
    baseline_min_days: int = 3
    trust_low: str = "0.9"
    trust_high: str = "1.3"
    opp_days: int = 30
    own_best_days: int = 90
    own_best_span: int = 28
    own_best_step: int = 7
    set_inc_days: int = 90
    peer_min_meals: int = 1000
    opp_min_meals: int = 100
    peer_min_branches: int = 3
    peerless: tuple[str, ...] = fv.PEERLESS
    dead_hours: tuple[int, ...] = (10, 14, 15, 16, 20)
    dead_peer_min_days: int = 20
    dead_own_min_days: int = 15
    dead_skip: tuple[str, ...] = fv.PEERLESS
    dwell_min: int = 3
    dwell_max: int = 240
    impute_days: int = 90
    impute_min_hour: int = 10
    impute_min_all: int = 30
    impute_fallback: int = 35
    first_hour: int = 10
    last_hour: int = 20
    tab_extra_days: int = 2
    match_extra_days: int = 10
    feed_days: int = 90
    feed_months: int = 3
    pairs_min_lift: str = "1.2"
    pairs_per_branch: int = 300
    winback_min_visits: int = 2
    winback_min_days: int = 21
    winback_rows: int = 200
    dish_min_picks: int = 2
    script_weeks_days: int = 96
    script_min_bills: int = 10
    script_top_items: int | None = 50
    script_compare_min_bills: int = 30
    payload_budget_mb: float = 10.0
    rules: Rules = field(default_factory=Rules)

    @property
    def data_through(self) -> dt.date:
        return self.as_of - dt.timedelta(days=1)

    def days_ago(self, days: int) -> dt.date:
        return self.as_of - dt.timedelta(days=days)

    @property
    def first_feed_month(self) -> str:
        """The oldest month monthly feeds keep, as YYYY-MM."""
        month_index = self.as_of.year * 12 + self.as_of.month - 1 - self.feed_months
        return f"{month_index // 12:04d}-{month_index % 12 + 1:02d}"

    @property
    def last_own_window(self) -> int:
        return (self.own_best_days - self.own_best_span) // self.own_best_step
