"""The tables by name, in the order a full rebuild makes them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from salesgrain.params import Params
from salesgrain.plans import baskets, daily, matching, monthly, occupancy, opportunity
from salesgrain.plans.base import Base
from salesgrain.plans.staging import Stage, no_stage
from salesgrain.sources.relations import PLATFORM_TABLES, Relations

BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {
    f.__name__: f
    for f in (
        daily.tree_daily, daily.hourly, daily.dwell, daily.pax_trust, daily.item_daily,
        monthly.option_monthly, monthly.option_by_dish, monthly.topping_route, baskets.pair_lift,
        monthly.party_size, monthly.ticket_hist, monthly.members_monthly, monthly.member_visits,
        daily.promo_daily, monthly.set_monthly, daily.calendar_daily, matching.grab_match,
        occupancy.occupancy_hourly, opportunity.set_incremental, baskets.pair_attach,
        occupancy.dead_hours, opportunity.opportunity,
    )
}
HELPERS: dict[str, Callable[[Tables], DataFrame]] = {
    f.__name__: f
    for f in (
        daily.baseline, occupancy.bill_intervals, opportunity.lever_daily, opportunity.lever_value,
        opportunity.opportunity_notes, opportunity.dead_hours_rollup,
    )
}


class Tables:
    """Derived tables on demand. `build` gives the plan; `t[name]` is how another plan reads one,
    from its stored copy when the stage keeps that name."""

    def __init__(self, rel: Relations, params: Params, stage: Stage | None = None):
        self.rel = rel
        self.params = params
        self.stage = stage or no_stage(rel.spark)
        self.base = Base(rel, params, self.stage)
        self._known: dict[str, DataFrame] = {}

    def build(self, name: str) -> DataFrame:
        if name in PLATFORM_TABLES and name not in BUILDERS:
            return self.rel[name]
        return (BUILDERS.get(name) or HELPERS[name])(self)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self.stage.keep(name, self.build(name))
        return self._known[name]

    def put(self, name: str, df: DataFrame) -> None:
        """Read a table from a stored copy, e.g. of a published run."""
        self._known[name] = df
