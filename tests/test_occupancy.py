"""Bill intervals and hour cells, on the edges that decide them."""

from __future__ import annotations

import datetime as dt

import domain
import pytest
from conftest import rows
from domain import D, PARAMS, TODAY, frames, order

from salesgrain.plans.catalog import Tables
from salesgrain.sources.relations import frame_relations


def tables(spark, orders, lines=(), params=PARAMS, staged=("recorded_stays",), **extra):
    data = frames(spark)
    data["orders"] = spark.createDataFrame(orders, data["orders"].schema)
    data["order_lines"] = spark.createDataFrame(list(lines), data["order_lines"].schema)
    for name, values in extra.items():
        data[name] = spark.createDataFrame(values, data[name].schema)
    return Tables(frame_relations(spark, data), params, domain.stage(spark, *staged))


def test_intervals(shop):
    got = rows(shop.build("bill_intervals"), "order_id")
    assert "1-13" not in got  # every meal line taken home
    assert "1-10" in got and got["1-1"]["persons"] == 1 and not got["1-1"]["imputed"]
    assert got["1-5"]["start_min"] == 15 * 60 and got["1-5"]["dwell_min"] == 30  # from the session
    assert got["1-8"]["sit"] and got["1-9"]["sit"]  # 3 and 240 minutes count
    assert not got["1-7"]["sit"]  # 241 do not
    child = got["1-12"]
    assert child["start_min"] == 12 * 60 and child["dwell_min"] == 11 and not child["imputed"]
    # too few normal bills for a median: the fallback of 35 minutes before closing
    for late in ("1-6", "3-1"):
        assert got[late]["imputed"] and got[late]["sit"] and got[late]["dwell_min"] == 35
    assert got["1-6"]["start_min"] == 12 * 60 + 22 - 35


def test_imputation_prefers_the_hour_then_the_branch(spark):
    noon = [order(f"1-{i}", opened="12:00", closed=f"12:{10 + 2 * i}") for i in range(10)]  # 10..28 minutes
    evening = [order(f"1-{100 + i}", opened="18:00", closed="18:50") for i in range(21)]
    late = [order("1-900", opened="12:59", closed="13:00"), order("1-901", opened="15:00", closed="15:01")]
    got = rows(tables(spark, noon + evening + late).build("bill_intervals"), "order_id")
    assert got["1-900"]["dwell_min"] == 19  # the median of the noon bills
    assert got["1-901"]["dwell_min"] == 50  # no bill at 15: the branch median of 31 bills
    fewer = rows(tables(spark, noon[1:] + evening + late).build("bill_intervals"), "order_id")
    assert fewer["1-900"]["dwell_min"] == 50  # nine noon bills are not enough, thirty in all are


def test_cells(shop):
    got = rows(shop.build("occupancy_hourly"), "location_id", "business_date", "hour")
    assert {k[2] for k in got if k[0] == "silom"} == set(range(10, 21))  # clipped to 10-20
    assert not [k for k in got if k[0] == "rama9"]  # opens after it closes: no hours
    noon = got["silom", D, 12]
    # opened at noon: 1-1, 1-7 (241 minutes: counts for persons only), child 1-12
    assert noon["persons_opened"] == 3 and noon["turns"] == 2 and noon["dwell_min_sum"] == 41
    # seated: 1-1 30 min, 1-9 60 min, child 11 min, late 1-6 (2 persons) 22 min
    assert noon["seat_minutes"] == 30 + 60 + 11 + 2 * 22 and noon["bills_open"] == 4
    assert noon["imputed_bills"] == 1
    assert noon["peak_persons"] == 5 and noon["peak_slot"] == 0  # at 12:00: 1-1, 1-9, 1-12, two of 1-6
    assert got["silom", D, 20]["seat_minutes"] == 0 and got["silom", D, 20]["peak_slot"] == 0


@pytest.mark.parametrize("opened, closed, seen_in", [
    ("12:00", "12:00", []),  # no length, exactly on the edge
    ("12:30", "12:30", [12]),  # no length inside an hour
    ("12:00", "13:00", [12]),  # ends where the next hour begins
    ("12:59", "13:01", [12, 13]),
])
def test_hour_edges(spark, opened, closed, seen_in):
    # a split child is never late-keyed, so its short interval is kept as it is
    tabs = [(1, 1, 1, 20, 0, "Split#1", domain.at(D, "08:00"), None, None),
            (1, 2, 2, 20, 9, "Split#2", domain.at(D, "12:00"), None, None)]
    orders = [order("1-1", opened=opened, closed=opened, day=D, void=True),
              order("1-2", opened=opened, closed=closed)]
    t = tables(spark, orders, pos_sale_tabs=tabs)
    got = rows(t.build("occupancy_hourly"), "hour")
    opened_hour = int(opened[:2])
    assert [h for h in range(10, 21) if got[h]["persons_opened"]] == ([opened_hour] if seen_in else [])
    cells = t.build("bill_intervals").collect()
    assert cells[0]["start_min"] == opened_hour * 60 + int(opened[3:])


def test_cells_match_a_brute_force_count(spark):
    import random

    rng = random.Random(11)
    orders = []
    for i in range(400):
        start = rng.randint(8 * 60, 22 * 60)
        length = rng.choice((0, 1, 2, 3, 17, 40, 95, 240, 241, 300))
        end = min(start + length, 23 * 60 + 59)
        orders.append(order(f"1-{i}", opened=f"{start // 60}:{start % 60}", closed=f"{end // 60}:{end % 60}"))
    t = tables(spark, orders)
    bills = rows(t.build("bill_intervals"))
    got = rows(t.build("occupancy_hourly"), "hour")
    for h in range(10, 21):
        lo, hi = h * 60, h * 60 + 60
        over = [b for b in bills if b["start_min"] < hi and b["end_min"] > lo]
        sat = [b for b in over if b["sit"]]
        new = [b for b in over if lo <= b["start_min"] < hi]
        assert got[h]["seat_minutes"] == round(sum(min(b["end_min"], hi) - max(b["start_min"], lo) for b in sat), 1)
        assert got[h]["bills_open"] == len(sat) and got[h]["persons_opened"] == len(new)
        assert got[h]["turns"] == len([b for b in new if b["sit"]])
        slots = [len([b for b in bills if b["sit"] and b["start_min"] <= lo + 10 * k < b["end_min"]]) for k in range(6)]
        assert got[h]["peak_persons"] == max(slots) and got[h]["peak_slot"] == slots.index(max(slots))


def test_dead_hours_and_rollup(spark):
    """One branch: the peer is nobody, the own best window decides."""
    orders = []
    number = 0
    for back in range(1, 91):
        day = TODAY - dt.timedelta(days=back)
        guests = 4 if 36 <= back <= 63 else 2  # the best four weeks
        for _ in range(guests):
            number += 1
            orders.append(order(f"1-{number}", day=day, total=100, opened="14:05", closed="14:35"))
    lines = [domain.line(o[0], i, 11, "N2 ก๋วยเตี๋ยว ต้มยำ ธรรมดา", "main") for i, o in enumerate(orders, 100)]
    t = tables(spark, orders, lines, staged=("recorded_stays", "seat_days", "dead_hours"))
    got = rows(t["dead_hours"], "hour")
    hour = got[14]
    assert hour["occ"] == 0.2 and hour["peer_target"] is None and hour["peer_loc"] is None
    assert hour["own_best"] == 0.4 and hour["target_used"] == 0.4 and hour["persons_day"] == 2
    assert hour["own_best_window"] == TODAY - dt.timedelta(days=63)
    assert hour["ticket_thb"] == 100 and hour["thb_day"] == 200
    assert got[15]["target_used"] is None and got[15]["thb_day"] == 0 and got[15]["dwell_min"] == 30
    (roll,) = rows(t.build("dead_hours_rollup"))
    days = hour["open_days"]
    assert roll["uplift_thb_month"] == 200 * days and roll["meals_30d"] == 2 * days
    assert roll["note"] == f"hours 14 · {days} open weekdays"
