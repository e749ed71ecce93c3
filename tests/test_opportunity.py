"""The calculator on a chain of four branches."""

from __future__ import annotations

import datetime as dt

import domain
import pytest
from conftest import rows
from domain import TODAY, frames, line, order

from salesgrain.params import Params
from salesgrain.plans.catalog import Tables
from salesgrain.sources.relations import frame_relations

PARAMS = Params(as_of=TODAY, peer_min_meals=20, opp_min_meals=10)
SIDES = {"a": 10, "b": 8, "c": 4, "rama9": 20}  # sides sold to 40 meals


@pytest.fixture(scope="module")
def chain(spark):
    data = frames(spark)
    orders, lines, n = [], [], 100
    for branch, sides in SIDES.items():
        for i in range(40):
            n += 1
            day = TODAY - dt.timedelta(days=1 + i % 28)
            orders.append(order(f"1-{n}", loc=branch, day=day, total=200 if i < 10 else 100))
            variant = ("ทรงเครื่อง", "เครื่องใน", "ธรรมดา")[i % 3]
            item = {"ทรงเครื่อง": 10, "ธรรมดา": 11, "เครื่องใน": 12}[variant]
            if branch == "c" and i < 10:
                lines.append(line(f"1-{n}", n * 10, 40, "Set สุดคุ้ม", "set", gross=150))
            else:
                lines.append(line(f"1-{n}", n * 10, item, f"N ก๋วยเตี๋ยว ต้มยำ {variant}", "main"))
            if i < sides:
                lines.append(line(f"1-{n}", n * 10 + 1, 32, "C6 เกี๊ยวทอด", "side", gross=50))
    items = [*domain.ITEMS, (12, "N3", "N3 ก๋วยเตี๋ยว ต้มยำ เครื่องใน", "main", domain.dec(90), "noodle")]
    data["orders"] = spark.createDataFrame(orders, data["orders"].schema)
    data["order_lines"] = spark.createDataFrame(lines, data["order_lines"].schema)
    data["items"] = spark.createDataFrame(items, data["items"].schema)
    data["locations"] = spark.createDataFrame(
        [(b, i, "branch", True, True, False, 10, 20) for i, b in enumerate(SIDES)], data["locations"].schema
    )
    data["sold_options"] = data["sold_options"].limit(0)
    return Tables(frame_relations(spark, data), PARAMS, domain.stage(spark, "recorded_stays", "seat_days", "till_cells", "dead_hours", "opportunity_notes"))


def test_second_best_peer_and_peerless_branch(chain):
    got = rows(chain["opportunity_notes"], "location_id", "lever")
    a, b, c, rama9 = (got[x, "side"] for x in SIDES)
    assert a["current_rate"] == 0.25 and a["peer_target"] == 0.2 and a["peer_best_loc"] == "b"
    assert b["peer_best_loc"] == "b"  # the runner-up may be the branch itself
    assert c["peer_target"] == 0.2 and c["target_used"] == 0.2 and c["gap_pp"] == 10
    assert c["value_per_unit_thb"] == 50 and c["meals_30d"] == 40 and c["uplift_thb_month"] == 200
    assert rama9["peer_target"] is None and rama9["own_best"] == 0.5 and rama9["note"] == "already at target"
    assert a["uplift_thb_month"] == 0 and a["note"] == "already at target"


def test_own_best_window(chain):
    got = rows(chain["opportunity_notes"], "location_id", "lever")
    a = got["a", "side"]
    # days 1..12 back sell twice, days 13..28 once: a window that starts later holds fewer meals
    assert a["own_best_window"] == TODAY - dt.timedelta(days=28) and a["own_best"] == 0.25


def test_tradeup_rows_carry_the_bowl_base_and_the_second_variant(chain):
    got = rows(chain["opportunity_notes"], "location_id", "lever")
    row = got["a", "tradeup"]
    assert row["meals_30d"] == 40 and row["current_rate"] == 0.35 and row["value_per_unit_thb"] == 60
    assert row["own_best"] == 0.3571 and row["target_used"] == 0.3571  # five of fourteen, days 15 to 28 back
    assert row["note"] == "base = 40 bowls in families with ทรงเครื่อง · เครื่องใน 33%"


def test_set_value_is_measured_per_party_size(chain):
    got = rows(chain.build("set_incremental"), "location_id")
    c = got["c"]
    assert c["set_bills"] == 10 and c["nonset_bills"] == 30
    assert c["diff_per_meal_thb"] == 100 and c["incremental_thb_per_set"] == 100
    assert got["a"]["set_bills"] == 0 and got["a"]["incremental_thb_per_set"] is None
    levers = rows(chain["opportunity_notes"], "location_id", "lever")
    assert levers["c", "set"]["value_per_unit_thb"] == 100
    assert levers["a", "set"]["peer_target"] == 0  # second best of 0.25, 0, 0


def test_pair_lift_counts(spark):
    data = frames(spark)
    orders = [order(f"1-{i}", day=TODAY - dt.timedelta(days=1)) for i in range(60)]
    lines = []
    for i in range(60):
        lines.append(line(f"1-{i}", i * 10, 10, "A", "main"))
        lines.append(line(f"1-{i}", i * 10 + 1, 10, "A", "main"))  # a repeated item counts once
        if i < 30:
            lines.append(line(f"1-{i}", i * 10 + 2, 32, "B", "side"))
        if i < 29:
            lines.append(line(f"1-{i}", i * 10 + 3, 33, "C", "dessert"))  # one bill short of thirty
    data["orders"] = spark.createDataFrame(orders, data["orders"].schema)
    data["order_lines"] = spark.createDataFrame(lines, data["order_lines"].schema)
    t = Tables(frame_relations(spark, data), Params(as_of=TODAY))
    (pair,) = rows(t.build("pair_lift"))
    assert (pair["item_a"], pair["item_b"], pair["bills_ab"], pair["total_bills"]) == ("A", "B", 30, 60)
    assert pair["lift"] == 1.0
