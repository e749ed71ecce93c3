"""Derived tables on the hand-made fixture, with values worked out by hand."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from conftest import rows
from domain import D, TODAY

KEPT = {"1-1", "1-2", "1-5", "1-6", "1-7", "1-8", "1-9", "1-10", "1-11", "1-12", "1-13", "3-1"}


def test_base_orders(shop):
    got = rows(shop.base.orders, "order_id")
    assert set(got) == KEPT  # voided, unfinished, not-live and old orders are out
    assert got["1-1"]["daypart"] == "lunch" and got["1-1"]["hr"] == 12 and got["1-1"]["ym"] == "2026-10"
    assert got["1-2"]["daypart"] == "dinner"
    assert got["1-5"]["hr"] is None and got["1-5"]["daypart"] == "non_peak"


def test_lines_and_options(shop):
    lines = rows(shop.base.lines, "line_id")
    assert {8, 9, 10}.isdisjoint(lines)  # inactive, special, split copy
    assert [lines[i]["bev_tier"] for i in (2, 3, 4, 5)] == ["water", "paid", "paid", "premium"]
    assert lines[6]["is_free"] and lines[7]["is_free"] and not lines[1]["is_free"]
    options = rows(shop.base.options)
    assert len(options) == 5  # the pick on the split copy is gone
    paid = {o["choice_th"]: o["is_paid_upsell"] for o in options}
    assert paid["เกี๊ยวทอด **"] and not paid["เก๊กฮวย"]  # a forced pick is no upsell


def test_units_merge_option_picks_into_items(shop):
    units = [u for u in rows(shop.base.units) if u["source"] != "menu"]
    got = {(u["item_code"], u["source"]): (u["qty"], u["thb"], u["bev_tier"]) for u in units}
    assert got == {
        ("C6", "option"): (Decimal(2), Decimal(50), None),
        ("E1", "set"): (Decimal(1), Decimal(0), "paid"),
        ("F1", "set"): (Decimal(2), Decimal(0), None),  # one pick stands for two
    }
    unmapped = rows(shop.base.unmapped_choices())
    assert unmapped == [{"modifier_group": "เพิ่มข้าว", "choice_th": "ไม่รู้จัก", "picks": 1}]


def test_order_facts(shop):
    got = rows(shop.base.order_facts, "order_id")
    assert set(got) == KEPT
    one, two, empty = got["1-1"], got["1-2"], got["1-5"]
    assert one["main_units"] == 1 and one["bev_units"] == 4 and one["bev_paid_units"] == 2
    assert one["side_units"] == 2 and one["side_set_units"] == 0
    assert two["set_units"] == 1 and two["dessert_set_units"] == 2 and two["bev_paid_set_units"] == 1
    assert two["promo"] == "ซื้อ 2 แถม 1 (derived)" and one["promo"] == "ไม่มีโปร"
    assert empty["main_units"] == 0 and empty["promo"] == "ไม่มีโปร"


def test_tree_keeps_order_scalars_and_column_order(shop):
    tree = shop.build("tree_daily")
    assert tree.columns[:6] == ["location_id", "business_date", "daypart", "channel", "orders", "pax_keyed"]
    assert tree.columns[-5:] == ["side_set_units", "bev_paid_set_units", "bev_premium_set_units",
                                 "dessert_set_units", "topping_set_units"]
    got = rows(tree, "location_id", "business_date", "daypart", "channel")
    lunch = got["silom", D, "lunch", "dine_in"]
    assert lunch["orders"] == 5  # 1-1, 1-6, 1-8, 1-12, 1-13
    assert lunch["net_thb"] == 300 + 90 + 60 + 40 + 45 and lunch["gross_thb"] == lunch["net_thb"] + 20
    assert lunch["main_units"] == 1 + 2 + 1 + 1 and lunch["paid_option_picks"] == 0
    unclosed = got["silom", D, "non_peak", "dine_in"]
    assert unclosed["orders"] == 3 and unclosed["topping_units"] == 1  # 1-5, 1-7, 1-9


def test_hourly_keeps_orders_without_a_closing_time(shop):
    got = rows(shop.build("hourly"), "location_id", "business_date", "hour", "channel")
    assert got["silom", D, None, "dine_in"]["orders"] == 1
    assert got["silom", D, 12, "dine_in"]["main_units"] == 5


def test_dwell_bounds_and_cancel_flag(shop):
    got = rows(shop.build("dwell"), "daypart")
    # 2.9 and 240.1 minutes are out, the cancelled session too; 3 and 240 stay
    assert got["non_peak"]["sessions"] == 1 and got["non_peak"]["avg_party"] == 3
    assert got["lunch"]["sessions"] == 1 and got["lunch"]["avg_dwell_min"] == 240


def test_pax_trust(shop):
    got = rows(shop.build("pax_trust"), "location_id", "business_date")
    day = got["silom", D]
    assert day["bowls"] == 5 and day["keyed_pax"] == 9 and day["ratio"] == 0.56 and not day["trusted"]
    assert got["rama9", D]["trusted"] and got["rama9", D]["ratio"] == 1


def test_items_have_a_route_and_a_default_category(shop):
    got = rows(shop.build("item_daily"), "item_name", "source")
    assert got["ของแปลก", "menu"]["main_category"] == "other" and got["ของแปลก", "menu"]["sub_category"] is None
    assert got["C6 เกี๊ยวทอด", "option"]["avg_price"] == 25
    assert not [k for k in got if "แลกฟรี" in k[0] or k[0].startswith("A13")]
    mains = [r for r in rows(shop.build("item_daily")) if r["item_id"] == 11 and r["business_date"] == D]
    assert sum(r["bills"] for r in mains) == 5 and sum(r["units"] for r in mains) == 6


def test_topping_route_is_a_full_outer_join(shop):
    (got,) = rows(shop.build("topping_route"))
    assert got["topping"] == "คอหมูย่าง" and got["as_option_units"] == 3 and got["as_menu_units"] == 1
    assert got["as_option_thb"] == 0 and got["as_menu_thb"] == 35


def test_party_takes_the_latest_master_on_the_table(shop):
    party = rows(shop.base.party, "order_id")
    assert party["1-12"]["party_id"] == "1-1" and party["1-8"]["party_id"] == "1-8"
    sizes = rows(shop.build("party_size"), "location_id", "daypart", "channel", "pax_bucket")
    # 1-1 with its child: two mains; 1-6: two mains; the others one person each
    pair = sizes["silom", "lunch", "dine_in", "2"]
    assert pair["bills"] == 2 and pair["net_thb"] == 300 + 40 + 90
    assert sizes["silom", "dinner", "take_away", "n/a"]["bills"] == 1
    net = sum(r["net_thb"] for r in sizes.values())
    assert net == sum(r["total_thb"] for r in rows(shop.base.orders))


def test_members(shop):
    monthly = rows(shop.build("members_monthly"), "location_id")
    assert monthly["silom"]["bills"] == 11 and monthly["silom"]["member_bills"] == 2
    assert monthly["silom"]["distinct_members"] == 1
    (member,) = rows(shop.build("member_visits"))
    assert member["member_key"] == "8f14e45fceea167a5a36dedd4bea2543"
    assert member["visits"] == 2 and member["last_date"] == TODAY and member["days_since"] == 0
    assert member["avg_thb"] == 400


def test_tickets_and_sets(shop):
    buckets = {}
    for r in rows(shop.build("ticket_hist")):
        buckets[r["thb_bucket"]] = buckets.get(r["thb_bucket"], 0) + r["bills"]
    assert buckets == {"<150": 8, "150-249": 1, "250-399": 1, "400-599": 1, "600+": 1}
    (sets,) = rows(shop.build("set_monthly"))
    assert sets["set_name"] == "Set สุดคุ้ม" and sets["thb"] == 150


def test_calendar(shop):
    got = rows(shop.build("calendar_daily"), "location_id", "business_date", "channel")
    day = got["silom", D, "dine_in"]
    assert (day["dow"], day["dom"], day["wom"]) == (3, 7, 1)
    assert not day["is_holiday"] and day["rain_mm"] == Decimal("2.5") and day["expected_thb"] is None
    assert got["silom", TODAY, "dine_in"]["wom"] == 2  # the 9th; today is kept


def test_baseline_leaves_out_holidays_but_judges_them(spark):
    import domain
    from salesgrain.plans.catalog import Tables
    from salesgrain.sources.relations import frame_relations

    weeks = [D - dt.timedelta(days=7 * i) for i in range(10)]
    orders = [domain.order(f"1-{i}", day=d, total=100 + 10 * i) for i, d in enumerate(weeks)]
    data = domain.frames(spark)
    data["orders"] = spark.createDataFrame(orders, data["orders"].schema)
    t = Tables(frame_relations(spark, data), domain.PARAMS)
    got = rows(t.build("calendar_daily"), "business_date")
    # weeks 1..8 back are 110..180; week 1 back is the holiday of the fixture
    assert got[D]["expected_thb"] == 150 and got[D]["gap_pct"] == -33.3
    assert got[weeks[1]]["is_holiday"] and got[weeks[1]]["expected_thb"] == 155
    assert got[weeks[7]]["expected_thb"] is None  # two comparable days only


def test_match_rules(shop):
    got = rows(shop.build("grab_match"), "booking_id")
    assert got["b1"]["bill_id"] == "1-11" and not got["b1"]["ambiguous"]
    assert "b2" not in got and "b4" not in got  # voided only, nothing
    assert got["b3"]["bill_id"] == "1-7" and got["b3"]["ambiguous"]  # lowest of two standing bills
    assert "b5" not in got  # its last three digits belong to an exact match


def test_pair_attach_leaves_set_picks_and_water_out(shop):
    got = rows(shop.build("pair_attach"), "main_family", "item")
    family = "ก๋วยเตี๋ยว ต้มยำ"
    assert set(got) == {(family, i) for i in ("เกี๊ยวทอด", "เก๊กฮวย", "ชาดำเย็น", "พิเศษ")}
    fried = got[family, "เกี๊ยวทอด"]
    assert fried["week_start"] == dt.date(2026, 10, 5) and fried["channel"] == "dine_in"
    assert (fried["bills_main"], fried["bills_both"], fried["thb_both"]) == (4, 1, 50)


def test_free_items_and_rare_pairs_make_no_pair(shop):
    assert rows(shop.build("pair_lift")) == []


def join_rows(df):
    """The most rows any join of an executed plan has put out."""
    df.collect()
    most, open_ = 0, [df._jdf.queryExecution().executedPlan()]
    while open_:
        node = open_.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            open_.append(node.executedPlan())
        elif "QueryStage" in name:
            open_.append(node.plan())
        else:
            children = node.children()
            open_ += [children.apply(i) for i in range(children.size())]
        if "Join" in name:
            most = max(most, node.metrics().apply("numOutputRows").value())
    return most


def test_a_number_that_many_share_makes_no_pairs(spark):
    """A thousand bookings and a thousand tabs on one number: joins put out a row a booking or tab."""
    import domain
    from salesgrain.plans.catalog import Tables
    from salesgrain.sources.relations import frame_relations

    n = 1000
    data = domain.frames(spark)
    data["grab_orders"] = spark.createDataFrame(
        [domain.booking(f"b{i}", "1213" if i % 2 else "213") for i in range(n)], data["grab_orders"].schema
    )
    tabs = [(1, i, i, 0, 0, None, domain.at(domain.D, "12:00"), "GF-213", None) for i in range(n)]
    data["pos_sale_tabs"] = spark.createDataFrame(tabs, data["pos_sale_tabs"].schema)
    data["orders"] = spark.createDataFrame(
        [domain.order(f"1-{i}", channel="delivery") for i in range(n)], data["orders"].schema
    )
    match = Tables(frame_relations(spark, data), domain.PARAMS).build("grab_match")
    got = match.collect()
    # the tabs are taken by the exact hits, so the longer numbers find none
    assert len(got) == n // 2 and all(r["ambiguous"] and r["bill_id"] == "1-0" for r in got)
    assert join_rows(match) <= n
