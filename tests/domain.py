"""A small noodle chain with the edge cases each rule needs. Times are Bangkok wall clock."""

from __future__ import annotations

import datetime as dt
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from salesgrain.params import Params
from salesgrain.plans.staging import Stage
from salesgrain.sources.relations import SCHEMAS

TODAY = dt.date(2026, 10, 9)  # a Friday
PARAMS = Params(as_of=TODAY)
D = TODAY - dt.timedelta(days=2)  # Wednesday 2026-10-07


def at(day: dt.date, clock: str) -> dt.datetime:
    hour, minute, *second = (int(x) for x in clock.split(":"))
    return dt.datetime(day.year, day.month, day.day, hour, minute, *(second or [0]))


def dec(x):
    return None if x is None else Decimal(str(x))


def order(oid, loc="silom", day=D, channel="dine_in", pax=1, total=100, disc=0, cust=None,
          opened="12:00", closed="12:30", final=True, void=False):
    return (oid, loc, day, channel, dec(pax), dec(total), dec(disc), cust,
            opened and at(day, opened), closed and at(day, closed), final, void)


def line(oid, lid, item, name, cat, qty=1, gross=60, unit=None, base=60, disc=0, active=True,
         special=False, home=False):
    return (oid, lid, item, name, cat, dec(qty), dec(gross), dec(gross if unit is None else unit),
            dec(base), dec(disc), active, special, home)


ORDERS = [
    order("1-1", pax=2, total=300, disc=20, cust=7),
    order("1-2", channel="take_away", pax=None, total=150, cust=0, opened="18:00", closed="18:05"),
    order("1-3", void=True),
    order("1-4", final=False),
    order("1-5", closed=None, total=80),
    order("1-6", opened="12:20", closed="12:22", total=90),  # late keyed
    order("1-7", opened="12:00", closed="16:01", total=70),  # 241 minutes
    order("1-8", opened="13:00", closed="13:03", total=60),  # 3 minutes
    order("1-9", opened="10:00", closed="14:00", total=50),  # 240 minutes
    order("1-10", day=TODAY, total=500, cust=7),
    order("1-11", channel="delivery", total=999, opened="11:00", closed="11:10"),
    order("1-12", opened="12:10", closed="12:11", total=40),  # split child of 1-1
    order("1-13", opened="12:40", closed="12:50", total=45),  # every meal line taken home
    order("2-1", loc="ghost", total=1000),  # branch not live
    order("1-14", day=TODAY - dt.timedelta(days=121), total=33),  # before the window
    order("3-1", loc="rama9", opened="11:59", closed="12:00", total=110),  # late keyed, no normal bills
]
LINES = [
    line("1-1", 1, 10, "N1 ก๋วยเตี๋ยว ต้มยำ ทรงเครื่อง", "main", gross=120),
    line("1-1", 2, 20, "H3 น้ำเปล่า", "beverage", gross=20, unit=20),
    line("1-1", 3, 21, "E1 เก๊กฮวย", "beverage", gross=20.01, unit=20.01),
    line("1-1", 4, 22, "E2 ชาดำเย็น", "beverage", gross=40, unit=40),
    line("1-1", 5, 23, "E9 พิเศษ", "beverage", gross=40.01, unit=40.01),
    line("1-1", 6, 30, "A13 หมูกระจก ฟรีรีวิว", "side", gross=0),
    line("1-1", 7, 31, "PRO1 แลกฟรี", "side", gross=0),
    line("1-1", 8, 11, "N2 ก๋วยเตี๋ยว ต้มยำ ธรรมดา", "main", active=False),
    line("1-1", 9, 11, "N2 ก๋วยเตี๋ยว ต้มยำ ธรรมดา", "main", special=True),
    line("1-1", 10, 11, "N2 ก๋วยเตี๋ยว ต้มยำ ธรรมดา", "main"),  # split copy
    line("1-2", 11, 40, "Set สุดคุ้ม", "set", gross=150, base=150),
    line("1-2", 12, 11, "N2 ก๋วยเตี๋ยว ต้มยำ ธรรมดา", "main", gross=0, base=99),  # buy 2 get 1
    line("1-2", 13, 50, "ของแปลก", None, gross=15, base=15),
    line("1-6", 14, 11, "N2 ก๋วยเตี๋ยว ต้มยำ ธรรมดา", "main", qty=2),
    line("1-12", 15, 11, "N2 ก๋วยเตี๋ยว ต้มยำ ธรรมดา", "main", qty=1),
    line("1-13", 16, 11, "N2 ก๋วยเตี๋ยว ต้มยำ ธรรมดา", "main", home=True),
    line("1-9", 17, 60, "B2 คอหมูย่าง", "topping", gross=35),
    line("3-1", 18, 11, "N2 ก๋วยเตี๋ยว ต้มยำ ธรรมดา", "main"),
]
ITEMS = [
    (10, "N1", "N1 ก๋วยเตี๋ยว ต้มยำ ทรงเครื่อง", "main", dec(120), "noodle"),
    (11, "N2", "N2 ก๋วยเตี๋ยว ต้มยำ ธรรมดา", "main", dec(60), "noodle"),
    (20, "H3", "H3 น้ำเปล่า", "beverage", dec("16.05"), "drink"),
    (21, "E1", "E1 เก๊กฮวย", "beverage", dec(25), "drink"),
    (22, "E2", "E2 ชาดำเย็น", "beverage", dec(40), "drink"),
    (23, "E9", "E9 พิเศษ", "beverage", dec(60), "drink"),
    (30, "A13", "A13 หมูกระจก ฟรีรีวิว", "side", dec(0), "side"),
    (31, "PRO1", "PRO1 แลกฟรี", "side", dec(0), "side"),
    (32, "C6", "C6 เกี๊ยวทอด", "side", dec(50), "side"),
    (33, "F1", "F1 ไอศครีม", "dessert", dec(30), "sweet"),
    (40, "Set1", "Set สุดคุ้ม", "set", dec(150), "set"),
    (41, "Set1", "Set สุดคุ้ม (เก่า)", "set", dec(140), "set"),
    (60, "B2", "B2 คอหมูย่าง", "topping", dec(35), "topping"),
]
OPTIONS = [
    # order, line, dish, group, choice, qty, price, paid
    ("1-1", 1, "ต้มยำ", "เพิ่มความอร่อย", "เกี๊ยวทอด **", dec(2), dec(25), True),
    ("1-2", 11, "เซต", "เครื่องดื่ม แก้วที่ 1", "เก๊กฮวย", dec(1), dec(0), True),
    ("1-2", 11, "เซต", "ไอศครีม 2ที่", "ไอศครีม 2ที่", dec(1), dec(0), False),
    ("1-2", 11, "เซต", "เพิ่มข้าว", "ไม่รู้จัก", dec(1), dec(10), True),  # nothing on the map
    ("1-9", 17, "ต้มยำ", "เพิ่ม toppping", "เพิ่ม คอหมู 50 กรัม", dec(3), dec(0), False),
    ("1-1", 10, "ต้มยำ", "เส้น", "เส้นเล็ก", dec(1), dec(0), False),  # hangs on a split copy
]
OPTION_MAP = [("เกี๊ยวทอด", "C6", dec(1)), ("เก๊กฮวย", "E1", dec(1)), ("ไอศครีม 2ที่", "F1", dec(2))]
LOCATIONS = [
    ("silom", 1, "branch", True, True, False, 9, 21),
    ("ghost", 2, "branch", False, True, False, 10, 20),
    ("rama9", 3, "branch", True, True, False, 10, 16),
    ("office", 4, "kitchen", True, True, False, 10, 20),
]
SESSIONS = [
    ("1-1", dec(2), dec("2.9"), at(D, "12:00"), at(D, "12:03"), None),
    ("1-5", dec(3), dec(3), at(D, "15:00"), at(D, "15:30"), None),
    ("1-6", dec(1), dec(240), at(D, "12:00"), at(D, "16:00"), False),
    ("1-7", dec(1), dec("240.1"), at(D, "12:00"), at(D, "16:01"), False),
    ("1-8", dec(5), dec(30), at(D, "12:00"), at(D, "12:30"), True),
]
TABS = [
    (1, 1, 1, 20, 0, "Split#1", at(D, "12:00"), None, None),
    (1, 2, 12, 20, 99, "Split#2", at(D, "12:10"), None, None),
    (1, 3, 8, 21, 5, "Split#2", at(D, "13:00"), None, None),  # child without a master
    (1, 4, 11, 0, 0, None, at(D, "11:00"), " gf 5265 ", None),
    (1, 5, 2, 0, 0, None, at(D, "18:00"), None, "TakeAway1"),
    (1, 6, 3, 0, 0, None, at(D, "12:00"), "GF-213", None),  # voided bill
    (1, 7, 9, 0, 0, None, at(D, "10:00"), None, "GF309"),
    (1, 8, 7, 0, 0, None, at(D, "12:00"), "309", None),
]
SEATS = [("silom", 10, 10, 22, None, None, None, None), ("rama9", None, 18, 12, None, None, None, None)]
HOLIDAYS = [(D - dt.timedelta(days=7), "วันหยุด")]
WEATHER = [(D, dec("2.5"), dec(33))]


def booking(bid, gf, category="payment", status="paid", day=D, loc="silom", clock="11:00", gross=100):
    money = [dec(x) for x in (gross, 10, gross - 10, -20, -2, gross - 32)]
    return (f"T{bid}", bid, loc, day, at(day, clock), gf, category, status, "delivery", *money, None, None)


BOOKINGS = [
    booking("b1", "5265"),
    booking("b2", "213"),  # only a voided tab
    booking("b3", "309"),  # two standing tabs
    booking("b4", "777"),  # nothing
    booking("b5", "1309", clock="12:00"),  # last three digits taken exactly by b3
    booking("b6", "100", "other", "ยกเลิก"),
    booking("b7", "101", "ads"),
]


def frames(spark):
    def make(name, data):
        schema = SCHEMAS[name].replace(" timestamp,", " timestamp_ntz,").replace(" timestamp ", " timestamp_ntz ")
        return spark.createDataFrame(data, schema)

    out = {
        "orders": make("orders", ORDERS), "order_lines": make("order_lines", LINES),
        "items": make("items", ITEMS), "sold_options": make("sold_options", OPTIONS),
        "map_option_item": make("map_option_item", OPTION_MAP), "locations": make("locations", LOCATIONS),
        "table_sessions": make("table_sessions", SESSIONS), "pos_sale_tabs": make("pos_sale_tabs", TABS),
        "seats": make("seats", SEATS), "holidays": make("holidays", HOLIDAYS),
        "weather_daily": make("weather_daily", WEATHER), "grab_orders": make("grab_orders", BOOKINGS),
        "split_dupe_lines": spark.createDataFrame([(10,)], "line_id bigint"),
    }
    return {name: df.withColumn("_", F.lit(1)).drop("_") for name, df in out.items()}


def stage(spark, *names) -> Stage:
    """Keeps the named intermediates (all, when none is named) in a folder of the test's own."""
    return Stage(spark, frozenset(names) or None, tempfile.mkdtemp(prefix="stage-"))
