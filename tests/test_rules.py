"""Text, number and date rules, on the values that decide them."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesgrain.functions import text, times
from salesgrain.functions.numbers import half_up, ratio
from salesgrain.params import Params, Rules

RULES = Rules(store_names={"One City Centre": "occ", "Park Silom": "silom"})


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in values.items())
    df = spark.createDataFrame([tuple(values.values())], schema) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("price, tier", [(0, "water"), (20, "water"), (20.01, "paid"), (40, "paid"), (40.01, "premium")])
def test_drink_tier(spark, price, tier):
    assert one(spark, text.drink_tier(F.col("p"), RULES), p=float(price)) == tier


@pytest.mark.parametrize("code, name, free", [
    ("A13", "หมูกระจก", True), ("H4", None, True), (None, "PRO1 แลกฟรี", True), ("A1", "หมู", False), (None, None, False),
])
def test_free_item(spark, code, name, free):
    assert one(spark, text.is_free_item(F.col("c"), F.col("n"), RULES), c=code, n=name) is free


@pytest.mark.parametrize("choice, key", [("เกี๊ยวทอด **", "เกี๊ยวทอด"), (" a* ", "a"), ("a*b", "a*b")])
def test_choice_key(spark, choice, key):
    assert one(spark, text.choice_key(F.col("c")), c=choice) == key


@pytest.mark.parametrize("name, key", [
    ("B2 คอหมูย่าง", "คอหมูย่าง"), ("เพิ่ม คอหมู 50 กรัม", "คอหมูย่าง"), ("เพิ่ม สันคอ*", "สันคอหมูย่าง"),
    ("หมูกรอบ (ใหม่) 100 g", "หมูกรอบ"), ("เพิ่ม หมู กรอบ", "หมูกรอบ"),
    ("*B1 egg", "B1egg"), ("(new) B1 egg", "B1egg"), ("B1*2 egg", "2egg"), ("B1egg 20g", "egg"), ("B1 เพิ่ม(x) egg *", "egg"),
])
def test_topping_key(spark, name, key):
    assert one(spark, text.topping_key(F.col("n"), RULES), n=name) == key


@pytest.mark.parametrize("name, family, variant", [
    ("N1 ก๋วยเตี๋ยว ต้มยำแห้ง ธรรมดา", "ก๋วยเตี๋ยว ต้มยำแห้ง", "ธรรมดา"),
    ("ก๋วยเตี๋ยว ทรงเครื่อง", "ก๋วยเตี๋ยว", "ทรงเครื่อง"), ("A2 หลอดโบราณ", "หลอดโบราณ", None),
])
def test_family_and_variant(spark, name, family, variant):
    assert one(spark, text.dish_family(F.col("n"), RULES), n=name) == family
    assert one(spark, text.dish_variant(F.col("n"), RULES), n=name) == variant


@pytest.mark.parametrize("typed, number", [
    ("213", "213"), ("GF-213", "213"), (" gf 5265 ", "5265"), ("GF309", "309"), ("TakeAway1", None),
    ("12", None), ("12345", None), (None, None),
])
def test_keyed_order_number(spark, typed, number):
    assert one(spark, text.keyed_order_number(F.col("t"), RULES), t=typed) == number


@pytest.mark.parametrize("raw, number", [("GF-050", "050"), ("GF-5265", "5265"), ("GF-851T", "851"), ("7", "007"), ("", None)])
def test_export_order_number(spark, raw, number):
    assert one(spark, text.export_order_number(F.col("r")), r=raw) == number


@pytest.mark.parametrize("raw, value", [("1,200", 1200), ("฿-3.50", "-3.5"), ("", 0), ("-", 0), ("1.2.3", 0), (None, 0)])
def test_lenient_number(spark, raw, value):
    assert one(spark, text.lenient_number(F.col("r")), r=raw) == Decimal(str(value))


@pytest.mark.parametrize("store, location", [
    ("Noodles - One City Centre", "occ"), ("Noodles - X - park silom tower", "silom"), ("Noodles - Elsewhere", None),
    ("One City Centre - Elsewhere", None), (None, None),
])
def test_store_location(spark, store, location):
    assert one(spark, text.store_location(F.col("s"), RULES.store_names), s=store) == location


def test_half_up_and_ratio(spark):
    assert one(spark, half_up(ratio(F.col("a"), F.col("b")), 2), a=17118.35, b=10.0) == 1711.84
    assert one(spark, half_up(ratio(F.col("a"), F.col("b")), 2), a=67647.98, b=4.0) == 16912.0
    assert one(spark, ratio(F.col("a"), F.col("b")), a=1.0, b=0.0) is None


def test_wall_clock_is_independent_of_the_session_zone(spark):
    instant = spark.sql("SELECT TIMESTAMP '2026-10-07 05:30:00+00:00' t")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            local = times.wall_clock(instant, "t").select(F.date_format("t", "yyyy-MM-dd HH:mm").alias("t"))
            assert local.first()["t"] == "2026-10-07 12:30"
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_clock_micros_runs_past_midnight(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2026-10-08 00:01:02.000003' t, DATE '2026-10-07' d")
    got = df.select(times.clock_micros(F.col("t"), F.col("d")).alias("x")).first()["x"]
    assert got == times.DAY + times.MINUTE + 2 * times.SECOND + 3


def test_first_feed_month_crosses_the_year():
    assert Params(as_of=dt.date(2026, 2, 10)).first_feed_month == "2025-11"
    assert Params(as_of=dt.date(2026, 12, 1)).first_feed_month == "2026-09"
    assert Params(as_of=dt.date(2026, 12, 1)).last_own_window == 8
