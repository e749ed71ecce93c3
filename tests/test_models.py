"""Regressions against plain solvers, and on a made-up branch whose effects are known."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
from conftest import rows
from domain import PARAMS
from pyspark.sql import functions as F

from salesgrain.operators.regression import linear_regression, logistic_regression
from salesgrain.plans import models
from salesgrain.plans.catalog import Tables
from salesgrain.sources.relations import frame_relations


def test_least_squares_equals_a_plain_solver(spark):
    rng = np.random.default_rng(1)
    data, want = [], {}
    for g in ("a", "b"):
        x = rng.normal(size=(80, 3))
        y = 2 + x @ [1.5, -3, 0.25] + rng.normal(size=80) * 0.3
        data += [(g, float(t), *map(float, r)) for t, r in zip(y, x)]
        design = np.column_stack([np.ones(80), x])
        beta, *_ = np.linalg.lstsq(design, y, rcond=None)
        rest = y - design @ beta
        error = np.sqrt(np.linalg.inv(design.T @ design).diagonal() * (rest @ rest) / (80 - 4))
        want[g] = beta, error, 1 - (rest @ rest) / ((y - y.mean()) @ (y - y.mean()))
    df = spark.createDataFrame(data + [("a", None, 1.0, 1.0, 1.0)], "g string, y double, p double, q double, r double").repartition(5)
    # double is twice p, always is the intercept: neither has a coefficient of its own
    terms = {"p": F.col("p"), "double": 2 * F.col("p"), "q": F.col("q"), "r": F.col("r"), "always": F.lit(1)}
    got = rows(linear_regression(df, ["g"], F.col("y"), terms), "g", "term")
    for g, (beta, error, share) in want.items():
        for i, term in enumerate(("intercept", "p", "q", "r")):
            assert abs(got[g, term]["coefficient"] - beta[i]) < 1e-9 and abs(got[g, term]["std_error"] - error[i]) < 1e-9
            assert abs(got[g, term]["statistic"] - beta[i] / error[i]) < 1e-6
        assert got[g, "double"]["coefficient"] is None and got[g, "always"]["coefficient"] is None
        assert got[g, "p"]["n"] == 80 and abs(got[g, "p"]["r_squared"] - share) < 1e-9


def slow_logistic(x, y):
    """Gradient ascent on single rows until nothing moves."""
    beta = np.zeros(x.shape[1])
    for _ in range(200_000):
        step = x.T @ (y - 1 / (1 + np.exp(-x @ beta))) / len(y)
        beta += 4 * step
        if np.abs(step).max() < 1e-12:
            break
    return beta


def test_logistic_equals_a_plain_solver(spark):
    rng = random.Random(4)
    data = []
    for _ in range(600):
        size, part = rng.choice("123"), rng.choice(["am", "pm"])
        odds = {"1": -1, "2": 0, "3": 0.7}[size] + (0.5 if part == "pm" else 0)
        data.append(("x", size, part, rng.random() < 1 / (1 + math.exp(-odds))))
    df = spark.createDataFrame(data, "g string, size string, part string, y boolean").repartition(4)
    factors = {"size": F.col("size"), "part": F.col("part")}
    got = rows(logistic_regression(df, ["g"], F.col("y"), factors, {"size": "1", "part": "none"}), "term")
    assert set(got) == {"intercept", "size=2", "size=3", "part=pm"}  # am stands in for the missing base
    x = np.array([[1, s == "2", s == "3", p == "pm"] for _, s, p, _ in data], dtype=float)
    beta = slow_logistic(x, np.array([y for *_, y in data], dtype=float))
    p = 1 / (1 + np.exp(-x @ beta))
    error = np.sqrt(np.linalg.inv(x.T @ (x * (p * (1 - p))[:, None])).diagonal())
    for i, term in enumerate(("intercept", "size=2", "size=3", "part=pm")):
        assert abs(got[term]["coefficient"] - beta[i]) < 1e-6 and abs(got[term]["std_error"] - error[i]) < 1e-6
        assert got[term]["rows"] == 600 and got[term]["hits"] == sum(y for *_, y in data)
    twice = df.groupBy("g", "size", "part", "y").agg(F.count("*").alias("n"))
    weighed = rows(logistic_regression(twice, ["g"], F.col("y"), factors, {"size": "1", "part": "none"}, F.col("n")), "term")
    assert all(abs(weighed[t]["coefficient"] - got[t]["coefficient"]) < 1e-9 for t in got)


def test_levels_that_tell_everything_and_groups_of_one_answer_end(spark):
    data = [("a", "x", True)] * 5 + [("a", "y", False)] * 5 + [("b", "x", True)] * 3
    df = spark.createDataFrame(data, "g string, f string, y boolean")
    got = rows(logistic_regression(df, ["g"], F.col("y"), {"f": F.col("f")}, {"f": "x"}), "g", "term")
    assert got["a", "intercept"]["coefficient"] > 5 and got["a", "f=y"]["coefficient"] < -10
    assert got["b", "intercept"]["coefficient"] > 5 and len(got) == 3


def test_calendar_regression_finds_the_effects_of_a_made_up_branch(spark, shop):
    first = PARAMS.as_of - dt.timedelta(days=112)
    days = [first + dt.timedelta(days=i) for i in range(112)]
    off = {d for d in days if d.day == 12 and d.weekday() < 5} | {next(d for d in days[20:] if d.weekday() == 3)}
    rain = {d: float((7 * i) % 23) for i, d in enumerate(days) if i % 5}

    def net(d):
        value = 1000 + 100 * (d.weekday() == 5) + 60 * (d.day == 15) - 300 * (d in off)
        value += 200 * (d not in off and d.weekday() == 4 and d - dt.timedelta(days=1) in off)
        return value - 40 * math.log1p(rain.get(d, 0.0))

    orders = shop.rel["orders"].schema
    blank = dict.fromkeys(orders.names)
    data = [
        {**blank, "order_id": f"o{i}", "location_id": "silom", "business_date": d, "channel": "dine_in", "is_finalized": True,
         "is_voided": False, "total_thb": round(net(d), 4), "closed_at": dt.datetime.combine(d, dt.time(12))}
        for i, d in enumerate(days)
    ]
    frames = {
        "orders": spark.createDataFrame([tuple(r[c] for c in orders.names) for r in data], ", ".join(
            f"{f.name} {'double' if f.name == 'total_thb' else f.dataType.simpleString()}" for f in orders.fields
        )).withColumn("total_thb", F.col("total_thb").cast("decimal(18,4)")),
        "locations": shop.rel["locations"],
        "holidays": spark.createDataFrame([(d, "x") for d in off], shop.rel["holidays"].schema),
        "weather_daily": spark.createDataFrame([(d, r) for d, r in rain.items()], "d date, rain_mm double"),
    }
    t = Tables(frame_relations(spark, frames), PARAMS)
    got = rows(models.calendar_regression(t), "term")
    for term, effect in {"saturday": 100, "fifteenth": 60, "holiday": -300, "bridge day": 200, "rain": -40, "sunday": 0, "week 3": 0}.items():
        assert abs(got[term]["coefficient"] - effect) < 0.01, term
    assert abs(got["intercept"]["coefficient"] - 1000) < 0.01 and got["rain"]["r_squared"] > 0.99999


def test_attach_regression_of_the_shop(shop):
    got = rows(models.attach_regression(shop), "location_id", "lever", "term")
    assert {k[1] for k in got} == set(models.ATTACH_LEVERS)
    for key, row in got.items():
        assert 0 <= row["hits"] <= row["rows"]
        if row["coefficient"] is not None:
            assert abs(row["odds_ratio"] - math.exp(row["coefficient"])) < 1e-9
