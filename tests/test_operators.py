"""Generic operators against brute force."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from salesgrain.operators.asof import latest_at_or_before
from salesgrain.operators.median import exact_percentiles
from salesgrain.operators.ranks import best_other, in_rolling_windows, smaller_target, with_peers


def test_asof_matches_brute_force_with_a_hot_group(spark):
    rng = random.Random(3)
    day = dt.datetime(2026, 10, 7)
    data = []
    for i in range(1200):
        table = 0 if rng.random() < 0.5 else rng.randint(1, 6)  # half of all rows on one table
        start = day + dt.timedelta(minutes=rng.randint(0, 300), seconds=rng.choice((0, 0, 20, 40)))
        data.append((i, table, start, rng.random() < 0.3))
    df = spark.createDataFrame(data, "id bigint, tab int, start timestamp_ntz, master boolean")
    got = rows(latest_at_or_before(df, ["tab"], "start", F.col("master"), "id", "found"), "id")
    for i, table, start, _ in data:
        earlier = [(s, j) for j, t, s, m in data if m and t == table and s <= start]
        assert got[i]["found"] == (max(earlier)[1] if earlier else None)


def test_asof_spreads_a_group_over_minutes(spark):
    df = spark.createDataFrame([], "id bigint, tab int, start timestamp_ntz, master boolean")
    found = latest_at_or_before(df, ["tab"], "start", F.col("master"), "id", "found")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(tab" in plan and "_minute" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_percentile_matches_numpy(spark):
    rng = random.Random(5)
    data = [(g, rng.randint(0, 50)) for g in (1, 1, 1, 2, 3) for _ in range(rng.randint(1, 90))]
    df = spark.createDataFrame(data, "g int, v bigint").unionByName(
        spark.createDataFrame([(1, None)], "g int, v bigint")
    )
    for share, width in ((0.5, 1), (0.9, 7), (0.5, 1000), (0.0, 10), (1.0, 10)):
        got = rows(exact_percentiles(df, ["g"], "v", {"p": share, "q": 0.25}, "n", width), "g")
        for g in (1, 2, 3):
            values = [v for k, v in data if k == g]
            assert got[g]["n"] == len(values)
            assert abs(got[g]["p"] - np.percentile(values, share * 100)) < 1e-9
            assert abs(got[g]["q"] - np.percentile(values, 25)) < 1e-9


def test_percentiles_read_their_input_once(spark):
    df = spark.range(100).withColumn("g", F.lit(1)).repartition(3, "id")
    found = exact_percentiles(df, ["g"], "id", {"a": 0.5, "b": 0.9}, "n", 10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "Join" not in plan
    assert tuple(round(x, 9) for x in found.first()) == (1, 100, 49.5, 89.1)


def test_rolling_windows_match_the_definition(spark):
    as_of = dt.date(2026, 10, 9)
    days = [as_of - dt.timedelta(days=i) for i in range(0, 95)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {(r["d"], r["window_start"]) for r in in_rolling_windows(df, "d", as_of, 28, 7, 8).collect()}
    want = set()
    for k in range(9):
        start, end = as_of - dt.timedelta(days=28 + 7 * k), as_of - dt.timedelta(days=1 + 7 * k)
        want |= {(d, start) for d in days if start <= d <= end}
    assert got == want


def test_peers(spark):
    data = [("x", "a", 0.5), ("x", "b", 0.4), ("x", "c", 0.4), ("y", "a", 0.9), ("y", "b", None)]
    pool = spark.createDataFrame(data, "g string, who string, rate double")
    other = rows(best_other(pool, pool, ["g"], "who", "rate"), "g", "who")
    assert other["x", "a"]["best_who"] == "b" and other["x", "b"]["best_who"] == "a"
    assert other["y", "a"]["best_rate"] is None
    in_windows = rows(with_peers(pool, ["g"], "who", "rate", F.lit(True), F.lit(True), 3), "g", "who")
    for key, row in other.items():
        assert (in_windows[key]["best_who"], in_windows[key]["best_rate"]) == (row["best_who"], row["best_rate"])
    assert {r["peer_who"] for k, r in in_windows.items() if k[0] == "x"} == {"b"}
    assert {r["peer_rate"] for k, r in in_windows.items() if k[0] == "y"} == {None}  # too few for a runner-up


def test_peers_match_brute_force(spark):
    rng = random.Random(8)
    data = [(g, f"b{i:02d}", rng.choice([None, 0.1, 0.2, 0.3, 0.4]), rng.random() < 0.7, rng.random() < 0.5)
            for g in range(30) for i in range(rng.randint(1, 7))]
    df = spark.createDataFrame(data, "g int, who string, rate double, pooled boolean, good boolean")
    got = rows(with_peers(df, ["g"], "who", "rate", F.col("pooled"), F.col("pooled") & F.col("good"), 2), "g", "who")

    def leaders(g, own, keep):
        found = [(r is None, -(r or 0), w, r) for k, w, r, *c in data if k == g and w != own and keep(*c)]
        return [(w, r) for _, _, w, r in sorted(found)]

    for g, who, *_ in data:
        best = (leaders(g, who, lambda pooled, good: pooled) + [(None, None)])[0]
        assert (got[g, who]["best_who"], got[g, who]["best_rate"]) == best
        good = leaders(g, None, lambda pooled, good: pooled and good)
        assert (got[g, who]["peer_who"], got[g, who]["peer_rate"]) == (good[1] if len(good) > 1 else (None, None))


def test_smaller_target_ignores_targets_not_above(spark):
    df = spark.createDataFrame([(0.5, 0.4, 0.7), (0.5, 0.6, 0.7), (0.5, 0.5, None)], "c double, a double, b double")
    got = [r[0] for r in df.select(smaller_target(F.col("c"), F.col("a"), F.col("b"))).collect()]
    assert got == [0.7, 0.6, None]
