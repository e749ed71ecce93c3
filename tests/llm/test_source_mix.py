from __future__ import annotations

import itertools
import json
import random
import re
from collections import Counter

import pytest
from corpus_rows import SCHEMA, frame, hard_texts, quotas
from pyspark.sql import functions as F

from salesgrain.llm import source_mix as sm


def targets(spark, sizes, weights):
    rows = [(i, n, float(w)) for i, (n, w) in enumerate(zip(sizes, weights))]
    got = sm.with_targets(spark.createDataFrame(rows, "place int, source_size long, weight double"), sum(sizes)).collect()
    return [r["target"] for r in sorted(got, key=lambda r: r["place"])]


def test_quotas_stop_at_the_limit_and_share_the_excess(spark):
    assert targets(spark, [10, 10, 10], [1, 2, 3]) == [5, 10, 15]
    got = targets(spark, [1, 100, 100, 1], [1, 2, 3, 1])
    assert got[0] == 3 and got[3] == 3 and sum(got) == pytest.approx(202) and got[2] / got[1] == pytest.approx(1.5)
    assert targets(spark, [], []) == [] and targets(spark, [0, 0], [1, 2]) == [0, 0]
    rng = random.Random(8)
    sizes, weights = [rng.choice([0, 1, 5, 90, 4_000]) for _ in range(60)], [rng.randint(1, 9) for _ in range(60)]
    assert targets(spark, sizes, weights) == quotas(sizes, weights, sum(sizes))


def best_flow(capacities, members, demands, max_repeats):
    """Most words, then least cost, over all whole-number flows."""
    best = (0, 0)
    options = []
    for c, own in zip(capacities, members):
        options.append([x for x in itertools.product(range(c * max_repeats + 1), repeat=len(own)) if sum(x) <= c * max_repeats])
    for choice in itertools.product(*options):
        got = Counter()
        for own, sent in zip(members, choice):
            for s, n in zip(own, sent):
                got[s] += n
        if all(got[s] <= d for s, d in enumerate(demands)):
            cost = sum(max(0, min(sum(x) - r * c, c)) * r for c, x in zip(capacities, choice) for r in range(max_repeats))
            best = max(best, (sum(got.values()), -cost))
    return best


def test_flow_is_least_cost():
    rng = random.Random(3)
    for _ in range(40):
        n = rng.randint(1, 3)
        members = [sorted(rng.sample(range(3), rng.randint(1, 2))) for _ in range(n)]
        capacities, demands = [rng.randint(0, 2) for _ in range(n)], [rng.randint(0, 4) for _ in range(3)]
        flow = sm.Flow(capacities, members, demands, 2)
        cost = 0
        for c, own, sent in zip(capacities, members, flow.sent):
            assert set(sent) <= set(own) and sum(sent.values()) <= 2 * c
            cost += sum(max(0, min(sum(sent.values()) - r * c, c)) * r for r in range(2))
        assert (sum(sum(x.values()) for x in flow.sent), -cost) == best_flow(capacities, members, demands, 2)


def test_hard_rows(spark):
    rows = hard_texts() + [(100 + i, "w " * (i % 17), "g") for i in range(300)]
    got = sm.mix_documents(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter((d, size(t), s) for d, t, s in rows)
    names = sorted({s for _, _, s in rows if s is not None}) + [None]
    sizes = [sum(size(t) for _, t, s in rows if s == name) for name in names]
    targets = dict(zip(names, quotas(sizes, [1.0 + i % 3 for i in range(len(names))], sum(sizes))))
    for name, total in zip(names, sizes):
        own = [r for r in got if r["source"] == name]
        assert {r["source_size"] for r in own} == {total}
        assert all(r["target"] == pytest.approx(targets[name]) and r["taken"] <= 3 * r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - targets[name]) <= max(r["size"] for r in own) / 2 + 1
    again = sm.mix_documents(frame(spark, rows[::-1])).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_overlapping_sources(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), (F.col("id") % 9 + 1).alias("size"),
        F.expr("case id % 3 when 0 then array('x') when 1 then array('y', 'x') else array('y', null) end").alias("sources"),
    )
    copies, sources = sm.mix(docs, weight=lambda place: F.lit(1.0))
    rows = copies.collect()
    assert all(set(r["copies"]) <= set(r["sources"]) and len(r["copies"]) <= 3 for r in rows)
    targets = {r["source"]: r["target"] for r in sources.collect()}
    assert set(targets) == {"x", "y", None} and sum(targets.values()) == pytest.approx(sum(r["size"] for r in rows))
    for name, target in targets.items():
        got = sum(r["size"] for r in rows for c in r["copies"] if c == name)
        assert abs(got - target) <= 30


def test_components_are_solved_as_the_whole_flow_would_be(spark):
    rng = random.Random(11)
    names = [f"s{i:02d}" for i in range(24)]
    rows = []
    for i in range(600):
        k = rng.randrange(24)
        own = [names[k]] if k % 4 == 0 else [names[k], names[min(k + 1, k // 4 * 4 + 3)]]  # chains of three beside single ones
        rows.append((i, rng.randint(1, 40), own[:: rng.choice([1, -1])]))
    docs = spark.createDataFrame(rows, "doc_id long, size long, sources array<string>")
    copies, sources = sm.mix(docs)
    capacity = Counter()
    for _, size, own in rows:
        capacity[tuple(sorted(set(own)))] += size
    patterns = sorted(capacity, key=lambda own: json.dumps([{"s": s} for s in own], separators=(",", ":")))
    target = {r["source"]: r["target"] for r in sources.collect()}
    used = sorted(target)
    whole = sm.Flow(
        [capacity[p] for p in patterns], [[used.index(s) for s in p] for p in patterns], [round(target[s]) for s in used], 3
    )
    got = Counter()
    for r in copies.collect():
        for source in r["copies"]:
            got[tuple(sorted(set(r["sources"]))), source] += r["size"]
    for p, sent in zip(patterns, whole.sent):
        for s in p:
            assert abs(got[p, s] - sent.get(used.index(s), 0)) <= 40  # whole documents against words


def test_more_sources_than_a_driver_should_hold(spark):
    n = 60_000
    docs = spark.range(2 * n).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 5 + 1).cast("int")).alias("text"),
        F.format_string("%06d", F.col("id") % n).alias("source"),
    )
    got = sm.mix_documents(docs)
    assert got.count() == 2 * n
    own = got.groupBy("source").agg(
        F.first("source_size").alias("size"), F.first("target").alias("target"), F.sum("taken").alias("taken"), F.max("size").alias("most")
    ).toPandas().sort_values("source")
    want = quotas(own["size"].tolist(), [1.0 + i % 3 for i in range(n)], int(own["size"].sum()))
    assert len(own) == n and own["target"].tolist() == pytest.approx(want)
    assert ((own["taken"] - own["target"]).abs() <= own["most"] / 2 + 1).all()


def test_a_chain_of_sources_is_one_component(spark):
    members = [(f"p{i}", place) for i in range(40) for place in (i, i + 1)] + [("q", 50), ("q", 52), ("r", 51)]
    got = sm.components(spark.createDataFrame(members, "pattern string, place long"), sm.Scratch(spark, "test"))
    assert {r["place"]: r["component"] for r in got.collect()} == {**dict.fromkeys(range(41), 0), 50: 50, 52: 50, 51: 51}


def test_drawn_rows_have_all_columns_and_empty_tables_stay_empty(spark):
    docs = frame(spark, hard_texts())
    out = sm.draw_documents(docs)
    assert out.columns == [*docs.columns, "copies"] and all(r["copies"] >= 1 for r in out.collect())
    empty = spark.createDataFrame([], SCHEMA)
    assert sm.mix_documents(empty).collect() == [] == sm.draw_documents(empty).collect()
