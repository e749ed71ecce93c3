from __future__ import annotations

import random
import re
import zlib

import numpy as np
from corpus_rows import SCHEMA, frame, hard_texts, multiset, prose

from salesgrain.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(text):
    text = text or ""
    words = WORD.findall(text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    where: dict = {}
    for i, w in enumerate(windows):
        where.setdefault(w, []).append(i)
    covered = {i + k for places in where.values() if len(places) > 1 for i in places for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), lines, len(covered), failed)


def junk(seed, n):
    rng = random.Random(seed)
    return " ".join(w + rng.choice(["###", "$$$", "%%%", " |"]) for w in prose(seed, n).split())


def labelled(n):
    docs = [(i, prose(i, 80) if i % 3 else junk(i, 80), "s") for i in range(n)]
    return docs, [(i, 1 if i % 3 else 0, 0) for i in range(n)]


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_counts_of_hard_rows(spark):
    rows = hard_texts() + [
        (50, "a b c a b c a", "s"), (51, "x\n x\nx\n\n\nx", "s"), (52, "one two three\x0bfour\x85five", "s"),
        (53, " ".join(["a b c"] * 40), "s"), (54, prose(9, 49), "s"), (55, prose(9, 50), "s"), (56, "#*$%&|<> <|>", "s"),
        (57, prose(10, 60).replace("\n", " ") + " " + prose(10, 60).replace("\n", " "), "s"),
    ]
    got = rules.apply_rules(frame(spark, rows), labels_of(spark, [(1, 1, 0), (1, None, 1), (None, 0, 0)])).collect()
    assert multiset((r["doc_id"], *[r[c] for c in rules.COUNTS], r["base_failed"]) for r in got) == multiset(
        (d, *brute_force(t)) for d, t, _ in rows
    )
    assert all(r["score"] > 0.999999 and r["kept"] != r["base_failed"] for r in got)  # no label 0: all alike


def test_held_out_rows_are_told_apart(spark):
    docs, labels = labelled(400)
    got = rules.apply_rules(frame(spark, docs), labels_of(spark, labels)).collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 50
    assert all(r["kept"] == bool(r["doc_id"] % 3) for r in held)


def test_labels_of_fold_0_and_order_of_rows_change_nothing(spark):
    docs, labels = labelled(120)
    other = [(d, 1 - q if zlib.crc32(str(d).encode()) % 5 == 0 else q, t) for d, q, t in labels]
    one = rules.apply_rules(frame(spark, docs), labels_of(spark, labels)).collect()
    two = rules.apply_rules(frame(spark, docs[::-1]), labels_of(spark, other[::-1])).collect()
    assert multiset(one) == multiset(two)


def test_sample_is_bounded_and_repeated_rows_count_once(spark):
    docs, labels = labelled(300)
    docs = docs + [(7, "a hot one", "s")] * 200 + [(7, f"another {i}", "s") for i in range(200)]
    sample = rules.labelled_sample(frame(spark, docs), labels_of(spark, labels + [(7, 1, 0), (7, 0, 0)]), 40).collect()
    assert len(sample) == 40 == len({r["doc_id"] for r in sample})
    everyone = rules.labelled_sample(frame(spark, docs), labels_of(spark, labels + [(7, 1, 0), (7, 0, 0)]), 1000).collect()
    folds = {i for i in range(300) if zlib.crc32(str(i).encode()) % 5}
    assert {r["doc_id"] for r in everyone} == folds
    assert [r["quality"] for r in everyone if r["doc_id"] == 7] == ([0.0] if 7 in folds else [])


def test_empty_tables(spark):
    empty, none = spark.createDataFrame([], SCHEMA), labels_of(spark, [])
    assert rules.apply_rules(empty, none).collect() == []
    assert [r["score"] > 0.999999 for r in rules.apply_rules(frame(spark, hard_texts()[:2]), none).collect()] == [True, True]


def test_gradient_is_that_of_the_loss_and_the_minimum_has_none():
    rng = np.random.default_rng(3)
    n, rows = 12, 40
    sizes = rng.integers(1, 6, rows)
    places = np.concatenate([rng.choice(n, s, replace=False) for s in sizes])
    values = rng.random(len(places))
    owner, first = np.repeat(np.arange(rows), sizes), np.cumsum(sizes) - sizes
    y = rng.integers(0, 2, rows).astype(float)

    def at(w):
        return rules.loss_and_slope(w, 0.3, places, values, owner, first, y)

    w = rng.normal(size=n)
    steps = [(at(w + 1e-5 * e)[0] - at(w - 1e-5 * e)[0]) / 2e-5 for e in np.eye(n)]
    assert np.allclose(at(w)[1], steps, atol=1e-6)
    best = rules.minimum(at, n)
    assert at(best)[0] < at(w)[0] and np.abs(at(best)[1]).max() < 2e-3


def test_calibrated_scores_are_probabilities():
    rng = np.random.default_rng(5)
    raw = rng.normal(size=40_000) * 3
    y = (rng.random(len(raw)) < rules.sigmoid(0.4 * raw - 0.7)).astype(float)
    slope, offset = rules.calibration(raw, y)
    assert abs(slope - 0.4) < 0.02 and abs(offset + 0.7) < 0.03
    assert rules.calibration(raw, np.ones(len(raw))) == (1.0, 0.0)
