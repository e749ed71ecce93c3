from __future__ import annotations

import math
import random

import numpy as np
import pytest
from corpus_rows import multiset

from salesgrain.llm.hard_negatives import Fields, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, row string, block long, score double"


def brute_force(rows, every):
    usable = []
    for number, (vec_id, vector, label, *_) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        usable.append((number, vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))

    def order(found):
        return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0, f[2]))

    out = []
    for a, anchor_id, label, vector in usable:
        if anchor_id is None or anchor_id % every:
            continue
        scored = [(sum(x * y for x, y in zip(vector, v)), i, n, lab) for n, i, lab, v in usable]
        positives = order([s for s in scored if s[3] == label and s[2] != a])[:5]
        others = order([s for s in scored if s[3] != label])
        for p in positives:
            fit = [s for s in others if 30 * p[0] <= 100 * s[0] <= 90 * p[0]][:10]
            out += [(anchor_id, p[1], r, s[1], p[0], s[0]) for r, s in enumerate(fit, 1)]
    return multiset(out)


def random_rows(seed, n, dims=6, size=1.0, labels=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        vector = [rng.choice([-1, -0.5, 0, 0.25, 0.5, 1]) * size + rng.random() * 0.01 for _ in range(dims)]
        out.append((i, vector, rng.randrange(labels), "x", 1, 0.5))
    return out


def mine(spark, rows, **kw):
    return multiset(hard_negatives(spark.createDataFrame(rows, SCHEMA), **kw).collect())


def test_many_blocks_and_groups_give_what_brute_force_gives(spark):
    rows = random_rows(1, 300)
    want = brute_force(rows, 10)
    assert len(want) > 500
    assert mine(spark, rows, anchor_every=10, block_rows=40, group_anchors=7) == want
    assert mine(spark, rows, anchor_every=10) == want


def test_hard_rows(spark):
    rows = random_rows(2, 60, dims=3)
    same = (30, [0.5, 0.5, 0.5], 1, "x", 1, 0.5)
    rows += [same, same, same, (20, [0.5, 0.5, 0.5], 2, "x", 1, 0.5)]  # repeated rows, ties
    rows += [(100 + i, [1.0, 0.25, 0.0], i % 3, "x", 1, 0.5) for i in range(40)]  # a group of copies
    rows += [
        (None, [1.0, 1.0, 1.0], 1, "x", 1, 0.5), (200, None, 1, "x", 1, 0.5), (210, [1.0, 2.0, 3.0], None, "x", 1, 0.5),
        (220, [1.0, None, 3.0], 1, "x", 1, 0.5), (230, [1.0, float("nan"), 3.0], 1, "x", 1, 0.5),
        (240, [float("inf"), 1.0, 1.0], 1, "x", 1, 0.5), (250, [], 1, "x", 1, 0.5), (260, [1.0], 2, "x", 1, 0.5),
        (-70, [1.0, 1.0, 0.5], 0, "x", 1, 0.5),
    ]
    assert mine(spark, rows, anchor_every=10, block_rows=16, group_anchors=4) == brute_force(rows, 10)


@pytest.mark.parametrize("size", [100.0, 1e6])
def test_components_of_any_size_are_exact(spark, size):
    rows = random_rows(3, 80, dims=5, size=size)
    assert mine(spark, rows, anchor_every=10, block_rows=30) == brute_force(rows, 10)


def test_an_empty_table_and_one_label(spark):
    assert mine(spark, []) == {}
    assert mine(spark, [(100, [1.0], 1, "x", 1, 0.5)]) == {}
    assert mine(spark, [(100 * i, [1.0], 1, "x", 1, 0.5) for i in range(1, 5)]) == {}


def test_several_candidates_share_a_word_and_their_products_stay_apart():
    rng = np.random.default_rng(1)
    for high, wide in ((3, False), (300, False), (1 << 28, True)):
        a, c = rng.integers(-high, high + 1, (9, 16)), rng.integers(-high, high + 1, (23, 16))
        a[0], c[0] = -high, high  # the extremes
        fields = Fields.of(16, -high, high)
        assert fields.wide == wide and fields.per_word > 1
        words = fields.pack(c)
        assert words.shape == (16, -(-23 // fields.per_word))
        want = a.astype(object) @ c.T.astype(object)
        assert (fields.scores(a, words, c) == want).all()
