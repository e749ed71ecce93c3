from __future__ import annotations

import os
import zlib

import numpy as np
import pytest
from corpus_rows import SCHEMA, frame, hard_texts

from salesgrain.llm import quality_model as qm

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@needs_data
def test_held_out_accuracy_and_folds(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in qm.score_documents(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    held = [(r["quality"], got[r["doc_id"]]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    right = sum(q == r["predicted"] for q, r in held) / len(held)
    assert right >= 0.95
    # held-out labels have no influence
    import pyspark.sql.functions as F

    flipped = labels.withColumn("quality", F.when(qm.fold("doc_id") == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in qm.score_documents(docs, flipped).collect()}
    assert all(again[d] == r["score"] for d, r in got.items())


def walk(trees: qm.Trees, row: np.ndarray) -> float:
    total = trees.start
    for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        total += leaf[node - len(feature)]
    return 1 / (1 + np.exp(-total))


def test_trees_learn_and_arrays_traverse_like_a_walk():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] * x[:, 1] > 0) & (x[:, 2] > -1)).astype(float)
    trees = qm.fit(x[:1500], y[:1500])
    score = trees.score(x[1500:])
    assert ((score > 0.5) == y[1500:]).mean() > 0.95
    assert np.allclose(score[:50], [walk(trees, row) for row in x[1500:1550]])


def test_hard_rows_and_odd_labels(spark):
    docs = frame(spark, hard_texts())
    labels = spark.createDataFrame([(9, 1), (9, 0), (11, 1), (12, 0), (13, None), (None, 1), (999, 0)], "doc_id long, quality int")
    got = qm.score_documents(docs, labels).collect()
    assert len(got) == len(hard_texts()) and all(0 <= r["score"] <= 1 for r in got)
    kept = qm.keep_good(docs, labels)
    assert kept.columns == docs.columns
    accepted = sorted(str(r["doc_id"]) for r in got if r["predicted"] == 1)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == accepted
    none = qm.score_documents(docs, labels.limit(0)).collect()
    assert all(r["score"] > 0.999 for r in none)
    assert qm.score_documents(spark.createDataFrame([], SCHEMA), labels).collect() == []


def test_statistics_of_an_empty_text_and_of_one_class():
    assert qm.statistics("") == [0.0] * len(qm.STATISTICS)
    assert len(qm.statistics("A b\n\n!")) == len(qm.STATISTICS)
    assert qm.fit(np.zeros((5, 2)), np.zeros(5)).score(np.zeros((2, 2))).max() < 1e-9


def test_training_rows_are_the_least_hashes_and_meet_bounded(spark):
    import pyspark.sql.functions as F

    ids = spark.range(5000).withColumnRenamed("id", "doc_id")
    assert qm.least_hashes(ids, 5000) is None
    turns = sorted((r[0], r[1]) for r in ids.select(F.xxhash64("doc_id"), "doc_id").collect())
    for limit, bits in ((1, 16), (700, 16), (700, 3)):
        got = {r["doc_id"] for r in ids.filter(qm.least_hashes(ids, limit, bits)).collect()}
        assert {d for _, d in turns[:limit]} <= got
        assert len(got) == limit if bits == 16 else len(got) <= limit + 200


def test_fit_uses_the_bounded_rows_only(spark, monkeypatch):
    import pyspark.sql.functions as F

    seen = []
    monkeypatch.setattr(qm, "fit", lambda x, y: seen.append((x[:, 0].tolist(), y.tolist())))
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.array(F.col("id").cast("double")).alias("statistics"))
    rows = rows.unionByName(rows.filter("doc_id < 50"))  # repeated rows train once
    labels = spark.range(600).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    qm.train(rows, labels, F.col("statistics"), limit=60)
    train_ids = rows.select("doc_id").distinct().filter(qm.fold("doc_id") != 0)
    want = [r["doc_id"] for r in train_ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(60).collect()]
    assert seen == [([float(d) for d in want], [float(d % 2) for d in want])]


def split_by_hand(x, grad, weight):
    """The best gain over all features and all values as thresholds."""
    def part(rows):
        return grad[rows].sum() ** 2 / (weight[rows].sum() + qm.RIDGE)

    return max(
        part(x[:, f] <= v) + part(x[:, f] > v) - part(np.ones(len(x), dtype=bool))
        for f in range(x.shape[1]) for v in np.unique(x[:, f])[:-1]
        if min(weight[x[:, f] <= v].sum(), weight[x[:, f] > v].sum()) >= qm.MIN_WEIGHT
    )


def test_best_splits_against_all_thresholds():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, size=(200, 4)).astype(float)
    grad, weight = rng.normal(size=200), rng.uniform(0.1, 0.3, size=200)
    cuts = [np.unique(x[:, f])[:-1] for f in range(4)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    node = (x[:, 3] > 4).astype(np.int64)
    feature, cut = qm.best_splits(binned, node, grad, weight, 2, cuts)
    for n in (0, 1):
        own = node == n
        left = x[own][:, feature[n]] <= cuts[feature[n]][cut[n]]
        g, w = grad[own], weight[own]
        gain = (
            g[left].sum() ** 2 / (w[left].sum() + qm.RIDGE) + g[~left].sum() ** 2 / (w[~left].sum() + qm.RIDGE)
            - g.sum() ** 2 / (w.sum() + qm.RIDGE)
        )
        assert np.isclose(gain, split_by_hand(x[own], g, w))


def test_statistics_by_hand():
    got = dict(zip(qm.STATISTICS, qm.statistics("Ab ab ab\n1, 2\nAb ab ab")))
    n = 22
    assert np.isclose(got["share_upper"], 2 / n) and np.isclose(got["share_lower"], 10 / n)
    assert np.isclose(got["share_digit"], 2 / n) and np.isclose(got["share_comma"], 1 / n)
    assert np.isclose(got["share_newline"], 2 / n) and np.isclose(got["share_space"], 5 / n)
    assert np.isclose(got["log_bytes"], np.log1p(n)) and np.isclose(got["log_words"], np.log1p(8))
    assert np.isclose(got["distinct_words"], 4 / 8) and np.isclose(got["word_is_top"], 4 / 8)
    assert np.isclose(got["distinct_lines"], 2 / 3) and np.isclose(got["longest_word"], np.log1p(2))
