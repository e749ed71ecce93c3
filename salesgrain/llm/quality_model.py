"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are counts and ratios over a whole text. Trees are complete to a fixed depth, grown level by
level on histograms of binned features with logistic loss, and kept as three arrays (feature, threshold,
leaf value), which whole batches of rows traverse at once.

The model is fitted on at most MAX_TRAINING_ROWS labelled doc_ids, those with the least hash. The bound is
found from counts of hashes, so rows beyond it never meet. It holds for fitting only: statistics and scores
cover every row. Labels are the only other input.

Defined cases: a null text counts as empty, an empty one has all statistics 0 and a score; labels that
are null are left out, and of several for one doc_id the least counts; a null doc_id is held out; of rows
that repeat a doc_id the one with the least statistics trains; without
a label of either kind every score is the share of label 1 (1.0 without any label); repeated rows each get
their own result row; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesgrain.llm.shared import Scratch, unused_name, whole_text

MAX_TRAINING_ROWS = 100_000
HELD_OUT_FOLDS = 5
ACCEPTED = 0.3
TREES, DEPTH, BINS, RATE, RIDGE, MIN_WEIGHT = 120, 4, 64, 0.1, 1.0, 1.0

# byte classes whose share of a text is a statistic
CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "comma", "mark", "pipe", "symbol", "markup", "other", "control")
_CLASS_OF = np.full(256, CLASSES.index("other"), dtype=np.uint8)
for _name, _chars in (
    ("lower", bytes(range(97, 123))), ("upper", bytes(range(65, 91))), ("digit", bytes(range(48, 58))),
    ("space", b" "), ("newline", b"\n"), ("stop", b"."), ("comma", b",;:"), ("mark", b"!?"), ("pipe", b"|"),
    ("symbol", b"#$%&*+=@^_~"), ("markup", b"<>{}[]()/\\\"'`-"), ("control", bytes([*range(10), *range(11, 32), 127])),
):
    _CLASS_OF[list(_chars)] = CLASSES.index(_name)
STATISTICS = (
    *(f"share_{name}" for name in CLASSES),
    "log_bytes", "log_words", "mean_word", "longest_word", "distinct_words", "distinct_lines", "mean_line", "word_is_top",
)


def statistics(text: str) -> list[float]:
    """The statistics of a text, in the order of STATISTICS."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(raw):
        return [0.0] * len(STATISTICS)
    shares = np.bincount(_CLASS_OF[raw], minlength=len(CLASSES)) / len(raw)
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    counts = Counter(words)
    n = max(1, len(words))
    return [
        *shares,
        float(np.log1p(len(raw))), float(np.log1p(len(words))), (len(text) - len(words)) / n,
        float(np.log1p(max(map(len, words), default=0))), len(counts) / n,
        len(set(lines)) / max(1, len(lines)), float(np.log1p(len(text) / max(1, len(lines)))),
        max(counts.values(), default=0) / n,
    ]


def statistics_of(text: Column) -> Column:
    return F.pandas_udf(_statistics, "array<double>")(text)


def _statistics(texts: pd.Series) -> pd.Series:
    return texts.map(statistics)


@dataclass(frozen=True)
class Trees:
    """Complete trees: node k of a level has children 2k + 1 and 2k + 2 in the next."""

    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes)
    leaf: np.ndarray  # (trees, leaves)
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            while len(x) and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - len(feature)] if len(x) else 0.0
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees for rows of statistics and labels 0 or 1."""
    n_inner, n_leaves = 2**DEPTH - 1, 2**DEPTH
    share = float(y.mean()) if len(y) else 1.0
    if not 0 < share < 1:
        none = np.zeros((0, n_inner))
        return Trees(none.astype(np.int64), none, np.zeros((0, n_leaves)), 40.0 if share else -40.0)
    start = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    trees = np.zeros((TREES, n_inner), dtype=np.int64), np.zeros((TREES, n_inner)), np.zeros((TREES, n_leaves))
    total = np.full(len(y), start)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-total))
        grad, weight = p - y, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            offset, width = 2**level - 1, 2**level
            feature, cut = best_splits(binned, node - offset, grad, weight, width, cuts)
            trees[0][t, offset : offset + width] = feature
            trees[1][t, offset : offset + width] = [cuts[f][c] if c < len(cuts[f]) else np.inf for f, c in zip(feature, cut)]
            own = node - offset
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature[own]] > cut[own])
        own = node - n_inner
        g = np.bincount(own, grad, minlength=n_leaves)
        h = np.bincount(own, weight, minlength=n_leaves)
        trees[2][t] = -RATE * g / (h + RIDGE)
        total += trees[2][t][own]
    return Trees(*trees, start)


def best_splits(binned, node, grad, weight, width, cuts) -> tuple[np.ndarray, np.ndarray]:
    """For each node of a level, the feature and the last bin that goes left; all left where nothing gains."""
    best = np.full(width, 1e-6)
    feature, cut = np.zeros(width, dtype=np.int64), np.full(width, BINS, dtype=np.int64)
    for f in range(binned.shape[1]):
        if not len(cuts[f]):
            continue
        cell = node * BINS + binned[:, f]
        g = np.bincount(cell, grad, minlength=width * BINS).reshape(width, BINS).cumsum(axis=1)
        h = np.bincount(cell, weight, minlength=width * BINS).reshape(width, BINS).cumsum(axis=1)
        all_g, all_h = g[:, -1:], h[:, -1:]
        gain = g**2 / (h + RIDGE) + (all_g - g) ** 2 / (all_h - h + RIDGE) - all_g**2 / (all_h + RIDGE)
        gain[(h < MIN_WEIGHT) | (all_h - h < MIN_WEIGHT)] = 0
        at = gain[:, : len(cuts[f])].argmax(axis=1)
        value = gain[np.arange(width), at]
        better = value > best
        best[better], feature[better], cut[better] = value[better], f, at[better]
    return feature, cut


def fold(doc_id: str) -> Column:
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(HELD_OUT_FOLDS))


def least_hashes(ids: DataFrame, limit: int, bits: int = 16) -> Column | None:
    """A test of doc_id that holds for the limit least hashes of ids(doc_id), distinct ones, and hardly more.

    The hash is cut twice, each time at one of 2^bits counted steps; None where all ids are within the limit.
    """
    if ids.count() <= limit:
        return None
    turn = F.xxhash64("doc_id")
    step, found, left = turn, ids, limit
    for level in (1, 2):
        step = F.shiftright(turn, 64 - level * bits)
        for row in found.groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy("step").collect():  # 2^bits at most
            if row["n"] >= left:
                break
            left -= row["n"]
        found, last = found.filter(step == row["step"]), row["step"]
    return step <= last


def train(rows: DataFrame, labels: DataFrame, described: Column, limit: int = MAX_TRAINING_ROWS) -> Trees:
    """Fits on the labelled rows(doc_id, ...) that are not held out; described gives a row's statistics."""
    known = (
        labels.filter(F.col("quality").isNotNull() & (fold("doc_id") != 0))
        .groupBy("doc_id").agg(F.min("quality").cast("double").alias("quality"))
    )
    if known.count() > limit:
        within = least_hashes(known.join(rows.select("doc_id"), "doc_id", "left_semi").select("doc_id"), limit)
        if within is not None:
            known, rows = known.filter(within), rows.filter(within)
    chosen = (
        rows.join(known, "doc_id").select("doc_id", "quality", described.alias("statistics"))
        .groupBy("doc_id", "quality").agg(F.min("statistics").alias("statistics"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).select("statistics", "quality").toPandas()
    )
    if not len(chosen):
        return fit(np.zeros((0, len(STATISTICS))), np.zeros(0))
    return fit(np.stack(chosen["statistics"]).astype(float), chosen["quality"].to_numpy())


def scorer(trees: Trees):
    """A column function: the score of each row of statistics."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.stack(batch) if len(batch) else np.zeros((0, len(STATISTICS)))
            yield pd.Series(trees.score(x.astype(float)))

    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs(doc_id, text)."""
    scratch = Scratch(docs.sparkSession, "quality")
    described = scratch.stage("statistics", docs.select("doc_id", statistics_of(whole_text()).alias("statistics")))
    score = scorer(train(described, labels, F.col("statistics")))
    scored = described.select("doc_id", (fold("doc_id") == 0).alias("held_out"), score("statistics").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= ACCEPTED, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier accepts, with all their columns."""
    texts = docs.select("doc_id", whole_text().alias("text"))
    score = scorer(train(texts, labels, statistics_of(F.col("text"))))
    name = unused_name(docs, "score")
    return docs.withColumn(name, score(statistics_of(whole_text(docs["text"])))).filter(F.col(name) >= ACCEPTED).drop(name)
