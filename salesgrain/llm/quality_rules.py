"""Quality rules: counts over a text with fixed limits, then a calibrated logistic regression on hashed n-grams.

The rules reject texts of few words and texts of which more than half repeats itself in three-word
windows. What they pass goes to a logistic regression on the words, word pairs and runs of three
characters of a text, hashed to 2**HASH_BITS features; a feature's value is the square root of its share
among the text's n-grams of its kind, so long texts weigh no more than short ones. Weights are found by
L-BFGS; the score is then calibrated on labelled rows that took no part in that, by a logistic curve, so
that it may be read as the probability of label 1. A text is kept from KEEP_FROM on.

The model is fitted on at most MAX_TRAINING_ROWS labelled documents, those with the least hash of doc_id.
The bound holds for fitting only: counts and scores cover every row and whole texts. A hash bound on
doc_id, taken from the number of labels, thins the documents out before they meet labels or one another.
Folds by crc32 of doc_id: 0 takes no part, 1 calibrates, the others give the weights.

Defined cases: a null text counts as empty; a text without words fails the rules and has a score; labels
that are null are left out, and of several for one doc_id the least counts; of several labelled rows with
one doc_id the greatest text is learnt from; a null doc_id is not learnt from; without a label of either
kind every score is the share of label 1 (1.0 without any label); repeated rows each get their own result
row; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesgrain.llm.quality_model import fold
from salesgrain.llm.shared import SPACE_CHARS, Scratch, whole_text
from salesgrain.llm.words import code_points, grams, mixed, powers

MIN_WORDS = 50
MOST_REPEATED = 50  # percent of the words
SYMBOLS = "#*$%&|<>"
KEEP_FROM = 0.5

MAX_TRAINING_ROWS = 8_000
HASH_BITS = 17
RIDGE = 1e-5
STEPS = 60
HISTORY = 8
CALIBRATION_FOLD = 1
HASH_SPAN = 1 << 32

_WORD_RADIX, _CHAR_RADIX = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_SYMBOL_CODES = np.array(sorted(map(ord, SYMBOLS)), dtype=np.uint32)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VERDICT = ", ".join(f"{c} long" for c in COUNTS) + ", score double"


def words_by_space(codes: np.ndarray) -> tuple[np.ndarray, int]:
    """Hashes of the runs of characters that are not white space, and how many characters these are."""
    inside = (codes != 32) & ((codes < 9) | (codes > 13))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), 0
    letters = codes[inside].astype(np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(mixed(letters) * powers(_WORD_RADIX, int(lengths.max()))[place], first)
    return mixed(sums), len(letters)


def repeated_words(words: np.ndarray) -> int:
    """Words within three-word windows that are in the text twice or more."""
    if len(words) < 4:
        return 0
    _, which, times = np.unique(grams(words, 3), return_inverse=True, return_counts=True)
    again = times[which] > 1
    covered = np.zeros(len(words), dtype=bool)
    for i in range(3):
        covered[i : i + len(again)] |= again
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier one."""
    lines = [line for line in text.split("\n") if line.strip(SPACE_CHARS)]
    return len(lines) - len(set(lines))


def features(codes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of a text, and their values."""
    kinds = [words]
    with np.errstate(over="ignore"):
        if len(words) > 1:
            kinds.append(words[:-1] * np.uint64(_WORD_RADIX) + words[1:] + np.uint64(2))
        if len(codes) > 2:
            wide = codes.astype(np.uint64)
            kinds.append(((wide[:-2] * np.uint64(_CHAR_RADIX) + wide[1:-1]) * np.uint64(_CHAR_RADIX) + wide[2:]) + np.uint64(3))
        places, values = [], []
        for hashes in kinds:
            if len(hashes):
                own, n = np.unique((mixed(hashes) >> np.uint64(64 - HASH_BITS)).astype(np.int32), return_counts=True)
                places.append(own)
                values.append(np.sqrt(n / len(hashes)))
    if not places:
        return np.zeros(0, dtype=np.int32), np.zeros(0)
    return np.concatenate(places), np.concatenate(values)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    start: float
    slope: float  # of the calibration
    offset: float

    def raw(self, places: np.ndarray, values: np.ndarray) -> float:
        return self.start + float(self.weights[places] @ values)

    def score(self, raw: float | np.ndarray) -> float | np.ndarray:
        return sigmoid(self.slope * raw + self.offset)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def log_odds(share: float) -> float:
    return float(np.clip(np.log(max(share, 1e-18) / max(1 - share, 1e-18)), -40, 40))


def loss_and_slope(weights, start, places, values, owner, first, y):
    """Mean logistic loss of the rows with the ridge, and its gradient in the weights."""
    z = start + np.add.reduceat(weights[places] * values, first)
    loss = float(np.mean(np.logaddexp(0, z) - y * z)) + RIDGE / 2 * float(weights @ weights)
    error = (sigmoid(z) - y) / len(y)
    return loss, np.bincount(places, error[owner] * values, minlength=len(weights)) + RIDGE * weights


def minimum(gradient_at, n: int) -> np.ndarray:
    """L-BFGS from 0 on, with steps halved until the loss falls enough."""
    at = np.zeros(n)
    loss, slope = gradient_at(at)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        way, used = -slope, []
        for move, change in reversed(moves):
            share = (move @ way) / (move @ change)
            way = way - share * change
            used.append(share)
        if moves:
            move, change = moves[-1]
            way *= (move @ change) / (change @ change)
        for (move, change), share in zip(moves, reversed(used)):
            way += move * (share - (change @ way) / (move @ change))
        length = 1.0 if moves else 1 / max(1e-12, float(np.linalg.norm(slope)))
        fall = float(way @ slope)
        for _ in range(20):
            there = at + length * way
            new_loss, new_slope = gradient_at(there)
            if new_loss <= loss + 1e-4 * length * fall:
                break
            length /= 2
        else:
            break
        move, change = there - at, new_slope - slope
        done = loss - new_loss < 1e-7
        at, loss, slope = there, new_loss, new_slope
        if done:
            break
        if move @ change > 1e-14:
            moves = [*moves, (move, change)][-HISTORY:]
    return at


def calibration(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve that fits the labels, by Newton steps on smoothed labels."""
    n_good, n_bad = float(y.sum()), float(len(y) - y.sum())
    if not n_good or not n_bad:
        return 1.0, 0.0
    target = np.where(y > 0, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    curve = np.array([1.0, 0.0])

    def loss(c):
        z = c[0] * raw + c[1]
        return float(np.sum(np.logaddexp(0, z) - target * z))

    inputs = np.stack([raw, np.ones(len(raw))], axis=1)
    for _ in range(50):
        p = sigmoid(inputs @ curve)
        gradient = inputs.T @ (p - target)
        steps = np.linalg.solve((inputs * (p * (1 - p))[:, None]).T @ inputs + 1e-9 * np.eye(2), gradient)
        size = 1.0
        while loss(curve - size * steps) > loss(curve) and size > 1e-6:
            size /= 2
        curve = curve - size * steps
        if np.abs(size * steps).max() < 1e-9:
            break
    return (float(curve[0]), float(curve[1])) if curve[0] > 0 else (1.0, 0.0)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, calibrates: np.ndarray) -> Model:
    """A model for the features of rows, their labels 0 or 1, and which rows calibrate."""
    n = 1 << HASH_BITS
    share = float(y.mean()) if len(y) else 1.0
    constant = Model(np.zeros(n, dtype=np.float32), log_odds(share), 1.0, 0.0)
    learns = np.flatnonzero(~calibrates & np.array([len(p) > 0 for p, _ in rows], dtype=bool)) if len(rows) else np.zeros(0, int)
    known = y[learns]
    if not 0 < share < 1 or not len(known) or not 0 < known.mean() < 1:
        return constant
    sizes = np.array([len(rows[i][0]) for i in learns])
    places = np.concatenate([rows[i][0] for i in learns])
    values = np.concatenate([rows[i][1] for i in learns])
    owner, first = np.repeat(np.arange(len(learns)), sizes), np.cumsum(sizes) - sizes
    start = log_odds(float(known.mean()))
    weights = minimum(lambda w: loss_and_slope(w, start, places, values, owner, first, known), n)
    model = Model(weights.astype(np.float32), start, 1.0, 0.0)
    held = np.flatnonzero(calibrates)
    raw = np.array([model.raw(*rows[i]) for i in held])
    slope, offset = calibration(raw, y[held]) if len(held) else (1.0, 0.0)
    return Model(model.weights, start, slope, offset)


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """doc_id, text and quality of at most so many labelled documents outside of fold 0."""
    turn = F.pmod(F.xxhash64("doc_id"), F.lit(HASH_SPAN))
    learnt = F.col("doc_id").isNotNull() & (fold("doc_id") != 0)
    known = labels.filter("quality is not null").filter(learnt).groupBy("doc_id").agg(F.min("quality").cast("double").alias("quality"))
    n_known = known.count()
    # so many more than wanted that too few come through less than once in a million times
    below = HASH_SPAN if n_known <= most else min(HASH_SPAN, int(HASH_SPAN * (most + 5 * most**0.5) / n_known))
    near = docs.select("doc_id", whole_text().alias("text")).filter(learnt & (turn < below))
    texts = near.join(known.filter(turn < below), "doc_id").groupBy("doc_id", "quality").agg(F.max("text").alias("text"))
    return texts.orderBy(turn, "doc_id").limit(most)


def train(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS) -> Model:
    """Fits in one task, on the bounded sample; only the model goes to the driver."""
    scratch = Scratch(docs.sparkSession, "rules")

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, y, calibrates = [], [], []
        for batch in batches:
            for text in batch["text"]:
                codes = code_points(text)
                places, values = features(codes, words_by_space(codes)[0])
                rows.append((places, values.astype(np.float32)))
            y += batch["quality"].tolist()
            calibrates += (batch["fold"] == CALIBRATION_FOLD).tolist()
        model = fit(rows, np.array(y), np.array(calibrates, dtype=bool))
        yield pd.DataFrame({
            "weights": [model.weights.tobytes()], "start": [model.start], "slope": [model.slope], "offset": [model.offset],
        })

    sample = scratch.stage("sample", labelled_sample(docs, labels, most).withColumn("fold", fold("doc_id")))
    one = sample.repartition(1).sortWithinPartitions("doc_id")  # bounded by `most`
    found = scratch.stage("model", one.mapInPandas(learn, "weights binary, start double, slope double, offset double")).first()
    if found is None:  # no task, as there is no row
        return fit([], np.zeros(0), np.zeros(0, dtype=bool))
    return Model(np.frombuffer(found["weights"], dtype=np.float32), found["start"], found["slope"], found["offset"])


def measures(model: Model):
    """A column function: the counts and the score of each text."""
    shared = model

    @F.pandas_udf(VERDICT)
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            counts, raw = [], []
            for text in texts:
                codes = code_points(text)
                words, n_chars = words_by_space(codes)
                n_symbols = int(np.isin(codes, _SYMBOL_CODES).sum())
                counts.append((len(words), n_chars, n_symbols, repeated_lines(text), repeated_words(words)))
                raw.append(shared.raw(*features(codes, words)))
            out = pd.DataFrame(counts, columns=list(COUNTS), dtype="int64")
            yield out.assign(score=shared.score(np.array(raw, dtype=float)))

    return measure


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, counts, base_failed, score and kept for each row of docs(doc_id, text)."""
    measure = measures(train(docs, labels))
    found = docs.select("doc_id", measure(whole_text()).alias("found")).select("doc_id", "found.*")
    n_words, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed: Column = (n_words < MIN_WORDS) | (100 * repeated > MOST_REPEATED * n_words)
    return found.select(
        "doc_id", *COUNTS, failed.alias("base_failed"), "score", (~failed & (F.col("score") >= KEEP_FROM)).alias("kept")
    )
