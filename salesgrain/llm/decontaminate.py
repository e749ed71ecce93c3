"""Benchmark decontamination: rare words of items as seeds, then Smith-Waterman alignment of words.

A match gives 2, a mismatch and a gap cost 1. The score is the alignment's share of what the whole item
would give, and edited copies keep most of it. A score of MIN_SCORE takes that share of the item's words as
matches, so of any more words than may be missing a copy has some. The words of all test items are counted
over the whole corpus, and the rarest of an item are its seeds: as many as may be missing, and a third of the
matches beyond them. Wherever a copy is, at least that third of the matches are seeds, whatever the edits are,
and where a document has so many of an item's seeds within reach, it is aligned with the item word by word.
Counts decide the cost alone: an item's seeds find all its copies, be they rare or not. Only a stretch that
shares as many words with the item, in its order, as the score takes is aligned. Texts are taken in blocks, so
that a short text costs its words and not a round of array calls.

Items are matched in slices of at most SLICE_ITEMS, the only thing tasks hold besides their own rows;
a larger benchmark means further passes over the documents.

Defined cases: a null text has no words and no leak; items of fewer than RUN_WORDS words are searched
as whole runs, as an edit would leave nothing that is theirs; items without a word have no copies; repeated items are reported each; repeated rows and null doc_ids are
reported each; an empty table on either side gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesgrain.llm.shared import Scratch, unused_name
from salesgrain.llm.words import words_of, words_of_texts

RUN_WORDS = 3
MATCH, MISMATCH, GAP = 2, -1, 1
MIN_SCORE = 0.6
SLICE_ITEMS = 10_000
HITS_AT_ONCE = 1_000_000
LEAKS = "array<struct<item_id:bigint,score:double,first_word:bigint,last_word:bigint>>"


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """Best local alignment score and the place in the window where it ends (exclusive)."""
    steps = GAP * np.arange(len(window) + 1)
    above = np.zeros(len(window) + 1, dtype=np.int64)
    best, end = 0, 0
    for word in item:
        row = np.zeros(len(window) + 1, dtype=np.int64)
        row[1:] = np.maximum(above[:-1] + np.where(window == word, MATCH, MISMATCH), above[1:] - GAP)
        row = np.maximum(np.maximum.accumulate(np.maximum(row, 0) + steps) - steps, 0)
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
        above = row
    return best, end


def matches_needed(n: int, min_score: float) -> int:
    """The least matches that an alignment of a score has with an item of n words."""
    return max(1, math.ceil(min_score * n - 1e-9))


def reach_of(n: int, min_score: float) -> int:
    """The most words of a document that an alignment of a score with an item of n words spans.

    What the matches of the whole item give beyond the score pays for added words.
    """
    return n + math.floor(MATCH * (1 - min_score) * n / GAP + 1e-9)


def longest_shared(item: list[int], window: list[int]) -> int:
    """The most words that an item and a window share in order, by bits: one for each word of the item.

    A bit of `steps` is clear where the longest row of words shared with the item so far grows by one.
    """
    places: dict[int, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    everything = (1 << len(item)) - 1
    steps = everything
    for word in window:
        met = steps & places.get(word, 0)
        steps = ((steps + met) | (steps - met)) & everything
    return len(item) - steps.bit_count()


class KnownCodes:
    """Sorted distinct codes, and a table of their first bits that turns most other words away."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        bits = max(16, (16 * len(codes)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first_bits = np.zeros(1 << bits, dtype=bool)
        self.first_bits[codes >> self.shift] = True

    def found(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of the words that are known, and which codes these are."""
        places = np.flatnonzero(self.first_bits[words >> self.shift])
        at = np.searchsorted(self.codes, words[places])
        same = np.flatnonzero(self.codes[np.minimum(at, len(self.codes) - 1)] == words[places])
        return places[same], at[same]


class Items:
    """Test items by their seeds."""

    def __init__(self, items: list[tuple[int, np.ndarray]], counts: dict[int, int], min_score: float):
        self.items = items
        self.sorted_words = [np.unique(words) for _, words in items]
        self.min_scores = [min_score if len(words) >= RUN_WORDS else 1.0 for _, words in items]
        sized = [(len(words), score) for (_, words), score in zip(items, self.min_scores)]
        self.needed = np.array([matches_needed(n, score) for n, score in sized], dtype=np.int64)
        self.hits = -(-self.needed // 3)
        self.reach = np.array([reach_of(n, score) for n, score in sized], dtype=np.int64)
        seeds: dict[int, list[int]] = {}
        for number, (_, words) in enumerate(items):
            rarest = sorted(words.tolist(), key=lambda code: (counts.get(code, 0), code))
            for code in set(rarest[: max(0, len(words) - self.needed[number] + self.hits[number])]):
                seeds.setdefault(code, []).append(number)
        self.seeds = KnownCodes(np.array(sorted(seeds), dtype=np.uint64))
        owners = [seeds[code] for code in self.seeds.codes.tolist()]
        self.n_owners = np.array([len(numbers) for numbers in owners], dtype=np.int64)
        self.first_owner = np.cumsum(self.n_owners) - self.n_owners
        self.owners = np.array([number for numbers in owners for number in numbers], dtype=np.int64)

    def leaks(self, texts: Iterable[str | None]) -> Iterator[list[tuple[int, float, int, int]]]:
        """For each text (item_id, score, first and last word) of every item that it has a copy of."""
        for words, first in words_of_texts(texts):
            best: list[dict[int, tuple[int, float, int, int]]] = [{} for _ in first[1:]]
            for text, number, low, high in self.candidates(words, first):
                known = best[text]
                found = self.best(words[first[text] : first[text + 1]], number, low, high)
                if found and (number not in known or found[1] > known[number][1]):
                    known[number] = found
            for known in best:
                yield [known[number] for number in sorted(known)]

    def candidates(self, words: np.ndarray, first_words: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Text of a block, item, first and last word (exclusive) of the stretches where an item's seeds are dense enough.

        The words of a text are numbered from 0; a stretch may begin before its text and end after it.
        """
        places, codes = self.seeds.found(words)
        if not len(places):
            return
        texts = np.searchsorted(first_words, places, side="right") - 1
        keys = texts * len(self.seeds.codes) + codes
        order = np.argsort(keys, kind="stable")
        places, keys = places[order], keys[order]
        first, count = groups(keys)
        texts, codes = np.divmod(keys[first], len(self.seeds.codes))
        # whole texts at a time, of so many seeds, owners and sums together that they fit
        sizes = self.n_owners[codes]
        sizes[groups(texts)[0]] += len(self.items)
        for part in fitting(texts, sizes):
            n_owners = self.n_owners[codes[part]]
            pair = expanded(self.first_owner[codes[part]], n_owners)
            owner = np.repeat(texts[part] - texts[part.start], n_owners) * len(self.items) + self.owners[pair]
            begin, n = np.repeat(first[part], n_owners), np.repeat(count[part], n_owners)
            chosen = np.flatnonzero(np.bincount(owner, n)[owner] >= self.hits[self.owners[pair]])
            chosen = chosen[np.argsort(owner[chosen], kind="stable")]
            owner, begin, n = owner[chosen], begin[chosen], n[chosen]
            # whole items at a time, of so many hits together that they fit
            for some in fitting(owner, n):
                hits = places[expanded(begin[some], n[some])]
                for key, low, high in self.dense(np.repeat(owner[some], n[some]), hits):
                    text, number = divmod(key, len(self.items))
                    text += int(texts[part.start])
                    yield text, number, low - int(first_words[text]), high - int(first_words[text])

    def dense(self, owner: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, int, int]]:
        order = np.lexsort((place, owner))
        owner, place = owner[order], place[order]
        hits, reach = (x[owner % len(self.items)] for x in (self.hits, self.reach))
        last = np.arange(len(owner)) + hits - 1
        inside = np.minimum(last, len(owner) - 1)
        near = np.flatnonzero((last == inside) & (owner[inside] == owner) & (place[inside] - place < reach))
        owner, low, high = owner[near], place[inside[near]] - reach[near] + 1, place[near] + reach[near]
        # stretches of an item that meet are one
        apart = np.flatnonzero((owner[1:] != owner[:-1]) | (low[1:] > high[:-1])) + 1
        first = np.concatenate([[0], apart])[: len(owner)]
        ends = np.concatenate([apart, [len(owner)]])[: len(owner)]
        yield from zip(owner[first].tolist(), low[first].tolist(), high[ends - 1].tolist())

    def best(self, words: np.ndarray, number: int, low: int, high: int) -> tuple[int, float, int, int] | None:
        """The best alignment within a stretch, where its score is enough."""
        item_id, item = self.items[number]
        low, high = max(0, low), min(len(words), high)
        window = words[low:high]
        # an alignment has at most as many matches as the words within its reach that are the item's
        own = self.sorted_words[number]
        is_own = own[np.minimum(np.searchsorted(own, window), len(own) - 1)] == window
        met = np.concatenate([[0], np.cumsum(is_own)])
        reach = min(int(self.reach[number]), len(window))
        full = np.flatnonzero(met[reach:] - met[: len(met) - reach] >= self.needed[number])
        if not len(full):
            return None
        # and at most as many as stand there in the item's order
        stretch = slice(int(full[0]), int(full[-1]) + reach)
        low, window = low + stretch.start, window[stretch]
        if longest_shared(item.tolist(), window[is_own[stretch]].tolist()) < self.needed[number]:
            return None
        points, end = align(item, window)
        score = points / (MATCH * len(item))
        if score < self.min_scores[number]:
            return None
        _, back = align(item[::-1], window[:end][::-1])
        return item_id, score, low + end - back, low + end - 1


def expanded(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The n[i] numbers from first[i] on, for each i."""
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal keys begins, and how long it is."""
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return first, np.diff(first, append=len(keys))


def fitting(keys: np.ndarray, sizes: np.ndarray) -> Iterator[slice]:
    """Slices of whole runs of equal keys, of about HITS_AT_ONCE together, or one larger run."""
    ends = np.flatnonzero(np.diff(keys, append=-1)) + 1
    block = np.cumsum(sizes)[ends - 1] // HITS_AT_ONCE
    begin = 0
    for end in ends[np.flatnonzero(np.diff(block, append=-1))]:
        yield slice(begin, end)
        begin = end


def word_counts(docs: DataFrame, codes: np.ndarray) -> dict[int, int]:
    """How often each of the codes is in the corpus; tasks send sums, one row for each code at most."""
    known = KnownCodes(codes)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros(len(codes), dtype=np.int64)
        for batch in batches:
            for words, _ in words_of_texts(batch["text"]):
                totals += np.bincount(known.found(words)[1], minlength=len(codes))
        met = np.flatnonzero(totals)
        yield pd.DataFrame({"place": met, "n": totals[met]})

    sums = docs.select("text").mapInPandas(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    return {int(codes[r["place"]]): r["n"] for r in sums.collect()}


def item_slices(benchmark: DataFrame) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The items that have words, at most SLICE_ITEMS at a time."""
    scratch = Scratch(benchmark.sparkSession, "benchmark")
    items = scratch.stage("items", benchmark.select("item_id", "text"))
    slices = max(1, -(-items.count() // (SLICE_ITEMS // 2)))  # half full on average: hashing is uneven
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(slices))
    for number in range(slices):
        rows = items.filter(part == number).orderBy("item_id", "text").collect()
        listed = [(r["item_id"], words_of(r["text"])[0]) for r in rows]
        yield [(item_id, words) for item_id, words in listed if len(words)]


def choose_seeds(docs: DataFrame, items: list[tuple[int, np.ndarray]], min_score: float) -> Items:
    codes = np.unique(np.concatenate([words for _, words in items])) if items else np.zeros(0, dtype=np.uint64)
    return Items(items, word_counts(docs, codes) if len(codes) else {}, min_score)


def leak_finder(items: Items):
    """A column function: the leaks of each text."""

    @F.pandas_udf(LEAKS)
    def leaks(texts: pd.Series) -> pd.Series:
        keys = ("item_id", "score", "first_word", "last_word")
        return pd.Series([[dict(zip(keys, leak)) for leak in found] for found in items.leaks(texts)], dtype="object")

    return leaks


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """doc_id, item_id, score, first_word and last_word (words from 0) of each item a document has a copy of."""
    texts = docs.select("doc_id", "text")
    out = None
    for items in item_slices(benchmark):
        finder = leak_finder(choose_seeds(texts, items, min_score))
        part = texts.select("doc_id", F.explode(finder(F.col("text"))).alias("leak")).select("doc_id", "leak.*")
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaky(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of docs without a copy of any item, with all their columns."""
    n_leaks = unused_name(docs, "n_leaks")
    out, texts = docs, docs.select("text")
    for items in item_slices(benchmark):
        finder = leak_finder(choose_seeds(texts, items, min_score))
        leaks: Column = F.size(finder(out["text"]))
        out = out.withColumn(n_leaks, leaks).filter(F.col(n_leaks) == 0).drop(n_leaks)
    return out
