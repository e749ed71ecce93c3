"""Ranked lexical search: exact best documents by range-maximum queries over posting lists.

The index holds, for blocks of documents, the posting list of every term: documents with their counts.
A search meets shards of about SHARD_DOCS documents with slices of about SLICE_ITEMS items. A shard's
documents are numbered; each posting list of an item's term gets the impact of every document and a sparse
table of the places of its maxima, so that the greatest impact within any interval of documents is one
lookup of two overlapping powers of two. The sum of these maxima over an item's terms bounds every
document of an interval. Intervals are opened best bound first, AT_ONCE together: an interval is split at
the document with its single greatest impact, that document is scored exactly, and the two rests are
bounded anew. An item is done when no interval left has a bound that reaches its TOP-th score. A shard gives
TOP documents an item at most; the best of all shards are the answer, since scores don't depend on the shard.

Documents within a shard lie by their most frequent item term, then doc_id: texts of one language or
subject lie together, which keeps bounds tight.

Words are compared by 64-bit hashes. Statistics (documents, words, documents with a term) cover the whole
table; their sums are taken per block first. Each task reads whole texts once, and texts are not shuffled.

Defined cases: a null text has no terms and is never found; an item without terms, or whose terms no
document holds, has no result; a null doc_id ranks last among equal scores; rows that repeat, documents
and items alike, are rows of their own; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesgrain.llm.shared import Scratch
from salesgrain.llm.words import words_of

TOP = 10
SHARD_DOCS = 8192
BLOCK_DOCS, BLOCK_WORDS = 1024, 4_000_000
SLICE_ITEMS = 1024
AT_ONCE = 64
IMPACT_SCALE, TF_SCALE, LENGTH_SCALE = 1_000_000_000, 1000, 8
NO_DOC = np.iinfo(np.int64).max

INDEX = "block string, n_docs long, n_words long, rows array<long>, doc_ids array<long>, lengths binary, terms binary, n_postings binary, docs binary, counts binary"
DF = "term long, n long"
FOUND = "item long, doc_id long, row long, score long"


def term_counts(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """A text's terms and their counts, and the number of all."""
    words, _, _ = words_of(text)
    terms, counts = np.unique(words, return_counts=True)
    return terms.view(np.int64), counts, len(words)


def block_row(name: str, rows: list, doc_ids: list, found: list) -> dict:
    """Posting lists of a block's documents, by term and then by document; documents by their place in the block."""
    terms = np.concatenate([t for t, _, _ in found])
    counts = np.concatenate([c for _, c, _ in found])
    docs = np.repeat(np.arange(len(found)), [len(t) for t, _, _ in found])
    order = np.argsort(terms, kind="stable")
    own, n_postings = np.unique(terms, return_counts=True)
    lengths = np.array([n for _, _, n in found], dtype=np.int64)
    return {
        "block": name, "n_docs": int((lengths > 0).sum()), "n_words": int(lengths.sum()), "rows": rows, "doc_ids": doc_ids,
        "lengths": lengths.tobytes(), "terms": own.tobytes(), "n_postings": n_postings.astype(np.int32).tobytes(),
        "docs": docs[order].astype(np.int16).tobytes(), "counts": counts[order].astype(np.int32).tobytes(),
    }


def build_index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows, doc_ids, found, held = [], [], [], 0
    for batch in batches:
        for row, doc_id, text in zip(batch["row"], batch["doc_id"], batch["text"]):
            rows.append(int(row))
            doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
            found.append(term_counts(text))
            held += len(found[-1][0])
            if len(rows) == BLOCK_DOCS or held > BLOCK_WORDS:
                yield pd.DataFrame([block_row(str(rows[0]), rows, doc_ids, found)])
                rows, doc_ids, found, held = [], [], [], 0
    if rows:
        yield pd.DataFrame([block_row(str(rows[0]), rows, doc_ids, found)])


def index_of(docs: DataFrame, scratch: Scratch) -> DataFrame:
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scratch.stage("index", numbered.mapInPandas(build_index, INDEX))


def list_lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for terms, n in zip(batch["terms"], batch["n_postings"]):
            yield pd.DataFrame({"term": np.frombuffer(terms, dtype=np.int64), "n": np.frombuffer(n, dtype=np.int32).astype(np.int64)})


def item_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [term_counts(text)[:2] for text in batch["text"]]
        sizes = [len(t) for t, _ in found]
        none = np.zeros(0, dtype=np.int64)
        yield pd.DataFrame({
            "item": np.repeat(batch["item"].to_numpy(), sizes), "term": np.concatenate([none, *[t for t, _ in found]]),
            "times": np.concatenate([none, *[n for _, n in found]]),
        })


class RangeMaxima:
    """Values in one array; the place of the greatest within any range, the first of equal ones."""

    def __init__(self, values: np.ndarray):
        self.values = values
        level = np.arange(len(values), dtype=np.int32)
        self.levels = [level]
        width = 1
        while 2 * width <= len(values):
            left, right = level[:-width], level[width:]
            level = np.where(values[right] > values[left], right, left)
            self.levels.append(level)
            width *= 2
        self.begins = np.cumsum([0, *map(len, self.levels)])
        self.places = np.concatenate(self.levels) if len(values) else level
        del self.levels

    def cut(self, longest: int) -> RangeMaxima:
        """Without the levels that ranges of at most so many values don't need."""
        n = max(1, int(longest).bit_length())
        self.begins = self.begins[: n + 1]
        self.places = self.places[: self.begins[-1]]
        return self

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places of the maxima of ranges that are not empty."""
        level = np.frexp((end - begin).astype(np.float64))[1] - 1
        first = self.places[self.begins[level] + begin]
        second = self.places[self.begins[level] + end - (1 << level)]
        return np.where(self.values[second] > self.values[first], second, first)


class Shard:
    """Posting lists of a slice's terms over a shard's documents, with their impacts and range maxima."""

    def __init__(self, blocks: pd.DataFrame, terms: np.ndarray, weights: np.ndarray, n_docs: int, n_words: int):
        parts = [own_postings(block, terms) for block in blocks.itertuples()]
        sizes = [len(block.rows) for block in blocks.itertuples()]
        offset = np.cumsum([0, *sizes])
        self.rows = np.concatenate([np.asarray(r, dtype=np.int64) for r in blocks["rows"]])
        ids = [v for part in blocks["doc_ids"] for v in part]
        self.doc_ids = np.array([NO_DOC if pd.isna(v) else int(v) for v in ids], dtype=np.int64)
        lengths = np.concatenate([np.frombuffer(v, dtype=np.int64) for v in blocks["lengths"]])
        term = np.concatenate([p[0] for p in parts])
        doc = np.concatenate([p[1] + at for p, at in zip(parts, offset)])
        count = np.concatenate([p[2] for p in parts])
        # the length measure m of a document, and the impact of a count
        measure = 25 + 75 * lengths * n_docs // max(1, n_words)
        impact = weights[term] * (IMPACT_SCALE * count // (TF_SCALE * count + LENGTH_SCALE * measure[doc]))
        place = self.order(term, doc, count, len(lengths))
        self.rows, self.doc_ids = self.rows[place], self.doc_ids[place]
        number = np.empty(len(place), dtype=np.int64)
        number[place] = np.arange(len(place))
        self.n = len(place)
        key = term * self.n + number[doc]
        order = np.argsort(key)
        self.key, self.impact = key[order], impact[order]
        self.doc = self.key % self.n
        self.first = np.searchsorted(self.key, np.arange(len(terms) + 1) * self.n)
        self.maxima = RangeMaxima(self.impact).cut(int(np.diff(self.first).max(initial=1)))

    def order(self, term: np.ndarray, doc: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
        """Documents by their most frequent term, then doc_id, then row."""
        main = np.full(n, -1, dtype=np.int64)
        by_count = np.lexsort((term, count))
        main[doc[by_count]] = term[by_count]
        return np.lexsort((self.rows, self.doc_ids, main))

    def best(self, terms: np.ndarray, times: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the best documents for an item's terms (numbers within the slice)."""
        held = self.first[terms + 1] > self.first[terms]
        terms, times = terms[held], times[held]
        places, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        if not len(terms):
            return places, scores
        begin, end = self.first[terms][None], self.first[terms + 1][None]
        bound, split = self.bounds(begin, end, times)
        least = 1  # what a document needs to come into the answer
        while len(bound):
            turn = np.argsort(-bound, kind="stable")
            now, later = turn[:AT_ONCE], turn[AT_ONCE:]
            opened, middle = (begin[now], end[now]), split[now]
            # where the split document stands, or would stand, in each list
            at = np.searchsorted(self.key, terms[None] * self.n + middle[:, None])
            at = np.clip(at, opened[0], opened[1])
            inside = (at < opened[1]) & (self.doc[np.minimum(at, len(self.doc) - 1)] == middle[:, None])
            score = (np.where(inside, self.impact[np.minimum(at, len(self.doc) - 1)], 0) * times).sum(axis=1)
            places, scores = self.merged(places, scores, middle, score, top)
            if len(places) == top:
                least = int(scores[-1])
            new_begin = np.concatenate([opened[0], at + inside])
            new_end = np.concatenate([at, opened[1]])
            some = (new_end > new_begin).any(axis=1)
            new_begin, new_end = new_begin[some], new_end[some]
            new_bound, new_split = self.bounds(new_begin, new_end, times)
            begin, end = np.concatenate([begin[later], new_begin]), np.concatenate([end[later], new_end])
            bound, split = np.concatenate([bound[later], new_bound]), np.concatenate([split[later], new_split])
            stays = bound >= least
            begin, end, bound, split = begin[stays], end[stays], bound[stays], split[stays]
        return places, scores

    def bounds(self, begin: np.ndarray, end: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For intervals (ranges of each list), the sum of the lists' maxima and the document of the greatest one."""
        filled = end > begin
        where = self.maxima.of(np.where(filled, begin, 0), np.where(filled, end, 1))
        most = np.where(filled, self.impact[where] * times, -1)
        greatest = most.argmax(axis=1)
        return np.maximum(most, 0).sum(axis=1), self.doc[where[np.arange(len(where)), greatest]]

    def merged(self, places, scores, new_places, new_scores, top: int) -> tuple[np.ndarray, np.ndarray]:
        found = new_scores > 0
        places = np.concatenate([places, new_places[found]])
        scores = np.concatenate([scores, new_scores[found]])
        order = np.lexsort((self.rows[places], self.doc_ids[places], -scores))[:top]
        return places[order], scores[order]


def own_postings(block, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block, the postings of sorted terms: number of the term, document, count."""
    listed = np.frombuffer(block.terms, dtype=np.int64)
    n = np.frombuffer(block.n_postings, dtype=np.int32).astype(np.int64)
    order = np.argsort(listed)  # stored as unsigned numbers sort
    at = np.minimum(np.searchsorted(listed, terms, sorter=order), len(listed) - 1) if len(listed) else np.zeros(0, dtype=np.int64)
    known = np.flatnonzero(listed[order[at]] == terms) if len(listed) else at
    list_no = order[at[known]] if len(known) else known
    first = np.cumsum(n) - n
    sizes = n[list_no]
    where = np.arange(sizes.sum()) + np.repeat(first[list_no] - (np.cumsum(sizes) - sizes), sizes)
    docs = np.frombuffer(block.docs, dtype=np.int16).astype(np.int64)[where]
    return np.repeat(known, sizes), docs, np.frombuffer(block.counts, dtype=np.int32).astype(np.int64)[where]


def searcher(n_docs: int, n_words: int, top: int):
    def search(key: tuple, blocks: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        if len(blocks) and len(asked):
            terms, number = np.unique(asked["term"].to_numpy(), return_inverse=True)
            weights = np.zeros(len(terms), dtype=np.int64)
            weights[number] = asked["weight"].to_numpy()
            shard = Shard(blocks, terms, weights, n_docs, n_words)
            times = asked["times"].to_numpy()
            for item, own in pd.Series(np.arange(len(asked))).groupby(asked["item"].to_numpy()):
                at = own.to_numpy()
                places, scores = shard.best(number[at], times[at], top)
                ids = shard.doc_ids[places]
                found.append(pd.DataFrame({
                    "item": item, "doc_id": [None if v == NO_DOC else int(v) for v in ids], "row": shard.rows[places], "score": scores,
                }))
        if not found:
            return pd.DataFrame({"item": [], "doc_id": [], "row": [], "score": []})
        return pd.concat(found, ignore_index=True).astype({"doc_id": "Int64"})

    return search


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, shard_docs: int = SHARD_DOCS, slice_items: int = SLICE_ITEMS
) -> DataFrame:
    """item_id, rank, doc_id and score of the best of docs(doc_id, text) for each of items(item_id, text)."""
    scratch = Scratch(docs.sparkSession, "search")
    index = index_of(docs, scratch)
    totals = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_words").alias("words"), F.sum(F.size("rows")).alias("rows")).first()
    n_docs, n_words, n_rows = totals["docs"] or 0, totals["words"] or 0, totals["rows"] or 0
    items = scratch.stage("items", items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"))
    wanted = scratch.stage("wanted", items.select("item", "text").mapInPandas(item_terms, "item long, term long, times long"))
    held = index.select("terms", "n_postings").mapInPandas(list_lengths, DF)
    known = held.join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("n") + 1)))
    weighed = wanted.join(known.select("term", weight.alias("weight")), "term")
    n_shards = max(1, math.ceil(n_rows / shard_docs))
    n_slices = max(1, math.ceil(items.count() / slice_items))

    def each(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    def dealt(column: str, n: int):
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("long")

    left = index.drop("n_docs", "n_words").select("*", dealt("block", n_shards).alias("shard"), each(n_slices).alias("slice"))
    right = weighed.select("*", dealt("item", n_slices).alias("slice"), each(n_shards).alias("shard"))
    pair = ("shard", "slice")
    found = left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInPandas(searcher(n_docs, n_words, top), FOUND)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
