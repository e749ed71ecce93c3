"""Hard-negative mining with exact integer scores, by Kronecker-packed products.

The score of two rows is the inner product of their components, floor(256 * x) each. Components are
shifted by the table's least one, so that none is negative. The shifted components that several
candidates have in one dimension then lie in separate fields of one integer, wide enough that a field
holds a whole inner product. So one multiplication for an anchor's component serves all candidates of
the word, the products of all dimensions add up field by field, and the fields are cut out again and
the shift is taken back. Words of up to 53 bits travel in doubles, which hold them exactly, so that a
matrix product does the work; where a single field is wider than that, words are Python integers of
WIDE_FIELDS fields.

Candidates lie in blocks of about BLOCK_ROWS rows and anchors in groups of about GROUP_ANCHORS; every pair
of a block and a group is one small co-grouped task, so neither side is ever whole in one place. The first
pass keeps each pair's best rows of the anchor's label, the second each pair's best rows of other labels
within the limits of each positive. Ranks over these lists are exact, since a list holds as many rows as
the answer may have.

Defined cases: a row with a null label, a null vector, or a null or non-finite component takes no part; a
shorter vector counts as filled up with zeros; a null vec_id is no anchor and ranks last among equal
scores; rows that repeat are rows of their own, each its own anchor, and one may be the positive of
another; components beyond 64-bit integers are cut to their range, scores too; anchors without a positive
or a negative have no result; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesgrain.llm.shared import Scratch

SCALE = 256
ANCHOR_EVERY = 100
POSITIVES, NEGATIVES = 5, 10
LEAST_SHARE, MOST_SHARE = 30, 90  # percent of the positive's score
BLOCK_ROWS, GROUP_ANCHORS = 4096, 1024
ANCHORS_AT_ONCE = 128
EXACT_BITS = 53  # integers of so many bits are exact in doubles
WIDE_FIELDS = 32
LAST = np.iinfo(np.int64).max

BLOCK = "block long, row array<long>, vec_id array<long>, label array<int>, vectors binary, width int"
POSITIVE = "anchor long, anchor_id long, row long, vec_id long, score long"
NEGATIVE = "anchor long, positive long, row long, vec_id long, score long"


@dataclass(frozen=True)
class Fields:
    """How shifted components lie in words."""

    dims: int
    low: int  # the least component
    bits: int  # of a field: no inner product of shifted components is wider

    @classmethod
    def of(cls, dims: int, low: int, high: int) -> Fields:
        low, high = min(low, 0), max(high, 0)
        return cls(dims, low, max(1, (dims * (high - low) ** 2).bit_length()))

    @property
    def wide(self) -> bool:
        return self.bits > EXACT_BITS

    @property
    def per_word(self) -> int:
        return WIDE_FIELDS if self.wide else EXACT_BITS // self.bits

    def shifted(self, vectors: np.ndarray) -> np.ndarray:
        """Rows of components as numbers from 0 on: doubles, or Python integers for wide fields."""
        return vectors.astype(object) - self.low if self.wide else (vectors - self.low).astype(np.float64)

    def pack(self, candidates: np.ndarray) -> np.ndarray:
        """Words (dimensions x ceil(candidates / fields)): candidate c lies in word c // fields."""
        shifted = self.shifted(candidates)
        n, fields = len(shifted), self.per_word
        words = np.zeros((self.dims, -(-n // fields)), dtype=shifted.dtype)
        for field in range(fields):
            own = shifted[field::fields].T
            words[:, : own.shape[1]] += own * (1 << field * self.bits)
        return words

    def unpack(self, sums: np.ndarray, n: int) -> np.ndarray:
        """The inner products of shifted components (anchors x candidates)."""
        out = np.empty((len(sums), n), dtype=object if self.wide else np.int64)
        sums = sums if self.wide else sums.astype(np.int64)
        for field in range(min(self.per_word, n)):
            own = out[:, field :: self.per_word]
            own[:] = (sums[:, : own.shape[1]] >> field * self.bits) & ((1 << self.bits) - 1)
        return out

    def scores(self, anchors: np.ndarray, words: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Exact inner products (anchors x candidates) of 64 bits."""
        kind = object if self.wide else np.int64
        products = self.unpack(self.shifted(anchors) @ words, len(candidates))
        # (a - low)(c - low) = ac - low(a + c) + low * low, summed over the dimensions
        of_anchor, of_candidate = anchors.astype(kind).sum(axis=1), candidates.astype(kind).sum(axis=1)
        exact = products + self.low * (of_anchor[:, None] + of_candidate[None, :]) - self.dims * self.low**2
        return np.clip(exact, -LAST, LAST).astype(np.int64) if self.wide else exact


def usable(embeddings: DataFrame, anchor_every: int, scratch: Scratch) -> DataFrame:
    """row, vec_id, label and integer vector of each row that takes part."""
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    infinity = F.lit(float("inf"))

    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinity)

    rows = embeddings.select("vec_id", "label", "embedding").filter(
        F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite)
    )
    return scratch.stage("rows", rows.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        relabelled.cast("int").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("vector"),
        F.coalesce(F.col("vec_id") % anchor_every == 0, F.lit(False)).alias("is_anchor"),
    ))


def blocks_of(rows: DataFrame, n_blocks: int, dims: int) -> DataFrame:
    """Rows in blocks, in each by vec_id, so that of equal scores the first one counts."""

    def gather(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["vec_id", "row"], na_position="last")
        vectors = np.zeros((len(part), dims), dtype=np.int64)
        for i, vector in enumerate(part["vector"]):
            vectors[i, : len(vector)] = vector
        small = -(1 << 15) <= vectors.min(initial=0) and vectors.max(initial=0) < 1 << 15
        stored = vectors.astype(np.int16 if small else np.int64)
        ids = [None if pd.isna(v) else int(v) for v in part["vec_id"]]
        return pd.DataFrame({
            "block": [key[0]], "row": [part["row"].tolist()], "vec_id": [ids], "label": [part["label"].tolist()],
            "vectors": [stored.tobytes()], "width": [stored.itemsize],
        })

    block = F.pmod(F.xxhash64("row"), F.lit(n_blocks)).alias("block")
    return rows.select(block, "row", "vec_id", "label", "vector").groupBy("block").applyInPandas(gather, BLOCK)


@dataclass(frozen=True)
class Block:
    row: np.ndarray
    vec_id: list
    label: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, part: pd.DataFrame, dims: int) -> Block:
        first = part.iloc[0]
        stored = np.frombuffer(first["vectors"], dtype=f"<i{first['width']}")
        ids = [None if pd.isna(v) else int(v) for v in first["vec_id"]]
        return cls(np.asarray(first["row"]), ids, np.asarray(first["label"]), stored.reshape(-1, dims).astype(np.int64))


def first_places(scores: np.ndarray, allowed: np.ndarray, n: int) -> list[np.ndarray]:
    """For each row of scores, the places of its n highest allowed ones, equal ones by place."""
    out = []
    for own, may in zip(scores, allowed):
        places = np.flatnonzero(may)
        if len(places) > n:
            least = np.partition(own[places], len(places) - n)[len(places) - n]
            above, equal = places[own[places] > least], places[own[places] == least]
            places = np.concatenate([above, equal[: n - len(above)]])
        out.append(places)
    return out


def positives_in(fields: Fields):
    def find(key: tuple, block: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(block) and len(anchors):
            own, words = block_and_words(block, fields)
            for part, scores in scored(anchors, own, words, fields):
                label, row = part["label"].to_numpy(), part["row"].to_numpy()
                allowed = (own.label == label[:, None]) & (own.row != row[:, None])
                for i, places in enumerate(first_places(scores, allowed, POSITIVES)):
                    anchor_id = part["vec_id"].iat[i]
                    found += [(row[i], anchor_id, own.row[p], own.vec_id[p], scores[i, p]) for p in places]
        return pd.DataFrame(found, columns=["anchor", "anchor_id", "row", "vec_id", "score"], dtype=object)

    return find


def negatives_in(fields: Fields):
    def find(key: tuple, block: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(block) and len(anchors):
            own, words = block_and_words(block, fields)
            for part, scores in scored(anchors, own, words, fields):
                other = own.label != part["label"].to_numpy()[:, None]
                for i, bounds in enumerate(part["positives"]):
                    for bound in bounds:
                        inside = other[i] & (scores[i] >= bound["least"]) & (scores[i] <= bound["most"])
                        (places,) = first_places(scores[i : i + 1], inside[None], NEGATIVES)
                        anchor = part["row"].iat[i]
                        found += [(anchor, bound["row"], own.row[p], own.vec_id[p], scores[i, p]) for p in places]
        return pd.DataFrame(found, columns=["anchor", "positive", "row", "vec_id", "score"], dtype=object)

    return find


def block_and_words(block: pd.DataFrame, fields: Fields) -> tuple[Block, np.ndarray]:
    own = Block.of(block, fields.dims)
    return own, fields.pack(own.vectors)


def scored(anchors: pd.DataFrame, own: Block, words: np.ndarray, fields: Fields):
    """Some anchors at a time, and their scores with a block's rows."""
    for begin in range(0, len(anchors), ANCHORS_AT_ONCE):
        part = anchors.iloc[begin : begin + ANCHORS_AT_ONCE]
        vectors = np.zeros((len(part), fields.dims), dtype=np.int64)
        for i, vector in enumerate(part["vector"]):
            vectors[i, : len(vector)] = vector
        yield part, fields.scores(vectors, words, own.vectors)


def meet(blocks: DataFrame, anchors: DataFrame, n_blocks: int, n_groups: int, find, schema: str) -> DataFrame:
    """What find() gives for every block with every group of anchors."""
    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    group = F.pmod(F.xxhash64("row"), F.lit(n_groups)).cast("long")
    left = blocks.select("*", each(n_groups).alias("group"))
    right = anchors.select("*", group.alias("group"), each(n_blocks).alias("block"))
    pair = ("block", "group")
    return left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInPandas(find, schema)


def ranked(found: DataFrame, n: int, *keys: str) -> DataFrame:
    """The n best rows of each key, by score and then by vec_id."""
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def hard_negatives(
    embeddings: DataFrame, anchor_every: int = ANCHOR_EVERY, block_rows: int = BLOCK_ROWS, group_anchors: int = GROUP_ANCHORS
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of embeddings(vec_id, embedding, label)."""
    scratch = Scratch(embeddings.sparkSession, "negatives")
    rows = usable(embeddings, anchor_every, scratch)
    seen = rows.agg(
        F.count("*").alias("n"), F.count_if("is_anchor").alias("anchors"), F.max(F.size("vector")).alias("dims"),
        F.min(F.array_min("vector")).alias("low"), F.max(F.array_max("vector")).alias("high"),
    ).first()
    fields = Fields.of(seen["dims"] or 0, seen["low"] or 0, seen["high"] or 0)
    n_blocks, n_groups = max(1, -(-seen["n"] // block_rows)), max(1, -(-seen["anchors"] // group_anchors))
    blocks = scratch.stage("blocks", blocks_of(rows, n_blocks, fields.dims))
    anchors = rows.filter("is_anchor").select("row", "vec_id", "label", "vector")
    positives = meet(blocks, anchors, n_blocks, n_groups, positives_in(fields), POSITIVE)
    positives = scratch.stage("positives", ranked(positives, POSITIVES, "anchor").drop("rank"))
    # 100 * negative between 30 * and 90 * positive, as bounds on the negative that can't overflow
    wide = F.col("score").cast("decimal(38,0)")
    least, most = F.ceil(wide * LEAST_SHARE / 100), F.floor(wide * MOST_SHARE / 100)
    bounds = positives.groupBy(F.col("anchor").alias("row")).agg(
        F.collect_list(F.struct("row", least.cast("long").alias("least"), most.cast("long").alias("most"))).alias("positives")
    )  # five at most
    found = meet(blocks, anchors.join(bounds, "row"), n_blocks, n_groups, negatives_in(fields), NEGATIVE)
    best = ranked(found, NEGATIVES, "anchor", "positive")
    known = positives.select(
        "anchor", "anchor_id", F.col("row").alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return best.join(known, ["anchor", "positive"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
