"""Near-copies by a chosen-path join on n-gram Jaccard similarity.

A text is the set of its word n-grams. Each set is embedded as TOKENS min-hash tokens, of which two sets
share about as large a part as their Jaccard similarity. A run starts with all sets in one bucket and
splits buckets recursively: a bucket samples tokens, on average 1 / threshold of them, and each sampled
token deals the bucket's sets to children by its value. So two sets at the threshold expect to share one
child at every level. Buckets of up to LEAF sets are compared pair by pair; so are, in blocks, those
that are still larger at MAX_DEPTH, which happens for large groups of near-copies. Runs are repeated
until a pair at the threshold is met with probability RECALL.

Pairs are compared on short sketches first, then exactly on all n-grams. Of the buckets that two sets
share only the one with the least number counts their link, so links add up over buckets, and no pair is
ever a row: a bucket gives its members' link counts and a spanning forest. Sets that are equal are one
member with a weight.

Defined cases: a null text counts as empty; a text of fewer than N_GRAM words is one n-gram of them all;
texts without words are linked to nothing, equal ones are one class; a null doc_id ranks last when the
class is named; rows that repeat get a result row each; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesgrain.llm.shared import Scratch, text_key, unused_name, whole_text
from salesgrain.llm.words import grams, mixed, words_of

N_GRAM = 5
THRESHOLD = 0.8
TOKENS = 128
RECALL = 0.99
LEAF = 500
MAX_DEPTH = 3
SLACK = 4.5  # standard deviations by which a sketch may understate a pair
DRAWS = 1 << 16  # resolution of the sampling of tokens

MEMBERS = "doc_id long, row long, node long, n_grams long, tokens array<int>"


def shingles(text: str | None) -> np.ndarray:
    return np.unique(grams(words_of(text)[0], N_GRAM))


def min_hashes(found: np.ndarray) -> np.ndarray:
    """The least of each of TOKENS hash functions over a set of n-grams."""
    low = (found & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    high = (found >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    out = np.full(TOKENS, 0xFFFFFFFF, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for begin in range(0, len(found), 4096):
            part = slice(begin, begin + 4096)
            # a[k] * x + b[k], folded once more with the other half, spreads well enough in 32 bits
            value = low[part, None] * _A + high[part, None] * _B
            value ^= value >> np.uint32(15)
            value *= np.uint32(0x2C1B3C6D)
            np.minimum(out, value.min(axis=0), out=out)
    return out


_A, _B = (
    (mixed(np.arange(1, TOKENS + 1, dtype=np.uint64) + np.uint64(salt)).astype(np.uint32) | np.uint32(1)) for salt in (0, 1 << 20)
)


def embed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        nodes, sizes, tokens = [], [], []
        for text, row in zip(batch["text"], batch["row"]):
            found = shingles(text)
            with np.errstate(over="ignore"):
                nodes.append(int(mixed(mixed(found).sum(keepdims=True)).view(np.int64)[0]) if len(found) else int(row))
            sizes.append(len(found))
            tokens.append(min_hashes(found).view(np.int32) if len(found) else np.zeros(0, dtype=np.int32))
        yield pd.DataFrame({
            "doc_id": batch["doc_id"], "row": batch["row"], "node": nodes, "n_grams": sizes, "tokens": tokens,
        })


def meeting_chance(depth: int) -> float:
    """Chance that a pair at the threshold still shares a bucket of a run after so many levels."""
    chance = 1.0
    for _ in range(depth):
        chance = 1 - math.exp(-chance)
    return chance


def runs_needed(recall: float, depth: int = MAX_DEPTH) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - meeting_chance(depth)))


def split(members: DataFrame, threshold: float) -> DataFrame:
    """One level: the children (bucket, node) of members(bucket, node, tokens)."""
    chosen = F.filter(
        F.sequence(F.lit(0), F.lit(TOKENS - 1)),
        lambda i: F.pmod(F.xxhash64("bucket", i), F.lit(DRAWS)) < round(DRAWS / (threshold * TOKENS)),
    )
    opened = members.select("bucket", "node", "tokens", F.explode(chosen).alias("i"))
    return opened.select(F.xxhash64("bucket", "i", F.get("tokens", F.col("i"))).alias("bucket"), "node")


def leaf_buckets(sets: DataFrame, scratch: Scratch, threshold: float, recall: float, leaf: int) -> DataFrame:
    """(bucket, node, blocks) of all buckets to compare: up to leaf members, or larger ones cut into blocks."""
    roots = F.explode(F.sequence(F.lit(1), F.lit(runs_needed(recall))))
    members = split(sets.select(roots.alias("run"), "node", "tokens").withColumn("bucket", F.xxhash64("run")), threshold)
    leaves = None
    for depth in range(1, MAX_DEPTH + 1):
        members = scratch.stage(f"level-{depth}", members)
        sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
        sizes = scratch.stage(f"sizes-{depth}", sizes)
        small = sizes.filter(F.col("n") <= leaf) if depth < MAX_DEPTH else sizes
        blocks = F.ceil(F.col("n") / leaf).cast("int").alias("blocks")
        part = members.join(small, "bucket").select("bucket", "node", blocks)
        leaves = part if leaves is None else leaves.unionByName(part)
        large = sizes.filter(F.col("n") > leaf).select("bucket")
        if depth == MAX_DEPTH or large.isEmpty():
            break
        members = split(members.join(large, "bucket").join(sets.select("node", "tokens"), "node"), threshold)
    return leaves


def block_pairs(leaves: DataFrame) -> DataFrame:
    """Deals the members of large buckets to pairs of blocks, (group, side) beside the other columns.

    Two members meet in the pair of their blocks; side tells on which side, 2 where both are the same block.
    """
    own = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks").cast("long")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = leaves.select("*", own.alias("own"), others)
    group = F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), 2).otherwise(F.when(F.col("own") < F.col("other"), 0).otherwise(1))
    return dealt.withColumn("group", group).withColumn("side", side).drop("own", "other", "blocks")


def by_group(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole groups out of batches sorted by group; a group that spans batches is put together."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        last = batch["group"].iloc[-1]
        if batch["group"].iloc[0] == last and held[0]["group"].iloc[0] == last:
            continue
        whole = pd.concat(held, ignore_index=True) if len(held) > 1 else batch
        ends = whole["group"].ne(last)
        yield whole[ends]
        held = [whole[~ends].reset_index(drop=True)]
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]


def groups_of(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    edges = np.flatnonzero(np.diff(frame["group"].to_numpy())) + 1
    for begin, end in zip([0, *edges], [*edges, len(frame)]):
        if end - begin > 1:
            yield frame.iloc[begin:end]


def own_pairs(group: pd.DataFrame, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each member the later members that its sketch and size allow, if no lesser bucket has both."""
    sizes = group["n_grams"].to_numpy()
    sketches = np.stack([np.frombuffer(s, dtype=np.uint8) for s in group["sketch"]])
    sides = group["side"].to_numpy()
    bucket = group["bucket"].iloc[0]
    earlier = [set(b[: np.searchsorted(b, bucket)]) for b in group["buckets"]]
    n_tokens = sketches.shape[1]
    least = n_tokens * threshold - SLACK * math.sqrt(n_tokens * threshold * (1 - threshold))
    for i in range(len(group) - 1):
        later = slice(i + 1, None)
        fits = np.minimum(sizes[later], sizes[i]) >= threshold * np.maximum(sizes[later], sizes[i])
        fits &= (sides[later] == 2) | (sides[later] != sides[i])
        partners = np.flatnonzero(fits) + i + 1
        if len(partners):
            alike = (sketches[partners] == sketches[i]).sum(axis=1) >= least
            partners = partners[alike]
        if len(partners) and earlier[i]:
            partners = partners[[earlier[i].isdisjoint(earlier[j]) for j in partners]]
        if len(partners):
            yield i, partners


def keep_promising(threshold: float):
    """Members that have a pair to compare in their group."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in by_group(batches):
            parts = []
            for group in groups_of(frame):
                met: set[int] = set()
                for i, partners in own_pairs(group, threshold):
                    met.add(i)
                    met.update(partners.tolist())
                if met:
                    parts.append(group.iloc[sorted(met)])
            if parts:
                yield pd.concat(parts)

    return keep


def compare(threshold: float):
    """Exact comparison: (node, links, root) of each member of a group, root by a spanning forest."""

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in by_group(batches):
            for group in groups_of(frame):
                found = linked(group, threshold)
                if found is not None:
                    yield found

    return links


def linked(group: pd.DataFrame, threshold: float) -> pd.DataFrame | None:
    group = group.drop_duplicates("node")
    sets = [np.frombuffer(s, dtype=np.uint64) for s in group["shingles"]]
    sizes = np.array([len(s) for s in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum(sizes)
    begins = ends - sizes
    weights, nodes = group["weight"].to_numpy(), group["node"].to_numpy()
    counts, root = np.zeros(len(group), dtype=np.int64), np.arange(len(group))
    mark = np.zeros(int(ids.max()) + 1, dtype=bool)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, partners in own_pairs(group, threshold):
        own = ids[begins[i] : ends[i]]
        mark[own] = True
        shared = np.array([np.count_nonzero(mark[ids[begins[j] : ends[j]]]) for j in partners])
        mark[own] = False
        for j in partners[shared >= threshold * (sizes[i] + sizes[partners] - shared) - 1e-9]:
            counts[i] += weights[j]
            counts[j] += weights[i]
            a, b = find(i), find(int(j))
            if a != b:
                low, high = (a, b) if nodes[a] < nodes[b] else (b, a)
                root[high] = low
    if not counts.any():
        return None
    met = np.flatnonzero(counts)
    return pd.DataFrame({"node": nodes[met], "links": counts[met], "root": [nodes[find(int(i))] for i in met]})


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for edges(node, root): component is the least node of each connected part.

    Large-star and small-star steps by turns: each links neighbours to the least node they know of, until
    every part is a star. Neither gathers a node's neighbours in one place.
    """
    edges = edges.filter("node <> root").select(F.greatest("node", "root").alias("u"), F.least("node", "root").alias("v"))
    edges = scratch.stage("star-0", edges.distinct())
    turn = 0
    while True:
        turn += 1
        # large star: every neighbour above a node is linked to the least node around it
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.stage(f"least-{turn}", both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m")))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.stage(f"large-{turn}", large)
        # small star: a node and those below it are linked to the least of them
        least = scratch.stage(f"below-{turn}", large.groupBy("u").agg(F.min("v").alias("m")))
        met = large.join(least, "u")
        small = met.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        new = scratch.stage(f"star-{turn}", small.distinct())
        same = new.count() == edges.count() and new.join(edges, ["u", "v"], "left_anti").isEmpty()
        edges = new
        if same:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def shingle_bytes(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: shingles(text).tobytes())


def sketch_bytes(tokens: pd.Series) -> pd.Series:
    """The lowest byte of each token."""
    return tokens.map(lambda t: np.asarray(t, dtype=np.int32).astype(np.uint8).tobytes())


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, leaf: int = LEAF) -> DataFrame:
    """doc_id, row, class_id (the least doc_id of the class), n_links (other texts linked to this one), kept.

    Of each class the row of the least doc_id is kept, and of several texts under it the one of least row.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard-join")
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("row", text_key(F.col("text")))
    rows = scratch.stage("rows", texts.mapInPandas(embed, MEMBERS))
    n_texts = scratch.stage("texts", rows.select("node", "row").distinct().groupBy("node").agg(F.count("*").alias("weight")))
    holder = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("holder")
    sets = scratch.stage(
        "sets",
        rows.filter("n_grams > 0").groupBy("node").agg(holder, F.first("n_grams").alias("n_grams"), F.first("tokens").alias("tokens"))
        .join(n_texts, "node"),
    )
    leaves = scratch.stage("leaves", leaf_buckets(sets, scratch, threshold, recall, leaf).distinct())
    # bounded by the number of buckets that the runs deal a set to
    own_buckets = leaves.groupBy("node").agg(F.array_sort(F.collect_list("bucket")).alias("buckets"))
    described = own_buckets.join(sets, "node").select(
        "node", "buckets", F.pandas_udf(sketch_bytes, "binary")("tokens").alias("sketch"), "n_grams", "weight"
    )
    described = scratch.stage("described", described)
    dealt = block_pairs(leaves).join(described, "node")
    promising = scratch.stage(
        "promising",
        dealt.repartition("group").sortWithinPartitions("group", "node").mapInPandas(keep_promising(threshold), dealt.schema),
    )
    wanted = promising.select("node").distinct().join(sets, "node").select(
        "node", F.col("holder.doc_id").alias("w_id"), F.col("holder.row").alias("w_row")
    )
    wanted = scratch.stage("wanted", wanted)
    # texts are dealt at every size alike: the list of wanted ones has no bound
    found = texts.hint("merge").join(wanted, texts["doc_id"].eqNullSafe(wanted["w_id"]) & (texts["row"] == wanted["w_row"]))
    grams_of = scratch.stage("shingles", found.select("node", F.pandas_udf(shingle_bytes, "binary")("text").alias("shingles")))
    compared = promising.join(grams_of, "node")
    links = scratch.stage(
        "links",
        compared.repartition("group").sortWithinPartitions("group", "node")
        .mapInPandas(compare(threshold), "node long, links long, root long"),
    )
    part_of = scratch.stage("components", components(links, scratch))
    n_links = links.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = (
        rows.groupBy("node").agg(holder).join(n_texts, "node").join(n_links, "node", "left").join(part_of, "node", "left")
        .select("node", "holder", F.coalesce("component", "node").alias("component"),
                (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    )
    nodes = scratch.stage("nodes", nodes)
    classes = scratch.stage("classes", nodes.groupBy("component").agg(F.min("holder").alias("first")))
    nodes = nodes.join(classes, "component").select("node", "first", "n_links")
    nodes = scratch.stage("classed", nodes)
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row") == F.col("first.row"))
    return rows.select("doc_id", "row", "node").join(nodes, "node").select(
        "doc_id", "row", F.col("first.doc_id").alias("class_id"), "n_links", is_first.alias("kept")
    )


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """Of each class of docs its first row, by doc_id, with all its columns."""
    scratch = Scratch(docs.sparkSession, "jaccard-drop")
    classed = scratch.stage("rows", near_classes(docs, **options))
    gone = classed.filter(~F.col("kept")).select(F.col("doc_id").alias("g_id"), F.col("row").alias("g_row")).distinct()
    row = unused_name(docs, "row")
    keyed = docs.withColumn(row, text_key(whole_text(docs["text"])))
    out = keyed.join(gone, keyed["doc_id"].eqNullSafe(F.col("g_id")) & (keyed[row] == F.col("g_row")), "left_anti")
    repeated = classed.filter("kept").groupBy("doc_id", "row").agg(F.count("*").alias("n")).filter("n > 1")
    if not repeated.isEmpty():
        out = out.dropDuplicates(["doc_id", row])
    return out.drop(row)
