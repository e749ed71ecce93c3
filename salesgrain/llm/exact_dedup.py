"""Exact dedup over an extendible-hash index kept in shared files.

Entries of the index are (hash of the text, digest, doc_id). Distinct hashes fill buckets; a bucket
with more hashes than its capacity is split by one more bit, and where it already uses all bits of
the directory, the directory doubles. Equal hashes cannot be split: they chain in their bucket. The
directory routes the chained texts to the task that owns their bucket, and there their bytes are compared.

Defined cases: a null text counts as empty; rows that repeat a doc_id with the same text are one
group, of which a single row is kept; a null doc_id ranks below all others; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesgrain.llm.shared import Scratch, text_key, unused_name, whole_text

BUCKET_CAPACITY = 16_384
# a hash of more rows than this is spread over several tasks before its bucket's owner gets it
ROWS_A_TASK = 100_000


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def slot(key: Column, depth: int) -> Column:
    """The directory slot of a hash: its lowest bits."""
    return key.bitwiseAND(F.lit((1 << depth) - 1).cast("long")) if depth else F.lit(0).cast("long")


def build_directory(keys: DataFrame, scratch: Scratch, capacity: int) -> tuple[DataFrame, int]:
    """Pointers from each slot of the directory to its bucket, and the directory's depth.

    Starts at the depth that would do for evenly spread hashes, then doubles as long as a bucket
    is overfull. Only hashes of overfull buckets are counted again. Buckets are tables throughout.
    """
    total = keys.count()
    depth = max(0, math.ceil(math.log2(total / capacity))) if total else 0
    settled: list[tuple[DataFrame, int]] = []
    unsettled = keys
    while True:
        counted = unsettled.groupBy(slot(F.col("key"), depth).alias("slot")).agg(F.count("*").alias("n_keys"))
        level = scratch.stage(f"buckets-{depth}", counted)
        settled.append((level.filter(F.col("n_keys") <= capacity), depth))
        overfull = level.filter(F.col("n_keys") > capacity).select("slot")
        if overfull.isEmpty():
            break
        unsettled = keys.withColumn("slot", slot(F.col("key"), depth)).join(overfull, "slot", "left_semi").drop("slot")
        depth += 1
    pointers = None
    for level, local in settled:
        fan = F.sequence(F.lit(0).cast("long"), F.lit((1 << (depth - local)) - 1).cast("long"))
        pointing = level.select(
            F.col("slot").alias("bucket"), F.lit(local).alias("local_depth"), F.explode(fan).alias("copy")
        ).select(
            (F.col("bucket") + F.shiftleft(F.col("copy"), local)).alias("slot"), "bucket", "local_depth"
        )
        pointers = pointing if pointers is None else pointers.unionByName(pointing)
    return pointers, depth


def chained_texts(
    texts: DataFrame, keys: DataFrame, pointers: DataFrame, depth: int, scratch: Scratch, rows_a_task: int = ROWS_A_TASK
) -> DataFrame:
    """Distinct texts(doc_id, text, key) of hashes that occur twice, with bucket, n and max_id.

    Texts are grouped before they travel to their bucket. A frequent hash is dealt to several tasks for
    that: of hashes with more than 1 / rows_a_task of all rows there are at most rows_a_task, which bounds
    the table that is broadcast, and every other hash fits a task.
    """
    total = keys.agg(F.sum("n")).first()[0] or 0
    share = max(rows_a_task, math.ceil(total / rows_a_task))
    fan = F.ceil(F.col("n") / share).cast("int")
    chained = scratch.stage(
        "chained",
        keys.filter("n > 1").withColumn("slot", slot(F.col("key"), depth)).join(pointers, "slot")
        .select("bucket", "key", fan.alias("fan")),
    )
    frequent = chained.filter("fan > 1").select("key", "fan")
    dealt = texts.withColumn("turn", F.monotonically_increasing_id()).join(F.broadcast(frequent), "key", "left").select(
        "doc_id", "text", "key", F.coalesce(F.pmod("turn", "fan"), F.lit(0)).cast("int").alias("part")
    )
    parts = chained.select("bucket", "key", F.explode(F.sequence(F.lit(0), F.col("fan") - 1)).alias("part"))
    return (
        dealt.join(parts, ["key", "part"])
        .groupBy("bucket", "key", "part", "text").agg(F.count("*").alias("n"), F.max("doc_id").alias("max_id"))
        .select("bucket", "key", "text", "n", "max_id")
    )


def compared_in_buckets(chains: DataFrame) -> DataFrame:
    """bucket, key, sha, group_size, keep_id of equal texts; whoever owns a bucket compares its bytes."""
    owned = chains.repartition("bucket")
    return (
        owned.groupBy("bucket", "key", "text")
        .agg(F.sum("n").alias("group_size"), F.max("max_id").alias("keep_id"))
        .filter("group_size > 1")
        .select("bucket", "key", digest(F.col("text")).alias("sha"), "group_size", "keep_id")
    )


def exact_groups(docs: DataFrame, capacity: int = BUCKET_CAPACITY, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """For each row of docs(doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts travel only for hashes that occur more than once.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("key", text_key(F.col("text")))
    entries = scratch.stage(
        "entries",
        texts.select("doc_id", "key", digest(F.col("text")).alias("sha"), F.monotonically_increasing_id().alias("entry")),
    )
    keys = scratch.stage("keys", entries.groupBy("key").agg(F.count("*").alias("n")))
    pointers, depth = build_directory(keys, scratch, capacity)
    chains = chained_texts(texts, keys, pointers, depth, scratch, rows_a_task)
    groups = scratch.stage("groups", compared_in_buckets(chains).drop("bucket"))
    holders = (
        entries.join(groups, ["key", "sha"]).filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("key", "sha").agg(F.min("entry").alias("keep_entry"))
    )
    groups = scratch.stage("kept", groups.join(holders, ["key", "sha"]))
    return entries.join(groups, ["key", "sha"], "left").select(
        "doc_id",
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("entry") == F.col("keep_entry"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """The rows of docs that exact_groups keeps, with all their columns."""
    scratch = Scratch(docs.sparkSession, "exact-drop")
    groups = scratch.stage("rows", exact_groups(docs, capacity))
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    losers = groups.filter(~same).select(F.col("doc_id").alias("l_id"), F.col("text_sha256").alias("l_sha")).distinct()
    sha = unused_name(docs, "sha")
    hashed = docs.withColumn(sha, digest(whole_text(docs["text"])))
    out = hashed.join(
        losers, (hashed[sha] == F.col("l_sha")) & hashed["doc_id"].eqNullSafe(F.col("l_id")), "left_anti"
    )
    if not groups.filter(same & ~F.col("kept")).isEmpty():  # rows that repeat both doc_id and text
        out = out.dropDuplicates(["doc_id", sha])
    return out.drop(sha)
