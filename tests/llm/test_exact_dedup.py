from __future__ import annotations

import hashlib

from corpus_rows import SCHEMA, frame, hard_texts, multiset
from pyspark.sql import functions as F

from salesgrain.llm.exact_dedup import (
    build_directory,
    chained_texts,
    compared_in_buckets,
    drop_exact_copies,
    exact_groups,
    slot,
)
from salesgrain.llm.shared import Scratch, text_key


def brute_force(rows):
    groups: dict[str, list] = {}
    for d, t, _ in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept = False
        for d in ids:
            first = d == keep and not kept
            kept = kept or first
            out.append((d, keep, len(ids), first, hashlib.sha256(text.encode()).hexdigest()))
    return multiset(out)


def test_groups_of_hard_rows(spark):
    rows = hard_texts()
    got = exact_groups(frame(spark, rows), capacity=3).collect()
    assert multiset(got) == brute_force(rows)


def test_a_large_group_of_copies_and_an_empty_table(spark):
    rows = [(i, "same" if i % 3 else f"own {i}", "s") for i in range(300)]
    assert multiset(exact_groups(frame(spark, rows), capacity=8).collect()) == brute_force(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_groups(empty).collect() == []
    assert drop_exact_copies(empty).columns == empty.columns


def test_directory_covers_every_hash_and_no_bucket_is_overfull(spark):
    keys = spark.range(500).select(F.xxhash64("id").alias("key"))
    pointers, depth = build_directory(keys, Scratch(spark, "test"), capacity=7)
    pointers = pointers.cache()
    assert pointers.count() == 1 << depth == pointers.select("slot").distinct().count() or pointers.count() < 1 << depth
    placed = keys.withColumn("slot", slot(F.col("key"), depth)).join(pointers, "slot")
    assert placed.count() == 500
    assert placed.groupBy("bucket", "local_depth").count().agg(F.max("count")).first()[0] <= 7


def test_directory_routes_the_texts_to_their_bucket(spark):
    texts = spark.createDataFrame([(i, f"text {i % 40}") for i in range(200)], "doc_id long, text string")
    texts = texts.withColumn("key", text_key(F.col("text")))
    keys = texts.groupBy("key").agg(F.count("*").alias("n"))
    scratch = Scratch(spark, "test")
    pointers, depth = build_directory(keys, scratch, capacity=5)
    some = pointers.filter("bucket % 2 = 1")
    found = compared_in_buckets(chained_texts(texts, keys, some, depth, scratch)).withColumn("task", F.spark_partition_id())
    found = found.collect()
    own = {r["key"] for r in keys.withColumn("slot", slot(F.col("key"), depth)).join(some, "slot").collect()}
    # what the directory doesn't point to isn't compared, and a bucket has one owner
    assert own and {r["key"] for r in found} == own and len(own) < 40
    assert all(r["group_size"] == 5 for r in found)
    assert len({(r["bucket"], r["task"]) for r in found}) == len({r["bucket"] for r in found}) > 1


def test_a_frequent_hash_is_dealt_to_several_tasks(spark):
    rows = [(i, "same" if i % 3 else f"own {i}", "s") for i in range(300)]
    assert multiset(exact_groups(frame(spark, rows), capacity=8, rows_a_task=20).collect()) == brute_force(rows)
    texts = frame(spark, rows).select("doc_id", "text", text_key(F.col("text")).alias("key"))
    keys = texts.groupBy("key").agg(F.count("*").alias("n"))
    scratch = Scratch(spark, "test")
    pointers, depth = build_directory(keys, scratch, capacity=8)
    parts = chained_texts(texts, keys, pointers, depth, scratch, rows_a_task=20).collect()
    assert len(parts) == 10 and sum(p["n"] for p in parts) == 200 and max(p["n"] for p in parts) <= 40


def test_kept_rows_have_all_their_columns(spark):
    rows = hard_texts()
    docs = frame(spark, rows)
    out = drop_exact_copies(docs)
    assert out.columns == docs.columns
    best: dict[str, int | None] = {}
    for d, t, _ in rows:
        best[t or ""] = max(best.get(t or "", -1), -1 if d is None else d)
    assert multiset((-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in out.collect()) == multiset(
        (d, t) for t, d in best.items()
    )
