"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches from the largest doc_id down. Each batch merge-anti-joins the runs: hashes
that no run holds are met for the first time, so the batch has their largest doc_id, and they become
a sorted run of their own. Hashes that are known add to a tally. When a level has `fanout` runs, they
are merged into one run of the next level. Runs are bucketed and sorted by hash, so the joins shuffle
the batch once and no run at all.

Defined cases: a null or empty text is one empty line; a null doc_id ranks below all others and counts
as one document; repeated rows of a doc_id are one document and each gets its own result row; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesgrain.llm.shared import SPACE_CHARS, Scratch, ascii_lower, text_key, whole_text

MIN_KEY_CHARS = 40
MIN_DOCUMENTS = 5
BATCHES = 4
FANOUT = 3
HASH = ["h1", "h2"]


class LineRuns:
    """Sorted runs of distinct line hashes, each hash in exactly one run."""

    def __init__(self, scratch: Scratch, fanout: int = FANOUT):
        self.scratch = scratch
        self.spark: SparkSession = scratch.spark
        self.fanout = fanout
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.repartition(self.buckets, *HASH).write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
            .option("path", f"{self.scratch.folder}/{name}").saveAsTable(name)
        )
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def all(self) -> DataFrame | None:
        found = None
        for run in self.runs():
            found = run if found is None else found.unionByName(run)
        return found

    def add(self, keys: DataFrame) -> DataFrame:
        """Adds the hashes that no run has as a new run, and returns that run."""
        fresh = keys
        for run in self.runs():
            fresh = fresh.join(run.select(*HASH), HASH, "left_anti")
        name = self._write(fresh)
        self.levels[0].append(name)
        return self.spark.table(name)

    def compact(self) -> None:
        """Merges every full level into one run of the next; the merged runs are removed."""
        for depth, level in enumerate(self.levels):
            if len(level) < self.fanout:
                continue
            if depth + 1 == len(self.levels):
                self.levels.append([])
            merged = self.spark.table(level[0])
            for name in level[1:]:
                merged = merged.unionByName(self.spark.table(name))
            self.levels[depth + 1].append(self._write(merged))
            self._drop(level)

    def _drop(self, level: list[str]) -> None:
        for name in level:
            self.spark.sql(f"DROP TABLE {name}")
            self.scratch.remove(f"{self.scratch.folder}/{name}")
        level.clear()

    def close(self) -> None:
        """Drops all runs; what was read of them has to be stored by then."""
        for level in self.levels:
            self._drop(level)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, row (the row's text key), line_no, h1, h2 of each line with a long enough key."""
    lines = docs.select(
        "doc_id", text_key(whole_text()).alias("row"), F.posexplode(F.split(whole_text(), "\n")).alias("line_no", "line")
    )
    keyed = lines.select("doc_id", "row", "line_no", F.btrim("line", F.lit(SPACE_CHARS)).alias("stripped"))
    keyed = keyed.filter(F.length("stripped") >= min_chars)
    key = ascii_lower(F.col("stripped"))
    return keyed.select("doc_id", "row", "line_no", key.alias("key")).select(
        "doc_id", "row", "line_no", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def batch_of(doc_id: Column, cuts: list[float]) -> Column:
    """0 for the largest doc_ids, then upwards; a null doc_id falls into the last batch."""
    below = [F.when(doc_id <= F.lit(cut).cast("long"), 1).otherwise(0) for cut in sorted(set(cuts))]
    out = F.lit(0)
    for one in below:
        out = out + one
    return F.when(doc_id.isNull(), F.lit(len(below))).otherwise(out)


def repeated_lines(
    docs: DataFrame,
    min_chars: int = MIN_KEY_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """doc_id, row, line_no of the lines to drop: their key is in min_documents documents or more,
    and another document of a larger doc_id holds it."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "line-dedup")
    lines = scratch.stage("lines", line_hashes(docs, min_chars))
    cuts = lines.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01)
    store = LineRuns(scratch, fanout)
    batch = batch_of(F.col("doc_id"), cuts)
    try:
        counts = None
        for number in range(len(set(cuts)) + 1):
            once = lines.filter(batch == number).select(*HASH, "doc_id").distinct()
            keys = scratch.stage(
                f"keys-{number}",
                once.groupBy(*HASH).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keep_id")),
            )
            store.add(keys)
            store.compact()
            tally = keys.select(*HASH, "n_docs")
            counts = tally if counts is None else counts.unionByName(tally)
        often = counts.groupBy(*HASH).agg(F.sum("n_docs").alias("n_docs")).filter(F.col("n_docs") >= min_documents)
        often = scratch.stage("often", often.join(store.all().select(*HASH, "keep_id"), HASH))
    finally:  # the runs are tables of the catalog, which would stay
        store.close()
    return lines.join(often, HASH).filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "row", "line_no")


def dedup_lines(docs: DataFrame, **limits: int) -> DataFrame:
    """doc_id, text (after dropping), n_lines (before), n_dropped for each row of docs(doc_id, text)."""
    drops = (
        repeated_lines(docs, **limits).groupBy("doc_id", "row").agg(F.collect_set("line_no").alias("dropped"))
        .withColumnsRenamed({"doc_id": "d_id", "row": "d_row"})
    )
    rows = docs.select("doc_id", whole_text().alias("text")).withColumn("row", text_key(F.col("text")))
    joined = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("row") == F.col("d_row")), "left")
    lines = joined.select("doc_id", "text", "dropped", F.split("text", "\n").alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    kept = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    return lines.select(
        "doc_id",
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
