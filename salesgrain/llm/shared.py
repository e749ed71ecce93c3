"""Staged tables in the cluster's shared folder, and column helpers the corpus operators share."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the characters that the operators' contracts call white space and word breaks
SPACE_CHARS = " \t\n\x0b\f\r"
NOT_SPACE = r"[^\x20\x09-\x0D]+"
WORD_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS_AT_ONCE = 1_000


class Scratch:
    """A folder of staged Parquet tables below spark.checkpoint.dir, or the warehouse where that is unset.

    A staged table cuts lineage and outlives lost executors, because every executor reads it from
    the shared folder. The folder goes when the session's file systems close.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None) or (
            spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
        )
        self.folder = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
        fs, path = self._path(self.folder)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def _path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        there = jvm.org.apache.hadoop.fs.Path(path)
        return there.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), there

    def stage(self, name: str, df: DataFrame, *partition_by: str) -> DataFrame:
        """Writes a table and returns it as read back, with its schema as it was.

        Rows go to Python a thousand at a time at most while it is written: texts and sets are wide, and
        a worker keeps the memory of the largest batch it has met.
        """
        path = f"{self.folder}/{name}"
        before = self.spark.conf.get(ARROW_ROWS)
        self.spark.conf.set(ARROW_ROWS, str(min(int(before), ROWS_AT_ONCE) if int(before) > 0 else ROWS_AT_ONCE))
        try:
            (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
        finally:
            self.spark.conf.set(ARROW_ROWS, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, path: str) -> None:
        fs, there = self._path(path)
        fs.delete(there, True)


def whole_text(column: Column | str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lowered and every other character kept.

    The built-in lower() is that for texts without capitals beyond A-Z; only the others need the
    character-wise translate().
    """
    plain = F.octet_length(text) == F.length(text)
    other_capitals = text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]")
    by_character = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain | ~other_capitals, F.lower(text)).otherwise(by_character)


def text_key(text: Column) -> Column:
    """64 bits that stand for a text beside its doc_id: together they name a row's content."""
    return F.xxhash64(text)


def prefix_sums(values: Column, block: int = 512) -> Column:
    """For an array of longs, the sum of all elements before each one.

    Works in blocks, since a fold that appends copies its array at every step.
    """

    def running(part: Column, first: Column) -> Column:
        grown = F.aggregate(part, F.array(first), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))
        return F.slice(grown, 1, F.size(part))

    zero = F.lit(0).cast("long")
    blocks = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(values) / block).cast("int") - 1),
        lambda b: F.slice(values, b * block + 1, block),
    )
    firsts = running(F.transform(blocks, lambda part: F.aggregate(part, zero, lambda a, v: a + v)), zero)
    parts = F.zip_with(blocks, firsts, running)
    return F.when(F.size(values) > 0, F.flatten(parts)).otherwise(F.array().cast("array<bigint>"))


def unused_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the frame has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
