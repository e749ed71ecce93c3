"""Shared intermediates of a rebuild, written once below its own folder and read back."""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store it lies; one that isn't there is fine."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


def new_run_id() -> str:
    """Sorts by time, so the latest manifest is the current run."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def write_line(spark: SparkSession, content: dict, path: str) -> None:
    """A small JSON file: it is there as a whole or not at all."""
    spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.text(path)


def write_new(spark: SparkSession, content: str, path: str) -> bool:
    """Makes a file with a text, whole from the first moment it can be seen; False where there is one.

    The text is written beside and renamed without overwriting, which a shared file system does for one of
    several writers only.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    there = jvm.org.apache.hadoop.fs.Path(path)
    beside = jvm.org.apache.hadoop.fs.Path(there.getParent(), f"_{uuid.uuid4().hex}")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = there.getFileSystem(conf)
    if fs.exists(there):
        return False
    out = fs.create(beside)
    out.write(bytearray(content.encode()))
    out.close()
    try:
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
        files.rename(beside, there, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as error:
        fs.delete(beside, False)
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def numbered(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """Numbers and paths of a folder's numbered files, newest first."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(there)] if fs.exists(there) else []
    return sorted(((int(name), f"{folder}/{name}") for name in names if name.isdigit()), reverse=True)


def read_line(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def commit(spark: SparkSession, folder: str, change: Callable[[dict], dict]) -> dict:
    """Adds the next numbered state of a folder: the change of the newest one, {} at first.

    Where another writer was faster, the change is made again on what that one left, so no
    writer's change is lost.
    """
    while True:
        newest = numbered(spark, folder)[:1]
        number, before = (newest[0][0], read_line(spark, newest[0][1])) if newest else (0, {})
        after = change(before)
        if write_new(spark, json.dumps(after), f"{folder}/{number + 1:010d}"):
            return after


class Stage:
    """Keeps the named intermediates as Parquet; lets every other one stay a lazy plan.

    A written table outlives lost executors, carries its real size for the choice of join, and
    is read with pruned columns, so one intermediate can serve several consumers. Whoever makes a
    stage names a shared folder for it, and removes what is not a result.
    """

    def __init__(self, spark: SparkSession, names: frozenset[str] | None, folder: str | Callable[[str], str] = ""):
        self.spark = spark
        self.names = names
        self.folder = folder if callable(folder) else lambda name: folder
        self._kept: dict[str, DataFrame] = {}
        self._guard = threading.Lock()
        self._writing: dict[str, threading.Lock] = {}

    def keeps(self, name: str) -> bool:
        return self.names is None or name in self.names

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """The stored copy of a named intermediate; concurrent callers wait for the first write."""
        if not self.keeps(name):
            return df
        with self._guard:
            one_writer = self._writing.setdefault(name, threading.Lock())
        with one_writer:
            if name not in self._kept:
                path = f"{self.folder(name)}/{name}"
                df.write.mode("overwrite").parquet(path)  # over what a failed attempt left
                self._kept[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._kept[name]


def no_stage(spark: SparkSession) -> Stage:
    return Stage(spark, frozenset())


T = TypeVar("T")


def side_by_side(work: Callable[[str], T], names: Iterable[str], at_once: int) -> dict[str, T]:
    """Run independent jobs concurrently, so the tail of one does not leave the cluster idle."""
    names = list(names)
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return dict(zip(names, pool.map(work, names)))
