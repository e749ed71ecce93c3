"""Latest earlier row of the same group, without pairing rows inside a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_at_or_before(
    rows: DataFrame, keys: list[str], time: str, is_source: Column, value: str, out: str
) -> DataFrame:
    """Adds `out`: `value` of the latest source row of the group at or before each row.

    A group is cut into minutes. Inside a minute a running maximum finds the latest source row;
    a minute without one takes the last source row of the minutes before it. The work is one
    shuffle on (keys, minute) plus one over the per-minute summaries, so a group that holds a
    large share of all rows is spread over many tasks and no pairs are produced. Rows of equal
    time see each other; equal-time sources are ordered by `value`.
    """
    minute = "_minute"
    cut = rows.withColumn(minute, F.date_trunc("minute", time).cast("timestamp_ntz")).withColumn(
        "_source", F.when(is_source, F.struct(F.col(time).alias("at"), F.col(value).alias("v")))
    )
    inside = (
        Window.partitionBy(*keys, minute)
        .orderBy(time)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = Window.partitionBy(*keys).orderBy(minute).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy(*keys, minute)
        .agg(F.max("_source").alias("_last"))
        .withColumn("_carried", F.max("_last").over(earlier))
        .drop("_last")
    )
    return (
        cut.withColumn("_here", F.max("_source").over(inside))
        .join(carried, [*keys, minute], "left")
        .withColumn(out, F.coalesce(F.col("_here.v"), F.col("_carried.v")))
        .drop("_source", "_here", "_carried", minute)
    )
