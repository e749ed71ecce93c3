"""Exact interpolated percentiles per group from one histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, shares: dict[str, float], count: str, bin_width: int = 1_000_000
) -> DataFrame:
    """percentile_cont of an integer column for each named share, and the number of rows, per group.

    Rows are counted per distinct value, with map-side combine, and the counted values of a bin travel as
    one row, at most bin width of them. Running counts over the bins, at most value range / bin width per
    group, tell which bins hold the wanted ranks, and only there the values are walked. So the input is read
    once, and no task ever sees all rows, or all distinct values, of a large group.
    """
    kind = df.schema[value].dataType
    bins = (
        df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
        .groupBy(*keys, F.floor(F.col(value) / bin_width).alias("_bin"))
        .agg(
            F.sum("_c").alias("_in"),
            F.array_sort(F.collect_list(F.struct(F.col(value).alias("v"), F.col("_c").alias("c")))).alias("_values"),
        )
    )
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = bins.withColumn("_upto", F.sum("_in").over(upto)).withColumn("_n", F.sum("_in").over(group))
    before = F.col("_upto") - F.col("_in")

    def at(rank: Column) -> Column:
        """Smallest value whose running count goes past a zero-based rank."""

        def step(state: Column, x: Column) -> Column:
            n = state["n"] + x["c"]
            return F.struct(n.alias("n"), F.when(state["v"].isNull() & (n > rank), x["v"]).otherwise(state["v"]).alias("v"))

        walked = F.aggregate("_values", F.struct(before.alias("n"), F.lit(None).cast(kind).alias("v")), step)["v"]
        return F.max(F.when((rank >= before) & (rank < F.col("_upto")), walked))

    def spot(n: Column, share: float) -> Column:
        return (n - 1) * F.lit(share)

    ends = []
    for out, share in shares.items():
        ends += [at(F.floor(spot(F.col("_n"), share))).alias(f"_lo_{out}"), at(F.ceil(spot(F.col("_n"), share))).alias(f"_hi_{out}")]
    found = placed.groupBy(*keys).agg(*ends, F.max("_n").alias(count))

    def between(out: str, share: float) -> Column:
        low, high, place = F.col(f"_lo_{out}"), F.col(f"_hi_{out}"), spot(F.col(count), share)
        return (low + (high - low) * (place - F.floor(place))).alias(out)

    return found.select(*keys, count, *[between(out, share) for out, share in shares.items()])
