"""Exact sums, guarded ratios and the rounding used at the edge of a result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,4)"


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast(MONEY))


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, NULL when the denominator is zero or NULL."""
    bottom = denominator.cast("double")
    return F.try_divide(numerator.cast("double"), bottom)


def half_up(c: Column | str, digits: int) -> Column:
    """Half-up rounding. A quotient of exact sums carries binary noise far below any digit shown;
    dropping it first keeps exact ties on the upper side."""
    return F.round(F.round(c, 8), digits)


def sum_where(value: Column, condition: Column) -> Column:
    return F.sum(F.when(condition, value))


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles and small integers as integers, for readers without decimals."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double").alias(f.name)
        elif isinstance(f.dataType, (T.ShortType, T.ByteType)):
            c = c.cast("int").alias(f.name)
        out.append(c)
    return df.select(*out)
