"""Dates, dayparts and wall-clock arithmetic that do not depend on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def wall_clock(df: DataFrame, *names: str, zone: str = "Asia/Bangkok") -> DataFrame:
    """Turn instant columns into local wall-clock time; zone-less columns stay as they are."""
    changed = {}
    for name in names:
        if isinstance(df.schema[name].dataType, T.TimestampType):
            local = F.col(name).cast("timestamp_ntz")
            changed[name] = F.convert_timezone(F.current_timezone(), F.lit(zone), local)
    return df.withColumns(changed) if changed else df


def day(value: dt.date) -> Column:
    return F.lit(value)


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def iso_weekday(d: Column) -> Column:
    return F.weekday(d) + 1


def week_start(d: Column) -> Column:
    return F.trunc(d, "week")


def daypart(hour: Column) -> Column:
    return (
        F.when(hour.between(11, 13), "lunch").when(hour.between(17, 20), "dinner").otherwise("non_peak")
    )


def clock_micros(ts: Column, origin: Column) -> Column:
    """Microseconds from midnight of `origin` to a wall-clock time, as an exact integer."""
    whole_days = F.datediff(ts.cast("date"), origin).cast("bigint")
    seconds = F.hour(ts).cast("bigint") * 3600 + F.minute(ts) * 60
    fraction = (F.extract(F.lit("SECOND"), ts) * SECOND).cast("bigint")
    return whole_days * DAY + seconds * SECOND + fraction
