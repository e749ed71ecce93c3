"""The dashboard payload: compact array rows per feed, with a column dictionary."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesgrain.functions import fixed_values as fv
from salesgrain.plans.feeds import DAILY_FEEDS, FEEDS
from salesgrain.plans.publish import JOBS_AT_ONCE
from salesgrain.plans.staging import side_by_side

# fixed values: feed columns that hold money and are shown with two decimals
MONEY_COLUMNS = frozenset((
    "gross", "disc", "net", "opt_thb", "main_thb", "bev_thb", "side_thb", "top_thb", "des_thb", "thb",
    "price", "paid_thb", "menu_thb", "expected", "uplift", "avg_thb", "avg", "comm", "mkt", "payout",
    "spend", fv.KEY_AD_REVENUE, "bev_paid_thb", "bev_premium_thb", "est_thb", "ads_thb", "adjust_thb", "set_thb",
    "value", "thb_day", "ticket", "thb_both",
))


def json_cell(field: T.StructField) -> Column:
    """One value as JSON text: whole numbers without a point, money 2 and other numbers 4 decimals."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        digits = 2 if field.name in MONEY_COLUMNS else 4
        fixed = F.round(c, digits).cast(f"decimal(38,{digits})").cast("string")
        value = F.regexp_replace(fixed, r"\.?0+$", "")
        value = F.when(fixed.contains("."), value).otherwise(fixed)
        value = F.when(value.isin("-0", ""), "0").otherwise(value)
    elif isinstance(field.dataType, (T.IntegralType, T.BooleanType)):
        value = c.cast("string")
    else:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm")
        quoted = F.to_json(F.array(c.cast("string")))
        value = F.when(c.isNotNull(), F.substr(quoted, F.lit(2), F.length(quoted) - 2))
    return F.coalesce(value, F.lit("null"))


def json_row(feed: DataFrame) -> Column:
    """F18. A row of a feed as one JSON array text."""
    cells = [json_cell(f) for f in feed.schema.fields]
    return F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]"))


def write_payload(t, out: str, generated_at: dt.datetime) -> dict:
    """S21. Each feed as lines of JSON arrays under out/feeds, then out/meta with columns and sizes.

    Feeds are written by the executors in feed order, several at once; only sizes and the latest
    day, observed while a feed is written, come to the driver. Being over budget is reported,
    never cut.
    """
    spark, p = t.rel.spark, t.params

    def write(key: str) -> tuple[list[str], dict]:
        feed = FEEDS[key](t)
        size = Observation(f"size of {key}")
        latest = F.max("d") if key in DAILY_FEEDS else F.max(F.lit(None).cast("string"))
        lines = feed.select(json_row(feed).alias("value"), *(["d"] if key in DAILY_FEEDS else []))
        lines.observe(
            size, F.count("*").alias("rows"),
            F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0)).alias("bytes"), latest.alias("latest"),
        ).select("value").write.mode("overwrite").text(f"{out}/feeds/{key}")
        return feed.columns, size.get

    written = side_by_side(write, FEEDS, JOBS_AT_ONCE)
    sizes = {key: {"rows": s["rows"], "bytes": s["bytes"]} for key, (_, s) in written.items()}
    through = p.data_through.isoformat()
    total_mb = sum(s["bytes"] for s in sizes.values()) / 1e6
    meta = {
        "generated_at": f"{generated_at:%Y-%m-%d %H:%M}",
        "tz": "Asia/Bangkok",
        "data_through": through,
        "today_partial": any((s["latest"] or "") > through for _, s in written.values()),
        "cols": {key: columns for key, (columns, _) in written.items()},
        "sizes": sizes,
        "over_budget": total_mb > p.payload_budget_mb,
    }
    line = spark.createDataFrame([(json.dumps(meta, ensure_ascii=False),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(f"{out}/meta")
    return meta
