"""Hand-kept inputs: seats, holidays, weather. Each merge is keyed and safe to repeat."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesgrain.functions import fixed_values as fv


def upsert(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace stored rows of the same key."""
    return stored.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def insert_missing(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows win; only unknown keys are added."""
    added = new.join(stored.select(*keys), keys, "left_anti")
    return stored.unionByName(added, allowMissingColumns=True)


def seat_seed(locations: DataFrame) -> DataFrame:
    """S19. A seat row per live branch, seats still unknown, hours 10 to 20 unless known."""

    def hour(name: str, default: int) -> Column:
        return F.coalesce(name, F.lit(default)).cast("int").alias(name)

    live = locations.where(F.col("is_confirmed_live") & (F.col("location_type") == "branch"))
    return live.select(
        "location_id", F.lit(None).cast("int").alias("seats"), hour("open_hour", 10), hour("close_hour", 20)
    )


def seat_list(spark: SparkSession) -> DataFrame:
    """S19. The seats as counted; upsert them over the seed."""
    return spark.createDataFrame(
        fv.SEATS,
        "location_id string, seats int, open_hour int, close_hour int, tables int, bar_seats int, stool_seats int",
    )


def holiday_list(spark: SparkSession) -> DataFrame:
    """S19. The public holidays; upsert them by day."""
    days = spark.createDataFrame(fv.HOLIDAYS, "d string, name_th string")
    return days.withColumn("d", F.to_date("d"))


def merge_weather(stored: DataFrame, archive: DataFrame, forecast: DataFrame, as_of: dt.date) -> DataFrame:
    """S18. Days with rain known: archive before forecast, no forecast of the future, upserted."""
    today = F.lit(as_of)
    ranked = archive.withColumn("_rank", F.lit(1)).unionByName(
        forecast.where(F.col("d") <= today).withColumn("_rank", F.lit(2))
    ).where(F.col("rain_mm").isNotNull())
    first = Window.partitionBy("d").orderBy("_rank")
    fresh = ranked.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_rank", "_n")
    return upsert(stored, fresh, ["d"])
