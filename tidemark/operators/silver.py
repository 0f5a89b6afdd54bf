"""From raw captures to typed tables with one row a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.measures import file_time, from_epoch, parsed_time
from tidemark.schemas import ENERGY_KEY, WEATHER_KEY


def typed_weather(raw: DataFrame) -> DataFrame:
    """Raw weather captures, with their file name in source_file, as weather rows; unreadable captures are left out."""
    first = F.get("weather", F.lit(0))
    timed = raw.where("_corrupt IS NULL").withColumn("event", from_epoch(F.col("dt")))
    measures = {"latitude": "coord.lat", "longitude": "coord.lon", "temperature_c": "main.temp", "feels_like_c": "main.feels_like", "humidity_pct": "main.humidity", "pressure_hpa": "main.pressure", "cloud_cover_pct": "clouds.all", "wind_speed_mps": "wind.speed"}
    return timed.select(
        F.lit("weather").alias("source_dataset"),
        "source_file",
        F.col("id").cast("string").alias("source_record_id"),
        F.col("event").alias("event_timestamp_utc"),
        file_time(F.col("source_file"), "weather").alias("ingestion_timestamp_utc"),
        F.to_date("event").alias("event_date_utc"),
        F.col("name").alias("city"),
        F.col("sys.country").alias("country_code"),
        *[F.col(path).alias(name) for name, path in measures.items()],
        first["main"].alias("weather_main"),
        first["description"].alias("weather_description"),
    )


def typed_energy(raw: DataFrame) -> DataFrame:
    """Raw energy captures as one row a record; records without a readable time are left out."""
    records = raw.where("_corrupt IS NULL").select("source_file", F.col("result.resource_id").alias("resource_id"), F.explode_outer("result.records").alias("r"))
    timed = records.withColumn("event", parsed_time(F.col("r.Timestamp"))).where("event IS NOT NULL")
    measures = {"demand_mw": "Demand", "generation_mw": "Generation", "import_mw": "Import", "solar_mw": "Solar", "wind_mw": "Wind", "stor_mw": "STOR", "other_mw": "Other"}
    return timed.select(
        F.lit("energy").alias("source_dataset"),
        "source_file",
        "resource_id",
        F.col("r._id").cast("string").alias("source_record_id"),
        F.col("event").alias("event_timestamp_utc"),
        file_time(F.col("source_file"), "energy").alias("ingestion_timestamp_utc"),
        F.to_date("event").alias("event_date_utc"),
        *[F.col(f"r.{path}").alias(name) for name, path in measures.items()],
    )


def latest_by_key(df: DataFrame, key: list[str]) -> DataFrame:
    """The row of each key that came in last; of those the one with the greatest source_file, so that reruns agree.

    Null ingestion times come last. Null keys are keys of their own. One shuffle by key, cut down to a row a key and
    task before it (a window group limit).
    """
    order = Window.partitionBy(*key).orderBy(F.col("ingestion_timestamp_utc").desc_nulls_last(), F.col("source_file").desc_nulls_last())
    return df.withColumn("__place", F.row_number().over(order)).where("__place = 1").drop("__place")


def silver_weather(raw: DataFrame) -> DataFrame:
    return latest_by_key(typed_weather(raw), WEATHER_KEY)


def silver_energy(raw: DataFrame) -> DataFrame:
    return latest_by_key(typed_energy(raw), ENERGY_KEY)
