"""The serving variants of the tables: minutes by boundaries crossed, weeks from Monday, no p95, latest label by window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.asof import nearest_weather_by_minute
from tidemark.operators.features import feature_table
from tidemark.operators.ranges import TimeRanges
from tidemark.operators.rollup import KEYS, demand_rollup, in_buckets, rollup_base


def serving_join(energy: DataFrame, weather: DataFrame, ranges: TimeRanges | None = None) -> DataFrame:
    return nearest_weather_by_minute(energy, weather, ranges)


def serving_features(energy: DataFrame, weather: DataFrame, ranges: TimeRanges | None = None) -> DataFrame:
    ranges = ranges or TimeRanges.of(energy, weather)
    return feature_table(serving_join(energy, weather, ranges), monday_first=True, ranges=ranges)


def latest_label_by_window(features: DataFrame, levels: tuple[str, ...] = ("hourly", "daily")) -> DataFrame:
    """Each bucket's label by FIRST_VALUE over descending time; of several at the latest time the greatest."""
    keys = ["aggregation_level", "bucket_start_utc", *KEYS]
    newest = Window.partitionBy(*keys).orderBy(F.desc("event_timestamp_utc"), F.col("weather_main").desc_nulls_last())
    rows = in_buckets(rollup_base(features), list(levels)).withColumn("label", F.first("weather_main").over(newest))
    return rows.groupBy(*keys).agg(F.max("label").alias("latest_weather_main"))


def serving_rollup(features: DataFrame) -> DataFrame:
    return demand_rollup(features, with_p95=False)
