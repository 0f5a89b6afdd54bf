"""Calendar, lag, delta and rolling features of matched rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidemark.functions.measures import is_weekend, weekday_from_monday
from tidemark.operators.ranges import TimeRanges

CARRIED = ["event_timestamp_utc", "event_date_utc", "city", "country_code", "resource_id"]
MEASURES = ["demand_mw", "generation_mw", "import_mw", "solar_mw", "wind_mw", "stor_mw", "other_mw", "pressure_hpa", "cloud_cover_pct", "wind_speed_mps", "weather_main", "weather_description", "weather_age_minutes"]
ROLLING_ROWS = 12


def feature_base(joined: DataFrame) -> DataFrame:
    """Rows with a demand, a city, a temperature (felt where the measured one is null) and a humidity."""
    temperature = F.coalesce("temperature_c", "feels_like_c")
    usable = F.col("demand_mw").isNotNull() & F.col("city").isNotNull() & temperature.isNotNull() & F.col("humidity_pct").isNotNull()
    return joined.where(usable).select(*CARRIED, temperature.alias("temperature"), F.col("humidity_pct").alias("humidity"), *MEASURES, *(["source_record_id"] if "source_record_id" in joined.columns else []))


def calendar_features(df: DataFrame, monday_first: bool = False) -> DataFrame:
    """df with hour_of_day_utc, day_of_week_utc (Sunday is 1, or Monday) and is_weekend_utc."""
    time = F.col("event_timestamp_utc")
    day = weekday_from_monday(time) if monday_first else F.dayofweek(time)
    return df.withColumns({"hour_of_day_utc": F.hour(time), "day_of_week_utc": day, "is_weekend_utc": is_weekend(time)})


def _looked_back(by_time: WindowSpec, rows: int) -> dict[str, Column]:
    recent = by_time.rowsBetween(1 - rows, 0)
    return {
        "demand_lag_1": F.lag("demand_mw", 1).over(by_time),
        "temperature_lag_1": F.lag("temperature", 1).over(by_time),
        f"demand_rolling_mean_{rows}": F.avg("demand_mw").over(recent),
        f"temperature_rolling_mean_{rows}": F.avg("temperature").over(recent),
    }


def _in_slices(df: DataFrame, series: list[str], order: list[str], rows: int) -> DataFrame:
    """df, which has __slice, with what looks back over rows rows of a series; slices of a series follow one another in order.

    The first rows of a slice look back into those before it: into their last rows. So a first window gives every row its
    values within its slice, and its place there from either end. The rows at the ends of slices then meet by series, and
    a second window gives the first ones their values; all others pass it by in the groups that they had.
    """
    reach = max(rows - 1, 1)
    own = Window.partitionBy(*series, "__slice")
    by_time = own.orderBy(*order)
    made = _looked_back(by_time, rows)
    df = df.withColumns({f"__{k}": v for k, v in made.items()} | {"__at": F.row_number().over(by_time), "__of": F.count("*").over(own)})
    df = df.withColumns({"__head": F.col("__at") <= reach, "__edge": (F.col("__at") <= reach) | (F.col("__of") - F.col("__at") < reach)})
    # At most two ends of reach rows a slice meet in a series' group of edges.
    df = df.withColumn("__group", F.when(~F.col("__edge"), F.col("__slice")))
    across = _looked_back(Window.partitionBy(*series, "__edge", "__group").orderBy(*order), rows)
    df = df.withColumns(across).withColumns({k: F.when(F.col("__head"), F.col(k)).otherwise(F.col(f"__{k}")) for k in across})
    return df.drop("__slice", "__at", "__of", "__head", "__edge", "__group", *[f"__{k}" for k in made])


def series_features(df: DataFrame, rows: int = ROLLING_ROWS, span: str | None = None, ranges: TimeRanges | None = None) -> DataFrame:
    """df with lags, deltas and rolling means within (resource_id, city) by time.

    Records at one instant are ordered by source_record_id where df has it. All share one shuffle and one sort. With a span
    (a unit of date_trunc, such as month) or ranges a series is cut into slices of time, so that a long one isn't one
    task's work. The results are the same; df is read once, and its rows are shuffled once more.
    """
    series, order = ["resource_id", "city"], ["event_timestamp_utc", *(["source_record_id"] if "source_record_id" in df.columns else [])]
    if span or ranges:
        out = _in_slices(df.withColumn("__slice", ranges.of_time("unix_micros(event_timestamp_utc)") if ranges else F.date_trunc(span, "event_timestamp_utc")), series, order, rows)
    else:
        out = df.withColumns(_looked_back(Window.partitionBy(*series).orderBy(*order), rows))
    return out.withColumns({"demand_delta_1": F.col("demand_mw") - F.col("demand_lag_1"), "temperature_delta_1": F.col("temperature") - F.col("temperature_lag_1")})


def feature_table(joined: DataFrame, monday_first: bool = False, span: str | None = None, ranges: TimeRanges | None = None) -> DataFrame:
    """The feature table of a matched table; span and ranges as in series_features."""
    out = series_features(calendar_features(feature_base(joined), monday_first), span=span, ranges=ranges).withColumn("temperature_sq", F.col("temperature") * F.col("temperature"))
    last = ["hour_of_day_utc", "day_of_week_utc", "is_weekend_utc", "temperature_sq", "demand_lag_1", "temperature_lag_1", "demand_delta_1", "temperature_delta_1", "demand_rolling_mean_12", "temperature_rolling_mean_12"]
    return out.select(*CARRIED, "temperature", "humidity", *MEASURES, *last)
