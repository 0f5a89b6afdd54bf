"""Scalar functions on times and measurements. Whole seconds are floored, whole minutes cut towards zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Base temperatures of heating and cooling degrees in Celsius.
HEATING_BASE_C, COOLING_BASE_C = 15, 18


def from_epoch(seconds: Column) -> Column:
    """Time of a number of seconds; null where it isn't a whole number."""
    return F.timestamp_seconds(seconds.try_cast("long"))


def parsed_time(text: Column, pattern: str | None = None) -> Column:
    """Time of a text, null where it doesn't parse."""
    return F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)


def file_time(file_name: Column, dataset: str) -> Column:
    """Time in a capture's file name, <dataset>_yyyyMMdd_HHmmss.json; null for other names."""
    digits = F.regexp_extract(file_name, rf"^{dataset}_(\d{{8}}_\d{{6}})\.json$", 1)
    return parsed_time(F.nullif(digits, F.lit("")), "yyyyMMdd_HHmmss")


def seconds_between(later: Column, earlier: Column) -> Column:
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def age_minutes(event: Column, observed: Column) -> Column:
    """Signed whole minutes from observed to event."""
    return (seconds_between(event, observed) / 60).cast("int")


def gap_minutes(event: Column, observed: Column) -> Column:
    return (F.abs(seconds_between(event, observed)) / 60).cast("int")


def minute_crossings(event: Column, observed: Column) -> Column:
    """Minute boundaries between observed and event, signed."""
    def minute(t):
        return F.floor(F.unix_timestamp(t) / 60)

    return (minute(event) - minute(observed)).cast("int")


def is_weekend(time: Column) -> Column:
    """1 on Saturday and Sunday, else 0."""
    return F.dayofweek(time).isin(1, 7).cast("int")


def weekday_from_monday(time: Column) -> Column:
    """1 on Monday to 7 on Sunday."""
    return F.weekday(time) + 1


def heating_degrees(temperature: Column) -> Column:
    """Degrees below the heating base; 0 for a null."""
    return F.when(temperature < HEATING_BASE_C, HEATING_BASE_C - temperature).otherwise(0.0)


def cooling_degrees(temperature: Column) -> Column:
    """Degrees above the cooling base; 0 for a null."""
    return F.when(temperature > COOLING_BASE_C, temperature - COOLING_BASE_C).otherwise(0.0)


def renewable_share(solar: Column, wind: Column, generation: Column) -> Column:
    """Solar and wind (0 where null) over a positive generation, else null."""
    return F.when(generation > 0, (F.coalesce(solar, F.lit(0.0)) + F.coalesce(wind, F.lit(0.0))) / generation)
