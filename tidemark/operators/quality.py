"""Declarative data-quality checks: one conditional aggregate a table, one action for all, a history, and a verdict."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ENERGY_KEY, QUALITY_RESULTS, WEATHER_KEY
from tidemark.sources.tables import append_table

MATCH_LIMIT_MINUTES = 360


class QualityError(ValueError):
    """A check of severity error has failed rows."""


@dataclass(frozen=True)
class Check:
    """A rule on one table: failed is an aggregate over it, or over its keys that repeat where unique names them."""

    name: str
    severity: str
    table: str
    failed: Column | None = None
    unique: tuple[str, ...] = ()


def _empty() -> Column:
    return (F.count("*") == 0).cast("long")


def _missing(*columns: str) -> Column:
    return F.count_if(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def _stale(now: Column, hours: int) -> Column:
    newest = F.max("event_timestamp_utc")
    return F.when(newest.isNull() | (newest < now - F.make_dt_interval(hours=F.lit(hours))), F.lit(1)).otherwise(0).cast("long")


def standard_checks(now: Column | None = None, lag_hours: int = 3) -> list[Check]:
    """The eleven checks; freshness allows lag_hours (at least 1) before now."""
    if int(lag_hours) < 1:
        raise ValueError("lag_hours must be at least 1")
    now = F.current_timestamp() if now is None else now
    late = _stale(now, int(lag_hours))
    weather, energy, features, joined = "silver_weather", "silver_energy", "gold_feature_engineering", "gold_weather_demand_join"
    return [
        Check("silver_weather_not_empty", "error", weather, _empty()),
        Check("silver_energy_not_empty", "error", energy, _empty()),
        Check("silver_weather_required_fields", "error", weather, _missing("event_timestamp_utc", "city", "temperature_c", "humidity_pct")),
        Check("silver_energy_required_fields", "error", energy, _missing("event_timestamp_utc", "resource_id", "demand_mw")),
        Check("silver_weather_duplicates", "error", weather, unique=tuple(WEATHER_KEY)),
        Check("silver_energy_duplicates", "error", energy, unique=tuple(ENERGY_KEY)),
        Check("silver_weather_freshness", "warn", weather, late),
        Check("silver_energy_freshness", "warn", energy, late),
        Check("gold_feature_required_fields", "error", features, _missing("event_timestamp_utc", "city", "temperature", "humidity", "demand_mw")),
        Check("gold_feature_freshness", "warn", features, late),
        Check("weather_match_outside_expected_window", "warn", joined, F.count_if(F.col("weather_event_timestamp_utc").isNotNull() & (F.abs("weather_time_delta_minutes") > MATCH_LIMIT_MINUTES))),
    ]


def check_report(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """check_name, severity, failed_rows (bigint), status of every check, lazily. A table is scanned once, and once per key."""
    parts = []
    for table, df in tables.items():
        plain = [c for c in checks if c.table == table and c.failed is not None]
        if plain:
            row = df.agg(*[c.failed.cast("long").alias(c.name) for c in plain])
            parts.append(row.select(F.inline(F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.col(c.name).alias("failed_rows")) for c in plain]))))
        for c in checks:
            if c.table == table and c.unique:
                repeated = df.groupBy(*c.unique).count().where("count > 1")
                parts.append(repeated.agg(F.count("*").alias("failed_rows")).select(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), "failed_rows"))
    found = reduce(DataFrame.unionByName, parts)
    return found.withColumn("status", F.when(F.col("failed_rows") == 0, "passed").otherwise("failed"))


def run_checks(spark: SparkSession, tables: dict[str, DataFrame], checks: list[Check], now: datetime, history: str | None = None, fmt: str = "parquet") -> list[dict]:
    """Run checks in one action, append the results to the table history, and only then raise if an error-severity check failed."""
    rows = [(now, r.check_name, r.severity, r.failed_rows, r.status) for r in check_report(tables, checks).collect()]  # a row a check
    results = spark.createDataFrame(rows, QUALITY_RESULTS)
    if history:
        append_table(results, history, fmt=fmt)
    failed = sorted((r[1], r[3]) for r in rows if r[2] == "error" and r[3])
    if failed:
        raise QualityError("Data quality checks failed: " + ", ".join(f"{name}={n}" for name, n in failed))
    return [r.asDict() for r in results.orderBy("severity", "check_name").collect()]


def recent_results(history: DataFrame, rows: int = 50) -> DataFrame:
    """The latest results of a history, newest run first."""
    return history.select("run_timestamp_utc", "check_name", "severity", "failed_rows", "status").orderBy(F.desc("run_timestamp_utc"), "check_name").limit(rows)


def latest_status(features: DataFrame) -> DataFrame:
    return features.agg(F.max("event_timestamp_utc").alias("latest_energy_timestamp_utc"), F.count("*").alias("feature_rows"))
