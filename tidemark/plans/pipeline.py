"""The batch pipeline: captures to typed tables, to matched, feature and rollup tables, to a quality verdict."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.asof import nearest_weather
from tidemark.operators.features import feature_table
from tidemark.operators.quality import run_checks, standard_checks
from tidemark.operators.ranges import TimeRanges
from tidemark.operators.rollup import demand_rollup
from tidemark.operators.silver import silver_energy, silver_weather
from tidemark.sources.bronze import read_captures
from tidemark.sources.tables import replace_table


@dataclass(frozen=True)
class Settings:
    """Where captures lie, the tables' format, and how old data may be."""

    raw_root: str
    fmt: str = "parquet"
    lag_hours: int = 3
    history: str = "dq_run_results"

    @classmethod
    def from_session(cls, spark: SparkSession, raw_root: str) -> Settings:
        """Settings with the session's values of tidemark.format, tidemark.lag_hours and tidemark.history."""
        get = lambda k, d: spark.conf.get(f"tidemark.{k}", d)
        return cls(raw_root, get("format", cls.fmt), int(get("lag_hours", str(cls.lag_hours))), get("history", cls.history))


class Counts:
    """Rows of the tables that a run writes, as observed during the writes."""

    def __init__(self):
        self.observed: dict[str, Observation] = {}

    def of(self, table: str) -> Observation:
        return self.observed.setdefault(table, Observation(table))

    def rows(self) -> dict[str, int]:
        return {table: o.get.get("rows", 0) for table, o in self.observed.items()}


def build_silver(spark: SparkSession, settings: Settings, counts: Counts | None = None) -> dict[str, DataFrame]:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    counts, out = counts or Counts(), {}
    for name, kind, made in (("silver_weather", "weather", silver_weather), ("silver_energy", "energy", silver_energy)):
        captures = read_captures(spark, f"{settings.raw_root}/raw/{kind}", kind)
        out[name] = replace_table(made(captures), name, "event_date_utc", settings.fmt, counts.of(name))
    return out


def build_gold(spark: SparkSession, silver: dict[str, DataFrame], settings: Settings, counts: Counts | None = None) -> dict[str, DataFrame]:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    counts = counts or Counts()

    def stored(df: DataFrame, name: str) -> DataFrame:
        return replace_table(df, name, fmt=settings.fmt, counted=counts.of(name))

    ranges = TimeRanges.of(silver["silver_energy"], silver["silver_weather"])
    joined = stored(nearest_weather(silver["silver_energy"], silver["silver_weather"], ranges), "gold_weather_demand_join")
    features = stored(feature_table(joined, ranges=ranges), "gold_feature_engineering")
    return {"gold_weather_demand_join": joined, "gold_feature_engineering": features, "gold_demand_aggregation": stored(demand_rollup(features), "gold_demand_aggregation")}


def run_pipeline(spark: SparkSession, settings: Settings, now: datetime | None = None) -> dict:
    """All steps; the tables' row counts and the checks' results. A failed error-severity check raises after its history is kept.

    Counts are gathered while the tables are written; no job counts them afterwards.
    """
    now, counts = now or datetime.now(timezone.utc), Counts()
    tables = build_silver(spark, settings, counts)
    tables |= build_gold(spark, tables, settings, counts)
    results = run_checks(spark, tables, standard_checks(F.lit(now), settings.lag_hours), now, settings.history, settings.fmt)
    return {"rows": counts.rows(), "checks": results}
