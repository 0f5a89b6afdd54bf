"""Every query of the library by name, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import measures as M
from tidemark.operators import asof, features, quality, rollup, serving, silver
from tidemark.operators.ranges import TimeRanges
from tidemark.plans.adapter import energy_capture_files, energy_events, energy_payloads, event_times, raw_energy, raw_weather, recaptured, rival_captures, weather_events, weather_payloads
from tidemark.schemas import ENERGY_KEY, WEATHER_KEY
from tidemark.sources.bronze import land_captures, scan_captures
from tidemark.sources.contracts import ENERGY_CONTRACT, WEATHER_CONTRACT, with_violations
from tidemark.sources.scratch import scratch_folder

#: The checks' present: the end of the events' month, so that results don't depend on the clock.
NOW = "2024-01-30 12:00:00"

WITH = """
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
se AS (SELECT 'energy' AS source_dataset, 'events' AS source_file, 'region-' || CAST(user_id % 4 AS VARCHAR) AS resource_id, CAST(event_id AS VARCHAR) AS source_record_id,
  ts AS event_timestamp_utc, ts + INTERVAL 5 MINUTE AS ingestion_timestamp_utc, CAST(ts AS DATE) AS event_date_utc,
  CASE WHEN event_id % 97 <> 0 THEN value END AS demand_mw, k AS generation_mw, value - k AS import_mw, CASE WHEN event_id % 11 <> 0 THEN k * 0.25 END AS solar_mw,
  k * 0.125 AS wind_mw, k * 0.0625 AS stor_mw, k * 0.5 AS other_mw FROM ev WHERE event_type <> 'view'),
sw AS (SELECT 'weather' AS source_dataset, 'events' AS source_file, CAST(event_id AS VARCHAR) AS source_record_id, ts AS event_timestamp_utc,
  ts + INTERVAL 5 MINUTE AS ingestion_timestamp_utc, CAST(ts AS DATE) AS event_date_utc, n_name AS city, CASE WHEN user_id % 25 <> 7 THEN r_name END AS country_code,
  CAST(52.5 AS DOUBLE) AS latitude, CAST(-1.25 AS DOUBLE) AS longitude, CASE WHEN event_id % 13 <> 0 THEN k * 0.5 - 8 END AS temperature_c, k * 0.5 - 9 AS feels_like_c,
  CASE WHEN event_id % 29 <> 0 THEN k END AS humidity_pct, k * 0.25 + 1000 AS pressure_hpa, k AS cloud_cover_pct, k / 16 AS wind_speed_mps,
  CASE WHEN k < 33 THEN 'Clear' WHEN k < 66 THEN 'Clouds' ELSE 'Rain' END AS weather_main, 'sky ' || CAST(user_id % 5 AS VARCHAR) AS weather_description
  FROM ev JOIN nation ON n_nationkey = user_id % 25 JOIN region ON r_regionkey = n_regionkey WHERE event_type = 'view')"""

_SECONDS = "(CAST(floor(epoch(e.event_timestamp_utc)) AS BIGINT) - CAST(floor(epoch(w.event_timestamp_utc)) AS BIGINT))"
_CROSSED = "(CAST(floor(epoch(e.event_timestamp_utc) / 60) AS BIGINT) - CAST(floor(epoch(w.event_timestamp_utc) / 60) AS BIGINT))"


def _join_sql(name: str, rank: str, age: str, gap: str) -> str:
    """The literal range join and ranking, as a CTE."""
    return f"""
{name} AS (SELECT * EXCLUDE (pick) FROM (SELECT e.resource_id, e.source_record_id, e.event_timestamp_utc, e.event_date_utc, w.city, w.country_code, e.demand_mw, e.generation_mw,
  e.import_mw, e.solar_mw, e.wind_mw, e.stor_mw, e.other_mw, w.event_timestamp_utc AS weather_event_timestamp_utc, CAST({age} AS INTEGER) AS weather_age_minutes,
  CAST({gap} AS INTEGER) AS weather_time_delta_minutes, w.temperature_c, w.feels_like_c, w.humidity_pct, w.pressure_hpa, w.cloud_cover_pct, w.wind_speed_mps, w.weather_main,
  w.weather_description, e.ingestion_timestamp_utc AS energy_ingestion_timestamp_utc, w.ingestion_timestamp_utc AS weather_ingestion_timestamp_utc,
  row_number() OVER (PARTITION BY e.resource_id, e.source_record_id, e.event_timestamp_utc ORDER BY {rank}, w.event_timestamp_utc DESC, w.city, w.source_record_id) AS pick
  FROM se e LEFT JOIN sw w ON w.event_timestamp_utc BETWEEN e.event_timestamp_utc - INTERVAL 6 HOUR AND e.event_timestamp_utc + INTERVAL 1 HOUR) WHERE pick = 1)"""


JOIN = _join_sql("wj", f"abs({_SECONDS})", f"trunc({_SECONDS} / 60)", f"trunc(abs({_SECONDS}) / 60)")
MINUTE_JOIN = _join_sql("wm", f"abs({_CROSSED})", _CROSSED, f"abs({_CROSSED})")
BASE = """
fb AS (SELECT event_timestamp_utc, event_date_utc, city, country_code, resource_id, coalesce(temperature_c, feels_like_c) AS temperature, humidity_pct AS humidity, demand_mw,
  generation_mw, import_mw, solar_mw, wind_mw, stor_mw, other_mw, pressure_hpa, cloud_cover_pct, wind_speed_mps, weather_main, weather_description, weather_age_minutes, source_record_id
  FROM {join} WHERE demand_mw IS NOT NULL AND city IS NOT NULL AND coalesce(temperature_c, feels_like_c) IS NOT NULL AND humidity_pct IS NOT NULL)"""
CALENDAR = """CAST(hour(event_timestamp_utc) AS INTEGER) AS hour_of_day_utc, CAST(dayofweek(event_timestamp_utc) + 1 AS INTEGER) AS day_of_week_utc,
  CAST(CASE WHEN dayofweek(event_timestamp_utc) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend_utc"""
MONDAY = CALENDAR.replace("dayofweek(event_timestamp_utc) + 1", "isodow(event_timestamp_utc)")
FEATURES = f"""
ft AS (SELECT * EXCLUDE (source_record_id), demand_mw - demand_lag_1 AS demand_delta_1, temperature - temperature_lag_1 AS temperature_delta_1 FROM (
  SELECT *, {CALENDAR}, temperature * temperature AS temperature_sq, lag(demand_mw) OVER o AS demand_lag_1, lag(temperature) OVER o AS temperature_lag_1,
  round(avg(demand_mw) OVER (o ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 6) AS demand_rolling_mean_12, round(avg(temperature) OVER (o ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 6) AS temperature_rolling_mean_12
  FROM fb WINDOW o AS (PARTITION BY resource_id, city ORDER BY event_timestamp_utc, source_record_id)))"""
RB = """
rb AS (SELECT *, CASE WHEN temperature < 15 THEN 15 - temperature ELSE 0 END AS heating_degree_c, CASE WHEN temperature > 18 THEN temperature - 18 ELSE 0 END AS cooling_degree_c,
  CASE WHEN generation_mw > 0 THEN (coalesce(solar_mw, 0) + coalesce(wind_mw, 0)) / generation_mw END AS renewable_share FROM fb WHERE resource_id IS NOT NULL)"""


def _level_sql(level: str, p95: str = "quantile_disc(demand_mw, 0.95)") -> str:
    unit = {"hourly": "hour", "daily": "day"}[level]
    r = lambda name, x: f"round(avg({x}), 6) AS {name}"
    return f"""SELECT '{level}' AS aggregation_level, date_trunc('{unit}', event_timestamp_utc) AS bucket_start_utc, date_trunc('{unit}', event_timestamp_utc) + INTERVAL 1 {unit.upper()} AS bucket_end_utc,
  CAST(date_trunc('{unit}', event_timestamp_utc) AS DATE) AS event_date_utc, city, country_code, resource_id, count(*) AS sample_count, {r("demand_avg_mw", "demand_mw")}, min(demand_mw) AS demand_min_mw,
  max(demand_mw) AS demand_max_mw, {p95} AS demand_p95_mw, round(stddev_samp(demand_mw), 6) AS demand_stddev_mw, {", ".join(r(k, v) for k, v in rollup.MEANS.items())},
  min(temperature) AS temperature_min_c, max(temperature) AS temperature_max_c, {", ".join(r(k, v) for k, v in rollup.LATER_MEANS.items())}, arg_max(weather_main, (event_timestamp_utc, weather_main)) AS latest_weather_main
  FROM rb GROUP BY date_trunc('{unit}', event_timestamp_utc), city, country_code, resource_id"""


def _done(df: DataFrame) -> DataFrame:
    """Times without a zone, and averages rounded, as the SQL gives them."""
    times = {c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"}
    means = {c: F.round(c, 6) for c, t in df.dtypes if t == "double" and any(x in c for x in ("_avg", "_stddev", "_rolling_mean"))}
    return df.withColumns(times | means)


def _joined_ranges(spark: SparkSession, d: str) -> tuple[DataFrame, TimeRanges]:
    """The matched table and the ranges of time that both sides were dealt into."""
    ranges = TimeRanges.of(event_times(spark, d))
    return asof.nearest_weather(energy_events(spark, d), weather_events(spark, d), ranges), ranges


def _joined(spark: SparkSession, d: str) -> DataFrame:
    return _joined_ranges(spark, d)[0]


def _base(spark: SparkSession, d: str) -> DataFrame:
    return features.feature_base(_joined(spark, d))


def _features(spark: SparkSession, d: str) -> DataFrame:
    joined, ranges = _joined_ranges(spark, d)
    return features.feature_table(joined, ranges=ranges)


def _now() -> F.Column:
    return F.lit(NOW).cast("timestamp")


def _report(spark: SparkSession, d: str, *names: str) -> DataFrame:
    checks = [c for c in quality.standard_checks(_now()) if not names or any(n in c.name for n in names)]
    used = {c.table for c in checks}
    tables = {"silver_weather": weather_events(spark, d), "silver_energy": energy_events(spark, d)}
    if used - set(tables):
        joined, ranges = _joined_ranges(spark, d)
        if {"gold_feature_engineering", "gold_weather_demand_join"} <= used:  # matched once, as the pipeline stores it
            folder = scratch_folder(spark, "matched")
            joined.write.parquet(folder)
            joined = spark.read.schema(joined.schema).parquet(folder)
        tables |= {"gold_feature_engineering": features.feature_table(joined, ranges=ranges), "gold_weather_demand_join": joined}
    return quality.check_report({k: v for k, v in tables.items() if k in used}, checks)


_LATE = f"CASE WHEN max(event_timestamp_utc) IS NULL OR max(event_timestamp_utc) < TIMESTAMP '{NOW}' - INTERVAL 3 HOUR THEN 1 ELSE 0 END"
_CHECKS = {
    "silver_weather_not_empty": ("error", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS n FROM sw"),
    "silver_energy_not_empty": ("error", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS n FROM se"),
    "silver_weather_required_fields": ("error", "SELECT count(*) AS n FROM sw WHERE event_timestamp_utc IS NULL OR city IS NULL OR temperature_c IS NULL OR humidity_pct IS NULL"),
    "silver_energy_required_fields": ("error", "SELECT count(*) AS n FROM se WHERE event_timestamp_utc IS NULL OR resource_id IS NULL OR demand_mw IS NULL"),
    "silver_weather_duplicates": ("error", "SELECT count(*) AS n FROM (SELECT city FROM sw GROUP BY city, event_timestamp_utc HAVING count(*) > 1)"),
    "silver_energy_duplicates": ("error", "SELECT count(*) AS n FROM (SELECT resource_id FROM se GROUP BY resource_id, source_record_id, event_timestamp_utc HAVING count(*) > 1)"),
    "silver_weather_freshness": ("warn", f"SELECT {_LATE} AS n FROM sw"),
    "silver_energy_freshness": ("warn", f"SELECT {_LATE} AS n FROM se"),
    "gold_feature_required_fields": ("error", "SELECT count(*) AS n FROM fb WHERE event_timestamp_utc IS NULL OR city IS NULL OR temperature IS NULL OR humidity IS NULL OR demand_mw IS NULL"),
    "gold_feature_freshness": ("warn", f"SELECT {_LATE} AS n FROM fb"),
    "weather_match_outside_expected_window": ("warn", "SELECT count(*) AS n FROM wj WHERE weather_event_timestamp_utc IS NOT NULL AND abs(weather_time_delta_minutes) > 360"),
}


def _report_sql(*names: str) -> str:
    parts = [f"SELECT '{k}' AS check_name, '{s}' AS severity, CAST(n AS BIGINT) AS failed_rows, CASE WHEN n = 0 THEN 'passed' ELSE 'failed' END AS status FROM ({q})" for k, (s, q) in _CHECKS.items() if not names or any(n in k for n in names)]
    ctes = WITH + (f",{JOIN},{BASE.format(join='wj')}" if not names or {"gold", "weather_match"} & set("_".join(names).split("__")) or any("gold" in k or "match" in k for k in _CHECKS if any(n in k for n in names)) else "")
    return f"WITH {ctes}\n" + "\nUNION ALL ".join(parts)


def _history(spark: SparkSession, d: str) -> DataFrame:
    """Three runs' worth of results: the report as of NOW and one and two days before."""
    report = _report(spark, d, "silver")
    return report.select(F.explode(F.array(*[(_now() - F.make_dt_interval(days=F.lit(i))) for i in range(3)])).alias("run_timestamp_utc"), "*")


def _select(keys: str, columns: str, source: str, ctes: str) -> str:
    return f"WITH {ctes}\nSELECT {keys}, {columns} FROM {source}"


_FULL = f"{WITH},{JOIN},{BASE.format(join='wj')}"
_SERVE = f"{WITH},{MINUTE_JOIN},{BASE.format(join='wm')}"
_ID = ["resource_id", "source_record_id", "event_timestamp_utc"]
_IDS = ", ".join(_ID)


def _series(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    joined, ranges = _joined_ranges(spark, d)
    return features.series_features(features.feature_base(joined), ranges=ranges).select(*_ID, *columns)


def _rolled(spark: SparkSession, d: str, levels: tuple[str, ...], *columns: str) -> DataFrame:
    out = rollup.demand_rollup(_features(spark, d), levels)
    return out.select("aggregation_level", "bucket_start_utc", *rollup.KEYS, *columns) if columns else out


def _rolled_sql(columns: str) -> str:
    return f"WITH {_FULL},{RB}\nSELECT aggregation_level, bucket_start_utc, city, country_code, resource_id, {columns} FROM ({_level_sql('hourly')} UNION ALL {_level_sql('daily')})"


_SERIES_SQL = f"WITH {_FULL}, sf AS (SELECT *, lag(demand_mw) OVER o AS demand_lag_1, lag(temperature) OVER o AS temperature_lag_1, round(avg(demand_mw) OVER (o ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 6) AS demand_rolling_mean_12, round(avg(temperature) OVER (o ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 6) AS temperature_rolling_mean_12 FROM fb WINDOW o AS (PARTITION BY resource_id, city ORDER BY event_timestamp_utc, source_record_id))\nSELECT {_IDS}, "
_LATEST = "WITH {w}, r2 AS (SELECT *, ingestion_timestamp_utc + INTERVAL 1 HOUR AS late FROM {t})\nSELECT * EXCLUDE (late) REPLACE (late AS ingestion_timestamp_utc, {m} + 1 AS {m}) FROM r2"
_RIVALS = """WITH {w}, r AS (SELECT * REPLACE ('capture-' || lpad(source_record_id, 9, '0') AS source_file,
  CASE WHEN CAST(source_record_id AS BIGINT) % 5 <> 0 THEN date_trunc('day', event_timestamp_utc) + INTERVAL 1 HOUR * (CAST(source_record_id AS BIGINT) % 3) END AS ingestion_timestamp_utc,
  date_trunc('hour', event_timestamp_utc) AS event_timestamp_utc, CASE WHEN CAST(source_record_id AS BIGINT) % 7 <> 0 THEN {k} END AS {k},
  CAST(CAST(source_record_id AS BIGINT) % 3 AS VARCHAR) AS source_record_id) FROM {t})
SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ingestion_timestamp_utc DESC NULLS LAST, source_file DESC) AS place FROM r) WHERE place = 1"""
_LABELS = " UNION ALL ".join(f"SELECT '{n}' AS aggregation_level, date_trunc('{u}', event_timestamp_utc) AS bucket_start_utc, city, country_code, resource_id, arg_max(weather_main, (event_timestamp_utc, weather_main)) AS latest_weather_main FROM rb GROUP BY ALL" for n, u in (("hourly", "hour"), ("daily", "day")))

def _scanned(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The events' captures, landed as files in the shared folder and scanned."""
    folder = scratch_folder(spark, "captures")
    land_captures(energy_capture_files(spark, d), f"{folder}/raw/energy")
    return scan_captures(spark, f"{folder}/raw/energy", "energy", f"{folder}/scanned")


_BROKEN = "CASE right(resource_id, 1) || '-' || day(event_date_utc) % 10 WHEN '2-5' THEN 'is not JSON' WHEN '1-7' THEN 'is empty' WHEN '0-9' THEN 'is not an object' WHEN '3-3' THEN 'has fields of other types: within objects or arrays' END"
_FILE = "'energy_' || strftime(event_date_utc, '%Y%m%d') || '_12000' || right(resource_id, 1) || '.json'"


#: name: (query, SQL or None)
ENTRIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "silver_energy_projection": (energy_events, f"WITH {WITH}\nSELECT * FROM se"),
    "silver_weather_projection": (weather_events, f"WITH {WITH}\nSELECT * FROM sw"),
    "props_json_extract": (lambda s, d: s.read.parquet(f"{d}/events.parquet").select("event_id", F.get_json_object("props", "$.k").try_cast("double").alias("k")), f"WITH {WITH}\nSELECT event_id, k FROM ev"),
    "dedup_latest_energy": (lambda s, d: silver.latest_by_key(recaptured(energy_events(s, d), "demand_mw"), ENERGY_KEY), _LATEST.format(w=WITH, t="se", m="demand_mw")),
    "dedup_latest_weather": (lambda s, d: silver.latest_by_key(recaptured(weather_events(s, d), "temperature_c"), WEATHER_KEY), _LATEST.format(w=WITH, t="sw", m="temperature_c")),
    "dedup_rivals_energy": (lambda s, d: silver.latest_by_key(rival_captures(energy_events(s, d), "resource_id"), ENERGY_KEY), _RIVALS.format(w=WITH, t="se", k="resource_id", keys=", ".join(ENERGY_KEY))),
    "dedup_rivals_weather": (lambda s, d: silver.latest_by_key(rival_captures(weather_events(s, d), "city"), WEATHER_KEY), _RIVALS.format(w=WITH, t="sw", k="city", keys=", ".join(WEATHER_KEY))),
    "captures_typed_energy": (lambda s, d: silver.typed_energy(raw_energy(s, d)),
        f"WITH {WITH}\nSELECT * REPLACE ('energy_' || strftime(event_date_utc, '%Y%m%d') || '_120000.json' AS source_file, date_trunc('second', event_timestamp_utc) AS event_timestamp_utc, CAST(event_date_utc AS TIMESTAMP) + INTERVAL 12 HOUR AS ingestion_timestamp_utc) FROM se WHERE CAST(source_record_id AS BIGINT) % 101 <> 0"),
    "captures_typed_weather": (lambda s, d: silver.typed_weather(raw_weather(s, d)),
        f"WITH {WITH}, n AS (SELECT *, CAST(source_record_id AS BIGINT) AS n FROM sw)\nSELECT * EXCLUDE (n) REPLACE (CASE WHEN n % 10 = 0 THEN 'other.json' ELSE 'weather_' || strftime(event_timestamp_utc, '%Y%m%d_%H%M%S') || '.json' END AS source_file, CASE WHEN n % 10 <> 0 THEN date_trunc('second', event_timestamp_utc) END AS ingestion_timestamp_utc, date_trunc('second', event_timestamp_utc) AS event_timestamp_utc, CASE WHEN n % 17 <> 0 THEN weather_main END AS weather_main, CASE WHEN n % 17 <> 0 THEN weather_description END AS weather_description) FROM n"),
    "contract_violations": (lambda s, d: with_violations(weather_payloads(s, d), WEATHER_CONTRACT).select("id", (F.size("violations") == 0).alias("valid")),
        f"WITH {WITH}, n AS (SELECT *, CAST(source_record_id AS BIGINT) AS id FROM sw)\nSELECT id, id % 11 <> 0 AND id % 9 <> 0 AND id % 12 <> 0 AND id % 17 <> 0 AND temperature_c IS NOT NULL AND feels_like_c IS NOT NULL AND humidity_pct IS NOT NULL AND cloud_cover_pct IS NOT NULL AND wind_speed_mps IS NOT NULL AS valid FROM n"),
    "contract_messages_weather": (lambda s, d: with_violations(weather_payloads(s, d), WEATHER_CONTRACT, name="weather_schema.json").select("id", "message"),
        f"""WITH {WITH}, n AS (SELECT *, CAST(source_record_id AS BIGINT) AS id FROM sw),
m AS (SELECT id, CASE WHEN id % 11 = 0 THEN ['$ is not JSON'] ELSE list_filter([CASE WHEN id % 9 = 0 THEN '$ lacks the required field ''dt''' END, CASE WHEN humidity_pct IS NULL THEN '$.main lacks the required field ''humidity''' END,
  CASE WHEN temperature_c IS NULL THEN '$.main lacks the required field ''temp''' END, CASE WHEN id % 12 = 0 THEN '$.name is shorter than 1' END, CASE WHEN id % 17 = 0 THEN '$.weather has fewer than 1 items' END], lambda x: x IS NOT NULL) END AS ms FROM n)
SELECT id, CASE WHEN len(ms) > 0 THEN 'payload breaks weather_schema.json: ' || array_to_string(ms, '; ') END AS message FROM m"""),
    "contract_messages_energy": (lambda s, d: with_violations(energy_payloads(s, d), ENERGY_CONTRACT, name="energy_schema.json").select("resource_id", "event_date_utc", "message"),
        f"""WITH {WITH}, p AS (SELECT resource_id, event_date_utc, CAST(source_record_id AS BIGINT) AS id, row_number() OVER (PARTITION BY resource_id, event_date_utc ORDER BY CAST(source_record_id AS BIGINT)) - 1 AS i FROM se),
m AS (SELECT resource_id, event_date_utc, list_sort(coalesce(list('$.result.records[' || i || '] lacks the required field ''_id''') FILTER (id % 7 = 0), [])) AS ms FROM p GROUP BY 1, 2)
SELECT resource_id, event_date_utc, CASE WHEN len(ms) > 0 THEN 'payload breaks energy_schema.json: ' || array_to_string(ms[1:5], '; ') || CASE WHEN len(ms) > 5 THEN '; ... ' || (len(ms) - 5) || ' additional' ELSE '' END END AS message FROM m"""),
    "captures_scanned_energy": (lambda s, d: silver.typed_energy(_scanned(s, d)[0]),
        f"WITH {WITH}\nSELECT * REPLACE ({_FILE} AS source_file, date_trunc('second', event_timestamp_utc) AS event_timestamp_utc, CAST(event_date_utc AS TIMESTAMP) + INTERVAL 12 HOUR + INTERVAL 1 SECOND * CAST(right(resource_id, 1) AS INTEGER) AS ingestion_timestamp_utc) FROM se WHERE CAST(source_record_id AS BIGINT) % 101 <> 0 AND {_BROKEN} IS NULL"),
    "captures_quarantined": (lambda s, d: _scanned(s, d)[1].select("source_file", "error"), f"WITH {WITH}\nSELECT DISTINCT {_FILE} AS source_file, {_BROKEN} AS error FROM se WHERE {_BROKEN} IS NOT NULL"),
    "range_join_candidates": (lambda s, d: asof.candidate_counts(energy_events(s, d), weather_events(s, d)).groupBy(*ENERGY_KEY).agg(F.sum("candidates").alias("candidates")),
        f"WITH {WITH}\nSELECT e.resource_id, e.source_record_id, e.event_timestamp_utc, count(w.event_timestamp_utc) AS candidates FROM se e LEFT JOIN sw w ON w.event_timestamp_utc BETWEEN e.event_timestamp_utc - INTERVAL 6 HOUR AND e.event_timestamp_utc + INTERVAL 1 HOUR GROUP BY 1, 2, 3"),
    "nearest_weather_join": (_joined, f"WITH {WITH},{JOIN}\nSELECT * FROM wj"),
    "nearest_weather_join_minute_rank": (lambda s, d: serving.serving_join(energy_events(s, d), weather_events(s, d), TimeRanges.of(event_times(s, d))), f"WITH {WITH},{MINUTE_JOIN}\nSELECT * FROM wm"),
    "weather_minutes_crossings": (lambda s, d: _joined(s, d).select(*_ID, M.minute_crossings(F.col("event_timestamp_utc"), F.col("weather_event_timestamp_utc")).alias("crossed")),
        _select(_IDS, "CAST(floor(epoch(event_timestamp_utc) / 60) - floor(epoch(weather_event_timestamp_utc) / 60) AS INTEGER) AS crossed", "wj", f"{WITH},{JOIN}")),
    "feature_base_filter": (_base, f"WITH {_FULL}\nSELECT * FROM fb"),
    "calendar_features": (lambda s, d: features.calendar_features(_base(s, d)).select(*_ID, "hour_of_day_utc", "day_of_week_utc", "is_weekend_utc"), _select(_IDS, CALENDAR, "fb", _FULL)),
    "calendar_features_monday_first": (lambda s, d: features.calendar_features(_base(s, d), True).select(*_ID, "hour_of_day_utc", "day_of_week_utc", "is_weekend_utc"), _select(_IDS, MONDAY, "fb", _FULL)),
    "lag_features": (lambda s, d: _series(s, d, "demand_lag_1", "temperature_lag_1"), _SERIES_SQL + "demand_lag_1, temperature_lag_1 FROM sf"),
    "delta_features": (lambda s, d: _series(s, d, "demand_delta_1", "temperature_delta_1"), _SERIES_SQL + "demand_mw - demand_lag_1 AS demand_delta_1, temperature - temperature_lag_1 AS temperature_delta_1 FROM sf"),
    "rolling_mean_12": (lambda s, d: _series(s, d, "demand_rolling_mean_12", "temperature_rolling_mean_12"), _SERIES_SQL + "demand_rolling_mean_12, temperature_rolling_mean_12 FROM sf"),
    "feature_engineering": (_features, f"WITH {_FULL},{FEATURES}\nSELECT * FROM ft"),
    "time_buckets": (lambda s, d: rollup.in_buckets(_base(s, d).select(*_ID), ["hourly", "daily"]),
        " UNION ALL ".join(f"SELECT {_IDS}, '{n}' AS aggregation_level, date_trunc('{u}', event_timestamp_utc) AS bucket_start_utc, date_trunc('{u}', event_timestamp_utc) + INTERVAL 1 {u} AS bucket_end_utc FROM fb" for n, u in (("hourly", "hour"), ("daily", "day"))).join([f"WITH {_FULL}\n", ""])),
    "degree_measures": (lambda s, d: rollup.rollup_base(_base(s, d)).select(*_ID, "heating_degree_c", "cooling_degree_c"), _select(_IDS, "heating_degree_c, cooling_degree_c", "rb", f"{_FULL},{RB}")),
    "renewable_share": (lambda s, d: rollup.rollup_base(_base(s, d)).select(*_ID, "renewable_share"), _select(_IDS, "renewable_share", "rb", f"{_FULL},{RB}")),
    "hourly_demand": (lambda s, d: _rolled(s, d, ("hourly",)), f"WITH {_FULL},{RB}\n{_level_sql('hourly')}"),
    "daily_demand": (lambda s, d: _rolled(s, d, ("daily",)), f"WITH {_FULL},{RB}\n{_level_sql('daily')}"),
    "demand_aggregation": (lambda s, d: _rolled(s, d, ("hourly", "daily")), f"WITH {_FULL},{RB}\n{_level_sql('hourly')} UNION ALL {_level_sql('daily')}"),
    "demand_p95": (lambda s, d: _rolled(s, d, ("hourly", "daily"), "demand_p95_mw"), _rolled_sql("demand_p95_mw")),
    "demand_stddev": (lambda s, d: _rolled(s, d, ("hourly", "daily"), "demand_stddev_mw"), _rolled_sql("demand_stddev_mw")),
    "latest_label_max_by": (lambda s, d: _rolled(s, d, ("hourly", "daily"), "latest_weather_main"), _rolled_sql("latest_weather_main")),
    "latest_label_first_value": (lambda s, d: serving.latest_label_by_window(_features(s, d)), f"WITH {_FULL},{RB}\n{_LABELS}"),
    "serving_features": (lambda s, d: serving.serving_features(energy_events(s, d), weather_events(s, d), TimeRanges.of(event_times(s, d))), f"WITH {_SERVE},{FEATURES.replace(CALENDAR, MONDAY)}\nSELECT * FROM ft"),
    "serving_demand_aggregation": (lambda s, d: serving.serving_rollup(serving.serving_features(energy_events(s, d), weather_events(s, d), TimeRanges.of(event_times(s, d)))), f"WITH {_SERVE},{RB}\n{_level_sql('hourly', 'CAST(NULL AS DOUBLE)')} UNION ALL {_level_sql('daily', 'CAST(NULL AS DOUBLE)')}"),
    "dq_not_empty": (lambda s, d: _report(s, d, "not_empty"), _report_sql("not_empty")),
    "dq_required_fields": (lambda s, d: _report(s, d, "required_fields"), _report_sql("required_fields")),
    "dq_duplicates": (lambda s, d: _report(s, d, "duplicates"), _report_sql("duplicates")),
    "dq_freshness": (lambda s, d: _report(s, d, "freshness"), _report_sql("freshness")),
    "dq_match_window": (lambda s, d: _report(s, d, "weather_match"), _report_sql("weather_match")),
    "dq_report": (lambda s, d: _report(s, d), _report_sql()),
    "dq_history_top50": (lambda s, d: quality.recent_results(_history(s, d)),
        f"SELECT r - INTERVAL 1 DAY * i AS run_timestamp_utc, check_name, severity, failed_rows, status FROM ({_report_sql('silver')}), (SELECT TIMESTAMP '{NOW}' AS r), (SELECT unnest(range(3)) AS i) ORDER BY 1 DESC, 2 LIMIT 50"),
    "latest_energy_status": (lambda s, d: quality.latest_status(_features(s, d)), f"WITH {_FULL}\nSELECT max(event_timestamp_utc) AS latest_energy_timestamp_utc, count(*) AS feature_rows FROM fb"),
}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _done(f(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(f) for name, (f, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ENTRIES.items() if sql}
