"""Table schemas as DDL: raw captures as they are read, and the typed tables made from them."""

RAW_WEATHER = """id BIGINT, dt BIGINT, name STRING, cod STRING, coord STRUCT<lat: DOUBLE, lon: DOUBLE>, sys STRUCT<country: STRING>,
main STRUCT<temp: DOUBLE, feels_like: DOUBLE, humidity: DOUBLE, pressure: DOUBLE>, clouds STRUCT<`all`: DOUBLE>, wind STRUCT<speed: DOUBLE>,
weather ARRAY<STRUCT<main: STRING, description: STRING>>, _corrupt STRING"""

RAW_ENERGY = """help STRING, success BOOLEAN, result STRUCT<resource_id: STRING, `limit`: BIGINT, total: BIGINT,
records: ARRAY<STRUCT<_id: BIGINT, `Timestamp`: STRING, Demand: DOUBLE, Generation: DOUBLE, Import: DOUBLE, Solar: DOUBLE, Wind: DOUBLE,
STOR: DOUBLE, Other: DOUBLE>>>, _corrupt STRING"""

SILVER_WEATHER = """source_dataset STRING, source_file STRING, source_record_id STRING, event_timestamp_utc TIMESTAMP,
ingestion_timestamp_utc TIMESTAMP, event_date_utc DATE, city STRING, country_code STRING, latitude DOUBLE, longitude DOUBLE,
temperature_c DOUBLE, feels_like_c DOUBLE, humidity_pct DOUBLE, pressure_hpa DOUBLE, cloud_cover_pct DOUBLE, wind_speed_mps DOUBLE,
weather_main STRING, weather_description STRING"""

SILVER_ENERGY = """source_dataset STRING, source_file STRING, resource_id STRING, source_record_id STRING, event_timestamp_utc TIMESTAMP,
ingestion_timestamp_utc TIMESTAMP, event_date_utc DATE, demand_mw DOUBLE, generation_mw DOUBLE, import_mw DOUBLE, solar_mw DOUBLE,
wind_mw DOUBLE, stor_mw DOUBLE, other_mw DOUBLE"""

QUALITY_RESULTS = "run_timestamp_utc TIMESTAMP, check_name STRING, severity STRING, failed_rows BIGINT, status STRING"

WEATHER_KEY = ["city", "event_timestamp_utc"]
ENERGY_KEY = ["resource_id", "source_record_id", "event_timestamp_utc"]
