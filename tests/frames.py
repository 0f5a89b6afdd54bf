"""Small energy and weather frames."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.schemas import SILVER_ENERGY, SILVER_WEATHER


def time(text):
    return datetime.fromisoformat(text)


def energy(spark, rows):
    """rows: (resource_id, record id, time text, demand) and, optionally, a dict of other columns."""
    full = []
    for r, i, at, demand, *more in rows:
        own = {"source_dataset": "energy", "source_file": "f", "resource_id": r, "source_record_id": i, "event_timestamp_utc": time(at) if at else None, "ingestion_timestamp_utc": time("2024-02-01"), "event_date_utc": time(at).date() if at else None, "demand_mw": demand, "generation_mw": 100.0, "import_mw": 1.0, "solar_mw": 10.0, "wind_mw": 20.0, "stor_mw": 0.0, "other_mw": 0.0}
        full.append(tuple((own | (more[0] if more else {})).values()))
    return spark.createDataFrame(full, SILVER_ENERGY)


def weather(spark, rows):
    """rows: (city, record id, time text, temperature) and, optionally, a dict of other columns."""
    full = []
    for c, i, at, temperature, *more in rows:
        own = {"source_dataset": "weather", "source_file": "f", "source_record_id": i, "event_timestamp_utc": time(at) if at else None, "ingestion_timestamp_utc": time("2024-02-01"), "event_date_utc": time(at).date() if at else None, "city": c, "country_code": None, "latitude": 0.0, "longitude": 0.0, "temperature_c": temperature, "feels_like_c": 5.0, "humidity_pct": 50.0, "pressure_hpa": 1000.0, "cloud_cover_pct": 10.0, "wind_speed_mps": 2.0, "weather_main": "Clear", "weather_description": "sky"}
        full.append(tuple((own | (more[0] if more else {})).values()))
    return spark.createDataFrame(full, SILVER_WEATHER)


def features(spark, rows):
    """rows: (time text, city, country, resource, demand, temperature, generation, solar, wind, label)."""
    names = "at STRING, city STRING, country_code STRING, resource_id STRING, demand_mw DOUBLE, temperature DOUBLE, generation_mw DOUBLE, solar_mw DOUBLE, wind_mw DOUBLE, weather_main STRING"
    return spark.createDataFrame(rows, names).withColumns({"event_timestamp_utc": F.to_timestamp("at"), "import_mw": F.lit(1.0), "humidity": F.lit(50.0), "wind_speed_mps": F.lit(2.0), "cloud_cover_pct": F.lit(3.0)})
