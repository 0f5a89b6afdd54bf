import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests import frames, test_captures
from tidemark.operators.asof import nearest_weather
from tidemark.operators.features import feature_table
from tidemark.operators.quality import QualityError, check_report, latest_status, recent_results, run_checks, standard_checks
from tidemark.plans.pipeline import Settings, run_pipeline
from tidemark.streaming.live import energy_stream, hourly_demand_stream, keep_current, read_current

NOW = datetime(2024, 1, 1, 3, 0, tzinfo=timezone.utc)


def tables(spark, energy, weather):
    e, w = frames.energy(spark, energy), frames.weather(spark, weather)
    joined = nearest_weather(e, w)
    return {"silver_energy": e, "silver_weather": w, "gold_weather_demand_join": joined, "gold_feature_engineering": feature_table(joined)}


def failed(spark, energy, weather, **options):
    report = check_report(tables(spark, energy, weather), standard_checks(F.lit(NOW), **options)).collect()
    assert len(report) == 11 and all((r.status == "passed") == (r.failed_rows == 0) for r in report)
    return {r.check_name: r.failed_rows for r in report if r.failed_rows}


def test_checks(spark):
    e, w = [("r", "1", "2024-01-01T00:00:00", 1.0)], [("A", "1", "2024-01-01T00:00:00", 1.0)]
    assert failed(spark, e, w) == {}
    assert failed(spark, e, w, lag_hours=2) == {f"{t}_freshness": 1 for t in ("silver_energy", "silver_weather", "gold_feature")}
    assert failed(spark, [], []) == {"silver_weather_not_empty": 1, "silver_energy_not_empty": 1} | {f"{t}_freshness": 1 for t in ("silver_energy", "silver_weather", "gold_feature")}
    assert failed(spark, [*e, ("r", "2", "2024-01-01T00:00:00", None)], [*w, ("A", "2", "2024-01-01T00:00:00", 2.0), (None, "3", None, None)]) == {"silver_energy_required_fields": 1, "silver_weather_required_fields": 1, "silver_weather_duplicates": 1}
    with pytest.raises(ValueError, match="at least 1"):
        standard_checks(lag_hours=0)
    assert [c.severity for c in standard_checks(lag_hours=4) if "freshness" in c.name] == ["warn"] * 3


def test_history_is_kept_before_the_error(spark):
    spark.sql("DROP TABLE IF EXISTS t_history")
    with pytest.raises(QualityError, match="silver_energy_not_empty=1"):
        run_checks(spark, tables(spark, [], []), standard_checks(F.lit(NOW)), NOW, "t_history")
    ok = tables(spark, [("r", "1", "2024-01-01T00:00:00", 1.0)], [("A", "1", "2024-01-01T00:00:00", 1.0)])
    assert [r["severity"] for r in run_checks(spark, ok, standard_checks(F.lit(NOW)), datetime(2024, 1, 2, tzinfo=timezone.utc), "t_history")] == ["error"] * 7 + ["warn"] * 4
    assert spark.table("t_history").count() == 22
    top = recent_results(spark.table("t_history"), 3).collect()
    assert [r.run_timestamp_utc.day for r in top] == [2, 2, 2] and [r.check_name for r in top] == sorted(r.check_name for r in top)
    assert latest_status(ok["gold_feature_engineering"]).first().feature_rows == 1
    spark.sql("DROP TABLE t_history")


def test_pipeline_from_captures_to_verdict(spark, tmp_path):
    at = 1704067200
    for h in range(3):
        test_captures.put(tmp_path, "weather", f"weather_20240101_0{h}0000.json", test_captures.weather(dt=at + 3600 * h))
    test_captures.put(tmp_path, "energy", "energy_20240101_030000.json", test_captures.energy([{"_id": i, "Timestamp": f"2024-01-01T0{i // 4}:{i % 4}5:00", "Demand": float(i), "Generation": 10.0} for i in range(12)]))
    settings = Settings.from_session(spark, str(tmp_path))
    out = run_pipeline(spark, settings, datetime(2024, 1, 1, 4, 0, tzinfo=timezone.utc))
    assert out["rows"] == {"silver_weather": 3, "silver_energy": 12, "gold_weather_demand_join": 12, "gold_feature_engineering": 12, "gold_demand_aggregation": 4}
    assert all(r["status"] == "passed" for r in out["checks"])
    for name in [*out["rows"], settings.history]:
        spark.sql(f"DROP TABLE {name}")


def test_streams(spark, tmp_path):
    def land(name, records):
        test_captures.put(tmp_path, "energy", name, test_captures.energy(records))

    land("energy_20240101_000000.json", [{"_id": 1, "Timestamp": "2024-01-01T10:00:00", "Demand": 1.0}, {"_id": 2, "Timestamp": "2024-01-01T10:30:00", "Demand": 3.0}])
    path, out, state = str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "state")
    keep_current(energy_stream(spark, path), out, state).awaitTermination()
    land("energy_20240101_010000.json", [{"_id": 1, "Timestamp": "2024-01-01T10:00:00", "Demand": 5.0}, {"_id": 9, "Timestamp": "2024-01-03T10:00:00", "Demand": 5.0}])
    keep_current(energy_stream(spark, path), out, state).awaitTermination()
    assert [(r.source_record_id, r.demand_mw) for r in read_current(spark, out).orderBy("source_record_id").collect()] == [("1", 5.0), ("2", 3.0), ("9", 5.0)]

    q = hourly_demand_stream(energy_stream(spark, path)).writeStream.format("memory").queryName("hourly").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.table("hourly").orderBy("bucket_start_utc").collect()
    assert [(str(r.bucket_start_utc), r.sample_count, r.demand_max_mw) for r in got] == [("2024-01-01 10:00:00", 3, 5.0), ("2024-01-03 10:00:00", 1, 5.0)]
    assert json.loads(q.lastProgress.json)["numInputRows"] >= 0
