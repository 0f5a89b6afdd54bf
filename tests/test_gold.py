from math import ceil, isclose

from pyspark.sql import functions as F

from tests import frames
from tidemark.functions import measures as M
from tidemark.operators.asof import nearest_weather
from tidemark.operators.features import calendar_features, feature_table, series_features
from tidemark.operators.ranges import TimeRanges
from tidemark.operators.rollup import LATER_MEANS, MEANS, SKETCH_K, daily_states, demand_rollup, hourly_states, rollup_base
from tidemark.operators.serving import latest_label_by_window, serving_rollup


def test_calendar(spark):
    df = spark.createDataFrame([("2024-01-07 05:10:00",), ("2024-01-06 23:59:59",), ("2024-01-01 00:00:00",)], "t STRING").select(F.to_timestamp("t").alias("event_timestamp_utc"))
    assert [tuple(r)[1:] for r in calendar_features(df).collect()] == [(5, 1, 1), (23, 7, 1), (0, 2, 0)]
    assert [r.day_of_week_utc for r in calendar_features(df, True).collect()] == [7, 6, 1]


def test_measures(spark):
    df = spark.createDataFrame([(10.0,), (16.0,), (20.0,), (None,)], "t DOUBLE").select(M.heating_degrees(F.col("t")), M.cooling_degrees(F.col("t")))
    assert [tuple(r) for r in df.collect()] == [(5.0, 0.0), (0.0, 0.0), (0.0, 2.0), (0.0, 0.0)]
    shares = spark.createDataFrame([(100.0,), (0.0,), (None,), (-1.0,)], "g DOUBLE").select(M.renewable_share(F.lit(None).cast("double"), F.lit(20.0), F.col("g")))
    assert [r[0] for r in shares.collect()] == [0.2, None, None, None]


def test_series(spark):
    rows = [("2024-01-01T00:00:00", 10.0), ("2024-01-01T00:30:00", 20.0), ("2024-01-01T00:30:00", 40.0)]
    joined = nearest_weather(frames.energy(spark, [("r", str(i), t, d) for i, (t, d) in enumerate(rows)]), frames.weather(spark, [("A", "1", "2024-01-01T00:10:00", 4.0)]))
    got = feature_table(joined).orderBy("demand_mw").collect()
    assert len(got[0]) == 30
    assert [r.demand_lag_1 for r in got] == [None, 10.0, 20.0] and [r.demand_delta_1 for r in got] == [None, 10.0, 20.0]
    assert all(isclose(r.demand_rolling_mean_12, m) for r, m in zip(got, [10, 15, 70 / 3], strict=True)) and [r.temperature_sq for r in got] == [16.0] * 3


def test_rolling_mean_is_twelve_rows(spark):
    df = spark.range(20).select(F.lit("r").alias("resource_id"), F.lit("c").alias("city"), F.timestamp_seconds("id").alias("event_timestamp_utc"), F.col("id").cast("double").alias("demand_mw"), F.lit(1.0).alias("temperature"))
    got = [r.demand_rolling_mean_12 for r in series_features(df).orderBy("event_timestamp_utc").collect()]
    assert got == [sum(range(max(0, i - 11), i + 1)) / min(i + 1, 12) for i in range(20)]


def test_slices_of_time_change_nothing(spark):
    # Two series and a null city; gaps of whole slices, slices of one row, rows at one instant, null times and null measures.
    n = F.col("id")
    time = F.when(n % 40 != 7, F.timestamp_seconds(F.floor(n / 3) * F.floor(n / 3) * 900))
    df = spark.range(300).select(
        F.lit("r").alias("resource_id"), F.when(n % 3 != 0, F.concat(F.lit("c"), (n % 3).cast("string"))).alias("city"), time.alias("event_timestamp_utc"),
        F.lpad(n.cast("string"), 3, "0").alias("source_record_id"), F.when(n % 5 != 0, F.sqrt("id")).alias("demand_mw"), (n % 11).cast("double").alias("temperature"),
    )
    df = df.union(df.withColumns({"source_record_id": F.concat(F.lit("x"), "source_record_id"), "demand_mw": F.col("demand_mw") + 1}))
    rows = lambda out: sorted(map(str, out.collect()))
    for width, span in ((12, "day"), (12, "month"), (12, "hour"), (2, "hour"), (1, "day")):
        whole, sliced = series_features(df, width), series_features(df, width, span)
        assert sliced.columns == whole.columns and rows(sliced) == rows(whole)
    assert series_features(df.limit(0), 12, "day").count() == 0
    bare = df.where("source_record_id NOT LIKE 'x%' AND event_timestamp_utc IS NOT NULL").drop("source_record_id")
    assert rows(series_features(bare, 12, "day")) == rows(series_features(bare, 12))


def test_unusable_rows_are_left_out(spark):
    energy = frames.energy(spark, [("r", "1", "2024-01-01T00:00:00", None), ("r", "2", "2024-01-01T00:00:01", 1.0), ("r", "3", "2024-03-01T00:00:00", 1.0)])
    for change, n in (({}, 1), ({"temperature_c": None}, 1), ({"temperature_c": None, "feels_like_c": None}, 0), ({"humidity_pct": None}, 0), ({"city": None}, 0)):
        weather = frames.weather(spark, [("A", "1", "2024-01-01T00:00:00", 4.0, change)])
        joined = nearest_weather(energy, weather)
        assert joined.count() == 3 and feature_table(joined).count() == n


def test_rollup(spark):
    rows = [(f"2024-01-01 00:{i:02d}:00", "A", None, "r", float(i), 10.0, 100.0, None, 20.0, "Rain" if i == 10 else "Clear") for i in range(1, 11)]
    rows += [("2024-01-01 05:00:00", "A", None, "r", 7.0, 20.0, 0.0, 1.0, 1.0, None), ("2024-01-01 05:00:00", None, None, "r", 7.0, 1.0, 1.0, 1.0, 1.0, "x"), ("2024-01-01 05:00:00", "A", None, None, 7.0, 1.0, 1.0, 1.0, 1.0, "x")]
    got = {(r.aggregation_level, str(r.bucket_start_utc)): r for r in demand_rollup(frames.features(spark, rows)).collect()}
    assert len(got) == 3
    first, alone, day = got["hourly", "2024-01-01 00:00:00"], got["hourly", "2024-01-01 05:00:00"], got["daily", "2024-01-01 00:00:00"]
    assert len(first) == 27 and (first.sample_count, first.demand_p95_mw, first.demand_avg_mw, first.latest_weather_main) == (10, 10.0, 5.5, "Rain")
    assert isclose(first.demand_stddev_mw, 3.0276503540974917) and isclose(first.renewable_share_avg, 0.2) and first.heating_degree_avg_c == 5.0
    assert (alone.demand_stddev_mw, alone.renewable_share_avg, alone.latest_weather_main, alone.cooling_degree_avg_c) == (None, None, None, 2.0)
    assert (day.sample_count, str(day.bucket_end_utc), day.latest_weather_main) == (11, "2024-01-02 00:00:00", None)
    assert {r.demand_p95_mw for r in serving_rollup(frames.features(spark, rows)).collect()} == {None}
    labels = {(r.aggregation_level, str(r.bucket_start_utc)): r.latest_weather_main for r in latest_label_by_window(frames.features(spark, rows)).collect()}
    assert labels == {k: r.latest_weather_main for k, r in got.items()}


def bunch(spark, n, hours=48, spread=1e9):
    """n rows of two keys over hours, with demands about spread that differ by little."""
    i = F.col("id")
    return spark.range(n).select(
        F.timestamp_seconds(i * 37 % (hours * 3600)).alias("event_timestamp_utc"), F.lit("A").alias("city"), F.when(i % 2 == 0, "x").alias("country_code"), F.lit("r").alias("resource_id"),
        (F.lit(spread) + (i * 7919 % 1000) / 1000).alias("demand_mw"), *[F.when(i % 5 != 0, (i % 13).cast("double")).alias(c) for c in ("temperature", "humidity", "generation_mw", "import_mw", "solar_mw", "wind_mw", "wind_speed_mps", "cloud_cover_pct")],
        F.when(i % 3 != 0, F.concat(F.lit("w"), (i % 7).cast("string"))).alias("weather_main"),
    )


def test_days_merged_from_hours_equal_days_from_rows(spark):
    df = bunch(spark, 20_000)
    base = rollup_base(df).withColumn("bucket_start_utc", F.date_trunc("day", "event_timestamp_utc"))
    means = {**MEANS, **LATER_MEANS}
    plain = base.groupBy("bucket_start_utc", "country_code").agg(F.count("*").alias("n"), F.stddev_samp("demand_mw").alias("s"), F.avg("demand_mw").alias("m"), *[F.avg(c).alias(k) for k, c in means.items()], F.max(F.struct("event_timestamp_utc", "weather_main"))["weather_main"].alias("w"))
    want = {(r.bucket_start_utc, r.country_code): r for r in plain.collect()}
    got = demand_rollup(df).where("aggregation_level = 'daily'").collect()
    assert len(got) == len(want) == 4
    for r in got:
        x = want[r.bucket_start_utc, r.country_code]
        assert (r.sample_count, r.latest_weather_main) == (x.n, x.w) and isclose(r.demand_stddev_mw, x.s, rel_tol=1e-6) and isclose(r.demand_avg_mw, x.m, rel_tol=1e-12)
        assert all(isclose(r[k], x[k], rel_tol=1e-9) for k in means)
    assert demand_rollup(df, ("hourly",)).exceptAll(demand_rollup(df).where("aggregation_level = 'hourly'")).count() == 0
    assert demand_rollup(df, ("daily",)).count() == 4 and demand_rollup(df.limit(0)).count() == 0


def test_percentiles_are_exact_up_to_a_sketch_and_near_beyond(spark):
    few = demand_rollup(bunch(spark, 2000, hours=2)).collect()
    assert len(few) == 6
    for r in few:
        values = sorted(x.demand_mw for x in bunch(spark, 2000, hours=2).where(F.col("country_code").eqNullSafe(r.country_code) & F.col("event_timestamp_utc").between(F.lit(r.bucket_start_utc), F.lit(r.bucket_end_utc) - F.expr("INTERVAL 1 SECOND"))).collect())
        assert len(values) == r.sample_count <= SKETCH_K and r.demand_p95_mw == values[ceil(0.95 * len(values)) - 1]
    for k, error in ((SKETCH_K, 0.0088), (4096, 0.0026)):  # twice the bound
        many = demand_rollup(bunch(spark, 120_000, hours=24, spread=0.0), ("daily",), sketch_k=k).collect()
        assert len(many) == 2 and all(r.sample_count == 60_000 and abs(r.demand_p95_mw - 0.949) <= error + 0.001 for r in many)


def test_a_day_shuffles_one_row_an_hour_and_key(spark):
    states = hourly_states(bunch(spark, 5000))
    assert states.count() == 96 and daily_states(states).count() == 4 and {len(r.hours) for r in daily_states(states).collect()} == {24}
    plan = demand_rollup(bunch(spark, 50))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Generate inline(concat" in plan.replace("\n", " ") and plan.count("Range (") == 1


def test_one_long_series_is_cut_by_ranges(spark):
    df = spark.range(3000).select(
        F.concat(F.lit("r"), (F.col("id") % 1).cast("string")).alias("resource_id"), F.when(F.col("id") % 2 == 0, "c").alias("city"), F.timestamp_seconds(F.col("id") * F.col("id") % 4001).alias("event_timestamp_utc"),
        F.lpad(F.col("id").cast("string"), 5, "0").alias("source_record_id"), F.when(F.col("id") % 6 != 0, F.sqrt("id")).alias("demand_mw"), (F.col("id") % 11).cast("double").alias("temperature"),
    )
    rows = lambda out: sorted(map(str, out.collect()))
    for ranges in (TimeRanges(), TimeRanges.of(df, ranges=9), TimeRanges.of(df, ranges=400), TimeRanges((5_000_000,) * 3)):
        for width in (12, 2, 1):
            sliced = series_features(df, width, ranges=ranges)
            assert rows(sliced) == rows(series_features(df, width))
    plan = series_features(df, ranges=TimeRanges.of(df, ranges=9))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("Exchange hashpartitioning(resource_id") == 2 and "Exchange hashpartitioning(resource_id#" in plan
    assert all("__slice" in x or "__edge" in x for x in plan.split("\n") if "Exchange hashpartitioning(resource_id" in x)
