import bisect
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests import frames
from tidemark import catalogue
from tidemark.operators.asof import candidate_counts, candidate_pairs, nearest_weather, nearest_weather_by_minute
from tidemark.operators.ranges import TimeRanges

EPOCH = frames.time("1970-01-01")


def micros(t):
    return (t - EPOCH) // timedelta(microseconds=1)


def brute(energy, weather, unit):
    out = {}
    for _, i, at, *_ in energy:
        e, best = (micros(frames.time(at)) if at else None), None
        for c, j, wt, *_ in weather:
            w = micros(frames.time(wt)) if wt else None
            if e is not None and w is not None and e - 6 * 3600 * 10**6 <= w <= e + 3600 * 10**6:
                key = (abs(e // unit - w // unit), -w, c is None, c or "", j)
                best = min(best, key) if best else key
        out[i] = None if best is None else (-best[1], best[3] or None, best[4])
    return out


def result(df):
    return {r.source_record_id: None if r.weather_event_timestamp_utc is None else (micros(r.weather_event_timestamp_utc), r.city, r.weather_description) for r in df.collect()}


def as_rows(rng, n, kind):
    base = frames.time("2024-01-01T00:00:00")
    out = []
    for i in range(n):
        us = rng.randrange(4 * 24 * 3600 * 10**6) if kind == "spread" else rng.choice([0, 6, 7, 13, -1, 1]) * 3600 * 10**6 + rng.choice([0, 1, -1, 500_000, 999_999, -999_999, 1_000_000, rng.randrange(3 * 10**6)])
        out.append(((base + timedelta(microseconds=us)).isoformat(), str(i)))
    return out


@pytest.mark.parametrize("seed,kind,n,m", [(1, "spread", 300, 60), (2, "clusters", 300, 80), (3, "clusters", 200, 200), (4, "spread", 50, 0)])
def test_nearest_equals_brute_force(spark, seed, kind, n, m):
    rng = random.Random(seed)
    e = [("r", i, at, 1.0) for at, i in as_rows(rng, n, kind)] + [("r", "none", None, 1.0)]
    w = [(rng.choice(["A", "B", None]), i, at, 1.0, {"weather_description": i}) for at, i in as_rows(rng, m, kind)] + [("A", "null", None, 1.0)]
    energy, weather = frames.energy(spark, e), frames.weather(spark, w)
    assert result(nearest_weather(energy, weather)) == brute(e, w, 10**6)
    assert result(nearest_weather_by_minute(energy, weather)) == brute(e, w, 60 * 10**6)
    pairs = candidate_pairs(energy, weather).where("weather_event_timestamp_utc IS NOT NULL").count()
    near = lambda x, y: x and y and -6 * 3600 <= (frames.time(y) - frames.time(x)).total_seconds() <= 3600
    assert pairs == sum(bool(near(a[2], b[2])) for a in e for b in w)


@pytest.mark.parametrize("seed,kind,n,m", [(1, "spread", 300, 60), (2, "clusters", 300, 80), (3, "clusters", 200, 200), (4, "spread", 50, 0)])
def test_candidate_counts_equal_brute_force(spark, seed, kind, n, m):
    rng = random.Random(seed)
    e = [("r", i, at, 1.0) for at, i in as_rows(rng, n, kind)] + [("r", "none", None, 1.0)]
    w = [("A", i, at, 1.0) for at, i in as_rows(rng, m, kind)] + [("A", "null", None, 1.0)]
    energy, weather, hour = frames.energy(spark, e), frames.weather(spark, w), 3600 * 10**6
    times = [[micros(frames.time(r[2])) if r[2] else None for r in rows] for rows in (e, w)]
    want = sorted((r[1], sum(x is not None and y is not None and x - 6 * hour <= y <= x + hour for y in times[1])) for r, x in zip(e, times[0], strict=True))
    for ranges in (None, TimeRanges(), TimeRanges.of(energy, weather, ranges=300)):
        assert sorted((r.source_record_id, r.candidates) for r in candidate_counts(energy, weather, ranges).collect()) == want


def test_candidates_of_a_dense_hour_are_counted_without_pairs(spark, tmp_path):
    events = spark.range(40_000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 12:00:00' + make_dt_interval(0, 0, 0, id % 1000) AS ts", "id AS user_id", "IF(id % 2 = 0, 'view', 'error') AS event_type", "1D AS value", "'{}' AS props"
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    spark.range(25).selectExpr("CAST(id AS INT) AS n_nationkey", "'n' AS n_name", "0 AS n_regionkey").write.parquet(str(tmp_path / "nation.parquet"))
    spark.createDataFrame([(0, "r")], "r_regionkey int, r_name string").write.parquet(str(tmp_path / "region.parquet"))
    out = catalogue.queries()["range_join_candidates"](spark, str(tmp_path))
    assert [tuple(r) for r in out.groupBy("candidates").count().collect()] == [(20_000, 20_000)]
    assert "LeftOuter" not in out._jdf.queryExecution().toString()  # the join that gives 400,000,000 pairs


@pytest.mark.parametrize(
    "event,observed,expected",
    [
        ("12:00:00", ["11:50:00", "12:10:00"], ("12:10:00", -10, 10)),
        ("12:00:00", ["06:00:00"], ("06:00:00", 360, 360)),
        ("12:00:00", ["05:59:59"], None),
        ("12:00:00", ["13:00:00"], ("13:00:00", -60, 60)),
        ("12:00:00", ["13:00:01"], None),
        ("12:00:00.900000", ["12:00:00.100000", "12:00:00.950000"], ("12:00:00.950000", 0, 0)),
        ("12:01:30", ["12:00:00"], ("12:00:00", 1, 1)),
        ("12:00:00", ["12:01:30"], ("12:01:30", -1, 1)),
    ],
)
def test_hand_made_matches(spark, event, observed, expected):
    got = nearest_weather(frames.energy(spark, [("r", "1", f"2024-01-01T{event}", 1.0)]), frames.weather(spark, [("A", str(i), f"2024-01-01T{t}", 1.0) for i, t in enumerate(observed)])).collect()
    assert len(got) == 1 and len(got[0]) == 26
    want = (None, None, None) if expected is None else (frames.time(f"2024-01-01T{expected[0]}"), *expected[1:])
    assert (got[0].weather_event_timestamp_utc, got[0].weather_age_minutes, got[0].weather_time_delta_minutes) == want


def test_minute_crossings_differ_from_cut_minutes(spark):
    e, w = frames.energy(spark, [("r", "1", "2024-01-01T12:01:00", 1.0)]), frames.weather(spark, [("A", "1", "2024-01-01T12:00:59", 1.0)])
    assert nearest_weather(e, w).first().weather_age_minutes == 0 and nearest_weather_by_minute(e, w).first().weather_age_minutes == 1


def test_the_plan_has_no_nested_loop(spark):
    plan = nearest_weather(frames.energy(spark, []), frames.weather(spark, []))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("bounds", [(), (0,), tuple(range(-3, 4))])
def test_ranges_count_bounds(spark, bounds):
    ranges = TimeRanges(bounds)
    df = spark.createDataFrame([(v,) for v in (None, -9, -3, -1, 0, 2, 3, 9)], "us LONG")
    got = df.select("us", ranges.of_time("us").alias("first"), ranges.dealt("us", ["us"]).alias("dealt")).collect()
    assert all(r.first == sum(b < r.us for b in bounds) for r in got if r.us is not None)
    assert all(r.first <= r.dealt <= sum(b <= r.us for b in bounds) for r in got if r.us is not None)
    assert all(0 <= r.dealt < ranges.count for r in got)


def test_an_instant_of_many_rows_is_dealt_over_its_ranges(spark):
    times = spark.range(4000).select(F.when(F.col("id") % 4 != 0, F.lit(0)).otherwise(F.col("id")).cast("timestamp").alias("event_timestamp_utc"), "id")
    ranges = TimeRanges.of(times, ranges=16)
    assert len(ranges.bounds) == 15 and ranges.bounds.count(0) >= 10
    dealt = times.groupBy(ranges.dealt("unix_micros(event_timestamp_utc)", ["id"]).alias("range")).count().collect()
    assert len(dealt) == 16 and max(r["count"] for r in dealt) < 600
    assert TimeRanges.of(times.limit(0)).bounds == ()


@pytest.mark.parametrize("seed", range(4))
def test_ranges_never_change_the_match(spark, seed):
    rng = random.Random(seed)
    e = [("r", i, at, 1.0) for at, i in as_rows(rng, 150, "clusters")] + [("r", f"same{i}", "2024-01-01T00:00:00", 1.0) for i in range(60)] + [("r", f"none{i}", None, 1.0) for i in range(9)]
    w = [(rng.choice(["A", "B", None]), i, at, 1.0, {"weather_description": i}) for at, i in as_rows(rng, 120, "clusters")]
    energy, weather = frames.energy(spark, e), frames.weather(spark, w)
    for ranges in (TimeRanges(), TimeRanges.of(energy, weather, ranges=50), TimeRanges(tuple(sorted(rng.choices([micros(frames.time(x[2])) for x in e + w if x[2]], k=20))))):
        assert result(nearest_weather(energy, weather, ranges)) == brute(e, w, 10**6)
        assert result(nearest_weather_by_minute(energy, weather, ranges)) == brute(e, w, 60 * 10**6)


def test_a_dense_minute(spark):
    """100,000 weather rows in one minute, 2,000 energy rows in it and 300 an hour before, whose reach ends within it."""
    base = "TIMESTAMP '2024-01-01 12:00:00'"
    day = frames.weather(spark, [("A", "0", "2024-01-01T00:00:00", 1.0)])
    weather = day.drop("event_timestamp_utc", "source_record_id").crossJoin(spark.range(100_000).selectExpr("id", f"{base} + make_dt_interval(0, 0, 0, CAST(id AS DECIMAL(18, 6)) * 0.0006) AS event_timestamp_utc", "CAST(id AS STRING) AS source_record_id")).drop("id").select(*day.columns)
    one = frames.energy(spark, [("r", "0", "2024-01-01T00:00:00", 1.0)])
    at = f"{base} + make_dt_interval(0, IF(id < 2000, 0, -1), 0, CAST(id % 2000 AS DECIMAL(18, 6)) * IF(id < 2000, 0.03, 0.2))"
    energy = one.drop("event_timestamp_utc", "source_record_id").crossJoin(spark.range(2300).selectExpr(f"{at} AS event_timestamp_utc", "CAST(id AS STRING) AS source_record_id")).select(*one.columns)
    seen = [i * 600 for i in range(100_000)]
    for match, unit in ((nearest_weather, 10**6), (nearest_weather_by_minute, 60 * 10**6)):
        out = match(energy, weather)
        start = micros(frames.time("2024-01-01T12:00:00"))
        got = {r.source_record_id: None if r.weather_event_timestamp_utc is None else micros(r.weather_event_timestamp_utc) - start for r in out.collect()}
        for i in range(2300):
            e = i * 30_000 if i < 2000 else (i - 2000) * 200_000 - 3600 * 10**6
            # The last one in reach of e's own unit, or else of the nearest unit before or after, which wins a tie.
            low, high = bisect.bisect_left(seen, e - 6 * 3600 * 10**6), bisect.bisect_right(seen, e + 3600 * 10**6)
            back, ahead = bisect.bisect_left(seen, (e // unit + 1) * unit, low, high) - 1, bisect.bisect_left(seen, (e // unit + 1) * unit, low, high)
            best = None if back < low else seen[back]
            if ahead < high and (best is None or seen[ahead] // unit - e // unit <= e // unit - best // unit):
                best = seen[bisect.bisect_left(seen, (seen[ahead] // unit + 1) * unit, ahead, high) - 1]
            assert got[str(i)] == best, (i, unit)
