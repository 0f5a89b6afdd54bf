"""Nearest-match join: every energy row with the weather row nearest in time, from six hours before to one hour after it.

Nearest is by whole seconds (or minutes: the unit), then the later weather row; of rows at the same instant the smallest
city, then record id. There is no equality key, so a literal join compares every pair. Here both sides are dealt into ranges
of time that hold about as many rows each, and in each range sorted together once. Of a unit's weather rows only the last
can be the nearest, wherever it is in reach, so weather comes as one row a unit; running windows give each energy row the
last unit at or before its own and the first one after. Only where an energy row's reach ends within that later unit the
last row in reach is another one: for that, weather rows also stand an hour before their time, where the last one before an
energy row is the last in its reach. What a range needs from others is one row each way, from one row a range.

The work is linear in rows but for one sort a range, nothing is replicated, and no key grows with what a second or minute
holds: weather is grouped by instant and unit with partial results, and energy rows of one instant go to all the ranges
that begin with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.measures import age_minutes, gap_minutes, minute_crossings
from tidemark.operators.ranges import TimeRanges, micros
from tidemark.schemas import ENERGY_KEY

SECOND_US, MINUTE_US, HOUR_US = 1_000_000, 60_000_000, 3_600_000_000
BEFORE_US, AFTER_US = 6 * HOUR_US, HOUR_US
WEATHER_PART = ["city", "country_code", "temperature_c", "feels_like_c", "humidity_pct", "pressure_hpa", "cloud_cover_pct", "wind_speed_mps", "weather_main", "weather_description"]
ENERGY_PART = ["demand_mw", "generation_mw", "import_mw", "solar_mw", "wind_mw", "stor_mw", "other_mw"]
#: Order of rows at one place: carried in, units, weather an hour early, energy, carried from behind.
_IN, _UNIT, _EARLY, _ENERGY, _BEHIND = range(5)
_FIRST, _LAST = 1 - (1 << 63), (1 << 63) - 1


def _placed(df: DataFrame, place: Column, side: int, ranges: TimeRanges, **what: Column) -> DataFrame:
    return df.withColumn("place", place).select(ranges.of_time("place").alias("range"), "place", F.lit(side).alias("side"), *[c.alias(n) for n, c in what.items()])


def _weather_places(weather: DataFrame, unit_us: int, ranges: TimeRanges) -> DataFrame:
    """range, place, side, unit (the first instant and the last row of a unit, at its start), early (a row, AFTER_US before it)."""
    city, record = F.col("city"), F.col("source_record_id")
    packed = F.struct(city.isNull(), city, record.isNull(), record, F.struct("us", F.col("event_timestamp_utc").alias("at"), F.col("ingestion_timestamp_utc").alias("came"), *WEATHER_PART).alias("w"))
    # One row an instant: the first by city, then record id, nulls last.
    instants = weather.where("event_timestamp_utc IS NOT NULL").withColumn("us", micros(F.col("event_timestamp_utc"))).groupBy("us").agg(F.min(packed)["w"].alias("w"))
    units = instants.groupBy(F.floor(F.col("us") / unit_us).alias("u")).agg(F.min("us").alias("first"), F.max("w").alias("last"))
    pair = F.struct("first", "last")
    at_units = _placed(units, F.col("u") * unit_us, _UNIT, ranges, unit=pair, early=F.lit(None))
    return at_units.unionByName(_placed(instants, F.col("us") - AFTER_US, _EARLY, ranges, unit=F.lit(None), early=F.col("w")))


def _carried(places: DataFrame, ranges: TimeRanges) -> DataFrame:
    """For each range two rows: the last unit and early row before it, and the first unit after it."""
    spark = places.sparkSession
    every = spark.range(ranges.count).selectExpr("CAST(id AS INT) AS range", "CAST(NULL AS BIGINT) AS place", "NULL AS unit", "NULL AS early")
    at = "IF({0} IS NOT NULL, struct(place, {0} AS row), NULL)"
    ends = places.select("range", "place", "unit", "early").unionByName(every).groupBy("range")
    ends = ends.agg(F.expr(f"min({at.format('unit')}) AS first"), F.expr(f"max({at.format('unit')}) AS last"), F.expr(f"max({at.format('early')}) AS last_early"))
    # A row a range: as many as the session's tasks call for, whatever the data.
    before = "OVER (ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    ends = ends.selectExpr("range", f"last(last.row, true) {before} AS unit", f"last(last_early.row, true) {before} AS early", "lead(first.row) IGNORE NULLS OVER (ORDER BY range) AS next")
    begin, end = f"struct({_FIRST}L AS place, {_IN} AS side, unit, early)", f"struct({_LAST}L AS place, {_BEHIND} AS side, next AS unit, CAST(NULL AS {places.schema['early'].dataType.simpleString()}) AS early)"
    return ends.selectExpr("range", f"inline(array({begin}, {end}))")


def _matched(energy: DataFrame, weather: DataFrame, unit_us: int, ranges: TimeRanges | None) -> DataFrame:
    """energy rows with `w`, the chosen weather row as a struct or null."""
    ranges = ranges or TimeRanges.of(energy, weather)
    us = micros(F.col("event_timestamp_utc"))
    places = _weather_places(weather, unit_us, ranges)
    w = places.unionByName(_carried(places, ranges)).withColumn("e", F.lit(None))
    e = energy.withColumn("place", us).select(ranges.dealt("place", ENERGY_KEY).alias("range"), "place", F.lit(_ENERGY).alias("side"), F.lit(None).alias("unit"), F.lit(None).alias("early"), F.struct(*energy.columns).alias("e"))
    seen = Window.partitionBy("range").orderBy("place", "side").rowsBetween(Window.unboundedPreceding, 0)
    both = w.unionByName(e).select(
        "place", "side", "e", F.last("unit", True).over(seen).alias("prev"), F.last("early", True).over(seen).alias("reached"),
        F.expr("lead(unit) IGNORE NULLS OVER (PARTITION BY range ORDER BY place, side)").alias("next"),
    ).where(F.col("side") == _ENERGY)
    back = f"IF(prev.last.us >= place - {BEFORE_US}L, prev.last, NULL) AS back"
    ahead = f"CASE WHEN next.last.us <= place + {AFTER_US}L THEN next.last WHEN next.first <= place + {AFTER_US}L THEN reached END AS ahead"
    far = "abs(floor({0}.us / {1}) - floor(place / {1}))"
    nearer = f"back IS NULL OR {far.format('ahead', unit_us)} <= {far.format('back', unit_us)}"
    return both.selectExpr("place", "e", back, ahead).selectExpr("e.*", f"CASE WHEN ahead IS NULL THEN back WHEN {nearer} THEN ahead ELSE back END AS w")


def _joined(matched: DataFrame, age, gap) -> DataFrame:
    event, seen = F.col("event_timestamp_utc"), F.col("w.at")
    return matched.select(
        *ENERGY_KEY, "event_date_utc", "w.city", "w.country_code", *ENERGY_PART, seen.alias("weather_event_timestamp_utc"),
        age(event, seen).alias("weather_age_minutes"), gap(event, seen).alias("weather_time_delta_minutes"), *[f"w.{c}" for c in WEATHER_PART[2:]],
        F.col("ingestion_timestamp_utc").alias("energy_ingestion_timestamp_utc"), F.col("w.came").alias("weather_ingestion_timestamp_utc"),
    )


def nearest_weather(energy: DataFrame, weather: DataFrame, ranges: TimeRanges | None = None) -> DataFrame:
    """Every energy row (keys are unique) with its nearest weather row, or nulls where none is in reach.

    ranges deal the rows out; where none are given, a scan of both sides' times makes them. An energy row without a time
    has no match, a weather row without one is no match.
    """
    return _joined(_matched(energy, weather, SECOND_US, ranges), age_minutes, gap_minutes)


def nearest_weather_by_minute(energy: DataFrame, weather: DataFrame, ranges: TimeRanges | None = None) -> DataFrame:
    """As nearest_weather, but distances are minute boundaries crossed, for ranking and for the result."""
    return _joined(_matched(energy, weather, MINUTE_US, ranges), minute_crossings, lambda e, w: F.abs(minute_crossings(e, w)))


def candidate_pairs(energy: DataFrame, weather: DataFrame) -> DataFrame:
    """All (energy key, weather time) pairs in reach; an energy row without any keeps one with a null.

    One outer join on hour buckets with the exact bounds as residual, so that it never compares every pair. Weather, which
    has fewer rows, goes to the eight hours from which it can be reached; each energy row lies in its own hour alone, so
    the join finds those without a match too.
    """
    us = micros(F.col("event_timestamp_utc"))
    hour = lambda c: F.floor(c / HOUR_US)
    e = energy.select(*ENERGY_KEY, us.alias("e_us")).withColumn("hour", hour(F.col("e_us")))
    w = weather.select(F.col("event_timestamp_utc").alias("weather_event_timestamp_utc"), "city", us.alias("w_us")).withColumn("w_hour", F.explode(F.sequence(hour(F.col("w_us") - AFTER_US), hour(F.col("w_us") + BEFORE_US))))
    reach = F.col("w_us").between(F.col("e_us") - BEFORE_US, F.col("e_us") + AFTER_US)
    return e.join(w, (F.col("hour") == F.col("w_hour")) & reach, "left").select(*ENERGY_KEY, "weather_event_timestamp_utc", "city")


def candidate_counts(energy: DataFrame, weather: DataFrame, ranges: TimeRanges | None = None) -> DataFrame:
    """The key of every energy row with `candidates`: how many weather rows are in reach, none where its time is null.

    They are the pairs of candidate_pairs, whose number grows with the square of what an hour holds, counted without making
    them. A weather row comes into reach AFTER_US before its time and is out of it once BEFORE_US after it have passed, so the
    count is the sum of such steps up to the energy row's time: a running sum in each range of time, begun with the sum of
    the ranges before it. Steps come as two rows an instant, and energy rows of one instant go to all the ranges that begin with it.
    """
    time = "event_timestamp_utc"
    if ranges is None:
        ranges = TimeRanges.of(energy, *[weather.select((F.col(time) + F.expr(f"INTERVAL {us} MICROSECONDS")).alias(time)) for us in (-AFTER_US, BEFORE_US)])
    us = micros(F.col(time))
    instants = weather.where(f"{time} IS NOT NULL").groupBy(us.alias("us")).agg(F.count("*").alias("n"))
    steps = instants.selectExpr(f"inline(array(struct(us - {AFTER_US}L AS place, n AS step), struct(us + {BEFORE_US + 1}L AS place, -n AS step)))")
    steps = steps.select(ranges.of_time("place").alias("range"), "place", F.lit(_UNIT).alias("side"), "step")
    every = weather.sparkSession.range(ranges.count).selectExpr("CAST(id AS INT) AS range", "0L AS step")
    totals = steps.select("range", "step").unionByName(every).groupBy("range").agg(F.sum("step").alias("step"))
    # A row a range: as many as the session's tasks call for, whatever the data.
    before = totals.selectExpr("range", f"{_FIRST}L AS place", f"{_IN} AS side", "sum(step) OVER (ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS step")
    e = energy.select(*ENERGY_KEY, us.alias("place")).select(ranges.dealt("place", ENERGY_KEY).alias("range"), "place", F.lit(_ENERGY).alias("side"), *ENERGY_KEY)
    seen = Window.partitionBy("range").orderBy("place", "side").rowsBetween(Window.unboundedPreceding, 0)
    both = e.unionByName(steps.unionByName(before), allowMissingColumns=True).withColumn("sum", F.sum("step").over(seen)).where(F.col("side") == _ENERGY)
    return both.select(*ENERGY_KEY, F.when(F.col("place").isNotNull(), F.coalesce("sum", F.lit(0))).otherwise(0).alias("candidates"))
