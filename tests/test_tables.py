import uuid
from datetime import datetime, timezone

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests import frames, test_captures, test_quality
from tidemark.operators.quality import run_checks, standard_checks
from tidemark.plans.pipeline import Settings, build_gold, build_silver, run_pipeline
from tidemark.sources import tables as T
from tidemark.sources.tables import SchemaConflict, append_table, drop_table, replace_table, schema_growth


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def versions(spark, name):
    return [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__")]


@pytest.fixture
def name(spark, request):
    made = f"t_{abs(hash(request.node.name)) % 10**9}"
    yield made
    drop_table(spark, made)


def numbers(spark, n, **more):
    return spark.range(n).withColumns({k: F.lit(v) for k, v in more.items()})


def failing(spark):
    """Six rows, of which the last task fails after others have written theirs."""
    return spark.range(0, 6, numPartitions=3).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("killed half-way"))).cast("long").alias("id"))


def test_a_table_is_replaced_as_one_change(spark, name):
    assert rows(replace_table(numbers(spark, 3), name)) == [(0,), (1,), (2,)]
    assert rows(replace_table(numbers(spark, 2), name)) == [(0,), (1,)]
    assert len(versions(spark, name)) == 1 and spark.catalog.getTable(name).tableType == "EXTERNAL"


@pytest.mark.parametrize("by", [None, "p"])
def test_a_write_killed_half_way_leaves_the_old_table(spark, name, by):
    before = rows(replace_table(numbers(spark, 3, p=7), name, by))
    broken = failing(spark).withColumn("p", F.lit(8))
    with pytest.raises(Exception, match="killed half-way"):
        replace_table(broken, name, by)
    assert rows(spark.table(name)) == before and len(versions(spark, name)) == 1
    with pytest.raises(Exception, match="killed half-way"):
        replace_table(broken, f"{name}_none", by)
    assert not spark.catalog.tableExists(f"{name}_none") and versions(spark, f"{name}_none") == []


def test_a_frame_may_read_the_table_that_it_replaces(spark, name):
    replace_table(numbers(spark, 4), name)
    for _ in range(2):
        now = spark.table(name)
        replace_table(now.unionByName(now.select((F.col("id") + 10).alias("id"))).where("id <> 0"), name)
    assert rows(spark.table(name)) == [(i,) for i in (1, 2, 3, 10, 11, 11, 12, 12, 13, 13, 20, 21, 22, 23)]


def test_schemas_and_partitions_may_change(spark, name):
    replace_table(numbers(spark, 2, p=1), name, "p")
    assert rows(replace_table(numbers(spark, 3, p=2), name, "p")) == [(0, 2), (1, 2), (2, 2)]
    assert spark.table(name).where("p = 1").count() == 0
    grown = replace_table(spark.range(1).select("id", F.lit("x").alias("more"), F.lit(3).alias("p")), name, "p")
    assert grown.columns == ["id", "more", "p"] and rows(grown) == [(0, "x", 3)]
    for df, by in ((spark.range(1).select(F.lit("text").alias("id")), None), (spark.range(1).select(F.lit(1.5).alias("z"), "id"), "id"), (numbers(spark, 1, a=1, b=2).select("b", "a"), None)):
        out = replace_table(df, name, by)
        assert out.dtypes == df.dtypes and out.count() == 1 and len(versions(spark, name)) == 1
    assert replace_table(spark.range(0), name).count() == 0


def test_a_table_of_another_maker_is_replaced_too(spark, name):
    numbers(spark, 5).write.saveAsTable(name)
    assert replace_table(numbers(spark, 2), name).count() == 2
    assert replace_table(spark.table(name).limit(1), name).count() == 1
    assert spark.catalog.getTable(name).tableType == "EXTERNAL"


def test_names_may_have_capitals_and_a_database(spark, name):
    for n in (f"{name}_Up", f"default.{name}_Up", f"`default`.`{name}_UP`"):
        assert replace_table(numbers(spark, 2), n).count() == 2
    assert spark.table(f"{name}_up").count() == 2 and len(versions(spark, f"{name}_up")) == 1
    drop_table(spark, f"{name}_Up")
    assert not spark.catalog.tableExists(f"{name}_up") and versions(spark, f"{name}_up") == []


@pytest.mark.parametrize("step", [1, 2])
def test_a_switch_killed_between_its_renames_is_mended(spark, name, step, monkeypatch):
    replace_table(numbers(spark, 3), name)
    real, seen = spark.sql, []

    def sql(text, *args, **kw):
        seen.extend([text] * ("RENAME" in text))
        if "RENAME" in text and len(seen) == step:
            raise KeyboardInterrupt
        return real(text, *args, **kw)

    monkeypatch.setattr(spark, "sql", sql)
    monkeypatch.setattr(T, "_mend", lambda *a: None)  # the process is gone
    with pytest.raises(KeyboardInterrupt):
        replace_table(numbers(spark, 1, other="x").select("other"), name)
    monkeypatch.undo()
    assert rows(replace_table(numbers(spark, 2), name)) == [(0,), (1,)]
    assert len(versions(spark, name)) == 1


def test_appended_columns_are_null_in_old_rows(spark, name):
    append_table(spark.createDataFrame([(1, "a")], "id INT, tag STRING"), name)
    append_table(spark.createDataFrame([(2.5, 2, "b")], "score DOUBLE, id INT, tag STRING"), name)
    append_table(spark.createDataFrame([(3,)], "ID TINYINT"), name)
    assert spark.table(name).columns == ["id", "tag", "score"]
    assert sorted(map(tuple, spark.table(name).collect()), key=lambda r: r[0]) == [(1, "a", None), (2, "b", 2.5), (3, None, None)]
    append_table(spark.range(0).select(F.lit(1).alias("late")), name)
    assert spark.table(name).columns == ["id", "tag", "score", "late"] and spark.table(name).count() == 3


def test_rows_that_do_not_fit_change_nothing(spark, name):
    append_table(spark.createDataFrame([(1, "a", (1,))], "id INT, tag STRING, s STRUCT<x: INT>"), name)
    for bad, word in (("id BIGINT", "id"), ("tag INT", "tag"), ("s STRUCT<x: INT, y: INT>", "s")):
        with pytest.raises(SchemaConflict, match=word):
            append_table(spark.createDataFrame([], f"{bad}, fresh INT"), name)
    with pytest.raises(SchemaConflict, match="no type"):
        append_table(spark.range(1).select(F.lit(None).alias("empty")), name)
    assert spark.table(name).columns == ["id", "tag", "s"] and spark.table(name).count() == 1
    assert [f.name for f in schema_growth(spark.table(name).schema, spark.range(0).select(F.lit(1).alias("ID"), F.lit(1).alias("n")).schema)] == ["n"]


def test_append_goes_into_replaced_and_partitioned_tables(spark, name):
    replace_table(numbers(spark, 2, p=1), name, "p")
    seen = Observation("appended")
    append_table(numbers(spark, 3, p=2, extra="e"), name, "p", counted=seen)
    assert spark.table(name).columns == ["id", "extra", "p"] and seen.get == {"rows": 3}
    assert rows(spark.table(name).where("p = 1")) == [(0, None, 1), (1, None, 1)] and spark.table(name).where("p = 2").count() == 3


def test_a_history_with_an_added_column(spark):
    spark.sql("DROP TABLE IF EXISTS t_grown_history")
    ok = test_quality.tables(spark, [("r", "1", "2024-01-01T00:00:00", 1.0)], [("A", "1", "2024-01-01T00:00:00", 1.0)])
    run_checks(spark, ok, standard_checks(F.lit(test_quality.NOW)), test_quality.NOW, "t_grown_history")
    more = spark.table("t_grown_history").withColumns({"run_id": F.lit("second"), "run_timestamp_utc": F.lit(datetime(2024, 1, 2))})
    append_table(more, "t_grown_history")
    run_checks(spark, ok, standard_checks(F.lit(test_quality.NOW)), datetime(2024, 1, 3, tzinfo=timezone.utc), "t_grown_history")
    found = {(r.run_timestamp_utc.day, r.run_id): r["count"] for r in spark.table("t_grown_history").groupBy("run_timestamp_utc", "run_id").count().collect()}
    assert found == {(1, None): 11, (2, "second"): 11, (3, None): 11}
    spark.sql("DROP TABLE t_grown_history")


def test_counts_come_with_the_writes(spark, tmp_path):
    """run_pipeline runs no more jobs than its steps without counts."""
    for h in range(3):
        test_captures.put(tmp_path, "weather", f"weather_20240101_0{h}0000.json", test_captures.weather(dt=1704067200 + 3600 * h))
    test_captures.put(tmp_path, "energy", "energy_20240101_030000.json", test_captures.energy([{"_id": i, "Timestamp": f"2024-01-01T0{i // 4}:{i % 4}5:00", "Demand": float(i), "Generation": 10.0} for i in range(12)]))
    settings, now = Settings.from_session(spark, str(tmp_path)), datetime(2024, 1, 1, 4, 0, tzinfo=timezone.utc)

    def steps():
        made = build_silver(spark, settings)
        made |= build_gold(spark, made, settings)
        run_checks(spark, made, standard_checks(F.lit(now), settings.lag_hours), now, settings.history)

    def jobs(f):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, f.__name__)
        out = f()
        found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found, out

    def whole():
        return run_pipeline(spark, settings, now)

    jobs(steps)  # tables are there from now on
    plain, (counted, out) = jobs(steps)[0], jobs(whole)
    assert counted == plain
    assert out["rows"] == {name: spark.table(name).count() for name in out["rows"]} and out["rows"]["silver_energy"] == 12
    for table in [*out["rows"], settings.history]:
        drop_table(spark, table)


def test_frames_of_silver_keep_their_schema(spark, name):
    weather = frames.weather(spark, [("A", "1", "2024-01-01T00:00:00", 4.0)])
    assert sorted(replace_table(weather, name, "event_date_utc").dtypes) == sorted(weather.dtypes)
