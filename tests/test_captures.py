import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators.silver import silver_energy, silver_weather
from tidemark.schemas import SILVER_ENERGY, SILVER_WEATHER
from tidemark.sources import feeds
from tidemark.sources.bronze import land_capture, land_captures, read_captures, scan_captures, with_file_times
from tidemark.sources.contracts import ENERGY_CONTRACT, WEATHER_CONTRACT, ContractError, check_contract, load_contract, message, resolve_contract, validate, violations, with_violations
from tidemark.sources.tables import append_by_date, create_view, replace_table

NOW = datetime(2025, 11, 3, 7, 5, 9, tzinfo=timezone.utc)


def weather(**change):
    own = {"id": 7, "dt": 1704110400, "name": "Leeds", "cod": 200, "coord": {"lat": 53.5, "lon": -1.5}, "sys": {"country": "GB"}, "main": {"temp": 6.5, "feels_like": 9, "humidity": 82, "pressure": 1005}, "weather": [{"main": "Clouds", "description": "broken clouds"}], "wind": {"speed": 4.5}, "clouds": {"all": 70}}
    return {k: v for k, v in (own | change).items() if v is not ...}


def energy(records, **change):
    return {"help": "h", "success": True, "result": {"resource_id": "res", "records": records, "limit": 10, "total": len(records)} | change}


def put(root, dataset, name, payload):
    path = root / "raw" / dataset / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(payload if isinstance(payload, str) else json.dumps(payload, indent=2))


def names(schema):
    return [c.split()[0] for c in schema.replace("\n", " ").split(", ")]


def test_weather_keeps_the_latest_capture(spark, tmp_path):
    put(tmp_path, "weather", "weather_20251103_060000.json", weather())
    put(tmp_path, "weather", "ingestion_date=2025-11-03/weather_20251103_073000.json", weather(main={"temp": 7.25, "feels_like": 9, "humidity": 82}))
    put(tmp_path, "weather", "weather_20251103_081500.json", weather(dt=..., weather=[], sys=...))
    put(tmp_path, "weather", "weather_20251103_090000.json", "{not json")
    put(tmp_path, "weather", "other.json", weather(main={"temp": 1.0}))
    raw = read_captures(spark, str(tmp_path / "raw" / "weather"), "weather")
    df = silver_weather(raw)
    assert df.columns == names(SILVER_WEATHER)
    got = sorted(df.collect(), key=lambda r: r.source_file)
    assert [(r.source_file, r.temperature_c, str(r.event_timestamp_utc), r.country_code, r.weather_main) for r in got] == [("weather_20251103_073000.json", 7.25, "2024-01-01 12:00:00", "GB", "Clouds"), ("weather_20251103_081500.json", 6.5, "None", None, None)]
    assert str(got[0].ingestion_timestamp_utc) == "2025-11-03 07:30:00" and str(got[0].event_date_utc) == "2024-01-01" and got[0].source_record_id == "7"
    assert sum(r._corrupt is not None for r in raw.collect()) == 1
    filled = with_file_times(silver_weather(raw.where("source_file = 'other.json'")), raw).first()
    assert filled.ingestion_timestamp_utc is not None


def test_energy_explodes_and_keeps_the_latest(spark, tmp_path):
    put(tmp_path, "energy", "energy_20251103_060000.json", energy([{"_id": 1, "Timestamp": "2025-03-14T21:30:00", "Demand": 812.5}]))
    put(tmp_path, "energy", "energy_20251103_073000.json", energy([{"_id": 1, "Timestamp": "2025-03-14T21:30:00", "Demand": 830}, {"_id": 2, "Timestamp": "2025-03-14T21:35:00", "Demand": 1.5, "STOR": 3}, {"_id": 3, "Timestamp": "soon"}, {"_id": 4}]))
    put(tmp_path, "energy", "energy_20251103_081500.json", energy([]))
    df = silver_energy(read_captures(spark, str(tmp_path / "raw" / "energy"), "energy"))
    assert df.columns == names(SILVER_ENERGY)
    assert [(r.source_record_id, r.demand_mw, r.stor_mw, str(r.event_date_utc)) for r in df.orderBy("source_record_id").collect()] == [("1", 830.0, None, "2025-03-14"), ("2", 1.5, 3.0, "2025-03-14")]


@pytest.mark.parametrize(
    "payload,contract,words",
    [
        (weather(), WEATHER_CONTRACT, None),
        (weather(dt=...), WEATHER_CONTRACT, "dt"),
        (weather(cod="200"), WEATHER_CONTRACT, "cod"),
        (weather(cod=200.0), WEATHER_CONTRACT, None),
        (weather(cod=True), WEATHER_CONTRACT, "cod"),
        (weather(name=""), WEATHER_CONTRACT, "name"),
        (weather(weather=[]), WEATHER_CONTRACT, "weather"),
        (weather(weather=[{"main": 1}]), WEATHER_CONTRACT, "description"),
        (weather(main=None), WEATHER_CONTRACT, "main"),
        (energy([{"_id": 1, "extra": 1}]), ENERGY_CONTRACT, None),
        (energy([{"_id": 1}, {"x": 1}]), ENERGY_CONTRACT, "_id"),
        (energy([{"_id": "1"}]), ENERGY_CONTRACT, "_id"),
        (energy([]) | {"success": False}, ENERGY_CONTRACT, "success"),
        (energy([], limit=0), ENERGY_CONTRACT, "limit"),
        (energy([], total=-1), ENERGY_CONTRACT, "total"),
        ({"invalid": True}, ENERGY_CONTRACT, "help"),
        ([], ENERGY_CONTRACT, "object"),
    ],
)
def test_contracts_on_the_driver_and_in_bulk(spark, payload, contract, words):
    found = violations(payload, contract)
    assert bool(found) == bool(words) and (not words or words in str(found))
    bulk = with_violations(spark.createDataFrame([(json.dumps(payload),)], "value STRING"), contract).first().violations
    assert bool(bulk) == bool(words) and (not words or any(words in x for x in bulk))


def test_contract_errors_and_files(spark, tmp_path):
    with pytest.raises(ContractError, match=r"weather_schema.json: .*; \.\.\. 2 additional"):
        validate({}, WEATHER_CONTRACT, "weather_schema.json")
    with pytest.raises(ValueError, match="pattern"):
        check_contract({"type": "object", "properties": {"a": {"pattern": "x"}}})
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "c.json").write_text(json.dumps(ENERGY_CONTRACT))
    path = resolve_contract("c.json", [str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "a")])
    assert load_contract(str(path)) == ENERGY_CONTRACT and load_contract(str(path)) is load_contract(str(path))
    with pytest.raises(FileNotFoundError, match="searched"):
        resolve_contract("d.json", [str(tmp_path)])
    assert with_violations(spark.createDataFrame([("{",), (None,)], "value STRING"), ENERGY_CONTRACT).where(F.size("violations") == 1).count() == 2


FEEDS = {"weather": feeds.Feed("weather", "http://w", {"q": "Leeds", "units": "metric"}, key_param="appid", key_env="W"), "energy": feeds.Feed("energy", "http://e", {"resource_id": "res", "limit": 10}, key_header="Authorization", key_env="E")}
ENV = {"W": "one", "E": "two"}


def test_ingest_lands_what_is_valid(tmp_path):
    asked = []

    def get(url, params, headers, timeout):
        asked.append((url, params, headers, timeout))
        return 200, weather() if url == "http://w" else energy([{"_id": 1}])

    paths = feeds.ingest(FEEDS, get, str(tmp_path), "ALL", ENV, NOW)
    assert [p.removeprefix(str(tmp_path)) for p in paths] == [f"/raw/{d}/ingestion_date=2025-11-03/{d}_20251103_070509.json" for d in ("weather", "energy")]
    assert asked[0][1]["appid"] == "one" and asked[1][2] == {"Authorization": "two"} and asked[0][3] == 30
    with pytest.raises(FileExistsError):
        feeds.ingest(FEEDS, get, str(tmp_path), "energy", ENV, NOW)
    assert land_capture(str(tmp_path), "x", {}, NOW, dated=False).endswith("/raw/x/x_20251103_070509.json")


@pytest.mark.parametrize("dataset", ["weather", "energy"])
def test_nothing_lands_on_failure(tmp_path, dataset):
    for answer, error in (((200, {"invalid": True}), ContractError), ((500, {}), OSError)):
        with pytest.raises(error):
            feeds.ingest(FEEDS, lambda *a, answer=answer: answer, str(tmp_path), dataset, ENV, NOW)
    assert not list(tmp_path.rglob("*.json"))
    with pytest.raises(ValueError, match="one of"):
        feeds.ingest(FEEDS, None, str(tmp_path), "both")


def test_feed_configuration(tmp_path):
    with pytest.raises(FileNotFoundError, match="template"):
        feeds.load_feed(str(tmp_path / "config.yaml"), "energy")
    (tmp_path / "config.yaml").write_text('api:\n  base_url: "http://x/api"\n  endpoint: "search"\n  api_key_env: "E"\n  api_key_header: "Authorization"\n  timeout_seconds: 12\n  params:\n    # note\n    resource_id: "r-1"\n    limit: 1000\n')
    feed = feeds.load_feed(str(tmp_path / "config.yaml"), "energy")
    assert (feed.url, feed.params, feed.timeout, feed.headers(ENV)) == ("http://x/api/search", {"resource_id": "r-1", "limit": 1000}, 12, {"Authorization": "two"})
    with pytest.raises(ValueError, match="not set"):
        feed.headers({})
    with pytest.raises(ValueError, match="together"):
        feeds.Feed("energy", "u", key_header="A").headers({})
    assert feeds.Feed("energy", "u").headers({}) == {}
    assert feeds.resource_ids({"result": {"resources": [{"id": "1", "name": "East"}, {"id": "2"}]}}) == {"East": "1", "2": "2"}


CONFIG = """
api:
  base_url: "http://x/api/"   # with a slash
  endpoint: search
  timeout_seconds: 9
  params:
    q: "it's: a #1 \\"text\\""
    fields: [a, 'b c']
    filters:
      region: East
      days:
        - 1
        - 2
other: {x: 1}
"""


def test_configuration_with_lists_and_quotes(tmp_path, monkeypatch):
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text(CONFIG)
    feed = feeds.load_feed(str(tmp_path / "c.yaml"), "energy")
    assert (feed.url, feed.timeout) == ("http://x/api/search", 9)
    assert feed.params == {"q": 'it\'s: a #1 "text"', "fields": ["a", "b c"], "filters": {"region": "East", "days": [1, 2]}}
    for text, word in (("api: [1]", "mapping"), ("", "mapping"), ("api: {params: 3}", "params"), ("api: {", "YAML")):
        with pytest.raises(ValueError, match=word):
            feeds.read_config(text)
    assert feeds.read_config("api: {base_url: u}") == {"base_url": "u"}
    monkeypatch.setattr(feeds, "yaml", None)
    assert feeds.read_config('api:\n  base_url: "u"\n  params:\n    limit: 3\n') == {"base_url": "u", "params": {"limit": 3}}


def test_sinks(spark, tmp_path):
    df = spark.range(4).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias("event_date_utc"))
    assert replace_table(df, "t_sink", "event_date_utc").count() == 4
    assert replace_table(df.withColumn("x", F.lit(1)), "t_sink").columns == ["id", "event_date_utc", "x"]
    assert append_by_date(df, str(tmp_path / "p")) and append_by_date(df, str(tmp_path / "p")) and not append_by_date(df.where("id > 9"), str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 8 and (tmp_path / "p" / "dt=2024-01-02").exists() and not (tmp_path / "q").exists()
    create_view(df, "v_sink")
    assert spark.sql("SELECT count(*) FROM v_sink").first()[0] == 4
    spark.sql("DROP TABLE t_sink")


def test_a_capture_lands_on_a_file_system_named_by_a_uri(spark, tmp_path):
    root = f"file://{tmp_path}"
    path = land_capture(root, "weather", {"name": "Örebro"}, NOW)
    assert path == f"{root}/raw/weather/ingestion_date=2025-11-03/weather_20251103_070509.json"
    assert [r.name for r in read_captures(spark, f"{root}/raw/weather", "weather").collect()] == ["Örebro"]
    with pytest.raises(FileExistsError):
        land_capture(root, "weather", {}, NOW)


def test_a_scan_parts_good_files_from_bad_ones(spark, tmp_path):
    put(tmp_path, "weather", "weather_20251103_060000.json", weather())
    put(tmp_path, "weather", "deep/er/weather_20251103_073000.json", weather(name="Örebro", extra={"x": [1]}))
    put(tmp_path, "weather", "other.json", weather(dt=..., sys=...))
    bad = {"cut.json": json.dumps(weather(), indent=2)[:80], "blank.json": " \n\t", "list.json": "[1, 2]", "text.json": '"x"', "types.json": weather(dt="soon", main="hot"), "inner.json": weather(main={"temp": "hot"})}
    for name, payload in bad.items():
        put(tmp_path, "weather", name, payload)
    put(tmp_path, "weather", "note.txt", "not a capture")
    good, rest = scan_captures(spark, str(tmp_path / "raw" / "weather"), "weather", str(tmp_path / "scanned"))
    assert good.columns == read_captures(spark, str(tmp_path / "raw" / "weather"), "weather").columns
    assert sorted((r.source_file, r.name, r.dt) for r in good.collect()) == [("other.json", "Leeds", None), ("weather_20251103_060000.json", "Leeds", 1704110400), ("weather_20251103_073000.json", "Örebro", 1704110400)]
    errors = {r.source_file: r.error for r in rest.collect()}
    assert errors == {"cut.json": "is not JSON", "blank.json": "is empty", "list.json": "is not an object", "text.json": "is not an object", "types.json": "has fields of other types: dt, main", "inner.json": "has fields of other types: within objects or arrays"}
    assert {r.source_file: r.text for r in rest.collect()}["cut.json"] == bad["cut.json"] and all(r.modified for r in rest.collect())
    assert silver_weather(good).count() == 3 and silver_weather(good).exceptAll(silver_weather(read_captures(spark, str(tmp_path / "raw" / "weather"), "weather"))).count() == 0
    written = sorted(p.name for p in (tmp_path / "scanned").iterdir() if p.is_dir())
    assert written == ["readable=false", "readable=true"]


def test_many_captures_land_at_once(spark, tmp_path):
    df = spark.createDataFrame([("a/x.json", '{"n": 1}'), ("b/y.json", "é"), ("c/z.json", None)], "path STRING, value STRING")
    for root in (str(tmp_path / "plain"), f"file://{tmp_path}/uri", f"file:{tmp_path}/uri"):
        land_captures(df, root)
        land_captures(df, root)
    assert (tmp_path / "plain" / "b" / "y.json").read_text() == "é" and sorted(p.name for p in (tmp_path / "uri").rglob("*.json")) == ["x.json", "y.json", "z.json"]


NESTED = {"type": "object", "properties": {"grid": {"type": "array", "minItems": 2, "items": {"type": "array", "minItems": 1, "items": {"type": "integer", "minimum": 0}}}}}


def test_messages_in_bulk_equal_those_of_the_driver(spark):
    payloads = [weather(), weather(dt=...), weather(dt=None), weather(name="", weather=[]), weather(weather=[{"main": "x"}, {"description": 1}, None, 5]), weather(main={"temp": "x"}, wind=None, clouds=[]), [], None, "x", 5, {}]
    payloads += [energy([{"_id": 1.5}, {"_id": True}, {}, *[{}] * 9], limit=0, total=-1), energy("no"), energy([{"_id": 1}]) | {"success": False}, {"grid": [[1, -2], [], ["x", 1.5, 2.0], 3]}, {"grid": [[1]]}, {"grid": [[0], [1, 2]]}]
    rows = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(payloads)], "i INT, value STRING")
    for contract, name in ((WEATHER_CONTRACT, "w"), (ENERGY_CONTRACT, "e"), (NESTED, "n")):
        for p, r in zip(payloads, with_violations(rows, contract, name=name).orderBy("i").collect(), strict=True):
            found = violations(p, contract)
            assert r.violations == [f"{a} {b}" for a, b in found]
            assert r.message == (message(found, name) if found else None)
    assert "additional" in with_violations(rows, ENERGY_CONTRACT, name="e").where("i = 11").first().message
