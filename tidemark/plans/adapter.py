"""Energy and weather tables made from a table of events: views are weather, all other events are energy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: The tables' schemas, so that no job has to look for them.
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
NATION, REGION = "n_nationkey INT, n_name STRING, n_regionkey INT", "r_regionkey INT, r_name STRING"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    k = F.get_json_object("props", "$.k").try_cast("double")
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").withColumns({"at": F.col("ts").cast("timestamp"), "k": k})


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_timestamp_utc of all events, energy and weather."""
    return _events(spark, sf_dir).select(F.col("at").alias("event_timestamp_utc"))


def energy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, value, n = F.col("k"), F.col("value"), F.col("event_id")
    return _events(spark, sf_dir).where("event_type <> 'view'").select(
        F.lit("energy").alias("source_dataset"), F.lit("events").alias("source_file"), F.concat(F.lit("region-"), (F.col("user_id") % 4).cast("string")).alias("resource_id"), n.cast("string").alias("source_record_id"),
        F.col("at").alias("event_timestamp_utc"), (F.col("at") + F.expr("INTERVAL 5 MINUTES")).alias("ingestion_timestamp_utc"), F.to_date("at").alias("event_date_utc"),
        F.when(n % 97 != 0, value).alias("demand_mw"), k.alias("generation_mw"), (value - k).alias("import_mw"), F.when(n % 11 != 0, k * 0.25).alias("solar_mw"), (k * 0.125).alias("wind_mw"), (k * 0.0625).alias("stor_mw"), (k * 0.5).alias("other_mw"),
    )


def weather_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n, user = F.col("k"), F.col("event_id"), F.col("user_id")
    nation = spark.read.schema(NATION).parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").alias("nk"), "n_name", "n_regionkey")
    region = spark.read.schema(REGION).parquet(f"{sf_dir}/region.parquet").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    places = F.broadcast(nation.join(region, "n_regionkey"))  # 25 nations
    e = _events(spark, sf_dir).where("event_type = 'view'")
    return e.join(places, user % 25 == F.col("nk")).select(
        F.lit("weather").alias("source_dataset"), F.lit("events").alias("source_file"), n.cast("string").alias("source_record_id"),
        F.col("at").alias("event_timestamp_utc"), (F.col("at") + F.expr("INTERVAL 5 MINUTES")).alias("ingestion_timestamp_utc"), F.to_date("at").alias("event_date_utc"),
        F.col("n_name").alias("city"), F.when(user % 25 != 7, F.col("r_name")).alias("country_code"), F.lit(52.5).alias("latitude"), F.lit(-1.25).alias("longitude"),
        F.when(n % 13 != 0, k * 0.5 - 8).alias("temperature_c"), (k * 0.5 - 9).alias("feels_like_c"), F.when(n % 29 != 0, k).alias("humidity_pct"), (k * 0.25 + 1000).alias("pressure_hpa"), k.alias("cloud_cover_pct"), (k / 16).alias("wind_speed_mps"),
        F.when(k < 33, "Clear").when(k < 66, "Clouds").otherwise("Rain").alias("weather_main"), F.concat(F.lit("sky "), (user % 5).cast("string")).alias("weather_description"),
    )


def recaptured(df: DataFrame, measure: str) -> DataFrame:
    """df with a second capture of every row an hour later, with another value of measure: input for keep-latest."""
    again = df.withColumns({"ingestion_timestamp_utc": F.col("ingestion_timestamp_utc") + F.expr("INTERVAL 1 HOUR"), measure: F.col(measure) + 1})
    return df.unionByName(again)


def rival_captures(df: DataFrame, key: str) -> DataFrame:
    """df with many captures of a key: times cut to the hour, few record ids, null and equal ingestion times, null keys."""
    n = F.col("source_record_id").cast("long")
    return df.withColumns(
        {
            "source_file": F.concat(F.lit("capture-"), F.lpad("source_record_id", 9, "0")),
            "ingestion_timestamp_utc": F.when(n % 5 != 0, F.date_trunc("day", "event_timestamp_utc") + F.make_dt_interval(hours=(n % 3).cast("int"))),
            "event_timestamp_utc": F.date_trunc("hour", "event_timestamp_utc"),
            key: F.when(n % 7 != 0, F.col(key)),
            "source_record_id": (n % 3).cast("string"),
        }
    )


def raw_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Energy events as raw captures, one a resource and day; every 101st record has no readable time, and one capture no records."""
    n = F.col("source_record_id").cast("long")
    time = F.when(n % 101 == 0, F.lit("soon")).otherwise(F.date_format("event_timestamp_utc", "yyyy-MM-dd HH:mm:ss"))
    names = {"demand_mw": "Demand", "generation_mw": "Generation", "import_mw": "Import", "solar_mw": "Solar", "wind_mw": "Wind", "stor_mw": "STOR", "other_mw": "Other"}
    record = F.struct(n.alias("_id"), time.alias("Timestamp"), *[F.col(k).alias(v) for k, v in names.items()])
    days = energy_events(spark, sf_dir).groupBy("resource_id", "event_date_utc").agg(F.collect_list(record).alias("records"))
    kind = days.schema["records"].dataType
    days = days.unionByName(spark.range(1).select(F.lit("none").alias("resource_id"), F.lit("2024-01-01").cast("date").alias("event_date_utc"), F.lit(None).cast(kind).alias("records")))
    name = F.concat(F.lit("energy_"), F.date_format("event_date_utc", "yyyyMMdd"), F.lit("_120000.json"))
    return days.select(name.alias("source_file"), F.struct("resource_id", "records").alias("result"), F.lit(None).cast("string").alias("_corrupt"))


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather events as raw captures; every 10th has a file name without a time, every 17th no weather entries."""
    n = F.col("source_record_id").cast("long")
    file = F.when(n % 10 == 0, F.lit("other.json")).otherwise(F.concat(F.lit("weather_"), F.date_format("event_timestamp_utc", "yyyyMMdd_HHmmss"), F.lit(".json")))
    entry = F.struct(F.col("weather_main").alias("main"), F.col("weather_description").alias("description"))
    return weather_events(spark, sf_dir).select(
        file.alias("source_file"), n.alias("id"), F.unix_timestamp("event_timestamp_utc").alias("dt"), F.col("city").alias("name"), F.lit(200).alias("cod"),
        F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")).alias("coord"), F.struct(F.col("country_code").alias("country")).alias("sys"),
        F.struct(F.col("temperature_c").alias("temp"), F.col("feels_like_c").alias("feels_like"), F.col("humidity_pct").alias("humidity"), F.col("pressure_hpa").alias("pressure")).alias("main"),
        F.struct(F.col("cloud_cover_pct").alias("all")).alias("clouds"), F.struct(F.col("wind_speed_mps").alias("speed")).alias("wind"),
        F.when(n % 17 == 0, F.array().cast("array<struct<main:string,description:string>>")).otherwise(F.array(entry)).alias("weather"), F.lit(None).cast("string").alias("_corrupt"),
    )


def weather_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id and value, the captures as JSON texts: every 11th isn't JSON, every 9th has no time, every 12th an empty name."""
    n = F.col("id")
    raw = raw_weather(spark, sf_dir).withColumns({"dt": F.when(n % 9 != 0, F.col("dt")), "name": F.when(n % 12 == 0, F.lit("")).otherwise(F.col("name"))})
    text = F.to_json(F.struct(*[c for c in raw.columns if c not in ("source_file", "_corrupt")]))
    return raw.select("id", F.when(n % 11 == 0, F.lit("{")).otherwise(text).alias("value"))


def _energy_documents(spark: SparkSession, sf_dir: str, lacking: int) -> DataFrame:
    """resource_id, event_date_utc, doc: energy captures as whole documents, records in order; every lacking-th has no _id."""
    raw = raw_energy(spark, sf_dir).where("result.resource_id <> 'none'").select("result.*", "source_file")
    record = F.transform(F.sort_array("records"), lambda r: r.withField("_id", F.when(r["_id"] % lacking != 0, r["_id"])))
    fields = F.struct("resource_id", record.alias("records"), F.lit(1000).alias("limit"), F.size("records").alias("total"))
    day = F.to_date(F.substring("source_file", 8, 8), "yyyyMMdd")
    return raw.select("resource_id", day.alias("event_date_utc"), F.struct(F.lit("h").alias("help"), F.lit(True).alias("success"), fields.alias("result")).alias("doc"))


def energy_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """resource_id, event_date_utc, value: a capture a day and resource as JSON, of whose records every 7th has no _id."""
    return _energy_documents(spark, sf_dir, 7).select("resource_id", "event_date_utc", F.to_json("doc").alias("value"))


def energy_capture_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path and value of a file a day and resource, pretty-printed JSON. Each tenth day has a broken one: cut in half (region-2,
    5th), blank (region-1, 7th), a list (region-0, 9th), or with records of another type (region-3, 3rd)."""
    docs = _energy_documents(spark, sf_dir, 1 << 60)
    text, day, r = F.to_json("doc", {"pretty": "true"}), F.dayofmonth("event_date_utc") % 10, F.substring("resource_id", -1, 1)
    other = F.lit('{"help": "h", "success": true, "result": {"resource_id": "region-3", "records": "none"}}')
    broken = F.when((r == "2") & (day == 5), F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int"))).when((r == "1") & (day == 7), "\n").when((r == "0") & (day == 9), "[]").when((r == "3") & (day == 3), other)
    path = F.concat("resource_id", F.lit("/energy_"), F.date_format("event_date_utc", "yyyyMMdd"), F.lit("_12000"), r, F.lit(".json"))
    return docs.select(path.alias("path"), F.coalesce(broken, text).alias("value"))
