"""Captures as a stream: typed energy rows, hourly rollups with late data, and a table kept current by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.silver import latest_by_key, typed_energy
from tidemark.schemas import ENERGY_KEY, RAW_ENERGY


def stream_captures(spark: SparkSession, path: str, schema: str = RAW_ENERGY) -> DataFrame:
    """A streaming scan of JSON captures as they land under path, with their file name in source_file."""
    frame = spark.readStream.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", True).json(path)
    return frame.select("*", F.col("_metadata.file_name").alias("source_file"))


def energy_stream(spark: SparkSession, path: str) -> DataFrame:
    return typed_energy(stream_captures(spark, path))


def hourly_demand_stream(energy: DataFrame, late: str = "6 hours") -> DataFrame:
    """Hourly demand by resource with a watermark: rows later than `late` are left out, windows close as it passes them.

    State is one small row a resource and open hour.
    """
    hour = F.window("event_timestamp_utc", "1 hour")
    demand = F.col("demand_mw")
    rolled = energy.where("demand_mw IS NOT NULL").withWatermark("event_timestamp_utc", late).groupBy(hour.alias("w"), "resource_id").agg(F.count("*").alias("sample_count"), F.avg(demand).alias("demand_avg_mw"), F.min(demand).alias("demand_min_mw"), F.max(demand).alias("demand_max_mw"))
    return rolled.select(F.col("w.start").alias("bucket_start_utc"), F.col("w.end").alias("bucket_end_utc"), "resource_id", "sample_count", "demand_avg_mw", "demand_min_mw", "demand_max_mw")


def keep_current(energy: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch's latest rows by key, appended under path by date; read_current gives the table. Runs what is there, then stops."""

    def write(batch: DataFrame, _: int) -> None:
        latest_by_key(batch, ENERGY_KEY).write.mode("append").partitionBy("event_date_utc").parquet(path)

    return energy.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The latest row of every key that keep_current has written."""
    return latest_by_key(spark.read.parquet(path), ENERGY_KEY)
