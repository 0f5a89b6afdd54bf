"""Raw JSON captures: scans with fixed schemas, and landing."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import RAW_ENERGY, RAW_WEATHER

RAW_SCHEMAS = {"weather": RAW_WEATHER, "energy": RAW_ENERGY}


def read_captures(spark: SparkSession, path: str | list[str], dataset: str) -> DataFrame:
    """One row a capture (a pretty-printed JSON document), with its file name in source_file.

    A file that doesn't parse is a row with its text in _corrupt, and doesn't hurt the others. Fields that no capture has
    are null. Directories are read with all their sub-directories.
    """
    frame = spark.read.schema(RAW_SCHEMAS[dataset]).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    return frame.select("*", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_modification_time").alias("modified"))


def scan_captures(spark: SparkSession, path: str | list[str], dataset: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Read captures once, and split what parses from what doesn't: (good, bad), both stored below out, a folder for tables.

    good is as read_captures has it, without its unreadable rows. bad has a row a file that can't be used: source_file,
    modified, error, and the text as it was found, for a later try. Errors: a blank file (Spark's scans pass over files of no
    bytes), a text that isn't JSON, a JSON value that isn't an object, an object whose fields have other types than the
    schema (top-level ones are named). What follows a whole JSON value is passed over, as
    Spark's reader does. A file is one row, so it is as large as a task's memory allows.
    """
    kind = RAW_SCHEMAS[dataset]
    fields = StructType.fromDDL(kind)
    text = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    text = text.select(F.col("value").alias("text"), F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_modification_time").alias("modified"))
    row = F.from_json("text", kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    parsed = text.withColumns({"doc": row, "json": F.try_parse_json("text")})
    # A field that is there and not null, but came out as null, has another type.
    there = {f.name: F.coalesce(F.schema_of_variant(F.try_variant_get("json", f"$['{f.name}']", "variant")) != "VOID", F.lit(False)) for f in fields if f.name != "_corrupt"}
    wrong = F.array_compact(F.array(*[F.when(there[f] & F.col("doc")[f].isNull(), F.lit(f)) for f in there]))
    object_ = F.schema_of_variant("json").rlike("^(OBJECT|STRUCT)<")
    error = (
        F.when(F.trim(F.regexp_replace("text", r"\s+", " ")) == "", "is empty")
        .when(F.col("json").isNull(), "is not JSON")
        .when(~object_, "is not an object")
        .when(F.col("doc._corrupt").isNotNull(), F.concat(F.lit("has fields of other types: "), F.when(F.size(wrong) > 0, F.array_join(wrong, ", ")).otherwise("within objects or arrays")))
    )
    parsed = parsed.withColumn("error", error).select("source_file", "modified", "doc", "error", F.when(F.col("error").isNotNull(), F.col("text")).alias("text"), F.col("error").isNull().alias("readable"))
    parsed.write.partitionBy("readable").parquet(out)
    both = spark.read.schema(parsed.schema).parquet(out)
    return both.where("readable").select("doc.*", "source_file", "modified"), both.where("NOT readable").select("source_file", "modified", "error", "text")


def with_file_times(silver: DataFrame, raw: DataFrame) -> DataFrame:
    """silver with the file's modification time where the file name had none."""
    times = raw.select("source_file", F.col("modified")).groupBy("source_file").agg(F.max("modified").alias("modified"))
    out = silver.join(times, "source_file", "left").withColumn("ingestion_timestamp_utc", F.coalesce("ingestion_timestamp_utc", "modified"))
    return out.select(*silver.columns)


def _create(path: str, text: str) -> None:
    """Write a new file. A path with a scheme goes to that file system, with the active session's settings."""
    if "://" not in path:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        with open(path, "x", encoding="utf-8") as f:
            f.write(text)
        return
    spark = SparkSession.active()
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if files.exists(target):
        raise FileExistsError(path)
    out = files.create(target, False)
    out.write(bytearray(text, "utf-8"))
    out.close()


def land_captures(captures: DataFrame, root: str) -> None:
    """Write many captures at once: the text in `value` to <root>/<path>, a row a file, by the tasks that hold them.

    root is a local folder or a URI that pyarrow knows, which all executors share. Paths are one row's each; a task that
    runs again writes the same files again.
    """
    uri = root if "://" in root else f"file://{root.removeprefix('file:')}"

    def write(rows):
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(uri)
        for r in rows:
            path = f"{base.rstrip('/')}/{r['path']}"
            files.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with files.open_output_stream(path) as f:
                f.write((r["value"] or "").encode())

    captures.select("path", "value").foreachPartition(write)


def land_capture(root: str, dataset: str, payload: dict, now: datetime | None = None, dated: bool = True) -> str:
    """Write one payload to <root>/raw/<dataset>/ingestion_date=.../<dataset>_<time>.json (without the date folder if not dated).

    root is a local folder or the URI of one on any file system that Spark reads. An existing capture is never replaced: a
    second one in the same second is an error.
    """
    now = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
    folder = [f"ingestion_date={now:%Y-%m-%d}"] if dated else []
    path = "/".join([root.rstrip("/"), "raw", dataset, *folder, f"{dataset}_{now:%Y%m%d_%H%M%S}.json"])
    _create(path, json.dumps(payload, indent=2))
    return path
