"""Table sinks. The format is a parameter; Parquet is the default.

A table of a format without its own versions (any but Delta) is replaced as one change: replace_table writes a new version
beside the present one, as a managed table `<name>__v_<hex>`, and only then points `<name>`, an external table, to its files.
Until that moment readers get the old rows, a failed or killed write leaves the table as it was, and the frame that is
written may read the very table that it replaces.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: Stored type, and the types that go into it without loss.
LOSSLESS = {
    "smallint": {"tinyint"},
    "int": {"tinyint", "smallint"},
    "bigint": {"tinyint", "smallint", "int"},
    "double": {"float", "tinyint", "smallint", "int"},
    "timestamp": {"date"},
}
#: A catalog that keeps no list of partitions finds them in the table's folder, so that a new folder is a new table.
_LISTED = "spark.sql.hive.manageFilesourcePartitions"


class SchemaConflict(ValueError):
    """Rows can't be stored in a table as it is."""


def _parts(spark: SparkSession, name: str) -> tuple[str, str]:
    """Database and table of a name with or without a database."""
    database, _, table = name.replace("`", "").rpartition(".")
    return database or spark.catalog.currentDatabase(), table


def _quoted(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}  # a row a property


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _ddl(fields: list[StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


@contextmanager
def _unlisted_partitions(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_LISTED, None)
    spark.conf.set(_LISTED, "false")
    try:
        yield
    finally:
        spark.conf.unset(_LISTED) if before is None else spark.conf.set(_LISTED, before)


def _point(spark: SparkSession, name: str, version: str, partitions: list[str], fmt: str) -> None:
    """Create the external table name over the files of version."""
    by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partitions)})" if partitions else ""
    where = _described(spark, version)["Location"].replace("'", "\\'")
    with _unlisted_partitions(spark):
        spark.sql(f"CREATE TABLE {name} ({_ddl(spark.table(version).schema.fields)}) USING {fmt} {by} LOCATION '{where}'")


def _grows_into(old: StructType, new: StructType, partitions: list[str]) -> list[StructField] | None:
    """The columns to add so that old becomes new, which only adds some at its end; None if it does more."""
    plain = lambda s: [(f.name, f.dataType) for f in s.fields if f.name not in partitions]
    tail = lambda s: [(f.name, f.dataType) for f in s.fields if f.name in partitions]
    kept = plain(old)
    if plain(new)[: len(kept)] != kept or tail(old) != tail(new):
        return None
    return [StructField(n, t) for n, t in plain(new)[len(kept) :]]


def _switch(spark: SparkSession, database: str, table: str, version: str, partitions: list[str], fmt: str) -> None:
    """Let the table have the rows of version. Its location is the last thing to change, in one statement.

    Where columns go or change their types or order, or the table isn't one of these (made by saveAsTable, or with other
    partitions), no statement can change it in place: a new one takes its name by two renames. A failure between them is
    mended by the next call.
    """
    name, old, new = (_quoted(database, t) for t in (table, f"{table}__old", f"{table}__new"))
    if not spark.catalog.tableExists(name):
        return _point(spark, name, version, partitions, fmt)
    facts = _described(spark, name)
    ours = facts.get("Type") == "EXTERNAL" and f"/{table.lower()}__v_" in facts["Location"].lower() and facts.get("Provider", "").lower() == fmt.lower()
    added = _grows_into(spark.table(name).schema, spark.table(version).schema, partitions) if ours and _partitions(spark, name) == partitions else None
    if added is None:
        _point(spark, new, version, partitions, fmt)
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
        spark.sql(f"DROP TABLE {old}")
        return None
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(added)})")  # null in the rows that are there yet
    where = _described(spark, version)["Location"].replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{where}'")
    return None


def _mend(spark: SparkSession, database: str, table: str) -> None:
    """Undo what a killed switch by renames left."""
    name, old, new = (_quoted(database, t) for t in (table, f"{table}__old", f"{table}__new"))
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(old):
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
    for t in (old, new):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def _versions(spark: SparkSession, database: str, table: str) -> list[str]:
    return [_quoted(database, t.name) for t in spark.catalog.listTables(f"`{database}`", f"{table}__v_*")]


def _observed(df: DataFrame, counted: Observation | None) -> DataFrame:
    return df if counted is None else df.observe(counted, F.count(F.lit(1)).alias("rows"))


def replace_table(df: DataFrame, name: str, partition_by: str | None = None, fmt: str = "parquet", counted: Observation | None = None) -> DataFrame:
    """Create or replace a table, its schema too, and return it as read back. counted gets the number of rows, as `rows`.

    The new rows are whole before they show, see above; df may read the table. The version before goes once the new one
    shows, so a query that is still reading it fails and has to be run again. One writer at a time may replace a table.
    """
    spark, df = df.sparkSession, _observed(df, counted)
    partitions = [partition_by] if partition_by else []
    if fmt.lower() == "delta":
        df.write.format(fmt).mode("overwrite").option("overwriteSchema", True).partitionBy(*partitions).saveAsTable(name)
        return spark.table(name)
    database, table = _parts(spark, name)
    _mend(spark, database, table)
    version = _quoted(database, f"{table}__v_{uuid.uuid4().hex}")
    try:
        df.write.format(fmt).partitionBy(*partitions).saveAsTable(version)
        _switch(spark, database, table, version, partitions, fmt)
    except BaseException:
        _mend(spark, database, table)
        there = _quoted(database, table)
        shown = spark.catalog.tableExists(there) and _described(spark, there).get("Location") == (_described(spark, version).get("Location") if spark.catalog.tableExists(version) else None)
        if not shown:
            spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    for other in _versions(spark, database, table):
        if other.lower() != version.lower():  # a catalog may fold case
            spark.sql(f"DROP TABLE {other}")
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table that replace_table made, with its files."""
    database, table = _parts(spark, name)
    for t in (_quoted(database, table), *_versions(spark, database, table)):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def _fits(stored: DataType, given: DataType) -> bool:
    a, b = stored.simpleString(), given.simpleString()
    return a == b or b == "void" or b in LOSSLESS.get(a, ())


def schema_growth(stored: StructType, given: StructType, case_sensitive: bool = False) -> list[StructField]:
    """The columns of given that stored lacks. SchemaConflict if one that both have doesn't fit, or a new one has no type."""
    key = (lambda n: n) if case_sensitive else str.lower
    known = {key(f.name): f for f in stored.fields}
    wrong = [f"{f.name} is {known[key(f.name)].dataType.simpleString()}, not {f.dataType.simpleString()}" for f in given.fields if key(f.name) in known and not _fits(known[key(f.name)].dataType, f.dataType)]
    added = [f for f in given.fields if key(f.name) not in known]
    wrong += [f"{f.name} is new and has no type" for f in added if f.dataType.simpleString() == "void"]
    if wrong:
        raise SchemaConflict("rows don't fit the table: " + "; ".join(wrong))
    return added


def append_table(df: DataFrame, name: str, partition_by: str | None = None, fmt: str = "parquet", counted: Observation | None = None) -> DataFrame:
    """Append df to a table by column name, and return the table. counted gets the number of rows, as `rows`.

    Columns that the table lacks are added to it first, at its end, and are null in its old rows; columns that df lacks are
    null in the new ones. Types must be the stored ones or go into them without loss (LOSSLESS); anything else, also a
    struct with other fields, is a SchemaConflict, and nothing is changed. A table that isn't there is made.
    """
    spark, df = df.sparkSession, _observed(df, counted)
    partitions = [partition_by] if partition_by else []
    if fmt.lower() == "delta" or not spark.catalog.tableExists(name):
        df.write.format(fmt).mode("append").option("mergeSchema", True).partitionBy(*partitions).saveAsTable(name)
        return spark.table(name)
    case = spark.conf.get("spark.sql.caseSensitive") == "true"
    added = schema_growth(spark.table(name).schema, df.schema, case)
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(added)})")
    given = {c if case else c.lower(): c for c in df.columns}
    one = lambda f: F.col(f"`{given[k]}`") if (k := f.name if case else f.name.lower()) in given else F.lit(None)
    df.select(*[one(f).cast(f.dataType).alias(f.name) for f in spark.table(name).schema.fields]).write.insertInto(name)
    return spark.table(name)


def append_by_date(df: DataFrame, path: str, date: str = "event_date_utc") -> bool:
    """Append df as Parquet under dt=<date>; an empty frame writes nothing. Says whether it wrote."""
    if df.isEmpty():
        return False
    df.withColumn("dt", F.date_format(date, "yyyy-MM-dd")).write.mode("append").partitionBy("dt").parquet(path)
    return True


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
