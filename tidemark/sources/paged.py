"""A feed as a Python data source: its records, page by page, each page a partition that a task fetches.

    register_paged(spark, get)
    spark.read.format("paged_feed").option("url", ...).option("page_size", 1000).load()

The contract is checked page by page before any of its records count. The schema is that of the feed's records.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructType

from tidemark.schemas import RAW_ENERGY
from tidemark.sources.contracts import CONTRACTS
from tidemark.sources.feeds import Feed, Get, checked

FORMAT = "paged_feed"


def records_schema(raw: str = RAW_ENERGY) -> StructType:
    """resource_id, page_offset, and the fields of one record of a raw capture."""
    record = StructType.fromDDL(raw)["result"].dataType["records"].dataType.elementType
    return StructType().add("resource_id", StringType()).add("page_offset", LongType()).add("record", record)


@dataclass
class Page(InputPartition):
    """The records from offset on, limit of them at most."""

    offset: int
    limit: int


class PagedReader(DataSourceReader):
    """Asks for one record to learn the total, then has a page a partition. A task that runs again fetches its page again."""

    def __init__(self, feed: Feed, get: Get, page_size: int, env: dict[str, str] | None, schema: StructType):
        self.feed, self.get, self.page_size, self.env, self.schema = feed, get, page_size, env, schema

    def _page(self, offset: int, limit: int) -> dict:
        feed = Feed(**(self.feed.__dict__ | {"params": dict(self.feed.params) | {"offset": offset, "limit": limit}}))
        return checked(feed, self.get, self.env, CONTRACTS[feed.dataset])["result"]

    def partitions(self) -> list[Page]:
        total = self._page(0, 1)["total"]
        return [Page(at, self.page_size) for at in range(0, total, self.page_size)]

    def read(self, partition: Page | None) -> Iterator[tuple]:
        if partition is None:  # Spark reads a source without partitions once
            return
        got = self._page(partition.offset, partition.limit)
        if len(got["records"]) > partition.limit:
            raise OSError(f"{self.feed.dataset}: a page of {partition.limit} records came with {len(got['records'])}")
        record = self.schema["record"].dataType
        kinds = {f.name: f.dataType.typeName() for f in record.fields}
        for r in got["records"]:
            yield got["resource_id"], partition.offset, tuple(_as(kinds[f.name], r.get(f.name)) for f in record.fields)


def _as(kind: str, value):
    """value as a column's type has it; null where it has another."""
    if kind == "double":
        return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None
    if kind == "long":
        return int(value) if isinstance(value, (int, float)) and not isinstance(value, bool) and float(value).is_integer() else None
    return value if isinstance(value, str) or value is None else json.dumps(value)


def paged_source(get: Get, env: dict[str, str] | None = None) -> type[DataSource]:
    """The data source that fetches through get(url, params, headers, timeout), which travels to the tasks.

    Options: url, params (a JSON object), page_size (1000), timeout (30), key_header with key_env, or key_param with
    key_env. env holds the secrets; without one each process reads its own environment.
    """

    made = records_schema()  # here, as it takes a session, which the processes that plan and read haven't

    class PagedFeed(DataSource):
        @classmethod
        def name(cls) -> str:
            return FORMAT

        def schema(self) -> StructType:
            return made

        def reader(self, schema: StructType) -> PagedReader:
            o = self.options
            size = int(o.get("page_size", 1000))
            if size < 1:
                raise ValueError("page_size must be at least 1")
            feed = Feed("energy", o["url"], json.loads(o.get("params", "{}")), int(o.get("timeout", 30)), o.get("key_header"), o.get("key_env"), o.get("key_param"))
            return PagedReader(feed, get, size, env, schema)

    return PagedFeed


def register_paged(spark: SparkSession, get: Get, env: dict[str, str] | None = None) -> None:
    spark.dataSource.register(paged_source(get, env))
