"""Scratch tables, text-to-hash kernels and other helpers that several operators share."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
#: Bytes that separate words: space and \t \n \v \f \r.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes handled at once; longer texts are cut between words.
PIECE = 1 << 18


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share. A session without one gets a folder of this machine only if it runs on it alone."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder or "/tmp/checkpoints"


class Scratch:
    """The tables of one call in the shared folder, which cut the lineage; those that its result doesn't read are removed."""

    def __init__(self, spark: SparkSession):
        self.spark, self.tables = spark, []

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """Write df as a table and read it back."""
        path = f"{scratch_dir(self.spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((out, path))
        return out

    def release(self, *kept: DataFrame) -> None:
        """Remove all tables but kept. Spark's cleaner removes the shuffles that nothing refers to any more in its own time."""
        jvm, gone = self.spark.sparkContext._jvm, [path for df, path in self.tables if not any(df is k for k in kept)]
        self.tables = [x for x in self.tables if x[1] not in gone]
        for path in gone:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table that stays."""
    return Scratch(df.sparkSession).stored(df, name)


def row_keys(table: DataFrame) -> DataFrame:
    """table, which is read straight from Parquet files, with __file and __row (long): the hash of a row's file, and its place there.

    They are the same in every scan, however it is split. A frame that isn't such a read needs numbers of its own.
    """
    return table.select("*", F.xxhash64("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold at most 1,024 rows, unless the session has set a number of its own: texts can be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1024")


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1
_COEF = mix(np.arange(1000, 1000 + SHINGLE_WORDS, dtype=np.uint64)) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse mod 2**64, at least n of each."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 2 * PIECE)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[key] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def word_hashes(data: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and first byte of every run of non-space bytes."""
    if lower:
        data = _LOWER[data]
    inside = np.concatenate(([False], ~_SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, end = edges[::2], edges[1::2]
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[first]) * down[first]), first


def _pieces(text: bytes) -> Iterator[bytes]:
    """Parts of at most PIECE bytes, cut before a space (longer only where one word is)."""
    at = 0
    while len(text) - at > PIECE:
        cut = next((i for i in range(at + PIECE, at, -1) if _SPACE[text[i]]), None)
        if cut is None:
            cut = next((i for i in range(at + PIECE, len(text)) if _SPACE[text[i]]), len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def batches(texts: list[bytes]) -> Iterator[list[int]]:
    """Positions of texts that together have about PIECE bytes."""
    now, size = [], 0
    for i, t in enumerate(texts):
        if now and size + len(t) > PIECE:
            yield now
            now, size = [], 0
        now.append(i)
        size += len(t) + 1
    if now:
        yield now


def words_of(texts: list[bytes], lower: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """(position, word hashes) of each text, in order."""
    for group in batches(texts):
        if len(group) == 1 and len(texts[group[0]]) > PIECE:
            yield group[0], np.concatenate([word_hashes(np.frombuffer(p, dtype=np.uint8), lower)[0] for p in _pieces(texts[group[0]])])
            continue
        joined = b" ".join(texts[i] for i in group)
        hashes, first = word_hashes(np.frombuffer(joined, dtype=np.uint8), lower)
        ends = np.cumsum([len(texts[i]) + 1 for i in group])
        cuts = np.searchsorted(first, ends)
        for i, a, b in zip(group, np.concatenate(([0], cuts[:-1])), cuts, strict=True):
            yield i, hashes[a:b]


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the runs of SHINGLE_WORDS words; a shorter text is one shingle, an empty one has none."""
    n = len(words)
    if n == 0:
        return words
    if n < SHINGLE_WORDS:
        return mix(np.sum(words * _COEF[:n], keepdims=True) + np.uint64(n))
    m = n - SHINGLE_WORDS + 1
    total = words[:m] * _COEF[0]
    for k in range(1, SHINGLE_WORDS):
        total += words[k : k + m] * _COEF[k]
    return np.unique(mix(total))


def encoded(texts) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


#: Counters of an array that travel together.
SLICE = 1 << 15


def array_slices(own: np.ndarray) -> list[tuple[int, bytes]]:
    """(slice, data) of each SLICE counters of an array, packed."""
    return [(k, zlib.compress(own[a : a + SLICE].tobytes(), 1)) for k, a in enumerate(range(0, len(own), SLICE))]


def merged_slices(parts: DataFrame, size: int, dtype, combine: Callable, finish: Callable = np.asarray, made=None) -> np.ndarray:
    """One array of size counters from the slices (slice int, data binary) of many, merged by combine (a ufunc).

    size is a bound that doesn't depend on the data. Slices are merged apart, and only the result reaches the driver,
    after finish, which gives the type made (else dtype).
    """
    step, made = min(size, SLICE), made or dtype

    def merge(key, pdf):
        total = np.zeros(step, dtype=dtype)
        for data in pdf["data"]:
            total = combine(total, np.frombuffer(zlib.decompress(data), dtype=dtype))
        return pd.DataFrame({"slice": [key[0]], "data": [zlib.compress(finish(total).astype(made).tobytes(), 1)]})

    out = np.zeros(size, dtype=made)
    for r in parts.groupBy("slice").applyInPandas(merge, "slice int, data binary").collect():  # size counters at most
        out[r["slice"] * step : (r["slice"] + 1) * step] = np.frombuffer(zlib.decompress(bytes(r["data"])), dtype=made)
    return out


def merged_array(df: DataFrame, fill: Callable, size: int, dtype, combine: Callable) -> np.ndarray:
    """One array of size counters from all of df: fill makes a task's own from its frames, combine merges them."""

    def part(frames):
        yield pd.DataFrame(array_slices(fill(frames)), columns=["slice", "data"])

    return merged_slices(df.mapInPandas(part, "slice int, data binary"), size, dtype, combine)


_ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}


def as_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """rows as a record batch of a schema such as "doc_id long, text string"; integers keep their nulls."""
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, type=_ARROW[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def slices_of_bytes(batch: pa.RecordBatch, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about size bytes where its rows are alike."""
    yield from slices(batch, max(16, size * batch.num_rows // max(1, batch.nbytes)))
