"""Token-id files with a minimal perfect hash index.

Layout: a folder with the table `shards` and the small table `manifest`. A shard is one row, and holds the documents
of a range of doc_id in ascending order:

  payload      raw ids, little-endian, 2 or 4 bytes each (width)
  seeds        int32 per index bucket: a displacement, or -slot - 1 where the bucket holds one key
  prints       uint32 per slot: fingerprint of the slot's key
  places       uint32 pairs per slot: first id and number of ids within the payload
  keys         int64 per document in order (the shard's list of documents; nulls as NULL_KEY)
  part, seq    the shard's number; local_start: ids of the part before it

`manifest` has a row for each part: its first id in the whole store, and its lowest and highest key. A key is found in
constant time in a shard: hash to a bucket, seed, slot; the fingerprint tells keys that aren't there.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch, as_batch, bounded_batches, mix, parallelism, slices, slices_of_bytes
from tidemark.llm.tokens import default_vocabulary, encoder

NULL_KEY = -(1 << 63)
BUCKET_KEYS = 3
SHARDS = "part int, seq int, local_start long, n_docs int, n_ids long, width int, low long, high long, seeds binary, prints binary, places binary, keys binary, payload binary"
ENCODED = "doc_id long, tie long, n long, width int, packed binary"
_M64 = (1 << 64) - 1


def _hashes(keys: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    return mix(mix(keys.astype(np.int64).view(np.uint64)) + repeats.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _step(h: int, seed: int) -> int:
    h = (h ^ (seed * 0x9E3779B97F4A7C15 & _M64)) * 0xBF58476D1CE4E5B9 & _M64
    h = (h ^ h >> 29) * 0x94D049BB133111EB & _M64
    return h ^ h >> 32


def build_index(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seeds per bucket, slot per key) of a minimal perfect hash of distinct 64-bit hashes (hash and displace)."""
    n = len(hashes)
    buckets: list[list[int]] = [[] for _ in range(max(1, -(-n // BUCKET_KEYS)))]
    values = hashes.tolist()
    for i, h in enumerate(values):
        buckets[(h >> 32) % len(buckets)].append(i)
    seeds, slots, taken = np.zeros(len(buckets), dtype="<i4"), np.zeros(n, dtype=np.int64), bytearray(n)
    order = sorted(range(len(buckets)), key=lambda b: -len(buckets[b]))
    free = None
    for b in order:
        if len(buckets[b]) > 1:
            seed = 1
            while True:
                got = [_step(values[i], seed) % n for i in buckets[b]]
                if len(set(got)) == len(got) and not any(taken[x] for x in got):
                    break
                seed += 1
        elif buckets[b]:
            free = iter([x for x in range(n) if not taken[x]]) if free is None else free
            got = [next(free)]
            seed = -got[0] - 1
        else:
            continue
        seeds[b] = seed
        for i, x in zip(buckets[b], got, strict=True):
            taken[x], slots[i] = 1, x
    return seeds, slots


def find(h: int, seeds: np.ndarray, prints: np.ndarray) -> int | None:
    """The slot of a hashed key; None if the shard doesn't hold it (up to one in 2**32)."""
    if not len(prints):
        return None
    seed = int(seeds[(h >> 32) % len(seeds)])
    slot = -seed - 1 if seed < 0 else _step(h, seed) % len(prints)
    return slot if int(prints[slot]) == h & 0xFFFFFFFF else None


def _repeats(keys: np.ndarray) -> np.ndarray:
    """How often each key came before, in sorted keys."""
    first = np.concatenate(([True], keys[1:] != keys[:-1]))
    at = np.arange(len(keys))
    return at - np.maximum.accumulate(np.where(first, at, 0))


def _shard(part: int, seq: int, local_start: int, keys: list[int], ids: list[bytes], width: int) -> tuple:
    keys_ = np.array(keys, dtype=np.int64)
    hashes = _hashes(keys_, _repeats(keys_))
    seeds, slots = build_index(hashes)
    counts = np.array([len(x) // width for x in ids], dtype=np.int64)
    prints, places = np.zeros(len(keys), dtype="<u4"), np.zeros((len(keys), 2), dtype="<u4")
    prints[slots] = (hashes & np.uint64(0xFFFFFFFF)).astype("<u4")
    places[slots] = np.stack([np.cumsum(counts) - counts, counts], axis=1)
    return (part, seq, local_start, len(keys), int(counts.sum()), width, keys[0], keys[-1], seeds.tobytes(), prints.tobytes(), places.tobytes(), keys_.tobytes(), b"".join(ids))


def write_store(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 2, shard_ids: int = 1 << 21) -> None:
    """Encode all of docs (doc_id, text), each with end_id appended, and write them in ascending doc_id order to path.

    A null or empty text is its end id alone. Rows that repeat a doc_id follow each other in the order of a text hash
    and have keys (doc_id, 0), (doc_id, 1), ... within a shard; null doc_ids come first. A shard ends after shard_ids
    ids (a longer document is a shard of its own). Columns other than doc_id and text are ignored. Texts are encoded
    where they lie; only compressed ids are shuffled.
    """
    vocabulary = vocabulary or default_vocabulary()
    bounded_batches(docs.sparkSession)

    def encode(batches):
        enc, end = encoder(vocabulary), np.array([end_id], dtype="<u4").tobytes()
        kind = "<u2" if max(enc.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        for whole in batches:
            for batch in slices_of_bytes(whole):
                rows = []
                doc_ids, ties, texts = (c.to_pylist() for c in batch.columns)
                for doc_id, tie, data in zip(doc_ids, ties, enc.encode_many(texts), strict=True):
                    ids = np.frombuffer(data + end, dtype="<u4").astype(kind)
                    rows.append((NULL_KEY if doc_id is None else doc_id, tie, len(ids), ids.itemsize, pa.compress(ids.tobytes(), codec="zstd", asbytes=True)))
                yield as_batch(rows, ENCODED)

    def shards(batches):
        part, seq, local, keys, ids, held, width = TaskContext.get().partitionId(), 0, 0, [], [], 0, 2
        for whole in batches:
            for batch in slices(whole, 64):
                for doc_id, _, n, width, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    data = pa.decompress(packed, n * width, codec="zstd", asbytes=True)
                    if keys and held + n > shard_ids:
                        yield as_batch([_shard(part, seq, local, keys, ids, width)], SHARDS)
                        seq, local, keys, ids, held = seq + 1, local + held, [], [], 0
                    keys.append(doc_id)
                    ids.append(data)
                    held += n
        if keys:
            yield as_batch([_shard(part, seq, local, keys, ids, width)], SHARDS)

    spark = docs.sparkSession
    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    work = Scratch(spark)
    table = work.stored(frame.mapInArrow(encode, ENCODED), "token-store-ids")
    parts = max(parallelism(spark), -(-(table.agg(F.sum("n")).first()[0] or 0) // (8 * shard_ids)))
    ordered = table.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.mapInArrow(shards, SHARDS).write.option("compression", "zstd").parquet(f"{path}/shards")
    work.release()
    read = spark.read.parquet(f"{path}/shards").groupBy("part").agg(F.sum("n_ids"), F.min("low"), F.max("high"))
    totals = sorted(read.collect())  # one row a part
    base = accumulate([0, *(t[1] for t in totals)])
    rows = [(t[0], b, t[2], t[3]) for t, b in zip(totals, base, strict=False)]
    spark.createDataFrame(rows, "part int, base long, low long, high long").coalesce(1).write.parquet(f"{path}/manifest")


def _bases(spark: SparkSession, path: str) -> dict[int, int]:
    return {r["part"]: r["base"] for r in spark.read.parquet(f"{path}/manifest").collect()}


def _parsed(row: dict) -> tuple:
    seeds, prints = np.frombuffer(row["seeds"], dtype="<i4"), np.frombuffer(row["prints"], dtype="<u4")
    return seeds, prints, np.frombuffer(row["places"], dtype="<u4").reshape(-1, 2), np.frombuffer(row["payload"], dtype=f"<u{row['width']}")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, each fetched from its shard by its key through the index."""
    bases, schema = _bases(spark, path), "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches):
        for whole in batches:
            for batch in slices(whole, 1):
                row = batch.to_pylist()[0]
                seeds, prints, places, payload = _parsed(row)
                keys, first = np.frombuffer(row["keys"], dtype=np.int64), bases[row["part"]] + row["local_start"]
                rows = []
                for key, h in zip(keys.tolist(), _hashes(keys, _repeats(keys)).tolist(), strict=True):
                    at, n = places[find(h, seeds, prints)].tolist()
                    rows.append((None if key == NULL_KEY else key, first + at, n, zlib.crc32(payload[at : at + n].astype("<u4").tobytes())))
                yield as_batch(rows, schema)

    return spark.read.schema(SHARDS).parquet(f"{path}/shards").mapInArrow(run, schema)


def lookup(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """doc_id, start, ids (array of int) of the wanted (doc_id) documents that the store holds; a repeated doc_id gives each.

    A binary search over the manifest gives each key its parts. Only the shards of those parts are read, and those whose
    range holds a key meet it by a join on the part; then one probe of the index finds each key.
    """
    manifest = sorted((r.low, r.high, r.part, r.base) for r in spark.read.parquet(f"{path}/manifest").collect())  # one row a part
    bases, schema = {part: base for *_, part, base in manifest}, "doc_id long, start long, ids array<int>"
    # Parts lie in ascending order, and neighbours share a key only where its rows are split among them.
    lows, highs, parts = [m[0] for m in manifest], [m[1] for m in manifest], [m[2] for m in manifest]

    def placed(batches):
        for batch in batches:
            found = [(key, part) for key in batch.column(0).to_pylist() for part in parts[bisect_left(highs, key) : bisect_right(lows, key)]]
            if found:
                yield as_batch(found, "key long, part int")

    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY))
    work = Scratch(spark)
    asked = work.stored(wanted.select(key.alias("key")).distinct().mapInArrow(placed, "key long, part int"), "token-store-asked")
    named = sorted(r.part for r in asked.select("part").distinct().collect())  # at most one row a part
    table = spark.read.schema(SHARDS).parquet(f"{path}/shards").where(F.col("part").isin(named))
    ranges = table.select("part", "seq", "low", "high")
    grouped = asked.join(ranges, "part").where("key BETWEEN low AND high").groupBy("part", "seq").agg(F.collect_set("key").alias("asked"))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, 1):
                row = batch.to_pylist()[0]
                seeds, prints, places, payload = _parsed(row)
                rows = []
                for key in row["asked"]:
                    repeat = 0
                    while (slot := find(int(_hashes(np.array([key]), np.array([repeat]))[0]), seeds, prints)) is not None:
                        at, n = places[slot].tolist()
                        rows.append((None if key == NULL_KEY else key, bases[row["part"]] + row["local_start"] + at, payload[at : at + n].astype(np.int32)))
                        repeat += 1
                yield as_batch(rows, schema)

    return table.join(grouped, ["part", "seq"]).mapInArrow(run, schema)
