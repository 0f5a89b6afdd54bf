"""Packing by concatenating and cutting: all documents' ids form one stream, cut into windows of fixed length.

Pass 1 encodes each document where it lies, with its place within its partition, and stores the ids. The partitions'
totals (one number a partition) give each partition's place in the stream by a prefix sum. Pass 2 cuts each document
at the window bounds that fall into it: one boundary record, a piece, for each window that it touches. Nothing is
shuffled, and only the last window can be short.
"""

from __future__ import annotations

import zlib
from itertools import accumulate

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import as_batch, bounded_batches, slices, slices_of_bytes, stored
from tidemark.llm.tokens import default_vocabulary, encoder

ENCODED = "part int, place long, doc_id long, n long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Rows that a task hands on at once.
ROWS = 128


def encoded_documents(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """part, place (ids of the partition before it), doc_id, n, ids (unsigned 16- or 32-bit), stored in the shared folder."""

    def run(batches):
        enc, part, place, end = encoder(vocabulary), TaskContext.get().partitionId(), 0, np.array([end_id], dtype="<u4").tobytes()
        kind = "<u2" if max(enc.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        for whole in batches:
            for batch in slices_of_bytes(whole):
                rows = []
                doc_ids, texts = (c.to_pylist() for c in batch.columns)
                for doc_id, data in zip(doc_ids, enc.encode_many(texts), strict=True):
                    ids = np.frombuffer(data + end, dtype="<u4")
                    rows.append((part, place, doc_id, len(ids), ids.astype(kind).tobytes()))
                    place += len(ids)
                yield as_batch(rows, ENCODED)

    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(frame.mapInArrow(run, ENCODED), "packing-ids")


def pack(docs: DataFrame, vocabulary: str | None = None, length: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids (array) on request.

    A null or empty text is its end id alone. Rows that repeat a doc_id are packed each on its own; a null doc_id stays
    null. The stream's order is that of the table's partitions. Columns other than doc_id and text are ignored. An
    empty table has no pieces. Very long documents are cut into as many pieces as they need.
    """
    bounded_batches(docs.sparkSession)
    table = encoded_documents(docs, vocabulary or default_vocabulary(), end_id)
    totals = sorted(table.groupBy("part").agg(F.sum("n")).collect())  # one row a partition
    before = dict(zip([t[0] for t in totals], accumulate([0, *(t[1] for t in totals)]), strict=False))

    def cut(batches):
        for whole in batches:
            for batch in slices(whole, ROWS):
                rows = []
                for part, place, doc_id, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    ids = np.frombuffer(data, dtype="<u2" if len(data) == 2 * n else "<u4").astype("<u4")
                    at, start = before[part] + place, 0
                    while start < n:
                        size = min(n - start, length - (at + start) % length)
                        piece = ids[start : start + size]
                        row = (doc_id, start, size, zlib.crc32(piece.tobytes()), n, (at + start) // length, (at + start) % length)
                        rows.append((*row, piece.astype(np.int32)) if with_ids else row)
                        start += size
                yield as_batch(rows, schema)

    schema = PIECES + ", ids array<int>" * with_ids
    return table.mapInArrow(cut, schema)


def sequences(pieces: DataFrame, length: int = 1024, pad_id: int = 0) -> DataFrame:
    """sequence_id, ids (padded to length), n_ids and the doc_ids of each sequence, from pack(..., with_ids=True)."""
    parts = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("parts"))
    ids = F.flatten(F.col("parts.ids"))
    return parts.select("sequence_id", F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(length) - F.size(ids))).alias("ids"), F.size(ids).alias("n_ids"), F.col("parts.doc_id").alias("doc_ids"))
