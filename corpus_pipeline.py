"""A training corpus from raw documents: quality classifier, line dedup, n-gram Jaccard join, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.mixing import mix_sources
from tidemark.llm.ngram_join import ngram_groups
from tidemark.llm.packing import pack
from tidemark.llm.quality_model import quality_scores
from tidemark.llm.shared import row_keys, scratch_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: What numbers the rows of a table that is read from Parquet, as every stage's docs are.
KEYS = ("__file", "__row")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones; repeated rows are judged alike, null and empty texts by the model's bias."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_scores(docs, labels, 2000, 0.3, *COLUMNS).where("predicted = 1").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one; a document that has nothing left goes."""
    out = line_dedup(row_keys(docs), min_chars=20, row=KEYS)
    return out.where("n_removed = 0 OR btrim(text, ' \t\n\r') <> ''").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked rows: the one with the smallest doc_id (nulls last), of those the first row.

    Rows count apart whatever their doc_id; a row without shingles links with nothing and stays.
    """
    docs = row_keys(docs.select(*COLUMNS))
    groups = ngram_groups(docs, percent=80, row=KEYS)
    alone = [F.when(F.col("component").isNull(), F.col(c)).alias(f"alone_{c}") for c in ("file", "row")]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col("file").alias("__file"), F.col("row").alias("__row"))).alias("first")
    kept = groups.groupBy("component", *alone).agg(first).select("first.__file", "first.__row")
    return docs.join(kept, [*KEYS], "left_semi").select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources reach their target shares, in a global shuffle.

    Null sources are a source, null texts have no characters, rows of one doc_id and source get as many copies each.
    """
    return mix_sources(row_keys(docs.select(*COLUMNS)), power=0.5, epochs=1.0, seed=0, row=KEYS).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 token ids; null and empty texts are their end id alone, repeated rows are packed each."""
    return pack(docs, length=1024, end_id=0)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates), ("source mixing", mixing), ("packing", packing)]

#: The stages' models, edit distances and token ids are beyond SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each one's result stored in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_dir(spark).rstrip('/')}/tidemark/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
