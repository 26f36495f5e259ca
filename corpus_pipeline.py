"""The corpus pipeline: five operators in a row, from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the caller may write it and read it back as the
next one's docs. All stages but the last return the columns of documents. Nulls, empty texts, ties, repeated rows
and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.llm import bpe, cotrain, mixing, simhash, toxicity
from rankwell.llm.common import materialize


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity stays below the threshold."""
    return toxicity.reject_toxic(docs, _labels(spark, sf_dir))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the combined views of the quality classifier accept."""
    return cotrain.reject_poor(docs, _labels(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: the one with the least doc_id, one row of it where rows are repeated.

    Rows without a doc_id name no document and stay as they are.
    """
    columns = docs.columns
    named = docs.filter(F.col("doc_id").isNotNull())
    classes = simhash.near_duplicates(named.select("doc_id", "text"))
    kept = classes.filter(F.col("doc_id") == F.col("component")).select(F.col("doc_id").alias("__kept")).distinct()
    single = named.join(kept, F.col("doc_id") == F.col("__kept"), "left_semi").dropDuplicates(["doc_id"])
    return single.select(*columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row of the mix, encoded and decoded."""
    return bpe.op6_byte_bpe(spark, docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: SQL expresses none of these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written to the shared folder before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for _, stage in first:
        docs = materialize(stage(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)
