"""A corpus from raw documents to token ids, in stages that are each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from catchment.llm import toxicity
from catchment.llm.byte_bpe import encode_bytes
from catchment.llm.exact_dedup import drop_copies
from catchment.llm.jaccard_join import drop_linked
from catchment.llm.mixing import take
from catchment.llm.shared import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more go; rows are judged by their text, whatever their id."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays, that with the least id."""
    return drop_linked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left (little-endian unsigned 32-bit integers), and the digest of the text they decode to."""
    return encode_bytes(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, columns=("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("byte bpe", encode),
]

#: SQL says neither the classifier nor the mix.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/stage{k}")
        docs = spark.read.parquet(f"{path}/stage{k}")
    return docs
