"""From raw documents to token ids in five stages, each written and read again.

Quality filter, near-duplicate removal, redaction of personal data, mixing of sources, BPE.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nodeledger.llm import minhash, mixing, pii, quality
from nodeledger.llm.queries import encoded_digests
from nodeledger.llm.store import shared_folder


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates: five words, similarity 0.8 or more."""
    return minhash.keep_one(docs, words=5, percent=80)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; ``n_chars`` follows the text."""
    hidden = pii.redacted(docs)
    return hidden.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed by temperature: every document at least once, small sources up to twice."""
    return mixing.mixed_documents(docs, repeats=2.0)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each copy, and digests of the ids and of the text decoded from them."""
    return encoded_digests(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("personal_data", without_personal_data),
    ("mixing", mixed),
    ("bpe", tokens),
]

#: The classifier, MinHash and the network have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is Parquet in the shared folder."""
    folder = f"{shared_folder(spark)}/llm-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
