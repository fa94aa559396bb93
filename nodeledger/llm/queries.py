"""The operators as queries over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nodeledger.llm import bpe, divergence, fingerprint, gridjoin, lexical, minhash, mixing, pii, quality, repetition, suffixes, tokenfiles, toxicity
from nodeledger.llm.sql import SQL, repetition_sql
from nodeledger.llm.store import shared_folder


def tokenizer_file(name: str) -> str:
    """Where the public tokenizer files are installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _named(spans: str):
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(parts, ",")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pii_spans(_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(_named("base").cast("binary"), 256).alias("base_sha256"), _named("spans").alias("spans"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(_table(spark, sf_dir, "documents")).drop("ids")


def encoded_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256): encoded, and decoded again."""
    path = tokenizer_file("byte_bpe_50k.json")
    decoded = bpe.bpe_round_trip(docs, path)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), sha(joined).alias("ids_sha256"), sha(F.col("text")).alias("decoded_sha256"))


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/llm-tokens-{uuid.uuid4().hex}"
    tokenfiles.write_token_files(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), folder, end_id=1)
    read = tokenfiles.read_token_files(spark, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scores.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"), repeats=2.0)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    edits = fingerprint.with_edits(_table(spark, sf_dir, "documents"))
    sha = F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")
    return edits.select("doc_id", "n_chars", sha, "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_bytes")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scores.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gridjoin.embedding_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.95)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffixes.without_repeats(_table(spark, sf_dir, "documents"), length=50)
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf_dir, "documents"), least=30, ranks=50)


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(_table(spark, sf_dir, "documents"))
    return lexical.ranked_search(index, _table(spark, sf_dir, "benchmark"), ranks=10)


def op13_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_pii, op2_bpe, op3_tokens, op4_quality, op5_minhash, op6_mixing, op7_fingerprints, op8_toxicity, op9_embeddings, op10_repeats, op11_divergence, op12_lexical, op13_repetition)
    return {f.__name__: f for f in own} | {"pipeline": _pipeline}


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def oracle_sql() -> dict[str, str]:
    rules = repetition_sql(repetition.NGRAMS, repetition.LINES, repetition.LINE_CHARS, repetition.MANY_SYMBOLS)
    return SQL | {"op13_repetition": rules}
