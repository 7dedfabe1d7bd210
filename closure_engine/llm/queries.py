"""The corpus queries of the driver contract: one thin query an operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .alignment import cross_tokenizer_alignment
from .common import shared_path, table
from .filter_audit import filter_audit
from .jaccard import jaccard_groups
from .lattice import near_duplicate_vectors
from .mixing import mix_sources
from .packing import pack_sequences
from .pii import personal_data
from .quality import quality_rules
from .secrets import secret_scan
from .sharding import shard_documents
from .token_counts import token_counts
from .token_records import read_records, write_records
from .toxicity import toxicity

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_sequences(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokenizer_alignment(table(spark, sf_dir, "documents"), tokenizer_path(), public_tokenizers.path(PIECES))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), shared_path(spark, "token-records")
    write_records(docs, path, tokenizer_path(), end_id=2)
    return read_records(spark, path, with_ids=False).select(
        F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "start", "n_tokens", "ids_crc32")


QUERIES = {
    "op1_jaccard": op1_jaccard,
    "op2_quality": op2_quality,
    "op3_toxicity": op3_toxicity,
    "op4_token_counts": op4_token_counts,
    "op5_mixing": op5_mixing,
    "op6_packing": op6_packing,
    "op7_secrets": op7_secrets,
    "op8_lattice": op8_lattice,
    "op9_pii": op9_pii,
    "op10_sharding": op10_sharding,
    "op11_alignment": op11_alignment,
    "op12_filter_audit": op12_filter_audit,
    "op13_token_records": op13_token_records,
}

ORACLE_SQL: dict[str, str] = {
    "op1_jaccard": oracles.JACCARD,
    "op2_quality": oracles.QUALITY,
    "op8_lattice": oracles.LATTICE,
    "op12_filter_audit": oracles.FILTER_AUDIT,
}
