"""The corpus pipeline: quality rules, near-copy removal, secret scans, mixing, packing.

Every stage works on all that its predecessor kept and returns the columns of
``documents``, the last one the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closure_engine.llm.common import written
from closure_engine.llm.jaccard import jaccard_groups, one_of_each_group
from closure_engine.llm.mixing import mix_sources, take_copies
from closure_engine.llm.packing import pack_sequences
from closure_engine.llm.quality import quality_rules
from closure_engine.llm.queries import tokenizer_path
from closure_engine.llm.secrets import redact_secrets

#: SQL can't express the rounding, the scans' model and the tokens; tests compare with a plain version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    return quality_rules(docs, keep=True)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the smallest id."""
    return one_of_each_group(docs, jaccard_groups(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by their kinds."""
    return redact_secrets(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes every document as often as the mix does."""
    return take_copies(docs, mix_sources(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return pack_sequences(docs, tokenizer_path())


STAGES = [("quality rules", quality), ("near copies", near_copies), ("secret scans", secrets), ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
