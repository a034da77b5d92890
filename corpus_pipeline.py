"""The corpus pipeline: quality votes, near duplicates, mixing, tokens.

Each stage takes the session, the documents that its predecessor kept and the
folder of the input tables, and returns a DataFrame; it is written as Parquet
and read again as the next stage's input.  All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm import bpe, mixing, near_dups, quality
from tabkit.session import bound_batches, scratch_path

RANKS = "byte_bpe_50k.tiktoken"


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules keep."""
    bound_batches(spark)
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (five-word shingles, similarity 0.8)."""
    bound_batches(spark)
    return near_dups.keep_one(docs, width=5, threshold=(80, 100))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document's whole text, and whether decoding them
    gives the text back."""
    path = public_tokenizers.path(RANKS)
    ids = bpe.encode(docs.select("doc_id", "source", "text"), path, public_tokenizers.PATTERN)
    hashed = ids.select("doc_id", "source", "ids", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    back = bpe.decode(hashed, path, public_tokenizers.PATTERN)
    return back.select("doc_id", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                       (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))


STAGES = [
    ("quality_votes", reject_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("byte_bpe", tokenize),
]

#: Expectation-maximisation, MinHash components and BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch
    folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
