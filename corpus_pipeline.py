"""From raw documents to token ids: filter by quality, drop exact copies, keep one of each group of near copies,
mix the sources to their target weights, encode.

Every stage works on all rows that the one before it kept; its result is written
to the shared folder of ``spark.checkpoint.dir`` and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm import bpe, exact_dedup, mixing, ngram_join, quality
from roadlens.llm.common import staged, table
from roadlens.llm.queries import quality_model

SHINGLE_WORDS, SIMILARITY = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, quality_model(spark, sf_dir))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.dedup(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts with similar sets of five-word shingles stays."""
    return ngram_join.keep_one(docs, SHINGLE_WORDS, SIMILARITY)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the mix of sources takes them."""
    return mixing.mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text; columns of these names are replaced."""
    import public_tokenizers

    coded = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    rest = [c for c in docs.columns if c.lower() not in ("text", "ids", "n_tokens", "decodes")]
    return coded.select(*rest, "ids", F.size("ids").cast("bigint").alias("n_tokens"),
                        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("n-gram Jaccard join", near_dedup_stage),
    ("mixing sources", mixing_stage),
    ("BPE encoding", bpe_stage),
]

# Sampling, fitting and tokenising are not SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
