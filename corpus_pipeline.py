"""Documents to packed training sequences, in five stages.

Each stage reads what the one before it kept and is written before the next one starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import decontam, langid, neardup, packing, pii
from larder.llm.common import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language: those without letters or anything known go.

    The model learns from the given rows.
    """
    found = langid.identify(docs, langid.fit(docs), into="_language")
    sure = (F.col("_language.lang") != langid.UNKNOWN) & (F.col("_language.score") > 0)
    return found.filter(sure).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one with the smallest id, of every group of near copies."""
    kept = neardup.near_duplicates(docs).filter("kept").select("doc_id").distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind and sets n_chars anew; all documents stay."""
    return pii.mask(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 2048 tokens."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

# Learned models, sketches and a tokenizer are outside SQL; tests check every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
