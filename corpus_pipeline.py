"""The corpus pipeline: language ID, exact and near duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import small_batches
from ledgerloom.llm.exact_dedup import drop_exact_duplicates
from ledgerloom.llm.language_id import declared_code, keep_identified
from ledgerloom.llm.near_dedup import drop_near_duplicates
from ledgerloom.llm.packing import pack
from ledgerloom.llm.substring_dedup import remove_repeats
from ledgerloom.plans.registry import register
from ledgerloom.sources.io import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is identified, with that as their lang."""
    return keep_identified(small_batches(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id."""
    return drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by 0.8 of their five-word shingles, the row with the smallest doc_id."""
    return drop_near_duplicates(small_batches(docs))


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that start in an earlier document."""
    return remove_repeats(small_batches(docs))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts, placed in training sequences of one language each."""
    return pack(small_batches(docs), by=declared_code(F.col("lang")))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", remove_passages),
    ("packing", pack_windows),
]

#: None: minwise signatures, trigram likelihoods and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


register("pipeline", run, ORACLE_SQL)
