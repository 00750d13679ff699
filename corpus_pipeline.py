"""Documents to training sequences: language, near-duplicates, repeated passages, leaks, packing.

Every stage takes (spark, docs, sf_dir) and all rows its predecessor kept; all but the last return the
columns of ``docs``. Rows without an id can't be named by a decision and go on as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontamination import decontaminate
from tidemark.llm.ids import one_of_equal, without
from tidemark.llm.language import identify
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.scratch import Scratch
from tidemark.llm.substrings import remove_repeats


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read as no language go."""
    return without(docs, identify(docs).where("not kept").select("doc_id"), "doc_id")


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, and one of equal rows."""
    return without(one_of_equal(docs, "doc_id"), near_duplicates(docs).where("not kept").select("doc_id"), "doc_id")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut; documents of which nothing is left go."""
    cut = remove_repeats(docs).where((F.col("n_removed_words") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).drop("n_removed_words")
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without(docs, decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("leaked").select("doc_id"), "doc_id")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]
#: Shingles, passages and tokens can't be had in SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each result written before the next reads it."""
    s = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = s.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
