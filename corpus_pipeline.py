"""A training corpus from ``documents``: language ID, line de-duplication,
near-duplicate removal, mixing of sources, packing.

Each stage takes all that its predecessor kept, as the Parquet table that was
written for it. All but the last return the columns of ``documents``; the
last returns the packed pieces. A stage that is called by itself sets the
session as the queries do, or its tasks would hold batches of 10,000 texts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm import langid, linefreq, mixing, packing, weightedhash
from tidings.session import apply_settings, written


def stage(fn: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apply_settings(spark)
        return fn(spark, docs, sf_dir)
    return run


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those that resemble no language."""
    learned = docs.where(~langid.held_out())
    prototypes = langid.train(learned)
    return langid.accepted(docs, prototypes, least=langid.floors(learned, prototypes))


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that are boilerplate of their source; every document stays."""
    clean = linefreq.drop_boilerplate(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves the document with the smallest id of each near-duplicate group."""
    return weightedhash.keep_one(docs)


@stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents so that sources near their targets."""
    return mixing.mixed_documents(docs)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 1024."""
    return packing.pack_documents(docs)


STAGES = [("language ID", language), ("line dedup", line_dedup), ("MinHash near-dedup", near_dedup),
          ("source mix", source_mix), ("best-fit packing", pack)]

#: Language vectors, sampling and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = written(step(spark, docs, sf_dir), "stage-" + name.lower().replace(" ", "-"))
    return docs
