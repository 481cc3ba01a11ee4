"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup,
benchmark decontamination, packing.

Each stage works on all documents that the stage before it kept and returns
them with the columns of ``documents``; the last returns the pieces of the packed
sequences.  What a stage rejects is gone for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import decontaminate, exact_dedup, lang_id, packing, queries, simhash
from linkloom.session import ensure_checkpoint_dir
from linkloom.sources.tables import read_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told, as they have no letter, go."""
    return lang_id.keep_known(docs, queries.language_model(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.exact_dedup(docs, keep_rows=True)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each component of near-duplicates stays."""
    return simhash.keep_first(docs, shingle=queries.SHINGLE, max_bits=queries.MAX_BITS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"),
                                       window=queries.BENCHMARK_WINDOW, keep_clean=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, queries.tokenizer_json(), capacity=queries.SEQUENCE)


STAGES = [("language", language), ("exact", exact), ("near", near), ("benchmark", benchmark), ("pack", pack)]

#: SimHash, language model and tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the
    shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
