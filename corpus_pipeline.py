"""Corpus pipeline: five stages over ``documents``.

1. ``quality``: documents the quality classifier predicts bad go.
2. ``exact_dedup``: of equal texts one row stays.
3. ``near_dedup``: of each SimHash component the row with the smallest id stays.
4. ``decontamination``: documents that hold a benchmark item go.
5. ``byte_bpe``: the rest is encoded; ids as little-endian unsigned 32-bit integers.

Each stage reads what the one before wrote.  Nulls, empty texts, repeated rows, empty
tables and extra columns have the results the operators define; extra columns go
through stages 1 to 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import bpe, decontaminate, exact_dedup, quality, simhash
from riskframe.llm._common import shared_rows, table


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs, simhash.SHINGLE, simhash.MAX_BITS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))
    return bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality", drop_bad),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("byte_bpe", encode),
]

#: SQL cannot express a fitted classifier: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spark.read.parquet(shared_rows(stage(spark, docs, sf_dir), f"pipeline-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
