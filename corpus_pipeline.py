"""The corpus pipeline: five stages, each on all that the stage before kept.

Null and empty texts have no language, so they go in the first stage. Repeated rows of a document are kept or dropped
together, but for lines and texts that an earlier doc_id holds. A null doc_id is never a duplicate nor a leak by itself. Extra columns
of any name pass by, up to the last stage, which returns its own. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagewright.llm import bpe, decontaminate, langid, linededup, neardup
from pagewright.llm.queries import bpe_vocabulary
from pagewright.llm.runtime import settings, swept, written

#: Rows that the last stage's executors hand to Python at once (10000 by default): executor and worker both hold them.
BATCH = 512

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: those that are null or without letters, and scores below 0.3."""
    return langid.accepted(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line (four fifths of all their tokens) go, and documents that have no other."""
    return linededup.stage(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least doc_id stays."""
    return neardup.one_of_each(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, at a similarity of 0.8 or more, go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens: their number, and digests of the ids and of the decoded text."""
    # Written here, while the batches are small: later it would be the caller's settings that hold.
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH)}):
        return written(bpe.round_trip(docs, bpe_vocabulary()), "tokens")


def alone(stage: Stage) -> Stage:
    """The stage, after the executors have given back the memory that the stage before took."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        swept(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("language ID", alone(identify_language)),
    ("line dedup", alone(drop_repeated_lines)),
    ("MinHash near-dedup", alone(drop_near_duplicates)),
    ("benchmark decontamination", alone(drop_leaked)),
    ("BPE encoding and decoding", alone(tokenize)),
]

#: The trained language models and the tokenizer can't be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
