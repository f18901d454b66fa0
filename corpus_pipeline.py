"""Corpus pipeline: documents through five operators of ``devicelens.llm``.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept;
its result is written as Parquet and read again as the next one's ``docs``, so a stage
begins by deleting the intermediate tables of those before it. All but the last return
the columns of ``documents``. SQL cannot express it as a whole (a
trained model, subword merges), so its tests hold each stage against brute force.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from devicelens.llm import bpe, decontaminate, hyperminhash, line_dedup, toxicity
from devicelens.llm.common import dropped, recorded, stored
from devicelens.llm.queries import table, vocabulary


_tables: list[str] = []  # intermediate tables of the stages so far


def stage(function):
    """A stage whose intermediate tables go when the next one begins."""
    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        dropped(spark, _tables)
        with recorded(_tables):
            return function(spark, docs, sf_dir)
    return run


@stage
def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trained classifier rejects go (operator 8)."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


@stage
def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier one go, and documents of nothing else (operator 5)."""
    return line_dedup.drop_repeated_lines(docs)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays (operator 1)."""
    return hyperminhash.drop_near_duplicates(docs)


@stage
def contaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with enough benchmark text go (operator 4)."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@stage
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and the digest of the text decoded from them (operator 10)."""
    return bpe.bpe_digests(docs, vocabulary("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("toxicity", toxic_documents),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("decontamination", contaminated_documents),
    ("bpe", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
