"""A training corpus in five stages, each one of the operators of kiln.llm.

Every stage reads what its predecessor wrote.  All but the last return the
columns of ``documents``; the last adds the token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm import line_dedup, mixing, near_dedup, quality_rules, sentencepiece_codec
from kiln.llm.common import drop_table, read_table, write_table

__all__ = ["STAGES", "ORACLE_SQL", "run"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows removed from the texts."""
    return line_dedup.apply(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.apply(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training set: a row for each copy that the source weights take, in training order."""
    return mixing.apply(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents and ``token_ids``."""
    return sentencepiece_codec.encode(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near dedup", near_duplicates),
          ("mixing", mix), ("sentencepiece", tokens)]

#: The last stage has no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        last = docs
        docs = write_table(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
        if k:
            drop_table(last)
    return docs
