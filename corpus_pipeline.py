"""Prepare a training corpus: five stages, each over all that the one before kept.

Every stage takes the documents so far and returns a DataFrame that is written and read
again as the input of the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sentaria.llm.common import stored, table
from sentaria.llm.decontaminate import clean_documents
from sentaria.llm.line_dedup import LEAST_CHARS, drop_repeated
from sentaria.llm.mil_quality import keep_good
from sentaria.llm.packing import pack
from sentaria.llm.simhash import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is fitted on the labels outside the held-out fold."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go, long ones also near repeats; every document stays, if need be without text.

    Two edits turn a short line into a different one ("And." and "Ein."), so it goes only if it repeats exactly.
    """
    return drop_repeated(docs, least=1, near=LEAST_CHARS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: the one with the least id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1,024 tokens, one row for each piece."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A trained classifier and edit distances are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
