"""Filtering by a list of trusted sentence ids.

An empty list means "no filter", never "keep nothing".

Filters store the list before they probe and join it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentaria.plans.sizing import written

ID = "sentence_id"


def ids_from_correctness(detailed: DataFrame) -> DataFrame:
    """Trusted ids of rows whose correctness is known and not negative."""
    if "correctness" not in detailed.columns:
        return detailed.select(ID).limit(0)
    return detailed.filter(F.col("correctness") >= 0).select(ID).distinct()


def add_ids(ids: DataFrame, more: DataFrame) -> DataFrame:
    return ids.select(ID).union(more.select(ID)).distinct()


def keep_trusted(df: DataFrame, ids: DataFrame, *id_columns: str) -> DataFrame:
    """Keep rows whose every id column (default ``sentence_id``) is trusted.

    The list is stored once: the joins know its size, and no aggregation stands between
    their shuffle and them, which would keep a hot id in one task.
    """
    ids = written(ids.select(ID), "trusted")
    if ids.isEmpty():
        return df
    for column in id_columns or (ID,):
        df = df.join(ids.select(F.col(ID).alias(column)), column, "left_semi")
    return df


def flag_trusted(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Add ``is_quality``; the bulk form of a membership test."""
    marked = written(ids.select(ID).distinct(), "trusted").withColumn("is_quality", F.lit(True))
    return df.join(marked, ID, "left").withColumn(
        "is_quality", F.coalesce("is_quality", F.lit(False))
    )


def retention(df: DataFrame, ids: DataFrame) -> DataFrame:
    """One row: rows before, rows kept, percentage kept (NULL for an empty input)."""
    kept = F.count(F.when(F.col("is_quality"), 1))
    if ids.isEmpty():
        kept = F.count(F.lit(1))
    return (
        flag_trusted(df.select(ID), ids)
        .agg(F.count(F.lit(1)).alias("initial_count"), kept.alias("kept_count"))
        .withColumn("kept_percent", F.try_divide(F.col("kept_count") * 100.0, F.col("initial_count")))
    )


def trusted_count(ids: DataFrame) -> DataFrame:
    return ids.select(ID).distinct().agg(F.count(F.lit(1)).alias("n_ids"))
