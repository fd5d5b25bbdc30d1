"""Readers for datasets this package wrote, and parameterised SQL over any tables."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentaria.schemas import SCHEMAS

log = logging.getLogger(__name__)


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_dataset(spark: SparkSession, base_dir: str, dataset: str = "sentences") -> DataFrame:
    """A whole dataset, files aligned by column name (absent columns are NULL).

    A dataset without a declared schema needs its footers merged, which is a job of
    its own; a declared one is read with its schema and needs none. Either way the
    missing dataset raises ``FileNotFoundError``.
    """
    path = f"{base_dir.rstrip('/')}/{dataset}"
    try:
        if dataset in SCHEMAS:
            return spark.read.schema(SCHEMAS[dataset]).parquet(path)
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as error:
        if is_missing_path(error):
            raise FileNotFoundError(path) from error
        raise


def read_language(
    spark: SparkSession, base_dir: str, dataset: str = "sentences", language: str = "eng"
) -> DataFrame:
    """One language of a dataset by partition pruning; a missing one raises ``FileNotFoundError``."""
    df = read_dataset(spark, base_dir, dataset).filter(F.col("language") == language)
    if df.select("language").isEmpty():
        raise FileNotFoundError(f"{base_dir}/{dataset}: no language {language!r}")
    return df


def available_languages(df: DataFrame) -> DataFrame:
    """Distinct languages; on a partitioned dataset no column data is read."""
    return df.select("language").filter(F.col("language").isNotNull()).distinct()


def list_languages(spark: SparkSession, base_dir: str, dataset: str = "sentences") -> list[str]:
    """Languages of a stored dataset, empty if it is missing. A handful of codes."""
    try:
        df = read_dataset(spark, base_dir, dataset)
    except FileNotFoundError:
        return []
    if "language" not in df.columns:
        return []
    return sorted(row["language"] for row in available_languages(df).collect())


def read_languages(
    spark: SparkSession, base_dir: str, languages: Iterable[str], dataset: str = "sentences"
) -> DataFrame:
    """Several languages in one pruned scan; missing ones are logged and skipped."""
    wanted = list(languages)
    missing = sorted(set(wanted) - set(list_languages(spark, base_dir, dataset)))
    if missing:
        log.warning("%s: no data for languages %s", dataset, ", ".join(missing))
    return read_dataset(spark, base_dir, dataset).filter(F.col("language").isin(wanted))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns aligned by name."""
    out, *rest = frames
    for df in rest:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def run_sql(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    sql: str,
    params: Sequence[object] | None = None,
) -> DataFrame:
    """Run SQL with ``?`` markers over the given tables under their names.

    A name that the session already uses is refused. The views are dropped as soon as the
    plan is analysed, so they never show up in the caller's catalog.
    """
    taken = [name for name in tables if spark.catalog.tableExists(name)]
    if taken:
        raise ValueError(f"names already in use: {', '.join(taken)}")
    try:
        for name, df in tables.items():
            df.createTempView(name)
        return spark.sql(sql, args=list(params)) if params else spark.sql(sql)
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
