"""Referential filtering, and key, null, reference and length reports.

Reports group the child side by key before any join, so a key that holds a large
share of all rows is reduced to one row per map task first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentaria.schemas import MAX_LENGTHS, PRIMARY_KEYS, REFERENCES, REQUIRED


def keep_known(df: DataFrame, sentences: DataFrame, *id_columns: str) -> DataFrame:
    """Keep rows whose every id column (default ``sentence_id``) is a known sentence."""
    for column in id_columns or ("sentence_id",):
        known = sentences.select(F.col("sentence_id").cast("bigint").alias(column))
        df = df.withColumn(column, F.col(column).cast("bigint")).join(known, column, "left_semi")
    return df


def keep_allowed(df: DataFrame, allowed: DataFrame | None) -> DataFrame:
    """Keep allowed ids; None allows everything and an empty list nothing."""
    return df if allowed is None else keep_known(df, allowed)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key values held by more than one row, with the row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def _long_form(counts: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One row per non-zero counter of a one-row frame."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_rows")) for c in columns]
    )
    return (
        counts.select(F.inline(pairs))
        .filter(F.col("n_rows") > 0)
        .select(F.lit(table).alias("table_name"), "column_name", "n_rows")
    )


def null_violations(df: DataFrame, table: str) -> DataFrame:
    """NULL counts of the required columns, in a single pass."""
    columns = [c for c in REQUIRED[table] if c in df.columns]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _long_form(counts, table, columns)


def length_violations(df: DataFrame, table: str) -> DataFrame:
    """Counts of values longer than the table's text limits, in a single pass."""
    limits = {c: n for c, n in MAX_LENGTHS.get(table, {}).items() if c in df.columns}
    counts = df.agg(*[F.count_if(F.char_length(c) > n).alias(c) for c, n in limits.items()])
    return _long_form(counts, table, list(limits))


def missing_parents(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Referenced keys without a parent row, with the number of child rows."""
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return used.join(parent.select(F.col(parent_column).alias("key")), "key", "left_anti")


def reference_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """All broken references among the given tables: table, column, key as text, rows."""
    reports = [
        missing_parents(tables[r.table], r.column, tables[r.parent], r.parent_column).select(
            F.lit(r.table).alias("table_name"),
            F.lit(r.column).alias("column_name"),
            F.col("key").cast("string").alias("key"),
            "n_rows",
        )
        for r in REFERENCES
        if r.table in tables and r.parent in tables
    ]
    return reduce(DataFrame.unionByName, reports)


def validate(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every report for the given tables; a clean corpus gives only empty frames."""
    def over(rule, rules):
        return reduce(DataFrame.unionByName, [rule(df, t) for t, df in tables.items() if t in rules])

    reports = {
        f"duplicate_keys_{table}": duplicate_keys(tables[table], *keys)
        for table, keys in PRIMARY_KEYS.items()
        if table in tables
    }
    reports["nulls"] = over(null_violations, REQUIRED)
    reports["lengths"] = over(length_violations, MAX_LENGTHS)
    reports["references"] = reference_violations(tables)
    return reports
