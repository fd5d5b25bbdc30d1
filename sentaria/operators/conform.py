"""Bring any input to a table's declared columns and types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField

from sentaria.schemas import DEFAULTS, SCHEMAS


def _conformed(df: DataFrame, field: StructField, default: str | None) -> Column:
    if field.name in df.columns:
        value = F.col(field.name)
        if isinstance(df.schema[field.name].dataType, (DoubleType, FloatType)):
            value = F.when(~F.isnan(value), value)
    else:
        value = F.lit(None)
    value = value.cast(field.dataType)
    if default is not None:
        value = F.coalesce(value, F.lit(default))
    return value.alias(field.name)


def conform(df: DataFrame, table: str, defaults: dict[str, str] | None = None) -> DataFrame:
    """Add missing columns, fill declared defaults, drop extras, order and cast.

    One projection: no shuffle, and unused input columns are pruned from the scan.
    A bad id fails the job under ANSI mode instead of being dropped quietly.
    """
    chosen = DEFAULTS.get(table, {}) if defaults is None else defaults
    return df.select([_conformed(df, f, chosen.get(f.name)) for f in SCHEMAS[table].fields])


def surrogate_ids(df: DataFrame, after: int = 0) -> DataFrame:
    """Prepend a unique, not dense, ``id``. Call it on a scan, where row order is stable."""
    return df.select((F.monotonically_increasing_id() + F.lit(after + 1)).alias("id"), "*")
