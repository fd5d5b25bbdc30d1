"""Clustered Parquet datasets.

Rows are range-partitioned and sorted by id, so one id range is one run of row groups.
The number of the input partition is the last range key: it spreads a single id that
holds a large share of the rows over many writers. Unlike a random salt it is the same
when a lost task runs again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentaria.plans.sizing import (
    DROP_SHUFFLES,
    MAX_SHUFFLE_WIDTH,
    TARGET_PARTITION_BYTES,
    input_bytes,
    session_settings,
    shuffle_width,
    sized_shuffles,
)
from sentaria.sources.datasets import read_dataset

ID = "sentence_id"
#: Input bytes for one range partition of a write.
WRITE_PARTITION_BYTES = 128 << 20
_ORIGIN = "_input_partition"
_BUCKET, _SAME = "_bucket", "_same"
#: Texts take two thirds of the space that they take with Spark's default codec.
CODEC = "zstd"
#: Shuffled bytes of token rows that one task sorts: in memory they are about seven times as large.
INDEX_PARTITION_BYTES = 64 << 20


def dataset_path(base_dir: str, dataset: str) -> str:
    return f"{base_dir.rstrip('/')}/{dataset}"


def write_width(df: DataFrame) -> int:
    """Range partitions for a write: by bytes alone, so that small files become few.

    An explicit number is not coalesced, so the session's own number must not enter. It
    serves where the size is unknown.
    """
    size = input_bytes(df)
    return shuffle_width(df) if size is None else max(1, math.ceil(size / WRITE_PARTITION_BYTES))


def clustered(df: DataFrame, *keys: str, width: int | None = None) -> DataFrame:
    """Range-partition and sort by ``keys``; frames with none of them are left alone."""
    keys = [key for key in keys if key in df.columns]
    if not keys:
        return df
    return (
        df.withColumn(_ORIGIN, F.spark_partition_id())
        .repartitionByRange(width or write_width(df), *keys, _ORIGIN)
        .sortWithinPartitions(*keys)
        .drop(_ORIGIN)
    )


def write_dataset(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: tuple[str, ...] = (),
    order: tuple[str, ...] = (ID,),
    lookup_keys: tuple[str, ...] = (),
    width: int | None = None,
) -> None:
    """Write one dataset, clustered by its partition columns and then by ``order``.

    Overwriting a partitioned dataset replaces only the partitions present in ``df``. Columns of
    ``lookup_keys`` get a Bloom filter in each row group, beside its least and greatest value.
    ``width`` is the number of range partitions, by default :func:`write_width`.
    """
    writer = clustered(df, *partition_by, *order, width=width).write.mode(mode).option("compression", CODEC)
    for key in lookup_keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    if lookup_keys:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    with sized_shuffles(df):
        writer.parquet(path)


def save_dataset(df: DataFrame, base_dir: str, dataset: str) -> None:
    """Replace a dataset that has no language column."""
    write_dataset(df, dataset_path(base_dir, dataset))


def save_by_language(df: DataFrame, base_dir: str, dataset: str = "sentences") -> None:
    """Replace the languages present in ``df``; the files of other languages stay.

    Rows without a language go to their own partition and show up in the null report.
    """
    if "language" not in df.columns:
        save_dataset(df, base_dir, dataset)
        return
    write_dataset(df, dataset_path(base_dir, dataset), partition_by=("language",))


def save_partitioned(
    df: DataFrame, base_dir: str, dataset: str = "sentences", *partition_columns: str
) -> None:
    """Partition by any columns, by default the language."""
    columns = partition_columns or ("language",)
    write_dataset(df, dataset_path(base_dir, dataset), partition_by=columns)


def _buckets_by_language(rows: DataFrame, width: int) -> Column:
    """Bucket count of a row's language, in proportion to its share of ``rows``.

    The counts reach the driver: one row per language code, of which every one is also
    a directory.
    """
    counts = rows.filter(F.col("language").isNotNull()).groupBy("language").count().collect()
    total = sum(row["count"] for row in counts) or 1
    pairs = [(row["language"], -(-width * row["count"] // total)) for row in counts]
    if not pairs:
        return F.lit(1)
    sizes = F.create_map(*[F.lit(value) for pair in pairs for value in pair])
    return F.coalesce(F.try_element_at(sizes, F.col("language")), F.lit(1))


def write_token_index(
    tokens: DataFrame, path: str, mode: str = "overwrite", languages: DataFrame | None = None
) -> None:
    """Write the inverted index: by language, sorted by key and sentence.

    Keys are hashed into buckets, more of them for larger languages, so a small language
    is one file and not one per task. The rebalance hint splits a bucket that a frequent
    word makes too large. A task sorts its rows in memory, and a token that is its own key is
    shuffled once. There is no sampling pass, which would run the tokeniser twice. A row group's dictionary of keys, or its Bloom filter where there are too many
    for a dictionary, turns away lookups of keys in other buckets.

    ``languages`` is a cheaper frame to count languages in, such as the sentences.
    """
    spark = tokens.sparkSession
    # Shuffled token rows are about five times the size of their text's files.
    needed = shuffle_width(tokens, growth=5.0 * TARGET_PARTITION_BYTES / INDEX_PARTITION_BYTES)
    width = max(needed, 2 * spark.sparkContext.defaultParallelism)
    buckets = _buckets_by_language(tokens if languages is None else languages, width)
    settings = {
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": INDEX_PARTITION_BYTES,
        "spark__sql__shuffle__partitions": min(4 * width, MAX_SHUFFLE_WIDTH),
    }
    order = ("language", "normalized_token", ID)
    same = F.col("token").eqNullSafe(F.col("normalized_token"))
    brief = tokens.withColumn(_SAME, same).withColumn("token", F.when(~F.col(_SAME), F.col("token")))
    whole = F.when(F.col(_SAME), F.col("normalized_token")).otherwise(F.col("token"))
    with session_settings(spark, **settings, **DROP_SHUFFLES):
        (
            brief.withColumn(_BUCKET, F.pmod(F.xxhash64("normalized_token"), buckets))
            .hint("rebalance", "language", _BUCKET)
            .sortWithinPartitions(*order)
            .withColumn("token", whole)
            .drop(_BUCKET, _SAME)
            .write.mode(mode)
            .option("compression", CODEC)
            .option("partitionOverwriteMode", "dynamic")
            .option("parquet.bloom.filter.enabled#normalized_token", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .partitionBy("language")
            .parquet(path)
        )


def compact_dataset(
    spark: SparkSession, base_dir: str, dataset: str, target_dir: str, *partition_columns: str
) -> DataFrame:
    """Rewrite a dataset of many small files as few clustered ones below ``target_dir``.

    The source is only read: readers keep a valid copy until they switch over.
    """
    df = read_dataset(spark, base_dir, dataset)
    path = dataset_path(target_dir, dataset)
    if dataset == "sentence_tokens":
        write_token_index(df, path)
    else:
        write_dataset(df, path, partition_by=partition_columns)
    return read_dataset(spark, target_dir, dataset)


def append_jdbc(
    df: DataFrame, url: str, table: str, chunk_rows: int = 10_000, **properties: str
) -> None:
    """Append to a relational table, one connection per task, ``chunk_rows`` per batch."""
    df.write.jdbc(url, table, mode="append", properties={"batchsize": str(chunk_rows), **properties})
