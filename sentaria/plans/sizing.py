"""Size-driven choices: shuffle width, input spreading, the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TARGET_PARTITION_BYTES = 256 << 20
#: Rows in memory that one task should group or sort.
TASK_BYTES = 256 << 20
#: Size of token rows in memory over that of the text's or the index's compressed files.
TOKEN_GROWTH = 32.0
# Above this width the map x reduce block count hurts more than larger partitions,
# which sort with spill.
MAX_SHUFFLE_WIDTH = 20_000
_UNKNOWN_BYTES = 1 << 60


def input_bytes(df: DataFrame) -> int | None:
    """Estimated bytes read by the plan's leaves, or None when Catalyst cannot tell.

    Only leaves are summed: estimates above joins multiply and would mislead.
    """
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    except (AttributeError, TypeError):  # no JVM handle, as with a remote session
        return None
    return None if any(size >= _UNKNOWN_BYTES for size in sizes) else sum(sizes)


def shuffle_width(df: DataFrame, growth: float = 1.0) -> int:
    """Partition count for a full shuffle of ``df``; ``growth`` is output over input size."""
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = input_bytes(df)
    if size is None:
        return default
    needed = math.ceil(size * growth / TARGET_PARTITION_BYTES)
    return max(default, min(needed, MAX_SHUFFLE_WIDTH))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Shuffle an input that is too small to fill the cluster; leave larger ones alone.

    A large input already arrives as one task per file split. A small one may sit in
    a single split, and then costly per-row work would run on one core.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = _bytes_setting(spark, "spark.sql.files.maxPartitionBytes", 128 << 20)
    size = input_bytes(df)
    if size is None or size >= cores * split:
        return df
    return df.repartition(2 * cores, *keys)


def dealt(df: DataFrame, *keys: str, growth: float = 1.0) -> DataFrame:
    """Deal rows out by ``keys`` to so many tasks that each can group or sort its share in memory.

    ``growth`` is the size of the rows in memory over that of the files they come from. A grouping by
    these keys needs no further shuffle.
    """
    size = input_bytes(df)
    if size is None:
        return df.repartition(*keys)
    needed = math.ceil(size * growth / TASK_BYTES)
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, min(needed, MAX_SHUFFLE_WIDTH)), *keys)


def _bytes_setting(spark: SparkSession, name: str, default: int) -> int:
    text = str(spark.conf.get(name, str(default))).strip().lower().removesuffix("b")
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    if text and text[-1] in units:
        return int(text[:-1]) << units[text[-1]]
    return int(text)


@contextmanager
def session_settings(spark: SparkSession, **settings):
    """Set SQL options around one action and put the old values back."""
    names = {name: name.replace("__", ".") for name in settings}
    before = {full: spark.conf.get(full, None) for full in names.values()}
    for name, value in settings.items():
        spark.conf.set(names[name], str(value))
    try:
        yield
    finally:
        for full, value in before.items():
            if value is None:
                spark.conf.unset(full)
            else:
                spark.conf.set(full, value)


#: Shuffle files are deleted when the write that made them has ended, not when the driver collects its garbage.
DROP_SHUFFLES = {"spark__sql__classic__shuffleDependency__fileCleanup__enabled": "true"}


def sized_shuffles(df: DataFrame):
    """Let the joins and groupings below one write start with a width that fits its input.

    Adaptive execution joins partitions that turn out small but never adds any, so too
    many is cheap and too few is not. The files of these shuffles go with the write.
    """
    name = "spark__sql__adaptive__coalescePartitions__initialPartitionNum"
    return session_settings(df.sparkSession, **{name: shuffle_width(df)}, **DROP_SHUFFLES)


def scratch_root(spark: SparkSession) -> str:
    """Folder that every executor sees: the cluster's checkpoint folder.

    A local master may fall back to a temporary folder; a cluster may not.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="sentaria-")
    spark.sparkContext.setCheckpointDir(folder)
    return scratch_root(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back: lineage cut, sizes known."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with sized_shuffles(df):
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_to = path
    return back


def discard(df: DataFrame) -> None:
    """Delete the files of a :func:`written` frame whose last reader has finished."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
