"""Helpers of the operators: stored intermediates, row numbers, connected components."""

from __future__ import annotations

import gc
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentaria.plans.sizing import input_bytes, scratch_path

#: Bytes that one shuffle partition of intermediate rows should hold.
PARTITION_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    The lineage is cut, a lost executor costs nothing that was written, and the size is
    known to the planner, which then broadcasts small tables and splits skewed joins.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def remove(df: DataFrame) -> None:
    """Delete the files of a ``stored`` frame whose last reader has finished."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """:func:`remove`, and the chance for Spark to delete shuffle files of frames no longer in use.

    It does so when the driver collects its garbage, which may else come after the disk is full.
    """
    remove(df)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def free_name(taken, name: str) -> str:
    """``name``, with underscores before it until it is none of the names ``taken`` (nor differs by case alone)."""
    held = {t.lower() for t in taken}
    while name.lower() in held:
        name = f"_{name}"
    return name


def quoted(name: str) -> Column:
    """The column of exactly that name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def wide_key(*columns: str | Column) -> Column:
    """A key of 128 bits: equal columns have equal keys, and others have different ones for any number of rows.

    Two hashes of 64 bits with different seeds. Nulls are values like any other.
    """
    plain = [F.col(c) if isinstance(c, str) else c for c in columns]
    nulls = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in plain])
    return F.struct(F.xxhash64(*plain, nulls).alias("a"), F.xxhash64(nulls, F.lit("b"), *plain).alias("b"))


#: Ids (8 bytes each) up to which a list is sent to all executors instead of being joined by shuffle.
SENT_IDS = 1_000_000


def sent_if_short(ids: DataFrame) -> DataFrame:
    """A stored list of ids with a broadcast hint if it is counted to be short."""
    return F.broadcast(ids) if ids.count() <= SENT_IDS else ids


def width(spark: SparkSession, n_bytes: float) -> int:
    """Partitions for a shuffle of about ``n_bytes``; not under the session's own number."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(n_bytes / PARTITION_BYTES))


def width_of(df: DataFrame, growth: float = 1.0) -> int:
    """``width`` for ``growth`` times the bytes that the leaves of ``df`` read."""
    return width(df.sparkSession, (input_bytes(df) or 0) * growth)


def numbered(df: DataFrame, *order: str | Column, name: str = "row_number", label: str = "numbered"):
    """``df`` with gapless numbers from 0 in the order of ``order``, and the row count.

    Rows are range-partitioned by ``order`` and then by their place in the input, so that
    equal rows spread over tasks. The partitions are stored before they are counted: a
    retried task cannot change numbers that were already given. Only the count of each
    partition is collected together.
    """
    place = F.monotonically_increasing_id()
    ranged = (
        df.withColumn("_place", place)
        .repartitionByRange(width_of(df), *order, "_place")
        .sortWithinPartitions(*order, "_place")
        .drop("_place")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    kept = stored(ranged, label)
    part = F.shiftright("_at", 33)
    counts = {r["p"]: r["n"] for r in kept.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = {}, 0
    for p in sorted(counts):
        starts[p] = total
        total += counts[p]
    spark = df.sparkSession
    offsets = spark.createDataFrame(
        [(p, s) for p, s in starts.items()] or [(0, 0)], "_part bigint, _start bigint"
    )
    # one row for each partition
    out = kept.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    number = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return out.withColumn(name, number).drop("_part", "_start", "_at"), total


def components(edges: DataFrame, label: str = "edges") -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the least node reachable.

    Alternating large and small stars: every round moves neighbours to a smaller one, so a
    path shortens by halves and a hub keeps one row for each neighbour. The minima of a
    round are stored before they are joined, which lets adaptive execution split the
    rows of a hub. Nulls and self links are dropped, repeats do not matter.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = stored(pairs.filter("u > v").distinct(), label)
    seen = _digest(now)
    while seen[0]:
        before = now
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = stored(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
            label,
        )
        large = stored(
            both.join(smallest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u > v").distinct(),
            label,
        )
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), label)
        moved = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(moved.unionByName(least.withColumnRenamed("m", "v")).distinct(), label)
        for past in (before, smallest, large, least):
            remove(past)
        last, seen = seen, _digest(now)
        if last == seen:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _digest(pairs: DataFrame) -> tuple:
    """Count and order-free checksum of a set of pairs."""
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    row = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(mixed).alias("s")).first()
    return row["n"], row["s"]
