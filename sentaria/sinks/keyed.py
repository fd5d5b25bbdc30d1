"""Appends that keep keys unique: what is stored is read only where a new key may be."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sentaria.plans.sizing import discard, written
from sentaria.schemas import PRIMARY_KEYS

#: Ranges of values that a scan is narrowed by, and values that are compared one by one.
RANGES = 64
EXACT = 10
#: Values that the driver cuts into ranges at their widest gaps; more are cut by Spark.
LISTED = 10_000
#: Characters of a text that rows of one key are first compared by.
BRIEF_CHARS = 64
#: So many words of marks, of 64 rows each, go to every task; more are joined by shuffle.
SENT_MARKS = 4_000_000
PLACE = "_place"
_WORD, _MASK = "_word", "_mask"


def value_ranges(values: DataFrame) -> list[tuple]:
    """Up to ``RANGES`` ``(least, greatest)`` that hold every value of a stored one-column frame.

    Few values are cut at their widest gaps. More are range-partitioned, and each
    partition gives one range.
    """
    (name,) = values.columns
    values = values.filter(F.col(name).isNotNull())
    listed = [row[0] for row in values.distinct().limit(LISTED + 1).collect()]
    if len(listed) > LISTED:
        parts = values.repartitionByRange(RANGES, name).groupBy(F.spark_partition_id().alias("part"))
        ends = parts.agg(F.min(name).alias("low"), F.max(name).alias("high")).collect()
        return sorted((row["low"], row["high"]) for row in ends)
    listed.sort()
    if len(listed) <= EXACT:
        return [(v, v) for v in listed]
    if isinstance(listed[0], int):
        widest = sorted(range(1, len(listed)), key=lambda i: listed[i - 1] - listed[i])[: RANGES - 1]
    else:
        widest = [len(listed) * k // RANGES for k in range(1, RANGES)]
    cuts = sorted({0, *widest, len(listed)})
    return [(listed[a], listed[b - 1]) for a, b in zip(cuts, cuts[1:]) if a < b]


def in_ranges(column: Column | str, ranges: list[tuple]) -> Column:
    """A predicate that Parquet readers skip row groups by: statistics for ranges, Bloom filters for single values."""
    column = F.col(column) if isinstance(column, str) else column
    tests = [column == F.lit(a) if a == b else column.between(F.lit(a), F.lit(b)) for a, b in ranges]
    return reduce(Column.__or__, tests, F.lit(False)) if tests else F.lit(False)


def _is_stored(df: DataFrame, column: str) -> bool:
    """Whether ``column`` is a column of a file as it stands there, perhaps under another name."""
    try:
        node = df.select(column)._jdf.queryExecution().optimizedPlan()
    except AttributeError:  # no JVM handle, as with a remote session
        return False
    while node.children().size() == 1:
        if node.nodeName() == "Project":
            value = node.projectList().head()
            if value.getClass().getSimpleName() == "Alias":
                value = value.child()
            if value.getClass().getSimpleName() != "AttributeReference":
                return False
        elif node.nodeName() != "Filter":
            return False
        node = node.children().head()
    return node.nodeName().startswith("LogicalRelation") or node.children().size() == 0


def narrowed(df: DataFrame, column: str, ranges: list[tuple]) -> DataFrame:
    """The rows whose ``column`` is in the ranges. A derived column, which is costly to compare, is held in their hull."""
    if len(ranges) > 1 and not _is_stored(df, column):
        ranges = [(ranges[0][0], ranges[-1][1])]
    return df.filter(in_ranges(column, ranges))


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with the place of each, which is the same whenever files are read by the same splits."""
    return rows.withColumn(PLACE, F.monotonically_increasing_id())


def _marks(places: DataFrame) -> DataFrame:
    """One bit for each place, 64 to a row."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit())
    return written(places.groupBy(_word().alias(_WORD)).agg(F.bit_or(bit).alias(_MASK)), "marks")


def _word() -> Column:
    return F.shiftright(F.col(PLACE), 6)


def _bit() -> Column:
    return F.col(PLACE).bitwiseAND(63).cast("int")


def _marked(rows: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """``rows`` beside the marks of their places, which go to every task: whole rows are not shuffled for them."""
    few = F.broadcast(marks) if marks.count() <= SENT_MARKS else marks
    return rows.withColumn(_WORD, _word()).join(few, _WORD, how)


def _brief(rows: DataFrame, columns: list[str]) -> Column:
    """Short values that order rows as their columns do, or tie: long text is cut, and nothing follows a cut."""
    parts, whole = [], F.lit(True)
    for name in columns:
        if isinstance(rows.schema[name].dataType, StringType):
            long = F.char_length(name) > BRIEF_CHARS
            parts += [F.when(whole, F.substring(name, 1, BRIEF_CHARS)), F.when(whole, long)]
            whole = whole & ~F.coalesce(long, F.lit(False))
        else:
            parts.append(F.when(whole, F.col(name)))
    return F.struct(*[part.alias(f"part_{k}") for k, part in enumerate(parts)])


def _places_lost(arriving: DataFrame, refused: DataFrame, keys: list[str]) -> DataFrame:
    """Marks of the rows whose key is refused, but for the least row of a new one.

    Rows are compared by short values and digests. Only those that tie in the first and differ in the
    second are compared as a whole.
    """
    others = [c for c in arriving.columns if c not in (*keys, PLACE)]
    values = [*others, *[F.col(c).isNull() for c in others]]
    digests = (F.xxhash64(*values).alias("_a"), F.xxhash64(F.lit(1), *values).alias("_b"))
    again = refused.select(*keys, F.col("stored").alias("_known"))
    several = written(
        arriving.select(*keys, PLACE, _brief(arriving, others).alias("_brief"), *digests).join(again, keys), "repeated"
    )
    # the least and the greatest digest of the least short values are one if all of those rows are
    found = several.filter(~F.col("_known")).groupBy(*keys).agg(
        F.min(F.struct("_brief", "_a", "_b", PLACE)).alias("_least"),
        F.min(F.struct("_brief", F.bitwise_not("_a").alias("_a"), F.bitwise_not("_b").alias("_b"))).alias("_last"),
    )
    tied = (F.col("_least._a") != F.bitwise_not("_last._a")) | (F.col("_least._b") != F.bitwise_not("_last._b"))
    least = written(found.select(*keys, f"_least.{PLACE}", "_least._brief", tied.alias("_tied")), "least-rows")
    kept = least.filter(~F.col("_tied")).select(PLACE)
    if not (open_ := least.filter("_tied").select(*keys, F.col("_brief").alias("_same"))).isEmpty():
        rows = several.join(open_, keys).filter(F.col("_brief").eqNullSafe(F.col("_same")))
        asked = _marks(rows.groupBy(*keys, "_a", "_b").agg(F.min(PLACE).alias(PLACE)))
        whole = _marked(arriving, asked, "inner").filter(F.getbit(_MASK, _bit()) == 1)
        order = F.struct(*[F.col(c) for c in others], F.col(PLACE))
        kept = kept.unionByName(whole.groupBy(*keys).agg(F.min(order)[PLACE].alias(PLACE)).select(PLACE))
    lost = _marks(several.select(PLACE).join(kept, PLACE, "left_anti"))
    discard(several)
    discard(least)
    return lost


def split_by_key(rows: DataFrame, held: DataFrame | None, table: str) -> tuple[DataFrame, DataFrame]:
    """``(new, refused)``: rows to append to ``held`` (None: nothing is stored), and the keys of the others.

    A row is refused if its key is stored, is null or repeats; of a repeated new key the
    least row is taken. ``refused`` has a row for each key: the key, ``stored`` and ``n_rows``,
    the number of rows refused. The stored keys are read only in the ranges of the new ones.
    """
    arriving = written(placed(rows), "arriving")
    new, refused = split_placed(arriving, held, table)
    if refused.isEmpty():
        return new, refused
    # stored once: writers read what they write more than once
    new = written(new, "new-rows")
    discard(arriving)
    return new, refused


def split_placed(arriving: DataFrame, held: DataFrame | None, table: str) -> tuple[DataFrame, DataFrame]:
    """:func:`split_by_key` of rows that are :func:`placed` and stored, without a copy: ``new`` is read from them."""
    keys = list(PRIMARY_KEYS[table])
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    counted = arriving.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    if held is None:
        counted = counted.withColumn("stored", F.lit(False))
    else:
        # the last key column tells rows apart best: the others have few values
        near = narrowed(held, keys[-1], value_ranges(arriving.select(keys[-1]))).select(*keys)
        known = near.join(arriving.filter(whole).select(*keys), keys, "left_semi").distinct()
        known = known.withColumn("_stored", F.lit(True))
        counted = counted.join(known, keys, "left").withColumn("stored", F.coalesce("_stored", F.lit(False)))
    lost = F.when(F.col("stored") | ~whole, F.col("_rows")).otherwise(F.col("_rows") - 1)
    refused = written(
        counted.select(*keys, "stored", lost.alias("n_rows")).filter("n_rows > 0"), "refused-keys"
    )
    if refused.isEmpty():
        return arriving.drop(PLACE), refused
    rest = _marked(arriving.filter(whole), _places_lost(arriving, refused, keys), "left")
    new = rest.filter(F.col(_MASK).isNull() | (F.getbit(_MASK, _bit()) == 0))
    return new.drop(PLACE, _WORD, _MASK), refused
