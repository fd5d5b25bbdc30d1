"""Pages of ordered rows, however deep.

Rows are range-partitioned and sorted by a total order and stored with their place. From
the row count of each partition follow the places at which a page begins and ends, and the
page is one range of places, which Parquet readers find by the statistics of row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentaria.plans.sizing import written
from sentaria.sinks.parquet import write_width

#: Rows of one column that one task may sort for a page; deeper pages are cut out of sorted partitions.
TOP_ROWS = 100_000
PLACE, _ORIGIN = "_place", "_origin"
PLACE_BITS = 33


def total_order(rows: DataFrame, first: str) -> list[str]:
    """``first`` and then every other column: equal rows apart, no two rows tie."""
    return [first, *[c for c in rows.columns if c != first]]


def places(rows: DataFrame, order: list[str]) -> tuple[DataFrame, list[tuple[int, int]]]:
    """``rows`` stored in order with their place, and the first place and row count of each partition in order.

    The number of the input partition comes last, so that equal rows spread over tasks.
    """
    ranged = (
        rows.withColumn(_ORIGIN, F.spark_partition_id())
        .repartitionByRange(write_width(rows), *order, _ORIGIN)
        .sortWithinPartitions(*order)
        .drop(_ORIGIN)
        .withColumn(PLACE, F.monotonically_increasing_id())
    )
    kept = written(ranged, "ranked")
    part = F.shiftright(PLACE, PLACE_BITS)
    # one row for each partition
    counts = kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    return kept, sorted((row["part"] << PLACE_BITS, row["n"]) for row in counts)


def _place_of(rank: int, parts: list[tuple[int, int]]) -> int | None:
    """The place of the row of ``rank`` (from 0), None beyond the last row."""
    for start, n in parts:
        if rank < n:
            return start + rank
        rank -= n
    return None


def page_of(rows: DataFrame, first: str, limit: int, offset: int, top_rows: int = TOP_ROWS) -> DataFrame:
    """Rows ``offset + 1`` to ``offset + limit`` by ``first`` and then all other columns, in that order.

    Repeated rows and repeated values of ``first`` count each. A page that ends within ``top_rows``
    is a plain top-k, a deeper one is cut out of sorted partitions; the rows are the same.
    """
    limit, offset = int(limit), int(offset)
    if limit <= 0:
        return rows.limit(0)
    order = total_order(rows, first)
    if offset + limit <= top_rows:
        return rows.orderBy(*order).offset(offset).limit(limit)
    kept, parts = places(rows, order)
    begin = _place_of(offset, parts)
    if begin is None:
        return rows.limit(0)
    inside = kept.filter(F.col(PLACE) >= begin)
    end = _place_of(offset + limit, parts)
    if end is not None:
        inside = inside.filter(F.col(PLACE) < end)
    return inside.orderBy(PLACE).drop(PLACE)
