"""Best-fit packing by the sum of squares.

Documents go one after another into sequences of fixed capacity. A document takes the open
sequence, or a new one, after which the sum of the squared counts of open sequences per
residual gap is smallest: no gap length becomes common, so there is a sequence for nearly
every length that comes. Pieces are dealt at random to groups that are packed at the same
time, and what still stands in sequences with room goes on to a next round of fewer groups.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentaria.llm.common import discard, stored, table
from sentaria.llm.packing import END_OF_TEXT, token_ids

SEQUENCE_TOKENS = 2048
#: Pieces that one task packs together. More pieces leave fewer sequences with room.
GROUP_PIECES = 1 << 16
#: A sequence with a larger gap than this share of its capacity is packed again in the next round.
ROOM = 1 / 64
#: Share of a group's pieces, the shortest, that come last, longest first: they fill gaps.
LATE = 0.1
#: Bits of a sequence id that number the sequences of one group, and its groups.
_LOCAL_BITS, _GROUP_BITS = 18, 40

PIECES = "place bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = f"{PIECES}, sequence_id bigint, offset bigint, room boolean"
_NO_SEQUENCE = -(1 << 29)


def fill(lengths: list[int], capacity: int = SEQUENCE_TOKENS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of every length in the order given, and the gap left in each sequence.

    With ``n[g]`` open sequences of gap ``g``, taking one of gap ``g`` for a length ``s``
    changes the sum of squares by ``2 - 2 n[g] + 2 n[g - s]``, a full one counts nothing,
    and a new sequence by ``1 + 2 n[capacity - s]``. The least change wins; among equals the
    smallest gap, and an open sequence before a new one.
    """
    twice = np.zeros(capacity + 1, np.int32)
    twice[0] = -1  # a sequence that becomes full leaves the sum
    taken = np.full(capacity + 1, _NO_SEQUENCE, np.int32)  # as ``twice``, but only where there is a sequence
    waiting: list[list[int]] = [[] for _ in range(capacity)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    gaps: list[int] = []
    for i, s in enumerate(lengths):
        at = -1
        if s < capacity:
            change = twice[: capacity - s] - taken[s:capacity]
            left = int(change.argmin())
            if taken[left + s] > 0 and change[left] + 2 <= 1 + twice[capacity - s]:
                gap = left + s
                at = waiting[gap].pop()
                twice[gap] -= 2
                taken[gap] = twice[gap] or _NO_SEQUENCE
        if at < 0:
            at, left = len(gaps), capacity - s
            gaps.append(capacity)
        sequence[i], offset[i] = at, capacity - gaps[at]
        gaps[at] = left
        if left:
            waiting[left].append(at)
            twice[left] += 2
            taken[left] = twice[left]
    return sequence, offset, np.array(gaps, np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) ^ (x.astype(np.uint64) >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _orders(places: np.ndarray, pieces: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Orders to try: a fixed shuffle with the shortest pieces last, and by falling length."""
    shuffled = np.lexsort((pieces, places, _mixed(places * 64 + pieces)))
    by_length = shuffled[np.argsort(lengths[shuffled], kind="stable")]
    late = by_length[: int(len(lengths) * LATE)]
    first = np.ones(len(lengths), bool)
    first[late] = False
    yield np.concatenate([shuffled[first[shuffled]], late[::-1]])
    yield by_length[::-1]


def _cutter(folder: str | None, capacity: int):
    schema = pa.schema(
        [("place", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32())]
        + [(c, pa.int64()) for c in ("start", "length", "ids_crc32")]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for place, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids = np.append(token_ids(text.as_py(), folder), np.uint32(END_OF_TEXT)).astype("<u4")
                ends = range(len(ids) % capacity or capacity, len(ids) + 1, capacity)
                for piece, end in enumerate(ends):
                    start = max(0, end - capacity)
                    rows.append((place, doc_id, piece, start, end - start, zlib.crc32(ids[start:end])))
            columns = list(zip(*rows)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return cut


def _packer(number: int, capacity: int):
    def pack_group(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lengths, places = rows["length"].to_numpy(), rows["place"].to_numpy()
        tried = [
            (order, *fill(lengths[order].tolist(), capacity))
            for order in _orders(places, rows["piece"].to_numpy(), lengths)
        ]
        order, sequence, offset, gaps = min(tried, key=lambda t: len(t[3]))
        base = (number << (_LOCAL_BITS + _GROUP_BITS)) | (key[0].as_py() << _LOCAL_BITS)
        rows = rows.drop_columns(["group"]).take(pa.array(order))
        return (
            rows.append_column("sequence_id", pa.array(base + sequence))
            .append_column("offset", pa.array(offset))
            .append_column("room", pa.array(gaps[sequence] > capacity * ROOM))
        )

    return pack_group


def pack_best_fit(
    docs: DataFrame,
    capacity: int = SEQUENCE_TOKENS,
    tokenizers: str | None = None,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Documents in sequences of ``capacity`` tokens: one row for each piece and its place.

    Only a document longer than ``capacity`` is cut, into pieces of that length with the
    rest as its first piece. A null or empty text is the closing id alone. Rows with null or
    repeated ids are packed like any other: pieces are dealt to groups by the place of
    their row, so no id and no length makes a group large. A very long text is tokenised whole
    in its task. An empty table gives no rows. Other columns are ignored, whatever their names.

    A round packs its pieces in groups of about ``group_pieces``, each in two orders of which the
    one with fewer sequences counts. Sequences with room (more
    than a 64th) are taken apart and packed again, until one group holds all, or until more
    than half of a round's pieces stay in such sequences (long pieces that nothing fills).
    """
    if not 1 <= group_pieces < 1 << _LOCAL_BITS:
        raise ValueError("group_pieces is out of range")
    rows = docs.select(F.monotonically_increasing_id().alias("place"), "doc_id", "text")
    left = stored(rows.mapInArrow(_cutter(tokenizers, capacity), PIECES), "pieces")
    count, number, done = left.count(), 0, []
    while True:
        groups = max(1, math.ceil(count / group_pieces))
        dealt = left.withColumn("group", F.pmod(F.xxhash64("place", "piece"), F.lit(groups)))
        packed = stored(dealt.groupBy("group").applyInArrow(_packer(number, capacity), PACKED), "packed")
        discard(left)
        again = 0 if groups == 1 else packed.filter("room").count()
        if not again or again > count // 2:
            done.append(packed)
            break
        done.append(packed.filter("not room"))
        left = stored(packed.filter("room").select("place", "doc_id", "piece", "start", "length", "ids_crc32"), "left")
        count, number = again, number + 1
    return reduce(DataFrame.unionByName, done).drop("place", "room")


def op11_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(table(spark, sf_dir, "documents"))
