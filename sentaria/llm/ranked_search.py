"""Ranked lexical search, term at a time for short lists and document at a time for long ones.

One scan stores the postings of the asked terms in blocks of documents. A block's short
lists are summed into accumulators, which then act as one more list with a known bound
beside the long ones. All lists are read in document order, window after window: a window
that cannot reach the k-th best score is skipped, and within one only documents of the
lists that can still lift a score over it are looked up in the others.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentaria.llm.common import stored, table

TOP = 20
#: Text bytes of a block.
BLOCK_BYTES = 32 << 20
#: Items that are asked together, and their bytes of text: what is sent to every task.
ITEMS = 2000
ITEM_BYTES = 16 << 20

#: Fixed constants of the score.
SCALE, TF_SCALE, LENGTH_SCALE, WEIGHT_SCALE = 1_000_000_000, 1000, 12, 1000
BASE_LENGTH, LENGTH_SHARE = 75, 25

_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_END = b"\xff"  # between documents; no byte of UTF-8

BLOCKS = "docs int, n_terms bigint, doc_ids array<bigint>, lengths array<bigint>, terms array<int>, sizes array<int>, places binary, counts binary"
_BLOCK_SCHEMA = pa.schema(
    [("docs", pa.int32()), ("n_terms", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
     ("terms", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())), ("places", pa.binary()), ("counts", pa.binary())]
)
FOUND = "query int, doc_id bigint, score bigint"


@dataclass(frozen=True)
class Layout:
    """Documents of a block and of a window; lists up to ``short`` of a block's documents are summed term at a time."""

    block: int = 8192
    window: int = 1024
    short: float = 1 / 16

    def windows(self, n_docs: int) -> int:
        return -(-n_docs // self.window)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in their order: runs of ASCII letters, digits and other characters."""
    return text.encode().translate(_TERM_BYTES).split() if text else []


# --- postings ------------------------------------------------------------------


class _Known(dict):
    """Numbers of asked terms from 2; any other term is 1."""

    def __missing__(self, term: bytes) -> int:
        return 1


def _indexer(vocabulary: list[bytes], layout: Layout):
    def block(rows: list[tuple[int | None, bytes]], known: _Known) -> pa.RecordBatch:
        # in the order of ids, nulls first, so that a block's places decide ties as ids do
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        words = b" \xff ".join([text for _, text in rows]).split()
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        ends = np.append(np.flatnonzero(ids == 0), len(ids))
        lengths = np.diff(ends, prepend=-1) - 1
        doc = np.repeat(np.arange(len(rows)), lengths)
        ids = ids[ids > 0]
        asked = ids > 1
        runs, counts = np.unique((ids[asked] - 2) * len(rows) + doc[asked], return_counts=True)
        term, place = np.divmod(runs, len(rows))
        present, sizes = np.unique(term, return_counts=True)
        values = [
            len(rows), int(lengths.sum()), [r[0] for r in rows], lengths.tolist(), present.tolist(), sizes.tolist(),
            place.astype("<u4").tobytes(), counts.astype("<u4").tobytes(),
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(values, _BLOCK_SCHEMA)], schema=_BLOCK_SCHEMA
        )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known({t: i + 2 for i, t in enumerate(vocabulary)})
        known[_END] = 0
        rows, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                # the end mark is put in after folding, as it is no byte of UTF-8
                text = (text.as_py() or b"").translate(_TERM_BYTES)
                rows.append((doc_id, text))
                size += len(text)
                if len(rows) >= layout.block or size >= BLOCK_BYTES:
                    yield block(rows, known)
                    rows, size = [], 0
        if rows:
            yield block(rows, known)

    return index


# --- search in one block -------------------------------------------------------


@dataclass
class Posting:
    """A list of places in ascending order, what each adds to a score, and the most of that per window."""

    places: np.ndarray
    gains: np.ndarray
    peaks: np.ndarray

    @classmethod
    def of(cls, places: np.ndarray, gains: np.ndarray, n_docs: int, layout: Layout) -> "Posting":
        peaks = np.zeros(layout.windows(n_docs), np.int64)
        np.maximum.at(peaks, places // layout.window, gains)
        return cls(places, gains, peaks)

    def times(self, weight: int) -> "Posting":
        return Posting(self.places, self.gains * weight, self.peaks * weight)

    def between(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.searchsorted(self.places, (start, end))
        return self.places[a:b], self.gains[a:b]


def summed(short: list[Posting], n_docs: int, layout: Layout) -> Posting:
    """Short lists as one: the accumulators of a term-at-a-time pass."""
    sums = np.zeros(n_docs, np.int64)
    for posting in short:
        sums[posting.places] += posting.gains
    places = np.flatnonzero(sums)
    return Posting.of(places, sums[places], n_docs, layout)


def best_of_block(
    lists: list[Posting], n_docs: int, top: int, floor: int, layout: Layout
) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of a block's documents that may be among the ``top`` best.

    ``floor`` is a score that a document must reach. Every document of the block with one
    of its ``top`` best scores of at least the floor is returned, ties included.
    """
    n_windows = layout.windows(n_docs)
    limit = int(n_docs * layout.short)
    streams = [p for p in lists if len(p.places) > limit]
    short = [p for p in lists if len(p.places) <= limit]
    if short:
        gathered = summed(short, n_docs, layout)
        streams.append(gathered)
        if len(gathered.gains) >= top:  # partial sums already hold the k-th best from below
            floor = max(floor, int(np.partition(gathered.gains, -top)[-top]))
    streams.sort(key=lambda p: int(p.peaks.max(initial=0)))
    found, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    peaks = np.stack([p.peaks for p in streams]) if streams else np.zeros((0, n_windows), np.int64)
    # what the lists up to each one can add in a window
    reach = np.cumsum(peaks, axis=0)
    for w in range(n_windows if streams else 0):
        if reach[-1, w] < floor:
            continue
        # documents only in the first lists cannot reach the floor: those lists are looked up, not walked
        walked = int(np.searchsorted(reach[:, w], floor))
        base, end = w * layout.window, (w + 1) * layout.window
        sums = np.zeros(layout.window, np.int64)
        for posting in streams[walked:]:
            places, gains = posting.between(base, end)
            sums[places - base] += gains
        at = np.flatnonzero(sums)
        score = sums[at]
        for k in range(walked - 1, -1, -1):
            hopeful = score + reach[k, w] >= floor
            at, score = at[hopeful], score[hopeful]
            if not len(at):
                break
            places, gains = streams[k].between(base, end)
            if len(places):
                near = np.searchsorted(places, at + base)
                near[near == len(places)] = 0
                score = score + np.where(places[near] == at + base, gains[near], 0)
        good = score >= max(floor, 1)
        if good.any():
            found, scores = np.concatenate([found, at[good] + base]), np.concatenate([scores, score[good]])
            if len(scores) > top:
                # places ascend, so a stable sort keeps the least ids of a tie
                keep = np.sort(np.argsort(-scores, kind="stable")[:top])
                found, scores = found[keep], scores[keep]
            if len(scores) == top:
                floor = max(floor, int(scores.min()))
    return found, scores


@dataclass(frozen=True)
class Statistics:
    documents: int
    terms: int


def gains_of(tf: np.ndarray, lengths: np.ndarray, of: Statistics) -> np.ndarray:
    """What an occurrence count adds to a score for each unit of a term's weight."""
    m = BASE_LENGTH + (LENGTH_SHARE * lengths * of.documents) // of.terms
    return (SCALE * tf) // (TF_SCALE * tf + LENGTH_SCALE * m)


def weight(df: int, of: Statistics) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * of.documents + 2) / (2 * df + 1)))


def _searcher(queries: list[dict[int, int]], of: Statistics, top: int, layout: Layout):
    """``queries``: for each, the weight of its terms times their repeats."""
    schema = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, bool, int]]] = [[] for _ in queries]  # (-score, has an id, id), sorted
        for batch in batches:
            for row in range(batch.num_rows):
                n_docs, _, ids, lengths, present, sizes, places, counts = (c[row].as_py() for c in batch.columns)
                places, tf = np.frombuffer(places, "<u4").astype(np.int64), np.frombuffer(counts, "<u4").astype(np.int64)
                gains = gains_of(tf, np.array(lengths, np.int64)[places], of)
                ends = np.cumsum(sizes).tolist()
                lists = {
                    t: Posting.of(places[e - s : e], gains[e - s : e], n_docs, layout)
                    for t, s, e in zip(present, sizes, ends)
                }
                for q, weights in enumerate(queries):
                    kept = best[q]
                    floor = -kept[-1][0] if len(kept) == top else 1
                    own = [lists[t].times(w) for t, w in weights.items() if t in lists and w > 0]
                    at, scores = best_of_block(own, n_docs, top, floor, layout)
                    if len(at):
                        new = [(-s, ids[p] is not None, ids[p] or 0) for p, s in zip(at.tolist(), scores.tolist())]
                        best[q] = sorted(kept + new)[:top]
        rows = [(q, i if has else None, -s) for q, kept in enumerate(best) for s, has, i in kept]
        columns = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return search


# --- all items -----------------------------------------------------------------


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """The stated queries in blocks of bounded number and size, one block at a time on the driver."""
    rows, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        more = len(row.text or "") * 4
        if rows and (len(rows) == ITEMS or size + more > ITEM_BYTES):
            yield rows
            rows, size = [], 0
        rows.append((row.item_id, row.text))
        size += more
    if rows:
        yield rows


def _search_block(
    docs: DataFrame, items: list[tuple[int | None, str | None]], top: int, layout: Layout
) -> DataFrame:
    spark = docs.sparkSession
    asked = [Counter(terms(text)) for _, text in items]
    vocabulary = sorted(set().union(*asked))
    blocks = stored(docs.select("doc_id", "text").mapInArrow(_indexer(vocabulary, layout), BLOCKS), "postings")
    counts = blocks.select(F.size(F.filter("lengths", lambda n: n > 0)).alias("n"), "n_terms")
    total = counts.agg(F.sum("n"), F.sum("n_terms")).first()
    of = Statistics(int(total[0] or 0), int(total[1] or 0))
    # one row for each asked term
    lists = blocks.select(F.explode(F.arrays_zip("terms", "sizes")).alias("t"))
    df = dict(lists.groupBy("t.terms").agg(F.sum("t.sizes")).collect())
    number = {t: i for i, t in enumerate(vocabulary)}
    queries = [
        {number[t]: repeats * weight(df[number[t]], of) for t, repeats in query.items() if number[t] in df}
        for query in asked
    ]
    found = blocks.mapInArrow(_searcher(queries, of, top, layout), FOUND)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= top)
    names = spark.createDataFrame([(q, item_id) for q, (item_id, _) in enumerate(items)], "query int, item_id bigint")
    # at most ITEMS rows
    return ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, layout: Layout = Layout()) -> DataFrame:
    """The ``top`` best documents of each item with a score above 0: ``item_id, rank, doc_id, score``.

    Whole texts are read. A null or empty text has no terms: such an item finds nothing,
    such a document is not found and not counted. Equal scores go by id, null ids first.
    Rows that repeat an id are documents, or items, of their own. Items without a hit and empty
    tables give no rows. A very long text makes its block large, never a second one. Other
    columns are ignored, whatever their names.

    Items are the stated queries: they are sent to the tasks in blocks of at most 2,000 items
    and 16 MB, and each block reads the documents once.
    """
    parts = [_search_block(docs, block, top, layout) for block in _item_blocks(items)]
    if not parts:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, parts)


def op13_hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
