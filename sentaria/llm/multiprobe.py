"""Approximate nearest neighbours by multiprobe p-stable hashing.

A vector's bucket in a table is the row of cells ``floor((a_i . x + b_i) / w)`` with Gaussian
``a_i``. A query visits its own bucket and then perturbed ones, cells moved by one, in the
order of their estimated chance: the sum of the squared distances to the cell borders that
a move crosses. All rows found in any table are ranked by their exact inner products.

Inner products become distances by the usual lift: stored vectors are scaled into the unit
ball and get one more coordinate that puts them on the sphere, queries are scaled to length
one and get a zero. A vector much shorter than the longest would land near the pole, where
cells tell little apart, so stored vectors are split into bands of alike norms. Each band
is scaled by its own longest vector and has its own tables, and a query visits all bands.
Bands of few rows are compared with every query, without tables.

Of rows with one and the same vector only the ``k + 1`` least ids are hashed: any other has
``k`` equals before it in every answer. A task reads its buckets one after another from
sorted rows, so it holds one block of rows and of queries at a time.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentaria.llm.common import stored, table, width_of

NEIGHBOURS = 20
QUERY_STEP = 20
TABLES = 5
#: Width of a cell on the unit sphere's scale.
CELL = 2.0
#: Functions of a table and buckets that a query visits in it, up to ``BASE_ROWS`` rows. Every
#: further factor of four in rows adds a function, so buckets keep their size, and with
#: it 2.2 times the visits, so they keep their chance.
BASE_ROWS, BASE_FUNCTIONS, BASE_VISITS, VISITS_GROWTH = 65_536, 5, 16, 2.2
#: Rows of one bucket, or queries of it, in one block; larger buckets are split into blocks.
SPLIT_ROWS = 1024
#: Rows of a run of norm bands that is compared with every query instead of being hashed.
SMALL_BAND = 1024
SEED = 11
_KEY = ("dims", "tab", "bucket")


def settings(n: int) -> tuple[int, int]:
    """Functions of a table and visits of a query for ``n`` rows."""
    more = max(0, math.ceil(math.log(max(n, 1) / BASE_ROWS, 4)))
    functions = BASE_FUNCTIONS + more
    return functions, min(3**functions, math.ceil(BASE_VISITS * VISITS_GROWTH**more))


def usable(vector: Column) -> Column:
    """Not null, not all zero, every component a finite number."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return vector.isNotNull() & ~F.exists(vector, odd) & F.exists(vector, lambda x: x != 0)


class Hashes:
    """The tables' functions for vectors of one length."""

    def __init__(self, dims: int, functions: int):
        rng = np.random.default_rng([SEED, dims, functions])
        self.lines = rng.normal(size=(TABLES, dims + 1, functions))
        self.shift = rng.uniform(0, CELL, (TABLES, functions))
        self.mix = rng.integers(1, 1 << 62, functions, dtype=np.int64) | 1

    def cells(self, lifted: np.ndarray, tab: int) -> tuple[np.ndarray, np.ndarray]:
        """Cell numbers and the place inside each cell, from 0 to 1."""
        at = (lifted @ self.lines[tab] + self.shift[tab]) / CELL
        low = np.floor(at)
        return low.astype(np.int64), at - low

    def bucket(self, cells: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (cells * self.mix).sum(-1)

    def visits(self, cells: np.ndarray, inside: np.ndarray, most: int) -> np.ndarray:
        """Buckets of each query in the order of their estimated chance."""
        out = np.empty((len(cells), most), np.int64)
        for i, (cell, x) in enumerate(zip(cells, inside)):
            out[i] = self.bucket(cell[None, :] + cheapest_moves(x, most))
        return out


def cheapest_moves(inside: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` rows of moves (-1, 0 or 1 for each function) of least cost, in the order of their cost.

    A move down costs the squared place inside the cell, one up the square of the rest. Sets
    of single moves come from a heap: with single moves sorted by cost, a set is followed by
    the one whose last move is the next in the order, and by the one that has that next move, too.
    """
    n = len(inside)
    single = sorted([(x * x, k, -1) for k, x in enumerate(inside.tolist())] + [((1 - x) ** 2, k, 1) for k, x in enumerate(inside.tolist())])
    cost = [c for c, _, _ in single]
    moves = np.zeros((most, n), np.int64)
    heap, found = [(cost[0], (0,))], 1  # the first row moves nothing
    while heap and found < most:
        total, chosen = heapq.heappop(heap)
        last, before = chosen[-1], chosen[:-1]
        clash = any(single[c][1] == single[last][1] for c in before)
        if not clash:
            for c in chosen:
                moves[found, single[c][1]] = single[c][2]
            found += 1
        if last + 1 < 2 * n:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*before, last + 1)))
            if not clash:  # a set that moves one function both ways stays one, whatever is added
                heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
    return moves[:found]


def _matrix(packed: pa.Array, dims: int) -> np.ndarray:
    """Vectors of one length from the bytes of their doubles."""
    return np.frombuffer(b"".join(packed.to_pylist())).reshape(-1, dims)


def band_numbers(squares: np.ndarray, longest: float) -> np.ndarray:
    """Norm bands from squared norms: 0 next to the longest, each 2 ** 0.25 shorter than the one before.

    Exact operations only, so every task gives a row the same band.
    """
    with np.errstate(divide="ignore", invalid="ignore"):
        part, power = np.frexp(squares / longest)
    # frexp gives 1 as 0.5 * 2 ** 1; half an octave of the square is one band
    return np.maximum(0, 2 * -power + (part < math.sqrt(0.5)) + (part == 0.5) * (power == 1)).astype(np.int64)


class Band:
    """Rows of neighbouring norm bands ``first`` to ``last`` with their tables, numbered from ``tab`` on."""

    def __init__(self, first: int, last: int, n: int, longest: float, tab: int):
        self.first, self.last, self.tab, self.whole = first, last, tab, n <= SMALL_BAND
        self.functions, self.most = settings(n)
        self.longest = math.sqrt(longest) * (1 + 1e-12)


def bands_of(counts: list[tuple[int, int, float]]) -> list[Band]:
    """Bands of one length's ``(number, rows, longest square)``; neighbours that are small together are one."""
    runs: list[list] = []
    for number, n, longest in sorted(counts):
        if runs and runs[-1][2] + n <= SMALL_BAND:
            runs[-1][1:3] = number, runs[-1][2] + n
        else:
            runs.append([number, number, n, longest])
    return [Band(*run, i * TABLES) for i, run in enumerate(runs)]


def _counted(longest: dict[int, float]):
    """Rows ``(dims, band, squares)`` of rows ``(dims, squares)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, squares = (batch.column(i).to_numpy() for i in range(2))
            most = np.array([longest[d] for d in dims.tolist()], float)
            columns = pa.array(dims, pa.int32()), pa.array(band_numbers(squares, most)), pa.array(squares)
            yield pa.RecordBatch.from_arrays(list(columns), names=["dims", "band", "squares"])

    return run


def _hashed(shape: dict[int, tuple[float, list[Band]]], queries: bool):
    """Rows ``(dims, tab, bucket, id, vec)`` of stored vectors or of queries' visits.

    Rows ``(id, vec, squares)`` come in; queries need no squared norms.
    """
    known: dict[tuple[int, int], Hashes] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                yield from hashed(*(column[at : at + 1000] for column in batch.columns))

    def hashed(ids: pa.Array, vectors: pa.Array, squares: pa.Array | None = None) -> Iterator[pa.RecordBatch]:
        sizes = vectors.value_lengths().to_numpy()
        flat = vectors.flatten().to_numpy()
        starts = np.cumsum(sizes) - sizes
        for dims in np.unique(sizes).tolist():
            longest, bands = shape[dims]
            every = np.flatnonzero(sizes == dims)
            if queries:
                for band in bands:
                    yield from of_band(band, dims, every, ids, flat, starts)
                continue
            numbers = band_numbers(squares.to_numpy()[every], longest)
            for band in bands:
                own = every[(numbers >= band.first) & (numbers <= band.last)]
                if len(own):
                    yield from of_band(band, dims, own, ids, flat, starts)

    def of_band(band: Band, dims: int, own: np.ndarray, ids: pa.Array, flat: np.ndarray, starts: np.ndarray):
        if (key := (dims, band.functions)) not in known:
            known[key] = Hashes(*key)
        hashes = known[key]
        x = flat[starts[own][:, None] + np.arange(dims)]
        packed = pa.array([row.tobytes() for row in x], pa.binary())
        norms = np.linalg.norm(x, axis=1)
        if queries:
            lifted = np.column_stack([x / norms[:, None], np.zeros(len(x))])
        else:
            rest = np.sqrt(np.maximum(0, 1 - (norms / band.longest) ** 2))
            lifted = np.column_stack([x / band.longest, rest])
        for tab in range(1 if band.whole else TABLES):
            if band.whole:
                buckets = np.zeros((len(own), 1), np.int64)
            else:
                cells, inside = hashes.cells(lifted, tab)
                buckets = hashes.visits(cells, inside, band.most) if queries else hashes.bucket(cells)[:, None]
            where = pa.array(np.repeat(np.arange(len(own)), buckets.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(where), dims, np.int32)),
                    pa.array(np.full(len(where), band.tab + tab, np.int32)),
                    pa.array(buckets.ravel()),
                    ids.take(pa.array(own)).take(where),
                    packed.take(where),
                ],
                names=[*_KEY, "id", "vec"],
            )

    return run


HASHED = "dims int, tab int, bucket bigint, id bigint, vec binary"


def exact_top(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int):
    """``(query_id, vec_id, score)`` of each query's ``k`` best rows, ties to the smaller id.

    A matrix product selects, a margin keeps all that could tie, and each pair left is
    summed again in one fixed order, so equal vectors get equal scores everywhere.
    """
    found = []
    longest = np.linalg.norm(rows, axis=1).max(initial=0.0)
    for at in range(0, len(queries), 256):
        q, ids = queries[at : at + 256], query_ids[at : at + 256]
        rough = q @ rows.T
        rough[ids[:, None] == row_ids[None, :]] = -np.inf
        keep = min(k, rough.shape[1])
        floor = np.partition(rough, rough.shape[1] - keep, axis=1)[:, rough.shape[1] - keep]
        # what rounding can move a product by goes with the lengths of both vectors
        margin = 1e-9 * np.linalg.norm(q, axis=1) * longest
        i, j = np.nonzero((rough >= (floor - margin)[:, None]) & (rough > -np.inf))
        for part in range(0, len(i), 65_536):
            a, b = i[part : part + 65_536], j[part : part + 65_536]
            found.append((ids[a], row_ids[b], np.multiply(q[a], rows[b]).sum(axis=1)))
    if not found:
        return np.array([], np.int64), np.array([], np.int64), np.array([])
    ids, vecs, scores = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((vecs, -scores, ids))
    ids, vecs, scores = ids[order], vecs[order], scores[order]
    first = np.r_[True, ids[1:] != ids[:-1]]
    rank = np.arange(len(ids)) - np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0))
    best = rank < k
    return ids[best], vecs[best], scores[best]


def _rerank(k: int):
    """Best rows of each query in each block; rows sorted by block and side come in, 0 for stored vectors."""

    def settle(block: list[pa.RecordBatch]) -> tuple | None:
        whole = pa.Table.from_batches(block).combine_chunks()
        is_query = whole["side"].to_numpy() == 1
        if is_query.all() or not is_query.any():
            return None
        x = _matrix(whole["vec"], whole["dims"][0].as_py())
        ids = whole["id"].to_numpy()
        return exact_top(x[is_query], ids[is_query], x[~is_query], ids[~is_query], k)

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = (np.concatenate(c) for c in zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, found, size = [], None, [], 0
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in _BLOCK])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for start, stop in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
                if start == stop:
                    continue
                key = keys[:, start].tolist()
                if held and key != last:
                    if (best := settle(held)) is not None:
                        found.append(best)
                        size += len(best[0])
                    held = []
                    if size >= 50_000:
                        yield batch_of(found)
                        found, size = [], 0
                held.append(batch.slice(start, stop - start))
                last = key
        if held and (best := settle(held)) is not None:
            found.append(best)
        if found:
            yield batch_of(found)

    return run


_BLOCK = (*_KEY, "row_part", "query_part")


def _in_blocks(rows: DataFrame, queries: DataFrame, k: int, tasks: int) -> DataFrame:
    """Best ``k`` rows of each query in each bucket both name; large buckets in blocks of both sides."""
    key = list(_KEY)
    count = lambda df, name: df.groupBy(*key).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > SPLIT_ROWS)
    n_rows, n_queries = stored(count(rows, "n"), "large-buckets"), stored(count(queries, "n"), "busy-buckets")
    parts = lambda df, name: df.select(*key, F.ceil(F.col("n") / SPLIT_ROWS).cast("int").alias(name))
    one = F.lit(1)
    own = lambda of: F.pmod(F.xxhash64("id", F.lit(of)), F.coalesce(of, one)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.coalesce(of, one) - 1))
    sized = lambda df: df.join(parts(n_rows, "rp"), key, "left").join(parts(n_queries, "qp"), key, "left")
    left = sized(rows).select(*key, own("rp").alias("row_part"), every("qp").alias("query_part"), F.lit(0).alias("side"), "id", "vec")
    right = sized(queries).select(*key, every("rp").alias("row_part"), own("qp").alias("query_part"), F.lit(1).alias("side"), "id", "vec")
    both = left.unionByName(right).repartition(tasks, *_BLOCK).sortWithinPartitions(*_BLOCK, "side")
    return both.mapInArrow(_rerank(k), "query_id bigint, vec_id bigint, score double")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of what the tables found, each pair of ids once."""
    pairs = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)


def _vectors_of_an_id(df: DataFrame) -> int:
    """The most rows that one id has."""
    return df.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 1


def _least_ids(rows: DataFrame, most: int) -> DataFrame:
    """Rows ``(id, vec)`` once each, and of one vector only those with the ``most`` least ids."""
    same = Window.partitionBy("vec").orderBy("id")
    once = rows.dropDuplicates(["vec", "id"])
    return once.withColumn("_at", F.row_number().over(same)).filter(F.col("_at") <= most).drop("_at")


def neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, id_column: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` nearest rows by inner product.

    Both tables carry ``id_column`` and ``column``. Rows with a null id and vectors that are
    null, zero or hold a null or non-finite component take no part; vectors meet only
    others of their length. A row never meets its own id; the score of two ids is the best
    over rows that repeat them. A query that finds fewer than ``k`` in its buckets is
    compared with all rows, in blocks, so it gets all there are. Other columns are ignored.
    """
    clean = lambda df: df.filter(F.col(id_column).isNotNull() & usable(F.col(column))).select(
        F.col(id_column).cast("bigint").alias("id"), F.col(column).cast("array<double>").alias("vec")
    )
    squares = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    rows = stored(_least_ids(clean(vectors), k + 1).withColumn("squares", squares), "distinct-vectors")
    asked = clean(queries)
    dims = F.size("vec").alias("dims")
    longest, n_rows = {}, 0
    for r in rows.groupBy(dims).agg(F.count(F.lit(1)).alias("n"), F.max("squares").alias("longest")).collect():
        longest[r["dims"]] = r["longest"]
        n_rows = max(n_rows, r["n"])
    numbered = rows.select(dims, "squares").mapInArrow(_counted(longest), "dims int, band bigint, squares double")
    counts = {}
    for r in numbered.groupBy("dims", "band").agg(F.count(F.lit(1)).alias("n"), F.max("squares").alias("most")).collect():
        counts.setdefault(r["dims"], []).append((r["band"], r["n"], r["most"]))
    shape = {d: (longest[d], bands_of(found)) for d, found in counts.items()}
    asked = stored(asked.filter(F.size("vec").isin(list(shape))).dropDuplicates(["vec", "id"]), "asked-vectors")
    # ids with several vectors take several of a block's places
    places = k * _vectors_of_an_id(rows) * _vectors_of_an_id(asked)
    tasks = width_of(rows, 4.0 * TABLES)
    indexed = rows.mapInArrow(_hashed(shape, False), HASHED)
    visits = asked.mapInArrow(_hashed(shape, True), HASHED)
    found = stored(_merged(_in_blocks(indexed, visits, places, tasks), k), "neighbours")
    full = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    short = stored(asked.join(full, asked["id"] == full["query_id"], "left_anti"), "short-queries")
    if short.isEmpty():
        return found.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    most = max(1, math.ceil(n_rows / SPLIT_ROWS))
    every = np.arange(most)

    def laid(side: int):
        """Rows in blocks by their ids, or each query once for every block."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for ids, vector in zip(batch.column(0), batch.column(1)):
                    packed = np.asarray(vector.as_py(), float)
                    blocks = every if side else every[[ids.as_py() % most]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(blocks), len(packed), np.int32)),
                            pa.array(np.full(len(blocks), -1, np.int32)),
                            pa.array(blocks),
                            pa.array([ids.as_py()] * len(blocks), pa.int64()),
                            pa.array([packed.tobytes()] * len(blocks), pa.binary()),
                        ],
                        names=[*_KEY, "id", "vec"],
                    )

        return run

    all_rows, everywhere = (df.mapInArrow(laid(side), HASHED) for side, df in enumerate((rows.drop("squares"), short)))
    rest = _merged(_in_blocks(all_rows, everywhere, places, tasks), k)
    both = found.join(full, "query_id", "left_semi").unionByName(rest)
    return both.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op1_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours(vectors, vectors.filter(F.col("vec_id") % QUERY_STEP == 0))
