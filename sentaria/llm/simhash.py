"""SimHash near-duplicates by meeting in the middle of Hamming balls.

Two fingerprints within four bits meet at a value within two bits of both. Every distinct
fingerprint therefore emits all 2,081 values of its ball of radius two, and equal values
meet. The values are dealt out by their leading bits: what is shuffled is the fingerprint
once for every leading block that its ball touches, and the task of a block lists the
values inside it. Blocks with many fingerprints are split by the values' hash over more
tasks. All fingerprints that meet at one value are within four bits of each other, so each
value links its members to the least of them and no group is paired out.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentaria.llm.common import components, free_name, quoted, remove, sent_if_short, stored, table, wide_key

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
BITS = 64
#: Mean number of fingerprints for one leading block, and the most before a block is split.
BLOCK_FINGERPRINTS = 256
SPLIT_FINGERPRINTS = 1024
#: Values held at once by the task of a block.
HELD_VALUES = 4_000_000
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text: majority bits of its shingles' XXH64, repeats counted.

    A-Z are lower-cased, words are runs without ASCII white space. Fewer words than a
    shingle make one shingle of them all; no word at all, or null, gives zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - shingle_words]]
    hashed, seed = xxhash.xxh64_intdigest, SEED
    n, ones = len(starts), np.zeros(BITS, np.int64)
    last = ends[shingle_words - 1 :]
    for k in range(0, n, _CHUNK):
        values = np.array(
            [hashed(line[a : b - 1], seed) for a, b in zip(starts[k : k + _CHUNK], last[k : k + _CHUNK])],
            np.uint64,
        )
        ones += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` without its text, with ``fp``: the fingerprint as a signed long."""
    kept = [c for c in docs.columns if c != "text"]
    source = docs.select(*kept, F.col("text").alias("fp"))
    at = len(kept)
    schema = docs.select(*kept, F.lit(0).cast("bigint").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [_signed(fingerprint(t.as_py(), shingle_words)) for t in batch.column(at)]
            columns = [*batch.columns[:at], pa.array(values, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return source.mapInArrow(run, schema)


def _masks(bits: int, radius: int) -> list[tuple[int, int]]:
    """All ``(mask, bits set)`` of at most ``radius`` of ``bits`` bits."""
    return [
        (sum(1 << b for b in chosen), r)
        for r in range(radius + 1)
        for chosen in itertools.combinations(range(bits), r)
    ]


def _block_bits(n: int) -> int:
    return min(30, max(6, math.ceil(math.log2(max(n, 1) / BLOCK_FINGERPRINTS + 1))))


def _touched(block_bits: int, half: int):
    """Rows ``(block, used, fp)``: the leading blocks that a ball touches."""
    masks = _masks(block_bits, half)
    flips = np.array([m for m, _ in masks], np.uint64)
    used = np.array([r for _, r in masks], np.int8)
    shift = np.uint64(BITS - block_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), 4096):
                part = fps[at : at + 4096]
                blocks = ((part >> shift)[:, None] ^ flips[None, :]).ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(blocks.astype(np.int64)),
                        pa.array(np.tile(used, len(part))),
                        pa.array(np.repeat(part, len(flips)).view(np.int64)),
                    ],
                    names=["block", "used", "fp"],
                )

    return run


def _least(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index reachable from each of ``n`` over links ``a``-``b``."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def _meet(block_bits: int, half: int):
    """Links of one block (or one part of it): each fingerprint with the least it reaches."""
    rest = BITS - block_bits
    low = np.uint64((1 << rest) - 1)
    flips = [np.array([m for m, _ in _masks(rest, half - r)], np.uint64) for r in range(half + 1)]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        # shifting the sign bit makes unsigned comparison agree with the signed longs
        fps, where = np.unique(group["fp"].to_numpy(), return_inverse=True)
        used = group["used"].to_numpy()
        parts, part = int(group["parts"].iloc[0]), int(group["part"].iloc[0])
        label = np.arange(len(fps))
        mine = [np.unique(where[used == r]) for r in range(half + 1)]
        total = sum(len(m) * len(f) for m, f in zip(mine, flips)) // parts
        inner = max(1, math.ceil(total / HELD_VALUES))
        for k in range(inner):
            values, owners = [], []
            for own, flip in zip(mine, flips):
                step = max(1, HELD_VALUES // len(flip))
                for at in range(0, len(own), step):
                    some = own[at : at + step]
                    v = ((fps[some].view(np.uint64) & low)[:, None] ^ flip[None, :]).ravel()
                    o = np.repeat(some, len(flip))
                    if parts * inner > 1:
                        hashed = (v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                        here = hashed % np.uint64(parts * inner) == np.uint64(part + parts * k)
                        v, o = v[here], o[here]
                    values.append(v)
                    owners.append(o)
            v, o = np.concatenate(values), np.concatenate(owners)
            order = np.argsort(v, kind="stable")
            v, o = v[order], o[order]
            same = np.flatnonzero(v[1:] == v[:-1])
            a, b = o[same], o[same + 1]
            a, b = a[a != b], b[a != b]
            near = np.bitwise_count(fps[a].view(np.uint64) ^ fps[b].view(np.uint64)) <= 2 * half
            a, b = a[near], b[near]
            pair = np.unique(np.minimum(a, b) * len(fps) + np.maximum(a, b))
            label = _least(len(fps), np.concatenate([np.arange(len(fps)), pair // len(fps)]), np.concatenate([label, pair % len(fps)]))
        moved = np.flatnonzero(label != np.arange(len(fps)))
        return pd.DataFrame({"a": fps[moved], "b": fps[label[moved]]})

    return run


def linked_fingerprints(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp``, enough to connect all within ``radius`` bits.

    ``fps`` holds every distinct fingerprint once.
    """
    half = (radius + 1) // 2
    if radius != 2 * half:
        raise ValueError("the radius must be even")
    n = fps.count()
    bits = _block_bits(n)
    shift = BITS - bits
    crowded = (
        fps.groupBy(F.shiftrightunsigned("fp", shift).alias("block"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > SPLIT_FINGERPRINTS)
        .select("block", F.ceil(F.col("n") / SPLIT_FINGERPRINTS).cast("int").alias("parts"))
    )
    crowded = stored(crowded, "crowded-blocks")
    rows = fps.select("fp").mapInArrow(_touched(bits, half), "block bigint, used tinyint, fp bigint")
    parts = F.coalesce("parts", F.lit(1))
    dealt = rows.join(crowded, "block", "left").select(
        "block", "used", "fp", parts.alias("parts"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")
    )
    return dealt.groupBy("block", "part").applyInPandas(_meet(bits, half), "a bigint, b bigint")


def with_components(rows: DataFrame, id_column: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """``rows`` (with ``fp``), ``_root``, the component's least fingerprint, and ``component_id``.

    ``component_id`` is the least id among all rows reachable by links.
    """
    by_print = stored(rows.groupBy("fp").agg(F.min(id_column).alias("_least")), "fingerprints")
    links = linked_fingerprints(by_print.select("fp"), radius)
    roots = components(links, "fingerprint-links")
    rooted = stored(
        by_print.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", F.coalesce("root", "fp").alias("_root"), "_least"
        ),
        "rooted-fingerprints",
    )
    least = stored(rooted.groupBy("_root").agg(F.min("_least").alias("component_id")), "component-ids")
    named = stored(rooted.join(least, "_root").select("fp", "_root", "component_id"), "named-fingerprints")
    return rows.join(named, "fp", "left")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Null and empty texts have fingerprint zero and link like any other. Rows with a null id
    take part; a component of such rows alone has a null id. Repeated rows stay repeated.
    An empty table gives an empty result. Whole texts are read, and other columns are
    ignored, whatever their names.
    """
    rows = stored(fingerprints(docs.select("doc_id", "text")), "document-fingerprints")
    return with_components(rows, radius=radius).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that are the first of their component: one row of each group.

    First is the least id; rows without an id come last, and the text decides between rows of
    one id. Of rows with equal id and text one stays. Columns of any name stay as they are.

    What goes is a list of keys, sent to all executors while it is short; of whole rows, only
    those that repeat another are shuffled.
    """
    key, mark = free_name(docs.columns, "_row"), free_name(docs.columns, "_repeated")
    rows = docs.select("doc_id", "text", wide_key("doc_id", "text").alias("_row"))
    wide = stored(fingerprints(rows), "document-fingerprints")
    named = stored(with_components(wide, radius=radius), "document-components")
    # by the root, as components of null ids alone all have a null id
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    first = stored(named.groupBy("_root").agg(F.min_by("_row", order).alias("_first")), "first-rows")
    by_key = named.groupBy("_row").agg(F.first("_root").alias("_root"), F.count(F.lit(1)).alias("_rows"))
    judged = by_key.join(first, "_root").select(
        F.col("_row").alias(key), (F.col("_row") == F.col("_first")).alias("_stays"), (F.col("_rows") > 1).alias(mark)
    )
    judged = stored(judged.filter(F.col(mark) | ~F.col("_stays")), "judged-rows")
    remove(first)
    remove(named)
    gone = judged.filter("NOT _stays").select(key)
    repeated = judged.filter("_stays").select(key, mark)
    kept = docs.withColumn(key, wide_key("doc_id", "text")).join(sent_if_short(gone), key, "left_anti")
    kept = kept.join(sent_if_short(repeated), key, "left")
    single = kept.filter(F.col(mark).isNull())
    several = kept.filter(F.col(mark).isNotNull()).dropDuplicates([key])
    return single.unionByName(several).select(*[quoted(c) for c in docs.columns])


def op5_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
