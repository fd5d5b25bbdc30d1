"""Repeated passages by suffix arrays that are sorted in two stages.

Every 50-byte string is dealt to the task of its anchor: the place of its least hash of 16
bytes. Equal strings have equal anchors, so all places of a string meet in one task, and
what is sent is one slice of text for each run of strings with the same anchor. Anchors
that no second text has are left out before any text is sent.

A task joins its distinct slices and sorts their suffixes in two stages: it sorts only
those that are smaller than their successors, then induces the others by scanning the
buckets of first bytes. Common prefixes of neighbours that reach 50 bytes mark equal
strings, whose least document is the one that keeps them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentaria.llm.common import discard, stored, table, width_of

STRING_BYTES = 50
ANCHOR_BYTES = 16
#: Bytes of text hashed at once, bytes of slices sorted at once, documents packed at once.
_PIECE = 1 << 18
SORT_BYTES = 2 << 20
_BATCH_BYTES = 16 << 20
#: Strings compared at once with the documents of their places.
_BLOCK_STRINGS = 1 << 20
#: Rows of one anchor that one task takes; an anchor with more is split over several.
SPLIT_ROWS = 20_000
_LAST = (1 << 63) - 1


# --- anchors -------------------------------------------------------------------


def _word_at(data: np.ndarray, n: int, shift: int) -> np.ndarray:
    """The eight bytes from each of ``n`` places, ``shift`` bytes further on, as one number."""
    out = np.empty(n, np.uint64)
    for k in range(min(8, n)):
        m = (n - k + 7) // 8
        out[k::8] = data[shift + k : shift + k + 8 * m].view("<u8")
    return out


def anchors(data: np.ndarray, string_bytes: int = STRING_BYTES) -> np.ndarray:
    """For each string of ``data``: hash (upper 44 bits) and place (lower 20) of its anchor.

    The least packed value is the least hash and, among equals, the leftmost place, so the
    choice depends on the string's own bytes only.
    """
    n = len(data) - ANCHOR_BYTES + 1
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    a, b = _word_at(data, n, 0), _word_at(data, n, 8)
    h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    least = (h & ~np.uint64(0xFFFFF)) | np.arange(n, dtype=np.uint64)
    reach, span = 1, string_bytes - ANCHOR_BYTES + 1
    while reach < span:
        step = min(reach, span - reach)
        least = np.minimum(least[: len(least) - step], least[step:])
        reach += step
    return least


def runs(text: bytes, string_bytes: int = STRING_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor hash, first string, last string)`` of the runs of a text's strings.

    A long text is hashed in pieces that overlap by a string; a run that a piece cuts
    becomes two, which changes nothing but where it is cut.
    """
    n = len(text) - string_bytes + 1
    data = np.frombuffer(text, np.uint8)
    found: list[tuple] = []
    for at in range(0, max(n, 0), _PIECE):
        least = anchors(data[at : at + _PIECE + string_bytes - 1], string_bytes)
        change = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        last = np.r_[change[1:], len(least)] - 1
        found.append(((least[change] >> np.uint64(20)).astype(np.int64), change + at, last + at))
    if not found:
        return (np.array([], np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


# --- two-stage suffix sorting --------------------------------------------------


def suffix_array(data: np.ndarray, depth: int, asked: tuple | None = None) -> np.ndarray:
    """Places of ``data`` in the order of their suffixes, compared to at least ``depth`` bytes.

    ``asked`` gives the first and last places of the ranges that are wanted: only these and
    what they are induced from are sorted.

    Stage one sorts the suffixes that are smaller than their successors. Stage two scans the
    buckets of first bytes in order and puts the predecessor of each suffix found, if it is
    greater than its successor, at the next free place of its own bucket. Suffixes equal to
    ``depth`` bytes may stand in any order.
    """
    n = len(data)
    if not n:
        return np.array([], np.int64)
    smaller = _smaller(data)
    direct = np.flatnonzero(smaller)
    if asked is None:
        wanted = np.ones(n, bool)
    else:
        # a greater suffix is induced from the next smaller one, through all places between
        first, last = asked
        source = np.r_[direct, n - 1][np.searchsorted(direct, last)]
        wanted = np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(source + 1, minlength=n + 1))[:n] > 0
        direct = direct[wanted[direct]]
    direct = _sorted_directly(data, direct, depth + 1)
    greater = wanted & ~smaller
    starts = np.searchsorted(data[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    # the last suffix is greater than its successor, the empty one, which is scanned before all
    if greater[n - 1]:
        induced[data[-1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        at = 0
        while at < len(induced[c]):
            _induce(data, greater, induced[c][at], induced)
            at += 1
        own = direct[starts[c] : starts[c + 1]]
        out += [*induced[c], own]
        induced[c] = []
        _induce(data, greater, own, induced)
    return np.concatenate(out)


def _induce(data, greater, scanned, induced) -> None:
    before = scanned[scanned > 0] - 1
    before = before[greater[before]]
    if not len(before):
        return
    keys = data[before]
    order = np.argsort(keys, kind="stable")
    before, keys = before[order], keys[order]
    cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    for a, b in zip(cuts, cuts[1:]):
        induced[keys[a]].append(before[a:b])


def _smaller(data: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor: the next unequal byte decides."""
    n = len(data)
    differs = np.r_[data[:-1] != data[1:], True]
    up = np.r_[data[:-1] < data[1:], False]
    at = np.where(differs, np.arange(n), n)
    return up[np.minimum.accumulate(at[::-1])[::-1]]


def _all_words(data: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes from every place and ``depth`` places on; zeros stand after the end."""
    n = len(data) + depth
    return _word_at(np.concatenate([data, np.zeros(depth + 16, np.uint8)]), n, 0)


def _sorted_directly(data: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in the order of ``depth`` bytes from each, eight bytes at a time, open ties only."""
    words = _all_words(data, depth).byteswap()
    order = places.copy()
    group = np.zeros(len(order), np.int64)
    open_ = np.arange(len(order))
    for shift in range(0, depth, 8):
        if not len(open_):
            break
        own, ranks = order[open_], group[open_]
        word = words[own + shift]
        by = np.lexsort((word, ranks)) if shift else np.argsort(word, kind="stable")
        own, word, ranks = own[by], word[by], ranks[by]
        order[open_] = own
        new = np.r_[True, (word[1:] != word[:-1]) | (ranks[1:] != ranks[:-1])]
        group[open_] = np.maximum.accumulate(np.where(new, open_, 0))
        tied = ~new
        tied[:-1] |= ~new[1:]
        open_ = open_[tied]
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Whether each suffix in ``order`` shares ``depth`` bytes with the one before it."""
    n = len(data)
    words = _all_words(data, depth)
    same = np.zeros(len(order), bool)
    if len(order) < 2:
        return same
    live = np.flatnonzero((order[1:] + depth <= n) & (order[:-1] + depth <= n)) + 1
    for shift in [*range(0, depth - 7, 8), depth - 8]:
        equal = words[order[live] + shift] == words[order[live - 1] + shift]
        live = live[equal]
    same[live] = True
    return same


def least_owners(slices: list[bytes], owners: np.ndarray, depth: int = STRING_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """The least owner of each string of each of ``slices`` among all of them, slice after slice.

    Also returns how many strings each slice has.
    """
    sizes = np.array([len(s) for s in slices])
    data = np.frombuffer(b"".join(slices), np.uint8)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    order = suffix_array(data, depth, (starts, ends - depth))
    slice_of = np.repeat(np.arange(len(slices)), sizes)[order]
    # suffixes that end within ``depth`` bytes of their slice are no strings
    whole = order + depth <= ends[slice_of]
    order, slice_of = order[whole], slice_of[whole]
    same = common_prefixes(data, order, depth)
    heads = np.flatnonzero(~same)
    least = np.full(len(data), _LAST)
    string = np.zeros(len(data), bool)
    string[order] = True
    if len(order):
        low = np.minimum.reduceat(owners[slice_of], heads)
        least[order] = np.repeat(low, np.diff(np.r_[heads, len(order)]))
    return least[string], sizes - depth + 1


# --- the Spark job -------------------------------------------------------------


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of Arrow batches in lists of about ``_BATCH_BYTES`` of text, the last column."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns[:-1]), batch.column(batch.num_columns - 1)):
            text = row[-1].as_py().encode("utf-8")
            held.append((*row[:-1], text))
            size += len(text)
            if size >= _BATCH_BYTES or len(held) >= 60_000:
                yield held
                held, size = [], 0
    if held:
        yield held


def _anchor_rows(buckets: int, string_bytes: int):
    """Rows ``(bucket, texts, owners, hashes)`` of a batch: packed arrays for each bucket.

    Anchors that two texts of the batch have go out with all these texts in bucket -1: they
    are shared already. Each other bucket gets every anchor of the batch once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _rows(batches):
            held = list(dict(held).items())
            found = [np.unique(runs(text, string_bytes)[0]) for _, text in held]
            texts = np.array([key for key, _ in held], np.int64)
            owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
            hashes = np.concatenate(found)
            order = np.argsort(hashes, kind="stable")
            hashes, owner = hashes[order], owner[order]
            new = np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)]
            again = ~new
            again[:-1] |= ~new[1:]
            out = [(-1, texts[owner[again]], hashes[again])]
            bucket = hashes[new] % buckets
            by = np.argsort(bucket, kind="stable")
            bucket, h, o = bucket[by], hashes[new][by], owner[new][by]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            for b in range(buckets):
                some = slice(cuts[b], cuts[b + 1])
                if some.start < some.stop:
                    # quotients of more than 32 bits are cut: two anchors may then look shared, which costs
                    # a needless comparison and changes no result
                    out.append((b, o[some].astype("<u2"), ((h[some] // buckets) & 0xFFFFFFFF).astype("<u4")))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _, _ in out], pa.int64()),
                    pa.array([texts.tobytes() if b >= 0 else b"" for b, _, _ in out], pa.binary()),
                    pa.array([o.tobytes() for _, o, _ in out], pa.binary()),
                    pa.array([h.tobytes() for _, _, h in out], pa.binary()),
                ],
                names=["bucket", "texts", "owners", "hashes"],
            )

    return run


def _shared(buckets: int):
    """``(text, anchor)`` of the anchors of a bucket that different texts of its batches have."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        bucket = int(group["bucket"].iloc[0])
        texts, values = [], []
        for t, o, h in zip(group["texts"], group["owners"], group["hashes"]):
            texts.append(np.frombuffer(t, np.int64)[np.frombuffer(o, "<u2")])
            values.append(np.frombuffer(h, "<u4"))
        texts, values = np.concatenate(texts), np.concatenate(values)
        order = np.argsort(values, kind="stable")
        texts, values = texts[order], values[order]
        heads = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
        differ = np.minimum.reduceat(texts, heads) != np.maximum.reduceat(texts, heads)
        again = np.repeat(differ, np.diff(np.r_[heads, len(values)]))
        return pd.DataFrame({"text_key": texts[again], "anchor": values[again].astype(np.int64) * buckets + bucket})

    return run


def _known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for owners, hashes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(owners, np.int64)), pa.array(np.frombuffer(hashes, np.int64))],
                names=["text_key", "anchor"],
            )


def _slices(buckets: int, string_bytes: int):
    """Rows ``(anchor, slice, owner, places)``: each distinct slice of a batch with its places.

    ``places`` packs text key, document and first string of every place; ``owner`` is the least document.
    """
    key_space = (1 << 32) * buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _rows(batches):
            seen: dict[tuple[int, bytes], int] = {}
            of, found = [], []
            for text_key, doc, wanted, text in held:
                hashes, first, last = runs(text, string_bytes)
                # as the anchors were packed: remainder and cut quotient
                packed = (hashes // buckets & 0xFFFFFFFF) * buckets + hashes % buckets
                exact = np.asarray(wanted, np.int64)
                pick = np.isin(packed, exact) | np.isin(hashes, exact)
                begin = first[pick]
                for h, a, b in zip(packed[pick].tolist(), begin.tolist(), last[pick].tolist()):
                    of.append(seen.setdefault((h, text[a : b + string_bytes]), len(seen)))
                place = np.empty((len(begin), 3), "<i8")
                place[:, 0], place[:, 1], place[:, 2] = text_key, doc, begin
                found.append(place)
            number = np.array(of, np.int64)
            places = np.concatenate(found)[np.argsort(number, kind="stable")]
            sizes = np.bincount(number, minlength=len(seen))
            ends = np.cumsum(sizes)
            owners = np.minimum.reduceat(places[:, 1], ends - sizes) if len(seen) else sizes
            flat, cuts = places.tobytes(), [0, *(24 * ends).tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([h for h, _ in seen], pa.int64()),
                    pa.array([s for _, s in seen], pa.binary()),
                    pa.array(owners, pa.int64()),
                    pa.array([flat[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                ],
                names=["anchor", "slice", "owner", "places"],
            )

    return run


def _removed(string_bytes: int):
    """Rows ``(text_key, start, stop)`` of the bytes that each place loses; input sorted by anchor and part."""

    def settle(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        number: dict[tuple, int] = {}
        owners: list[int] = []
        of = []
        for key, text, owner, _ in rows:
            k = number.setdefault((key, text), len(number))
            if k == len(owners):
                owners.append(owner)
            elif owner < owners[k]:
                owners[k] = owner
            of.append(k)
        least, n_strings = least_owners([text for _, text in number], np.array(owners), string_bytes)
        begin = np.cumsum(n_strings) - n_strings
        low, high = np.minimum.reduceat(least, begin), np.maximum.reduceat(least, begin)
        at = np.frombuffer(b"".join(places for *_, places in rows), "<i8").reshape(-1, 3)
        k = np.repeat(np.array(of), [len(places) // 24 for *_, places in rows])
        wholly = at[:, 1] > high[k]
        keys, starts, stops = [at[wholly, 0]], [at[wholly, 2]], [at[wholly, 2] + n_strings[k[wholly]] + string_bytes - 1]
        partly = np.flatnonzero(~wholly & (at[:, 1] > low[k]))
        blocks = np.cumsum(n_strings[k[partly]]) // _BLOCK_STRINGS
        for some in np.split(partly, np.flatnonzero(np.diff(blocks)) + 1):
            n = n_strings[k[some]]
            own = np.repeat(np.arange(len(some)), n)
            within = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            lost = least[begin[k[some]][own] + within] < at[some, 1][own]
            # a lost string that follows no lost one of its place opens a span, the last before another closes it
            first, last = within == 0, within == n[own] - 1
            opens = lost & (first | ~np.roll(lost, 1))
            closes = lost & (last | ~np.roll(lost, -1))
            keys.append(at[some, 0][own[opens]])
            starts.append(at[some, 2][own[opens]] + within[opens])
            stops.append(at[some, 2][own[closes]] + within[closes] + string_bytes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).astype(np.int64)) for x in (keys, starts, stops)],
            names=["text_key", "start", "stop"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for anchor, part, text, owner, places in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= SORT_BYTES and (anchor, part) != last:
                    yield from settle(rows)
                    rows, size = [], 0
                last = (anchor, part)
                rows.append((anchor, text, owner, places))
                size += len(text)
        if rows:
            yield from settle(rows)

    return run


def removed_spans(docs: DataFrame, owners: DataFrame, string_bytes: int = STRING_BYTES) -> DataFrame:
    """``(text_key, start, stop)``: byte ranges that different texts lose, overlapping; see ``dedup``.

    ``docs`` has ``text_key``, ``doc`` and ``text``, null ids and texts replaced; ``owners`` the
    least ``doc`` of each ``text_key``. One row of each text takes part.
    """
    spark = docs.sparkSession
    if string_bytes < ANCHOR_BYTES + 8:
        raise ValueError("strings must be longer than an anchor by 8 bytes or more")
    buckets = 2 * width_of(docs, 1.0)
    long_enough = docs.filter(F.octet_length("text") >= string_bytes)
    packed = stored(
        long_enough.select("text_key", "text").mapInArrow(
            _anchor_rows(buckets, string_bytes), "bucket bigint, texts binary, owners binary, hashes binary"
        ),
        "anchors",
    )
    pair = "text_key bigint, anchor bigint"
    across = packed.filter("bucket >= 0").groupBy("bucket").applyInPandas(_shared(buckets), pair)
    within = packed.filter("bucket < 0").select("owners", "hashes").mapInArrow(_known, pair)
    by_text = across.unionByName(within).groupBy("text_key").agg(F.collect_set("anchor").alias("wanted"))
    wanted = stored(
        by_text.join(owners, "text_key").select(F.col("text_key").alias("_key"), F.col("owner").alias("_owner"), "wanted"),
        "shared-anchors",
    )
    discard(packed)
    joined = long_enough.join(wanted, (F.col("text_key") == F.col("_key")) & (F.col("doc") == F.col("_owner")))
    slices = stored(
        joined.select("text_key", "doc", "wanted", "text").mapInArrow(
            _slices(buckets, string_bytes), "anchor bigint, slice binary, owner bigint, places binary"
        ),
        "slices",
    )
    del joined, by_text, across, within
    discard(wanted)
    busy = slices.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SPLIT_ROWS)
    busy = stored(busy.select("anchor", F.ceil(F.col("n") / SPLIT_ROWS).cast("int").alias("parts")), "busy-anchors")
    dealt = slices.join(busy, "anchor", "left").select(
        "anchor", F.pmod(F.xxhash64("places"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"), "slice", "owner", "places"
    )
    # every part of a busy anchor needs all its slices with their least owner, once each
    copies = (
        slices.join(busy, "anchor").groupBy("anchor", "slice").agg(F.min("owner").alias("owner"), F.max("parts").alias("parts"))
        .select("anchor", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "slice", "owner", F.lit(b"").alias("places"))
    )
    together = dealt.unionByName(copies)
    sorted_ = together.repartition(width_of(slices, 4.0), "anchor", "part").sortWithinPartitions("anchor", "part")
    removed = stored(sorted_.mapInArrow(_removed(string_bytes), "text_key bigint, start bigint, stop bigint"), "removed")
    del dealt, copies, together, sorted_
    discard(slices)
    return removed


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and checksum of what is left of each text."""
    for batch in batches:
        ids, out = batch.column(0), []
        for text, copy, spans in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3)):
            data = text.as_py().encode("utf-8")
            flat = [{"start": 0, "stop": len(data)}] if copy else spans.as_py()
            if not flat:
                out.append((len(data), 0, 0, hashlib.sha256(data).hexdigest()))
                continue
            at = np.array([(s["start"], s["stop"]) for s in flat], np.int64)
            at = at[np.argsort(at[:, 0], kind="stable")]
            reach = np.maximum.accumulate(at[:, 1])
            new = np.r_[True, at[1:, 0] > reach[:-1]]
            begins = at[new, 0]
            stops = reach[np.r_[np.flatnonzero(new)[1:] - 1, len(at) - 1]]
            kept = hashlib.sha256()
            for a, b in zip([0, *stops.tolist()], [*begins.tolist(), len(data)]):
                kept.update(data[a:b])
            out.append((len(data), int((stops - begins).sum()), len(begins), kept.hexdigest()))
        columns = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [ids, *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def dedup(docs: DataFrame, string_bytes: int = STRING_BYTES) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a string of ``string_bytes`` bytes that covers it also starts in a document
    with a smaller id. A null text is empty. Rows with a null id count as larger than all
    others and lose nothing to each other; rows that share an id never lose to each other.
    Texts shorter than a string stay. Equal texts are compared as
    one, by a 64-bit key of their content; all but those of the least document go wholly. Strings never cross documents, and all are judged on
    the input. Other columns are ignored.
    """
    keyed = docs.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(_LAST)).alias("doc"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("text_key", F.xxhash64("text", F.octet_length("text")))
    owners = keyed.groupBy("text_key").agg(F.min("doc").alias("owner"), F.count(F.lit(1)).alias("n"))
    owners = stored(owners, "text-owners")
    spans = removed_spans(keyed, owners, string_bytes).groupBy("text_key").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")
    )
    # texts that lose something: parts of them, or wholly in all rows but those of the least document
    losing = owners.join(spans, "text_key", "left").filter("n > 1 OR spans IS NOT NULL").select(
        F.col("text_key").alias("_key"), "owner", "spans"
    )
    losing = stored(losing, "losing-texts")
    copy = (F.col("doc") > F.col("owner")) & (F.octet_length("text") >= string_bytes)
    joined = keyed.join(losing, F.col("text_key") == F.col("_key"), "left").select(
        "doc_id", "text", F.coalesce(copy, F.lit(False)).alias("copy"), "spans"
    )
    return joined.mapInArrow(
        _kept, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )


def op3_two_stage_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
