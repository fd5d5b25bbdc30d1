"""Near-duplicate lines by a segment-partition edit join.

Two lines within ``t`` edits agree on one of any ``t + 1`` segments of the longer one, at a
place that the edits allow. Every distinct line indexes the segments of its own length and
probes, for each length it may meet, the few substrings that can equal a segment there.
Pairs that meet are verified by a banded bit-parallel edit distance.

Lines travel twice: first their keys alone, packed, to find those that another line has;
then, once each, the texts of such lines, in blocks of both sides of a key. A block verifies its pairs
and returns the links of each line as a number and a forest that connects what it linked,
so that a group of lines that are all alike returns rows in proportion to its lines. A pair
is verified under the least of the keys it shares, and thus counted once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentaria.llm.common import components, discard, free_name, quoted, remove, sent_if_short, stored, table, wide_key, width_of

#: Edits (insertions, deletions, substitutions of characters) between near-duplicate lines.
EDITS = 2
#: Least characters of a line unless a caller asks for shorter ones; two edits of a shorter line change its meaning.
LEAST_CHARS = 20
#: Lines of each side of one key that a block verifies; a key with more becomes several blocks.
BLOCK_LINES = 512
#: Lines after which a task writes what it has counted so far.
_HELD_LINES = 50_000
#: Lines whose repeats a task leaves out while it hashes segments.
_SEEN_LINES = 1_000_000
#: Rows that lose lines, and such lines, up to which a list of them is sent to all executors.
SENT_ROWS, SENT_LINES = 500_000, 4_000_000


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """``(start, size)`` of the ``edits + 1`` even segments of a line; the last ones are longer."""
    size, longer = divmod(length, edits + 1)
    out, start = [], 0
    for i in range(edits + 1):
        own = size + (i >= edits + 1 - longer)
        out.append((start, own))
        start += own
    return out


def probes(length: int, other: int, edits: int) -> Iterator[tuple[int, int, int]]:
    """``(segment, start, size)`` of a line's substrings that may equal a segment of a line of ``other`` characters.

    ``other`` is at most ``length``. A substring is needed only if the edits before it and
    those after it can both stay within what the segments there leave over.
    """
    extra = length - other
    for i, (start, size) in enumerate(segments(other, edits)):
        low = max(0, start - i, start + extra - (edits - i))
        high = min(length - size, start + i, start + extra + (edits - i))
        for at in range(low, high + 1):
            yield i, at, size


def within(a: str, b: str, edits: int) -> int | None:
    """Edit distance of two lines if it is at most ``edits``, else None.

    Equal ends are cut off; what is left is compared with bit vectors as wide as the band
    of ``2 * edits + 1`` diagonals, one step for each character, and given up as soon as
    the band holds no value that is small enough.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > edits:
        return None
    start, stop = 0, len(b)
    while start < stop and a[start] == b[start]:
        start += 1
    cut = 0
    while cut < stop - start and a[len(a) - 1 - cut] == b[stop - 1 - cut]:
        cut += 1
    a, b = a[start : len(a) - cut], b[start : stop - cut]
    if not b:
        return len(a) if len(a) <= edits else None
    # bit d of reach[e]: diagonal d - edits is reached so far with e edits or fewer
    width = 2 * edits + 1
    full = (1 << width) - 1
    reach = [0] * (edits + 1)
    for e in range(edits + 1):
        for d in range(edits, edits + e + 1):
            reach[e] |= 1 << d  # the first characters of ``a`` left out
    for j, c in enumerate(b):
        same = 0
        for d in range(width):
            i = j + d - edits
            if 0 <= i < len(a) and a[i] == c:
                same |= 1 << d
        new = [reach[0] & same]
        for e in range(1, edits + 1):
            moved = (reach[e] & same) | reach[e - 1] | (reach[e - 1] >> 1)
            moved |= new[e - 1] << 1
            new.append(moved & full)
        if not new[edits]:
            return None
        reach = new
    goal = 1 << (len(a) - len(b) + edits)
    return next((e for e in range(edits + 1) if reach[e] & goal), None)


def _hash(edits: int, length: int, segment: int, text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), (length * (edits + 1) + segment) & 0xFFFFFFFF)


def _own_keys(edits: int, text: str) -> set[int]:
    """Hashes of the segments of a line."""
    n = len(text)
    return {_hash(edits, n, i, text[at : at + z]) for i, (at, z) in enumerate(segments(n, edits))}


def _probing_keys(edits: int, text: str, other: int) -> set[int]:
    """Hashes of the substrings that may equal a segment of a line of ``other`` characters."""
    return {_hash(edits, other, i, text[at : at + z]) for i, at, z in probes(len(text), other, edits)}


def _packed_keys(edits: int, least: int, buckets: int):
    """Rows ``(bucket, side, keys, lines)`` of many lines: side 0 indexes, side 1 probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                keys: tuple[list, list] = ([], [])
                lines: tuple[list, list] = ([], [])
                for number, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if number in seen:
                        continue
                    seen.add(number)
                    found = set()
                    for other in range(max(least, len(text) - edits), len(text) + 1):
                        found |= _probing_keys(edits, text, other)
                    for side, got in enumerate((_own_keys(edits, text), found)):
                        keys[side].extend(got)
                        lines[side].extend([number] * len(got))
                out = []
                for side in (0, 1):
                    h = np.array(keys[side], np.uint64)
                    of = np.array(lines[side], np.int64)
                    bucket = (h % np.uint64(buckets)).astype(np.int64)
                    order = np.argsort(bucket, kind="stable")
                    # a cut quotient makes some pairs meet in vain; they fail the comparison
                    short = ((h[order] // np.uint64(buckets)) & np.uint64(0xFFFFFFFF)).astype("<u4")
                    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                    for b in range(buckets):
                        some = slice(cuts[b], cuts[b + 1])
                        if some.start < some.stop:
                            out.append((b, side, short[some].tobytes(), of[order][some].tobytes()))
                if len(seen) >= _SEEN_LINES:
                    seen.clear()
                columns = list(zip(*out)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int8(), pa.binary(), pa.binary()))],
                    names=["bucket", "side", "keys", "lines"],
                )

    return run


def _meet(block_lines: int):
    """Rows ``(key, line, side, part, across)``: the lines of a bucket under each key that two lines have.

    ``part`` is the line's block on its own side of the key, ``across`` the number of blocks
    on the other side.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        unpack = lambda side, column, kind: np.concatenate(
            [np.frombuffer(x, kind) for x in group.loc[group["side"] == side, column]] or [np.array([], kind)]
        )
        bucket = np.int64(group["bucket"].iloc[0])
        keys, lines = [], []
        for side in (0, 1):
            key, line = unpack(side, "keys", "<u4"), unpack(side, "lines", np.int64)
            order = np.lexsort((line, key))
            key, line = key[order], line[order]
            # tasks that have the same line send its keys again
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])
            keys.append(key[new])
            lines.append(line[new])
        held = np.unique(keys[0])
        count = lambda key: np.searchsorted(key, held, side="right") - np.searchsorted(key, held)
        n = count(keys[0]), count(keys[1])
        # every line probes its own segments: a key that one line alone has holds it once on each side
        shared = (n[0] > 1) | (n[1] > 1)
        out = []
        for side in (0, 1):
            inside = np.flatnonzero(np.isin(keys[side], held[shared]))
            key = keys[side][inside]
            at = np.searchsorted(held, key)
            place = inside - np.searchsorted(keys[side], key)
            out.append(
                pd.DataFrame(
                    {
                        "key": key.astype(np.int64) | (bucket << 32), "line": lines[side][inside], "side": np.int8(side),
                        "part": (place // block_lines).astype(np.int32),
                        "across": (-(-n[1 - side][at] // block_lines)).astype(np.int32),
                    }
                )
            )
        return pd.concat(out)

    return run


def _verified(edits: int, buckets: int):
    """Rows ``(line, n, other)``: links of a line found here, or an edge of the forest that connects them.

    Rows ``(key, row_part, probe_part, side, line, text)`` come in, sorted by block and side.
    """

    def packed(hashes: set[int]) -> set[int]:
        return {h % buckets << 32 | h // buckets & 0xFFFFFFFF for h in hashes}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: dict[int, int] = {}
        root: dict[int, int] = {}
        edges: list[tuple[int, int]] = []
        probing: dict[tuple[int, int], set[int]] = {}

        def find(line: int) -> int:
            while (up := root.setdefault(line, line)) != line:
                root[line] = line = root[up]
            return line

        def written() -> pa.RecordBatch:
            columns = [*links, *(a for a, _ in edges)], [*links.values(), *[0] * len(edges)], [*[None] * len(links), *(b for _, b in edges)]
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["line", "n", "other"])
            for x in (links, root, edges):
                x.clear()
            return out

        def meet(key: int, y: int, text: str, indexed: list[tuple]) -> None:
            for x, other, own in indexed:
                longer = len(text) - len(other)
                if not 0 <= longer <= edits or (not longer and x >= y):
                    continue
                mine = probing.get((y, len(other)))
                if mine is None:
                    mine = probing[y, len(other)] = packed(_probing_keys(edits, text, len(other)))
                if min(own & mine, default=None) == key and within(text, other, edits) is not None:
                    links[x] = links.get(x, 0) + 1
                    links[y] = links.get(y, 0) + 1
                    a, b = find(x), find(y)
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        edges.append((x, y))

        block, indexed = None, []
        for batch in batches:
            for key, row_part, probe_part, side, line, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, row_part, probe_part) != block:
                    block, indexed = (key, row_part, probe_part), []
                    probing.clear()
                    if len(root) >= _HELD_LINES:
                        yield written()
                if side == 0:
                    indexed.append((line, text, packed(_own_keys(edits, text))))
                else:
                    meet(key, line, text, indexed)
        yield written()

    return run


def line_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, _row, line_no, text)``: the lines of every text, split at line feeds; null texts have none."""
    lines = F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text")
    return docs.select("doc_id", _row_key().alias("_row"), lines)


def line_key(text: Column | str) -> Column:
    return F.xxhash64(text)


def linked_lines(lines: DataFrame, edits: int = EDITS, least: int = LEAST_CHARS) -> DataFrame:
    """``(line, n, other)`` that tell how the distinct lines within ``edits`` are linked.

    Rows with a null ``other`` add ``n`` to the number of links of ``line``; the other rows are
    links ``line, other``, enough of them to connect all that links connect. ``lines`` has rows
    ``(line, text)`` of ``least`` characters or more, repeats among them, one number for each text.
    """
    buckets = 2 * width_of(lines, 1.0)
    packed = lines.mapInArrow(_packed_keys(edits, least, buckets), "bucket bigint, side tinyint, keys binary, lines binary")
    met = packed.groupBy("bucket").applyInPandas(
        _meet(BLOCK_LINES), "key bigint, line bigint, side tinyint, part int, across int"
    )
    met = stored(met, "met-lines")
    ids = stored(met.select("line").distinct(), "met-line-ids")
    # only lines that meet another are fetched, each of them once
    wanted = lines.join(sent_if_short(ids), "line", "left_semi")
    texts = stored(wanted.groupBy("line").agg(F.first("text").alias("text")), "met-texts")
    remove(ids)
    every = F.explode(F.sequence(F.lit(0), F.col("across") - 1)).alias("other_part")
    dealt = met.join(texts, "line").select("key", "side", "part", every, "line", "text")
    block = ["key", "row_part", "probe_part"]
    own = F.col("side") == 0
    dealt = dealt.select(
        "key", F.when(own, F.col("part")).otherwise(F.col("other_part")).alias("row_part"),
        F.when(own, F.col("other_part")).otherwise(F.col("part")).alias("probe_part"), "side", "line", "text",
    )
    dealt = dealt.repartition(width_of(texts, 8.0), *block).sortWithinPartitions(*block, "side")
    links = stored(dealt.mapInArrow(_verified(edits, buckets), "line bigint, n bigint, other bigint"), "line-links")
    remove(texts)
    discard(met)
    return links


def classes(
    docs: DataFrame, edits: int = EDITS, least: int = LEAST_CHARS, near: int | None = None
) -> DataFrame:
    """One row for each line of ``docs`` of ``least`` characters or more.

    ``doc_id, line_no, line, class_id, n_links, first``: the line's key, the key of its class,
    the number of other distinct texts within ``edits`` and whether this row is the class's
    first (least document id, then line number, then a key of id and text; null ids last).
    Classes are what links connect. Rows equal in id and text are one document: a line that is
    first is so in each of them.

    Lines of ``near`` characters or more are linked (``least`` if not given, at least one for
    each segment); a shorter one has no links, and its class is its own text. Columns of
    ``docs`` other than ``doc_id`` and ``text`` are ignored, whatever their names.
    """
    return _keyed_classes(docs, edits, least, near).drop("_row")


def _row_key() -> Column:
    """Key of a row of documents: rows without an id, or that repeat one, are told apart by their text."""
    return wide_key("doc_id", "text")


def _numbered_lines(docs: DataFrame, least: int) -> DataFrame:
    """:func:`line_rows` of ``least`` characters or more with the number ``line`` of each text.

    Numbers are hashes of 64 bits. Texts that share one, which happens among very many lines,
    are found by a second hash and take that as their number.
    """
    rows = line_rows(docs).filter(F.char_length("text") >= least)
    check = F.xxhash64(F.lit("second"), "text")
    rows = rows.withColumn("line", line_key("text"))
    both = rows.select("line", check.alias("check")).groupBy("line").agg(F.min("check").alias("x"), F.max("check").alias("y"))
    twins = stored(both.filter("x < y").select("line", F.lit(True).alias("twin")), "line-numbers-shared")
    if twins.isEmpty():
        remove(twins)
        return rows
    number = F.when(F.col("twin"), check).otherwise(F.col("line"))
    return rows.join(sent_if_short(twins), "line", "left").select(
        "doc_id", "_row", "line_no", "text", number.alias("line")
    )


def _keyed_classes(docs: DataFrame, edits: int, least: int, near: int | None) -> DataFrame:
    """:func:`classes` with the key ``_row`` of the row that a line is from."""
    near = max(least if near is None else near, edits + 1)
    rows = _numbered_lines(docs, least)
    links = linked_lines(rows.filter(F.char_length("text") >= near).select("line", "text"), edits, near)
    counts = links.filter("other IS NULL").groupBy("line").agg(F.sum("n").alias("n_links"))
    counts = stored(counts, "link-counts")
    edges = links.filter("other IS NOT NULL").select(F.col("line").alias("a"), F.col("other").alias("b"))
    roots = components(edges, "line-components")
    named = stored(
        counts.join(roots.withColumnRenamed("node", "line"), "line", "left").select(
            "line", F.coalesce("root", "line").alias("class_id"), "n_links"
        ),
        "line-classes",
    )
    remove(counts)
    discard(links)
    # lines without links are not in the list of classes
    placed = stored(
        rows.select("doc_id", "_row", "line_no", "line").join(sent_if_short(named), "line", "left").select(
            "doc_id", "_row", "line_no", "line", F.coalesce("class_id", "line").alias("class_id"),
            F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        ),
        "placed-lines",
    )
    remove(named)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "line_no", "_row")
    firsts = placed.groupBy("class_id").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_lines"))
    # the only line of its class is its first
    firsts = stored(firsts.filter("_lines > 1").drop("_lines"), "first-lines")
    return placed.join(sent_if_short(firsts), "class_id", "left").select(
        "doc_id", "_row", "line_no", "line", "class_id", "n_links",
        (F.col("_first").isNull() | (order == F.col("_first"))).alias("first"),
    )


def drop_repeated(
    docs: DataFrame, edits: int = EDITS, least: int = LEAST_CHARS, near: int | None = None
) -> DataFrame:
    """``docs`` without the lines whose class has an earlier line; all columns and rows stay.

    ``least`` and ``near`` as in :func:`classes`. Shorter lines and null texts stay as they are. A text all of whose lines go is empty.
    A row loses its own lines only, whatever rows without an id or with the same id lose; rows
    equal in id and text stay equal. Columns of any other name stay, also those named like
    internal ones.

    The list of what goes is sent to all executors while it is short; only if it is long are
    documents shuffled to meet it.
    """
    row, gone = free_name(docs.columns, "_row"), free_name(docs.columns, "_gone")
    lost = _keyed_classes(docs, edits, least, near).filter("NOT first").select(F.col("_row").alias(row), "line_no")
    lost = stored(lost.groupBy(row).agg(F.collect_set("line_no").alias(gone)), "repeated-lines")
    size = lost.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size(gone)), F.lit(0)).alias("lines")).first()
    if size["n"] <= SENT_ROWS and size["lines"] <= SENT_LINES:
        lost = F.broadcast(lost)
    joined = docs.withColumn(row, _row_key()).join(lost, row, "left")
    lines = F.split("text", "\n", -1)
    numbered = F.transform(lines, lambda t, i: F.when(~F.array_contains(gone, i), t))
    kept = F.array_join(F.array_compact(numbered), "\n")
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept)
    return joined.withColumn("text", text).select(*[quoted(c) for c in docs.columns])


def op9_segment_edit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that is not empty with its class, its links and whether it is its class's first.

    Lines from three characters on, one for each segment, are linked; one or two characters
    are within two edits of any other two, so such lines are grouped by their text.
    """
    docs = table(spark, sf_dir, "documents")
    return classes(docs, least=1, near=EDITS + 1).withColumnRenamed("first", "kept")
