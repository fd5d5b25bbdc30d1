"""Phrase collocation mining with mergeable Misra-Gries summaries.

The first pass counts hashes of word n-grams within chunks of text, deals the counts to hash
partitions and merges them there in a summary with more counters than the partition's
occurrences divided by the threshold: every n-gram that reaches the threshold keeps a
counter. Each chunk learns which of its own hashes survive, one bit for each, so no list of
survivors is sent to all tasks. The second pass counts the surviving n-grams exactly, by
their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentaria.llm.common import discard, stored, table, width_of

#: Words of the longest phrase, and occurrences of a candidate.
LONGEST = 3
LEAST = 10
#: A candidate goes if a longer one around it has this share of its occurrences, in per cent.
ABSORBED = 50
FIRST = 2000
_SLICES = 256
#: Bytes of text of one language that are counted together, and of all languages that wait in a task.
CHUNK_BYTES = 6 << 20
WAITING_BYTES = 48 << 20
#: Counters of a summary for each threshold of mass; one is enough, more let fewer rare n-grams through.
SLACK = 4
#: Bits of an n-gram's hash.
KEY_BITS = 56
#: Hashes that wait for a merge.
_MERGED_TOGETHER = 1 << 20

_END = b"\xff"  # the end of a piece; no byte of UTF-8
_FOLDED = bytes(
    c + 32 if 65 <= c <= 90 else _END[0] if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256)
)

CHUNKS = "chunk bigint, lang string, words bigint, vocabulary binary, ids binary"
SUMMARIES = "part int, chunk bigint, mass bigint, size int, counters binary"
SURVIVORS = "part int, chunk bigint, size int, survive binary"
COUNTS = "lang string, phrase string, words int, f bigint"


def _schema(fields: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in fields.split(", "))])


# --- chunks of numbered words --------------------------------------------------


class _Numbers(dict):
    """Numbers of words in the order of their first occurrence; 0 ends a piece."""

    def __init__(self):
        super().__init__({_END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def numbered_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of UTF-8 texts, and the number of every word; a 0 ends each piece.

    A number is the place in the list plus one.
    """
    words = _END.join(texts).translate(_FOLDED).replace(_END, b" \xff ").split()
    numbers = _Numbers()
    ids = np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words))
    return list(numbers)[1:], ids


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, waiting, sizes = _schema(CHUNKS), {}, {}
    first = TaskContext.get().partitionId() << 32
    made = 0

    def chunk(lang: str) -> pa.RecordBatch:
        nonlocal made
        words, ids = numbered_words(waiting.pop(lang))
        del sizes[lang]
        row = [first + made, lang, int(np.count_nonzero(ids)), _END.join(words), ids.tobytes()]
        made += 1
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            text = text.as_py()
            waiting.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text)
            if sizes[lang] >= CHUNK_BYTES:
                yield chunk(lang)
            elif sum(sizes.values()) >= WAITING_BYTES:
                yield chunk(max(sizes, key=sizes.get))
    for lang in list(waiting):
        yield chunk(lang)


# --- first pass: summaries by hash ---------------------------------------------


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_hashes(lang: str, words: list[bytes], ids: np.ndarray, longest: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length from one: the places where an n-gram of it begins, and their hashes."""
    seed = xxhash.xxh64_intdigest(lang.encode())
    of_word = np.fromiter(
        (xxhash.xxh64_intdigest(w, seed) for w in (b"", *words)), np.uint64, len(words) + 1
    )
    places = np.flatnonzero(ids)
    hashes = of_word[ids[places]]
    out = [(places, _spread(hashes) >> np.uint64(64 - KEY_BITS))]
    for n in range(2, longest + 1):
        goes_on = places + n - 1 < len(ids)
        goes_on[goes_on] = ids[places[goes_on] + n - 1] > 0
        places, hashes = places[goes_on], hashes[goes_on]
        hashes = _spread(hashes + np.uint64(n)) + of_word[ids[places + n - 1]]
        out.append((places, _spread(hashes) >> np.uint64(64 - KEY_BITS)))
    return out


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _edges(parts: int) -> np.ndarray:
    """Least key of each partition."""
    return np.array([(p << KEY_BITS) // parts for p in range(parts + 1)], np.uint64)


def to_bytes(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and their counts: steps between keys and counts, byte by byte of like weight.

    A chunk's steps need far fewer bytes than its keys, and equal leading bytes side by
    side compress.
    """
    out = []
    for numbers in (np.diff(keys, prepend=np.uint64(0)), counts.astype(np.uint64)):
        most = int(numbers.max(initial=0))
        n_bytes = max(1, (most.bit_length() + 7) // 8)
        planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n_bytes]
        out.append(bytes([n_bytes]) + planes.T.tobytes())
    return b"".join(out)


def from_bytes(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    read, out = 0, []
    for _ in range(2):
        n_bytes = data[read]
        planes = np.zeros((size, 8), np.uint8)
        planes[:, :n_bytes] = np.frombuffer(data, np.uint8, n_bytes * size, read + 1).reshape(n_bytes, size).T
        out.append(planes.reshape(-1).view("<u8"))
        read += 1 + n_bytes * size
    return np.cumsum(out[0], dtype=np.uint64), out[1].astype(np.int64)


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple[int, str, list[bytes], np.ndarray]]:
    for i in range(batch.num_rows):
        chunk, lang, vocabulary, ids = (batch.column(c)[i].as_py() for c in ("chunk", "lang", "vocabulary", "ids"))
        yield chunk, lang, vocabulary.split(_END) if vocabulary else [], np.frombuffer(ids, np.uint32)


def _summariser(parts: int, longest: int):
    schema = _schema(SUMMARIES)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = _edges(parts)
        for batch in batches:
            for chunk, lang, words, ids in _rows_of(batch):
                hashes = [h for _, h in ngram_hashes(lang, words, ids, longest)]
                keys, counts = counted(np.concatenate(hashes))
                cuts = np.searchsorted(keys, edges).tolist()
                rows = [
                    (p, chunk, int(counts[a:b].sum()), b - a, to_bytes(keys[a:b] - edges[p], counts[a:b]))
                    for p, (a, b) in enumerate(zip(cuts, cuts[1:]))
                    if a < b
                ]
                columns = list(zip(*rows)) or [()] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return summarise


class Summary:
    """A mergeable Misra-Gries summary of at most ``capacity`` counters.

    Merging adds counters; when there are too many, the count of the first that has no
    room is taken from all, and those that reach zero go. What was taken altogether is
    less than mass / capacity, and no count is short by more than that.
    """

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def merge(self, others: list[tuple[np.ndarray, np.ndarray]]) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in others)])
        counts = np.concatenate([self.counts, *(c for _, c in others)])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first) if len(keys) else counts
        over = len(self.keys) - self.capacity
        if over > 0:
            least = int(np.partition(self.counts, over - 1)[over - 1])
            stays = self.counts > least
            self.keys, self.counts = self.keys[stays], self.counts[stays] - least
            self.taken += least

    def reaching(self, threshold: int) -> np.ndarray:
        """Keys that may occur ``threshold`` times, sorted; every one that does is among them."""
        return self.keys[self.counts + self.taken >= threshold]


def _survivors(threshold: int):
    schema = _schema(SURVIVORS)

    def merged(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        mass = sum(rows["mass"].to_pylist())
        summary = Summary(SLACK * (mass // threshold + 1))
        sizes, counters = rows["size"].to_pylist(), rows["counters"]
        waiting, n = [], 0
        for size, data in zip(sizes, counters):
            waiting.append(from_bytes(data.as_py(), size))
            n += size
            if n >= max(_MERGED_TOGETHER, len(summary.keys)):
                summary.merge(waiting)
                waiting, n = [], 0
        summary.merge(waiting)
        if summary.taken >= threshold:
            raise RuntimeError("a summary took more than its capacity allows")
        found = summary.reaching(threshold)
        masks = []
        for size, data in zip(sizes, counters):
            keys, _ = from_bytes(data.as_py(), size)
            at = np.searchsorted(found, keys)
            at[at == len(found)] = 0
            masks.append(np.packbits(found[at] == keys).tobytes() if len(found) else b"")
        return pa.table([rows["part"], rows["chunk"], rows["size"], pa.array(masks, pa.binary())], schema=schema)

    return merged


# --- second pass: exact counts by words ----------------------------------------


def _exact(words: list[bytes], ids: np.ndarray, places: np.ndarray, n: int) -> Iterator[tuple[str, int]]:
    """Phrases of ``n`` words that begin at ``places``, with their counts, told apart by word numbers."""
    runs = np.stack([ids[places + i] for i in range(n)], axis=1)
    bits = max(1, len(words).bit_length())
    if n * bits <= 64:
        code = np.zeros(len(runs), np.uint64)
        for i in range(n):
            code = (code << np.uint64(bits)) | runs[:, i]
        code, counts = np.unique(code, return_counts=True)
        low = np.uint64((1 << bits) - 1)
        runs = np.stack([(code >> np.uint64(bits * (n - 1 - i))) & low for i in range(n)], axis=1)
    else:
        runs, counts = np.unique(runs, axis=0, return_counts=True)
    for run, count in zip((runs.astype(np.int64) - 1).tolist(), counts.tolist()):
        yield b" ".join([words[i] for i in run]).decode(), count


def _counter(longest: int):
    schema = _schema(COUNTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (_, lang, words, ids) in enumerate(_rows_of(batch)):
                survive = batch.column("survive")[i].as_py()
                places = ngram_hashes(lang, words, ids, longest)
                keys, _ = counted(np.concatenate([h for _, h in places]))
                # parts are runs of sorted keys, so their bits one after another are those of all keys
                bits = [
                    np.unpackbits(np.frombuffer(s["survive"], np.uint8), count=s["size"])
                    if s["survive"] else np.zeros(s["size"], np.uint8)
                    for s in sorted(survive, key=lambda s: s["part"])
                ]
                found = keys[np.concatenate(bits).astype(bool)] if bits else keys[:0]
                if not len(found):
                    continue
                for n, (at, hashes) in enumerate(places, 1):
                    near = np.searchsorted(found, hashes)
                    near[near == len(found)] = 0
                    rows = list(_exact(words, ids, at[found[near] == hashes], n))
                    if rows:
                        phrases, counts = zip(*rows)
                        size = len(rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * size), pa.array(phrases), pa.array([n] * size, pa.int32()),
                             pa.array(counts, pa.int64())],
                            schema=schema,
                        )

    return count


def chunks_of(docs: DataFrame) -> DataFrame:
    """Stored chunks of numbered words, each of one language (``und`` for none)."""
    given = docs.filter(F.length("text") > 0).select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return stored(given.mapInArrow(_chunks, CHUNKS), "chunks")


def frequent_ngrams(chunks: DataFrame, parts: int, longest: int = LONGEST, threshold: int = LEAST) -> DataFrame:
    """``(lang, phrase, words, f)`` of every n-gram with ``f >= threshold``, exactly counted."""
    summaries = chunks.select("chunk", "lang", "vocabulary", "ids").mapInArrow(_summariser(parts, longest), SUMMARIES)
    masks = stored(summaries.groupBy("part").applyInArrow(_survivors(threshold), SURVIVORS), "survivors")
    # a row for each hash partition of a chunk, one bit for each of its n-grams
    by_chunk = masks.groupBy("chunk").agg(F.collect_list(F.struct("part", "size", "survive")).alias("survive"))
    both = chunks.select("chunk", "lang", "vocabulary", "ids").join(by_chunk, "chunk")
    counts = both.mapInArrow(_counter(longest), COUNTS)
    exact = counts.groupBy("lang", "phrase").agg(F.first("words").alias("words"), F.sum("f").alias("f"))
    out = stored(exact.filter(F.col("f") >= threshold), "frequent")
    discard(masks)
    return out


def _cut(part: str, k: Column) -> Column:
    first = part == "left"
    words = F.split("phrase", " ")
    return F.array_join(
        F.slice(words, F.lit(1), k) if first else F.slice(words, k + 1, F.col("words") - k), " "
    )


def scored(frequent: DataFrame) -> DataFrame:
    """``(lang, phrase, words, a, l, r, score)`` of every phrase of two words or more, at its worst cut."""
    cuts = frequent.filter("words > 1").select(
        "lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    cuts = cuts.withColumn("left", _cut("left", F.col("k"))).withColumn("right", _cut("right", F.col("k")))
    for side, name in (("left", "l"), ("right", "r")):
        known = frequent.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        cuts = cuts.join(known, ["lang", side])
    exact = {c: F.col(c).cast("decimal(16,0)") for c in "alr"}
    cuts = cuts.withColumns({
        "above": F.lit(1_000_000).cast("decimal(7,0)") * (exact["a"] * exact["a"]), "below": exact["l"] * exact["r"],
    }).withColumn("score", F.expr("above div below"))
    worst = F.min(F.struct("score", "k", "l", "r"))
    return cuts.groupBy("lang", "phrase", "words", "a").agg(worst.alias("worst")).select(
        "lang", "phrase", "words", "a", "worst.l", "worst.r", "worst.score"
    )


def absorbed(frequent: DataFrame) -> DataFrame:
    """``(lang, phrase, within)``: the largest count of a longer candidate around a phrase."""
    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1),"
        " i -> array_join(slice(split(phrase, ' '), i, n), ' '))))"
    )
    parts = frequent.filter("words > 2").select("lang", F.explode(inner).alias("phrase"), "f")
    return parts.groupBy("lang", "phrase").agg(F.max("f").alias("within"))


def collocations(
    docs: DataFrame, longest: int = LONGEST, threshold: int = LEAST, share: int = ABSORBED, first: int = FIRST
) -> DataFrame:
    """The ``first`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Null and empty texts hold no words; a null language is ``und``, like the language of
    that name. Ids play no part, so null and repeated ones do not matter, and repeated rows
    count again. Equal scores go by ``a``, then by the phrase. A very long text is one chunk
    of its task. An empty table, or one without a phrase often enough, gives no rows. Other columns
    are ignored, whatever their names.
    """
    if longest < 2 or threshold < 1:
        raise ValueError("phrases have two words or more and occur")
    chunks = chunks_of(docs)
    words = chunks.groupBy("lang").agg(F.sum("words").alias("n"))  # a row for each language
    frequent = frequent_ngrams(chunks, width_of(docs, growth=6.0), longest, threshold)
    rows = scored(frequent).join(absorbed(frequent), ["lang", "phrase"], "left")
    kept = rows.filter(F.col("within").isNull() | (100 * F.col("within") < share * F.col("a")))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most rows: its first phrases are found in slices, and then among those
    slices = kept.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(_SLICES)))
    within = Window.partitionBy("lang", "slice").orderBy(*best)
    front = slices.withColumn("place", F.row_number().over(within)).filter(F.col("place") <= first)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")
    ranked = front.withColumn("rank", rank).filter(F.col("rank") <= first)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_misra_gries_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
