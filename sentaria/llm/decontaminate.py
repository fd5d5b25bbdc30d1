"""Benchmark decontamination by spaced-seed hashing, in DataFrame expressions only.

A mask marks positions of a short window of tokens that count and leaves the others out,
so a substituted word at a free position does not change the hash. Documents and benchmark
items are joined on such hashes; a hit fixes how the two lie on each other, and the tokens
around it are compared place by place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentaria.llm.common import free_name, quoted, sent_if_short, stored, table, wide_key

#: Positions that count, from the start of the window. Together they hit every window of 13
#: tokens with up to two substitutions (see the tests).
MASKS = ((0, 1, 2, 3, 5, 7), (0, 2, 3, 6, 7, 8))
#: Tokens of the compared window and the share of them that must agree.
WINDOW = 13
SHARE = 0.8
#: Rows of seeds (24 bytes each) up to which they are sent to all executors; more are joined by shuffle.
SENT_SEEDS = 1_000_000
#: Hits of one document that are verified together; more of them become several rows.
ROW_HITS = 256
_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits; null gives an empty list."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), _SPLIT)
    return F.filter(parts, lambda t: t != "")


def token_hashes(text: Column) -> Column:
    return F.transform(tokens(text), lambda t: F.xxhash64(t))


def runs(length: int, share: float = SHARE) -> list[tuple[int, int]]:
    """``(start, size)`` of runs of an item of ``length`` tokens, one of which every allowed substitution leaves whole.

    Of even runs, one more than tokens may differ, one holds none that does.
    """
    differ = max(n for n in range(length) if length - n >= length * share)
    cuts = [i * length // (differ + 1) for i in range(differ + 2)]
    size = length // (differ + 1)
    return [(at, size) for at in cuts[:-1]]


def _seeds(df: DataFrame, masks: list[tuple[int, ...]], *kept: str) -> DataFrame:
    """Rows ``(kept, at, seed)`` for every mask and every place where it fits ``toks``.

    The outer explodes keep Spark from deriving a filter on the size of their input, which
    would repeat the tokenising for every element; their null seeds join nothing.
    """
    n = F.size("toks")

    def hashed(mask: tuple[int, ...]) -> Column:
        span = mask[-1] + 1
        places = F.when(n >= span, F.sequence(F.lit(0), n - span)).otherwise(F.array().cast("array<int>"))
        one = lambda i: F.xxhash64(F.lit(str(mask)), *(F.get("toks", i + p) for p in mask))
        return F.transform(places, one)

    packed = df.select(*kept, F.array(*map(hashed, masks)).alias("_by_mask"))
    each = packed.select(*kept, F.explode_outer("_by_mask").alias("_seeds"))
    return each.select(*kept, F.posexplode_outer("_seeds").alias("at", "seed"))


def agreement(doc: Column, item: Column, shift: Column, window: int = WINDOW) -> Column:
    """Most tokens that agree in any window of ``item`` laid on ``doc`` from ``shift`` on.

    Items shorter than the window are one window. Places before or after the document
    agree with nothing.
    """

    def same(i: Column) -> Column:
        place = shift + i
        inside = (place >= 0) & (place < F.size(doc))
        return F.when(inside & (F.get(doc, F.greatest(place, F.lit(0))) == F.get(item, i)), 1).otherwise(0)

    width = F.least(F.lit(window), F.size(item))
    starts = F.sequence(F.lit(0), F.size(item) - width)
    agree = F.transform(F.sequence(F.lit(0), F.size(item) - 1), same)
    best = lambda a: F.array_max(
        F.transform(starts, lambda s: F.aggregate(F.slice(a, s + 1, width), F.lit(0), lambda n, x: n + x))
    )
    # one-element array: the flags are computed once and then read by every window
    return F.transform(F.array(agree), best)[0]


def overlaps(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """``(doc_id, item_id, agreeing, compared)`` for every document and item that overlap.

    They overlap if some ``window`` tokens of the item, or the whole item if it is
    shorter, lie on the document with at least ``share`` of them equal, and a mask hits there.
    Shorter items are found by :func:`runs`, which miss no allowed substitution; the masks
    miss none in a whole window at the share they were chosen for. ``agreeing`` is the best
    window's count, ``compared`` its length. Null and empty texts overlap nothing. Rows with
    null ids take part, repeated rows count once. Whole texts are read; the hits of a very long one
    are verified in parts. Other columns are ignored, whatever their names.
    """
    found = row_overlaps(docs, items, window, share)
    best = F.max(F.struct(F.try_divide("agreeing", "compared"), "agreeing", "compared")).alias("_best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("_best.agreeing").alias("agreeing"), F.col("_best.compared").alias("compared")
    )


def row_overlaps(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """``(row, doc_id, item_id, agreeing, compared)`` of every hit that :func:`overlaps` counts.

    ``row`` is the key of a row of ``docs`` (its id and text), so that rows without an id, or
    that repeat one, are told apart. An overlap may be found by several hits.
    """
    asked = items.select("item_id", token_hashes(F.col("text")).alias("toks")).distinct()
    asked = stored(asked.filter(F.size("toks") > 0), "benchmark-items")
    n = F.size("toks")
    # at most one length for each token short of a window
    short = sorted(r["n"] for r in asked.filter(n < window).select(n.alias("n")).distinct().collect())
    long = [m for m in MASKS if not asked.filter(n >= window).isEmpty()]
    masks = long + [tuple(range(z)) for z in sorted({z for length in short for _, z in runs(length, share)})]
    parts = [_seeds(asked.filter(n >= window), long, "item_id", "toks")] if long else []
    for length in short:
        for at, size in runs(length, share):
            own = asked.filter(n == length).withColumn("_all", F.col("toks"))
            part = own.select("item_id", "_all", F.slice("toks", at + 1, size).alias("toks"))
            found = _seeds(part, [tuple(range(size))], "item_id", "_all")
            parts.append(found.select("item_id", F.col("_all").alias("toks"), (F.col("at") + at).alias("at"), "seed"))
    if not parts:
        return _no_overlaps(docs, items)
    item_seeds = reduce(DataFrame.unionByName, parts).filter("seed IS NOT NULL").select(
        F.col("at").alias("item_at"), "seed", F.xxhash64("item_id", "toks").alias("item_key"),
        # a hit of a whole item agrees wherever it is: one for each document will do
        n.isin([length for length in short if len(runs(length, share)) == 1]).alias("whole"),
    )
    item_seeds = stored(item_seeds.distinct(), "benchmark-seeds")
    if item_seeds.count() <= SENT_SEEDS:
        item_seeds = F.broadcast(item_seeds)
    read = docs.select("doc_id", "text").select(
        F.xxhash64("doc_id", "text").alias("row"), token_hashes(F.col("text")).alias("toks")
    )
    hits = (
        _seeds(read, masks, "row").join(item_seeds, "seed")
        .select("row", "item_key", (F.col("at") - F.col("item_at")).alias("shift"), "whole")
        .groupBy("row", "item_key", F.when(~F.col("whole"), F.col("shift")).alias("_place"))
        .agg(F.min("shift").alias("shift")).drop("_place")
    )
    hits = stored(hits, "seed-hits")
    # only texts with hits are read again; a short list of them is known before
    of_row = stored(
        hits.groupBy("row").agg(F.ceil(F.count(F.lit(1)) / ROW_HITS).cast("int").alias("parts")), "rows-with-hits"
    )
    keyed = asked.select("item_id", F.col("toks").alias("item_toks"), F.xxhash64("item_id", "toks").alias("item_key"))
    part = F.pmod(F.xxhash64("item_key", "shift"), F.col("parts")).alias("part")
    dealt = hits.join(of_row, "row").select("row", part, "item_key", "shift")
    laid = dealt.join(keyed, "item_key").groupBy("row", "part").agg(
        F.collect_list(F.struct("item_id", "shift", "item_toks")).alias("_laid")
    )
    laid = stored(laid, "hits-by-row")
    again = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    again = again.join(sent_if_short(of_row), "row", "left_semi")
    both = again.join(laid, "row").select(
        wide_key("doc_id", "text").alias("row"), "doc_id", token_hashes(F.col("text")).alias("toks"), "_laid"
    )

    def compared(hit: Column) -> Column:
        return F.struct(
            hit["item_id"].alias("item_id"),
            agreement(F.col("toks"), hit["item_toks"], hit["shift"], window).alias("agreeing"),
            F.least(F.lit(window), F.size(hit["item_toks"])).alias("compared"),
        )

    found = both.select("row", "doc_id", F.transform("_laid", compared).alias("_found"))
    found = found.select("row", "doc_id", F.explode_outer("_found").alias("_f")).select("row", "doc_id", "_f.*")
    return found.filter(F.col("agreeing") >= F.col("compared") * share)


def _no_overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    none = docs.select(wide_key("doc_id", "text").alias("row"), "doc_id").limit(0).crossJoin(items.select("item_id").limit(0))
    return none.select("row", "doc_id", "item_id", F.lit(0).alias("agreeing"), F.lit(0).alias("compared"))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, with their columns, whatever their names.

    A row goes for its own text only: rows without an id, or that repeat one, are judged one by one.
    Null and empty texts stay.
    """
    name = free_name(docs.columns, "_row")
    dirty = stored(row_overlaps(docs, items).select(F.col("row").alias(name)).distinct(), "dirty-rows")
    keyed = docs.withColumn(name, wide_key("doc_id", "text"))
    return keyed.join(sent_if_short(dirty), name, "left_anti").select(*[quoted(c) for c in docs.columns])


def op2_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
