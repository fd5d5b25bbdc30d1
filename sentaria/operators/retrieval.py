"""Vocabulary search and the lookups attached to its hits.

Lookups return flat rows, one per child, so a sentence with a huge number of
children is just many rows. :func:`nest` turns a page of them into arrays of bounded
length.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentaria.functions.text import (
    fold_case,
    normalized_tokens,
    query_tokens,
    resolve_query_tokens,
    split_tokens,
    text_contains,
)
from sentaria.operators.ranking import PLACE, PLACE_BITS, TOP_ROWS, page_of, places, total_order
from sentaria.plans.sizing import TOKEN_GROWTH, dealt, spread, written
from sentaria.schemas import SCHEMAS
from sentaria.sinks.keyed import narrowed, value_ranges

ID = "sentence_id"
_MASK_BITS = 62
# Whole sentences that one task may sort for a page.
ROW_PAGE = 1_000

# Order of the children of one sentence.
TRANSLATION_ORDER = ("language", "translation_id")
AUDIO_ORDER = ("source", "audio_id")
GRAMMAR_ORDER = ("pattern_id",)


# --- token index ---------------------------------------------------------------


def token_rows(sentences: DataFrame, grouped: bool = False) -> DataFrame:
    """One row per token occurrence: the rows of the inverted index.

    ``grouped`` deals the texts out by id, to tasks that can each group the tokens of theirs in memory.
    """
    texts = sentences.select(ID, "language", "text")
    texts = dealt(texts, ID, growth=TOKEN_GROWTH) if grouped else spread(texts, ID)
    # keys are made row by row in compiled code; a function over an array is interpreted
    tokens = texts.select(ID, "language", split_tokens(F.col("text")).alias("_tokens"))
    rows = tokens.select(ID, "language", F.posexplode("_tokens").alias("position", "token"))
    key = fold_case(F.col("token")).alias("normalized_token")
    return rows.select(ID, "language", "token", key, "position")


def key_rows(sentences: DataFrame) -> DataFrame:
    """One row per sentence and distinct key: enough to search, without positions."""
    keys = F.array_distinct(normalized_tokens(F.col("text")))
    return spread(sentences.select(ID, "language", "text"), ID).select(
        ID, "language", F.explode(keys).alias("normalized_token")
    )


def sentences_in_language(sentences: DataFrame, language: str | None) -> DataFrame:
    return sentences.filter(F.col("language") == language) if language else sentences


def match_index(
    sentence_tokens: DataFrame,
    keys: list[str],
    language: str | None = None,
    match_all: bool = True,
) -> DataFrame:
    """Ids of sentences holding all (or any) of the keys, from the token index.

    Language and keys are literals, so a stored index is read by partition and
    row-group statistics. Match-all gathers one bit per key while it groups by
    sentence: a single shuffle with map-side combine, however frequent a key is.
    """
    postings = sentences_in_language(sentence_tokens, language).filter(
        F.col("normalized_token").isin(keys)
    )
    if not match_all:
        return postings.select(ID).distinct()

    slot = F.array_position(F.array(*[F.lit(k) for k in keys]), F.col("normalized_token")) - 1
    words = range(-(-len(keys) // _MASK_BITS))
    masks = [
        F.bit_or(
            F.when(
                F.floor(slot / _MASK_BITS) == w,
                F.call_function("shiftleft", F.lit(1).cast("bigint"), (slot % _MASK_BITS).cast("int")),
            ).otherwise(F.lit(0).cast("bigint"))
        ).alias(f"mask_{w}")
        for w in words
    ]
    bits = [min(_MASK_BITS, len(keys) - w * _MASK_BITS) for w in words]
    complete = [F.col(f"mask_{w}") == F.lit((1 << bits[w]) - 1) for w in words]
    return postings.groupBy(ID).agg(*masks).filter(reduce(Column.__and__, complete)).select(ID)


def match_text(
    sentences: DataFrame,
    keys: list[str],
    language: str | None = None,
    match_all: bool = True,
) -> DataFrame:
    """The same hits straight from the text, as whole sentence rows.

    One scan and no shuffle; the better plan for a single question to a corpus that
    has no index yet.
    """
    chosen = spread(sentences_in_language(sentences, language), ID)
    return chosen.filter(text_contains(F.col("text"), keys, match_all))


def page(hits: DataFrame, limit: int = 100, offset: int = 0, top_rows: int = TOP_ROWS) -> DataFrame:
    """One page of hits by ascending sentence id, then by the other columns; see :func:`page_of`."""
    return page_of(hits, ID, limit, offset, top_rows)


# --- flat lookups --------------------------------------------------------------


def requested(spark: SparkSession, sentence_ids: int | Iterable[int]) -> DataFrame:
    """Distinct requested ids as a frame."""
    values = [sentence_ids] if isinstance(sentence_ids, int) else sentence_ids
    unique = dict.fromkeys(int(value) for value in values)
    return spark.createDataFrame([(value,) for value in unique], f"{ID} bigint")


def _only(children: DataFrame, ids: DataFrame) -> DataFrame:
    return children.join(ids.select(ID), ID, "left_semi")


def translations_of(
    links: DataFrame,
    sentences: DataFrame,
    ids: DataFrame | None = None,
    target_language: str | None = None,
) -> DataFrame:
    """Directed translations, one row per link row (repeated links give repeats).

    ``sentence_id`` is the source; the translation's own id is ``translation_id``.
    """
    if ids is not None:
        links = _only(links, ids)
    targets = sentences_in_language(sentences, target_language)
    return links.select(ID, "translation_id").join(
        targets.withColumnRenamed(ID, "translation_id"), "translation_id"
    ).select(ID, "translation_id", "language", "text", "username", "date_added", "date_modified")


def audio_of(sentence_audio: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Audio rows, of the given sentences only if ids are given."""
    rows = sentence_audio.select(SCHEMAS["sentence_audio"].names)
    return rows if ids is None else _only(rows, ids).select(rows.columns)


def grammar_of(
    sentence_grammar_patterns: DataFrame,
    grammar_patterns: DataFrame,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Annotations with their pattern; both source columns are kept under own names."""
    annotations = sentence_grammar_patterns.withColumnRenamed("source", "annotation_source")
    if ids is not None:
        annotations = _only(annotations, ids)
    patterns = grammar_patterns.withColumnRenamed("source", "pattern_source")
    return annotations.join(patterns, "pattern_id").select(
        ID, "pattern_id", "language", "name", "description", "pattern_text",
        "pattern_source", "metadata_json", "evidence_text", "confidence", "annotation_source",
    )


# --- nesting -------------------------------------------------------------------


def _ordered_parts(counted: DataFrame, order: tuple[str, ...], part_rows: int) -> DataFrame:
    """``counted`` with ``part``: the rows of each parent in order, ``part_rows`` to a part.

    Rows of all parents are sorted over tasks by parent and order, so that a parent of any
    size is spread. Their counts for each task and parent say where a task's rows of
    a parent begin, and so which part a row is in.
    """
    fields = [c for c in counted.columns if c not in (ID, *order)]
    kept, _ = places(counted, [ID, *order, *fields])
    task = F.shiftright(PLACE, PLACE_BITS).alias("task")
    runs = kept.groupBy(ID, task).agg(F.count(F.lit(1)).alias("n"), F.min(PLACE).alias("first"))
    before = Window.partitionBy(ID).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(ID, "task", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    ranked = kept.withColumn("task", task).join(runs, [ID, "task"])
    rank = F.col("begin") + F.col(PLACE) - F.col("first")
    return ranked.withColumn("part", F.floor(rank / part_rows).cast("int")).select(*counted.columns, "part")


def nest(children: DataFrame, order: tuple[str, ...], part_rows: int = 10_000) -> DataFrame:
    """Ordered arrays of children: ``sentence_id, part, items``.

    Identical children become one item with ``copies``, counted before the shuffle.
    A sentence with more than ``part_rows`` distinct children is returned in several parts
    that follow one another in order, so no array grows without bound and nothing is lost.
    """
    fields = [c for c in children.columns if c != ID]
    counted = written(children.groupBy(ID, *fields).agg(F.count(F.lit(1)).alias("copies")), "children")
    sizes = counted.groupBy(ID).agg(F.count(F.lit(1)).alias("n"))
    large = written(sizes.filter(F.col("n") > part_rows).select(ID), "large-parents")
    if large.isEmpty():
        dealt = counted.withColumn("part", F.lit(0))
    else:
        split = _ordered_parts(counted.join(large, ID, "left_semi"), order, part_rows)
        dealt = counted.join(large, ID, "left_anti").withColumn("part", F.lit(0)).unionByName(split)
    item = F.struct(
        F.struct(*order).alias("rank"), F.struct(*fields, "copies").alias("child")
    )
    return (
        dealt.groupBy(ID, "part")
        .agg(F.array_sort(F.collect_list(item)).alias("ranked"))
        .select(ID, "part", F.transform("ranked", lambda x: x["child"]).alias("items"))
    )


def nest_for(ids: DataFrame, nested: DataFrame) -> DataFrame:
    """Add an empty part for every requested id that has no children."""
    return ids.select(ID).distinct().join(nested, ID, "left").select(
        ID,
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("items", F.array().cast(nested.schema["items"].dataType)).alias("items"),
    )


#: Types of the nested arrays, for extras that were not asked for.
_NESTED = {
    "translations": (
        "array<struct<translation_id:bigint,language:string,text:string,username:string,"
        "date_added:timestamp,date_modified:timestamp,copies:bigint>>"
    ),
    "audio": "array<struct<"
    + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in SCHEMAS["sentence_audio"] if f.name != ID)
    + ",copies:bigint>>",
    "grammar_patterns": (
        "array<struct<pattern_id:string,language:string,name:string,description:string,"
        "pattern_text:string,pattern_source:string,metadata_json:string,evidence_text:string,"
        "confidence:double,annotation_source:string,copies:bigint>>"
    ),
}


# --- search --------------------------------------------------------------------


@dataclass(frozen=True)
class SearchResult:
    """A page of sentences and the flat rows attached to it; None where not asked for."""

    sentences: DataFrame
    translations: DataFrame | None = None
    audio: DataFrame | None = None
    grammar_patterns: DataFrame | None = None

    def _extras(self):
        yield "translations", self.translations, TRANSLATION_ORDER
        yield "audio", self.audio, AUDIO_ORDER
        yield "grammar_patterns", self.grammar_patterns, GRAMMAR_ORDER

    def summary(self) -> DataFrame:
        """Per sentence and extra: how many children, and the first and last of them."""
        out = self.sentences.select(ID)
        for name, rows, order in self._extras():
            if rows is None:
                out = out.withColumn(f"n_{name}", F.lit(0).cast("bigint"))
                continue
            key = F.struct(*order)
            ends = rows.groupBy(ID).agg(
                F.count(F.lit(1)).alias(f"n_{name}"),
                F.min(key)[order[-1]].alias(f"first_{name}"),
                F.max(key)[order[-1]].alias(f"last_{name}"),
            )
            out = out.join(ends, ID, "left").withColumn(
                f"n_{name}", F.coalesce(f"n_{name}", F.lit(0).cast("bigint"))
            )
        return out

    def nested(self, part_rows: int = 10_000) -> DataFrame:
        """``sentence, translations, audio, grammar_patterns`` per sentence.

        A sentence whose children need several parts appears once per part; a switched
        off or absent extra is an empty array.
        """
        lists = {
            name: nest(rows, order, part_rows)
            for name, rows, order in self._extras()
            if rows is not None
        }
        first = self.sentences.select(ID, F.lit(0).alias("part"))
        parts = reduce(
            DataFrame.union, [nested.select(ID, "part") for nested in lists.values()], first
        ).distinct()
        sentence = F.struct(*self.sentences.columns).alias("sentence")
        out = self.sentences.select(ID, sentence).join(parts, ID)
        for name, nested in lists.items():
            kind = nested.schema["items"].dataType
            out = out.join(nested.withColumnRenamed("items", name), [ID, "part"], "left").withColumn(
                name, F.coalesce(name, F.array().cast(kind))
            )
        for name, rows, _ in self._extras():
            if rows is None:
                out = out.withColumn(name, F.array().cast(_NESTED[name]))
        return out.select("sentence", "part", "translations", "audio", "grammar_patterns").orderBy(
            f"sentence.{ID}", "part"
        )


def near(children: DataFrame, ids: DataFrame, ranges: list[tuple] | None = None) -> DataFrame:
    """The children of a stored page of ids, from the row groups that may hold them.

    The page's ids become a few ranges of values in the scan's filter (``ranges``, if the
    caller has them already). The page itself is then joined by its real size.
    """
    narrow = narrowed(children, ID, value_ranges(ids.select(ID)) if ranges is None else ranges)
    return narrow.join(ids.select(ID), ID, "left_semi").select(children.columns)


def translations_near(
    links: DataFrame,
    sentences: DataFrame,
    ids: DataFrame,
    target_language: str | None = None,
    ranges: list[tuple] | None = None,
) -> DataFrame:
    """:func:`translations_of` a stored page of ids, without a shuffle of all sentences.

    The page's links are stored; their targets narrow the scan of sentences as the
    page's ids narrow that of links.
    """
    own = written(near(links.select(ID, "translation_id"), ids, ranges), "page-links")
    targets = sentences_in_language(sentences, target_language)
    return translations_of(own, narrowed(targets, ID, value_ranges(own.select("translation_id"))))


def search_vocabulary(
    tables: dict[str, DataFrame],
    words: str | Iterable[object],
    language: str | None = None,
    target_language: str | None = None,
    match_all: bool = True,
    include_translations: bool = True,
    include_audio: bool = True,
    include_grammar: bool = True,
    limit: int = 100,
    offset: int = 0,
) -> SearchResult:
    """Sentences holding exact words, with translations, audio and grammar.

    Uses ``tables["sentence_tokens"]`` when it is there and the sentence text when it
    is not. The sentences come in the order of their ids. The page is written to the
    scratch folder first, so the lookups share one search; they join it by its real size. ``target_language`` narrows translations,
    never the hits. No usable word means no hits.
    """
    sentences = tables["sentences"].select(SCHEMAS["sentences"].names)
    keys = resolve_query_tokens(sentences.sparkSession, words)
    if not keys:
        return SearchResult(sentences.limit(0))

    if "sentence_tokens" in tables:
        chosen = sentences_in_language(sentences, language)
        hits = match_index(tables["sentence_tokens"], keys, language, match_all)
        ids = written(page(hits, limit, offset), "page")
        found = written(near(chosen, ids), "found")
        if found.select(ID).distinct().count() < ids.count():
            # the index names sentences that are not there: they take no place in a page
            ids = written(page(_only(hits, chosen), limit, offset), "page")
            found = written(near(chosen, ids), "found")
    else:
        hits = match_text(sentences, keys, language, match_all)
        found = written(page(hits, limit, offset, ROW_PAGE), "page")
        ids = found.select(ID)

    translations = audio = grammar = None
    ranges = value_ranges(ids) if include_translations or include_audio or include_grammar else []
    if include_translations and "links" in tables:
        translations = translations_near(tables["links"], sentences, ids, target_language, ranges)
    if include_audio and "sentence_audio" in tables:
        audio = audio_of(near(tables["sentence_audio"], ids, ranges))
    if include_grammar and "sentence_grammar_patterns" in tables:
        grammar = grammar_of(near(tables["sentence_grammar_patterns"], ids, ranges), tables["grammar_patterns"])
    found = found.select(SCHEMAS["sentences"].names).orderBy(*total_order(found, ID))
    return SearchResult(found, translations, audio, grammar)


def sentence_with_translations(tables: dict[str, DataFrame], sentence_id: int) -> SearchResult:
    """One sentence and its direct translations; both empty for an unknown id."""
    sentences = tables["sentences"].select(SCHEMAS["sentences"].names)
    known = written(sentences.filter(F.col(ID) == F.lit(int(sentence_id))), "one-sentence")
    return SearchResult(known, translations_near(tables["links"], sentences, known.select(ID)))


# --- grouped lookups -----------------------------------------------------------


def _grouped(spark: SparkSession, sentence_ids, lookup, order: tuple[str, ...]) -> DataFrame:
    ids = written(requested(spark, sentence_ids), "asked-ids")
    return nest_for(ids, nest(lookup(ids), order))


def grouped_translations(
    tables: dict[str, DataFrame], sentence_ids: int | Iterable[int], target_language: str | None = None
) -> DataFrame:
    """``sentence_id, part, items``: the translations of each requested sentence, none as an empty array."""
    links, sentences = tables["links"], tables["sentences"]
    lookup = lambda ids: translations_near(links, sentences, ids, target_language)
    return _grouped(sentences.sparkSession, sentence_ids, lookup, TRANSLATION_ORDER)


def grouped_audio(tables: dict[str, DataFrame], sentence_ids: int | Iterable[int]) -> DataFrame:
    """``sentence_id, part, items``: the audio rows of each requested sentence, none as an empty array."""
    rows = tables["sentence_audio"]
    return _grouped(rows.sparkSession, sentence_ids, lambda ids: audio_of(near(rows, ids)), AUDIO_ORDER)


def grouped_grammar(tables: dict[str, DataFrame], sentence_ids: int | Iterable[int]) -> DataFrame:
    """``sentence_id, part, items``: the annotations of each requested sentence, none as an empty array."""
    rows, patterns = tables["sentence_grammar_patterns"], tables["grammar_patterns"]
    return _grouped(rows.sparkSession, sentence_ids, lambda ids: grammar_of(near(rows, ids), patterns), GRAMMAR_ORDER)


# --- batch search --------------------------------------------------------------


def _first_per_group(rows: DataFrame, group: str, count: int) -> DataFrame:
    """Rank by sentence id inside ``group`` and keep the first ``count`` ranks.

    Spark trims each map task to ``count`` rows before the shuffle (window group
    limit) up to a threshold. Beyond it the same is done here with a salted first
    round, so a group that holds most rows never meets one task unreduced.
    """
    whole = Window.partitionBy(group).orderBy(ID)
    threshold = int(
        rows.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    )
    if count > threshold:
        salted = rows.withColumn("salt", F.pmod(F.xxhash64(ID), F.lit(64)))
        local = Window.partitionBy(group, "salt").orderBy(ID)
        rows = salted.withColumn("rank", F.row_number().over(local)).filter(F.col("rank") <= count)
        rows = rows.drop("salt", "rank")
    return rows.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= count)


def batch_keys(queries: DataFrame) -> DataFrame:
    """``query_id, language, keys``; ``words`` may be a string or an array of strings."""
    is_list = queries.schema["words"].dataType.typeName() == "array"
    language = F.col("language") if "language" in queries.columns else F.lit(None)
    return queries.select(
        "query_id",
        language.cast("string").alias("query_language"),
        query_tokens(F.col("words"), is_list=is_list).alias("keys"),
    ).filter(F.size("keys") > 0)


def _in_language() -> Column:
    return F.col("query_language").isNull() | (F.col("query_language") == F.col("language"))


def search_batch(
    queries: DataFrame,
    sentence_tokens: DataFrame,
    match_all: bool = True,
    limit: int = 100,
    offset: int = 0,
) -> DataFrame:
    """Search for a whole table of queries: ``query_id, rank, sentence_id``.

    ``sentence_tokens`` is the token index, or :func:`key_rows` of the sentences.

    Match-all takes each query's rarest key, reads only that key's postings as
    candidates, and checks the candidates against the keys of their sentence. A
    frequent word therefore costs nothing unless a query has no rarer one.

    Match-any keeps, per key and language, only the first ``offset + limit`` ids:
    no later id of a key can enter a page.
    """
    last = int(offset) + int(limit)
    asked = written(batch_keys(queries), "batch-keys")
    exploded = asked.select("query_id", "query_language", F.explode("keys").alias("normalized_token"))
    vocabulary = exploded.select("normalized_token").distinct()
    postings = written(
        sentence_tokens.select(ID, "language", "normalized_token").join(
            vocabulary, "normalized_token", "left_semi"
        ),
        "postings",
    )
    if match_all:
        # of a query of one key only the first ids can enter a page, however frequent the key
        one = asked.filter(F.size("keys") == 1).select("query_id", "query_language", F.explode("keys").alias("normalized_token"))
        several = asked.filter(F.size("keys") > 1)
        if one.isEmpty():
            hits = _match_all_batch(asked, exploded, postings)
        else:
            more = exploded.join(several.select("query_id"), "query_id", "left_semi")
            hits = _match_all_batch(several, more, postings).unionByName(_match_any_batch(one, postings, last))
    else:
        hits = _match_any_batch(exploded, postings, last)
    return (
        _first_per_group(hits, "query_id", last)
        .filter(F.col("rank") > int(offset))
        .select("query_id", "rank", ID)
    )


def _match_all_batch(asked: DataFrame, exploded: DataFrame, postings: DataFrame) -> DataFrame:
    frequency = postings.groupBy("normalized_token").agg(F.count(F.lit(1)).alias("n_postings"))
    rarest = (
        exploded.join(frequency, "normalized_token", "left")
        .groupBy("query_id", "query_language")
        .agg(
            F.min_by(
                "normalized_token",
                F.struct(F.coalesce("n_postings", F.lit(0).cast("bigint")), "normalized_token"),
            ).alias("normalized_token")
        )
    )
    candidates = (
        postings.join(rarest, "normalized_token")
        .filter(_in_language())
        .select("query_id", ID)
        .distinct()
    )
    # Bounded per group: a sentence has at most as many keys as its text has words.
    held = (
        postings.join(candidates.select(ID), ID, "left_semi")
        .groupBy(ID)
        .agg(F.collect_set("normalized_token").alias("held"))
    )
    return (
        candidates.join(held, ID)
        .join(asked.select("query_id", "keys"), "query_id")
        .filter(F.size(F.array_except("keys", "held")) == 0)
        .select("query_id", ID)
    )


def _match_any_batch(exploded: DataFrame, postings: DataFrame, last: int) -> DataFrame:
    own = dealt(postings, *postings.columns, growth=TOKEN_GROWTH).distinct()
    keyed = own.withColumn("posting", F.struct("language", "normalized_token"))
    first = _first_per_group(keyed, "posting", last).drop("posting", "rank")
    return (
        exploded.join(first, "normalized_token")
        .filter(_in_language())
        .select("query_id", ID)
        .distinct()
    )
