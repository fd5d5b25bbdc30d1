"""The registered queries, each over the whole tables of the given folder.

Long text is compared by its length and its digest, so results stay narrow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentaria.functions.scalar import is_reusable_license, word_count
from sentaria.operators import analytics, audio, integrity, quality, retrieval
from sentaria.operators.conform import conform, surrogate_ids
from sentaria.plans import jobs
from sentaria.plans.corpus_views import CorpusViews
from sentaria.plans.jobs import ExtractInputs
from sentaria.plans.sizing import TOKEN_GROWTH, dealt, scratch_path, spread, written
from sentaria.schemas import SCHEMAS
from sentaria.sinks.parquet import (
    CODEC,
    compact_dataset,
    save_by_language,
    save_dataset,
    save_partitioned,
    write_token_index,
)
from sentaria.sinks.store import CorpusStore
from sentaria.sources import exports
from sentaria.sources.datasets import (
    available_languages,
    read_dataset,
    read_language,
    read_languages,
    run_sql,
    union_by_name,
)
from sentaria.streaming.index_stream import batch_writer, update_index

ID = "sentence_id"
FREQUENT_PAIR = ["the", "Attion"]
FREQUENT_ANY = ["whereas", "attion", "eauouon"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def registered(plan: Callable[[CorpusViews], DataFrame]):
    """Register a plan under its function name as a ``(spark, folder)`` callable."""
    QUERIES[plan.__name__] = lambda spark, sf_dir: plan(CorpusViews(spark, sf_dir))
    return plan


def _brief(df: DataFrame) -> DataFrame:
    n_chars = F.char_length("text").cast("bigint").alias("n_chars")
    return df.select(ID, "language", n_chars, F.md5("text").alias("text_md5"))


# --- scans, filters, schema ----------------------------------------------------


@registered
def language_filter(v: CorpusViews) -> DataFrame:
    from sentaria.sources.exports import in_languages

    return _brief(in_languages(v.sentences, ["de", "fr"]))


@registered
def sentences_by_language(v: CorpusViews) -> DataFrame:
    return _brief(retrieval.sentences_in_language(v.sentences, "en"))


@registered
def long_sentences(v: CorpusViews) -> DataFrame:
    return _brief(analytics.longer_than(v.sentences, 1000))


@registered
def conform_sentences(v: CorpusViews) -> DataFrame:
    """An input with a foreign column, a missing one and another column order."""
    given = v.base("documents").select(
        "source", F.col("text"), F.col("lang").alias("language"), F.col("doc_id").alias(ID)
    )
    rows = conform(given, "sentences")
    return rows.select(
        ID, "language", F.md5("text").alias("text_md5"),
        F.col("username").isNull().alias("no_username"),
        F.col("date_added").isNull().alias("no_date_added"),
    )


@registered
def conform_audio(v: CorpusViews) -> DataFrame:
    given = v.base("events").select(
        F.col("user_id").alias(ID),
        F.col("event_id").cast("string").alias("audio_id"),
        F.nullif("event_type", F.lit("view")).alias("status"),
    )
    rows = conform(given, "sentence_audio")
    return rows.select(
        "source", "audio_id", ID, "status", F.col("license").isNull().alias("no_license")
    )


@registered
def list_languages(v: CorpusViews) -> DataFrame:
    return available_languages(v.sentences)


@registered
def union_languages(v: CorpusViews) -> DataFrame:
    """Per-language frames with different columns, aligned by name."""
    english = retrieval.sentences_in_language(v.sentences, "en").select(ID, "language", "username")
    french = retrieval.sentences_in_language(v.sentences, "fr").select("language", ID)
    return union_by_name([english, french])


@registered
def sql_passthrough(v: CorpusViews) -> DataFrame:
    return run_sql(
        v.spark,
        {"corpus_sentences": v.sentences},
        """SELECT language, username, count(*) AS n_sentences
           FROM corpus_sentences WHERE language IN (?, ?) AND char_length(text) >= ?
           GROUP BY language, username""",
        ["en", "es", 200],
    )


# --- tokens --------------------------------------------------------------------


def _index_summary(tokens: DataFrame) -> DataFrame:
    """One row per key; two aggregation levels instead of a distinct count."""
    per_sentence = tokens.groupBy("language", "normalized_token", ID).agg(
        F.count(F.lit(1)).alias("n"), F.sum("position").alias("p")
    )
    return per_sentence.groupBy("language", "normalized_token").agg(
        F.sum("n").alias("n_tokens"),
        F.count(F.lit(1)).alias("n_sentences"),
        F.sum("p").alias("position_sum"),
    )


def _stored_summary(tokens: DataFrame) -> DataFrame:
    """:func:`_index_summary` of a stored index, grouped by as many tasks as its rows need in memory."""
    keys = ("language", "normalized_token", ID)
    return _index_summary(dealt(tokens.select(*keys, "position"), *keys, growth=TOKEN_GROWTH))


@registered
def token_index(v: CorpusViews) -> DataFrame:
    return _index_summary(retrieval.token_rows(v.sentences, grouped=True))


_INDEX_PATHS: dict[tuple[str, str], str] = {}


def _stored_index(v: CorpusViews) -> DataFrame:
    """The stored index of the folder: built by the first query that asks, then shared."""
    key = (v.spark.sparkContext.applicationId, v.sf_dir)
    if key not in _INDEX_PATHS:
        path = scratch_path(v.spark, "token-index")
        write_token_index(retrieval.token_rows(v.sentences), path, languages=v.sentences)
        _INDEX_PATHS[key] = path
    return v.spark.read.schema(SCHEMAS["sentence_tokens"]).parquet(_INDEX_PATHS[key])


@registered
def stored_token_index(v: CorpusViews) -> DataFrame:
    return _stored_summary(_stored_index(v))


@registered
def stream_token_index(v: CorpusViews) -> DataFrame:
    """The documents arrive as files; a stream stores and indexes them."""
    base = scratch_path(v.spark, "stream")
    spread(v.sentences, ID).write.parquet(f"{base}/arriving")
    update_index(v.spark, f"{base}/arriving", f"{base}/store", f"{base}/checkpoints")
    return _stored_summary(CorpusStore(v.spark, f"{base}/store").read("sentence_tokens"))


@registered
def stream_distinct_sentences(v: CorpusViews) -> DataFrame:
    """Every document arrives twice; the stream keeps one row of each id."""
    base = scratch_path(v.spark, "stream")
    for _ in range(2):
        spread(v.sentences, ID).write.mode("append").option("compression", CODEC).parquet(f"{base}/arriving")
    update_index(
        v.spark, f"{base}/arriving", f"{base}/store", f"{base}/checkpoints", distinct_ids=True
    )
    return _brief(CorpusStore(v.spark, f"{base}/store").read("sentences"))


def _with_token_counts(store: CorpusStore) -> DataFrame:
    """The stored sentences and how many rows of the index each has."""
    n_tokens = store.read("sentence_tokens").groupBy(ID).agg(F.count(F.lit(1)).alias("n_tokens"))
    # digests are joined, not texts
    held = store.read("sentences").select(ID, "language", F.md5("text").alias("text_md5"))
    return held.join(n_tokens, ID, "left").select(
        ID, "language", "text_md5", F.coalesce("n_tokens", F.lit(0).cast("bigint")).alias("n_tokens")
    )


def _streamed_and_loaded(v: CorpusViews, stream_first: bool) -> DataFrame:
    """English documents arrive as a stream, all others as a batch, in one store."""
    base = scratch_path(v.spark, "mixed")
    english = F.col("language").eqNullSafe("en")
    spread(v.sentences.filter(english), ID).write.parquet(f"{base}/arriving")
    store = CorpusStore(v.spark, f"{base}/store")

    def load():
        store.load_sentences(v.sentences.filter(~english), rebuild=False)

    if not stream_first:
        load()
    update_index(v.spark, f"{base}/arriving", f"{base}/store", f"{base}/checkpoints")
    if stream_first:
        load()
    return _with_token_counts(store)


@registered
def store_stream_then_batch(v: CorpusViews) -> DataFrame:
    return _streamed_and_loaded(v, stream_first=True)


@registered
def store_batch_then_stream(v: CorpusViews) -> DataFrame:
    return _streamed_and_loaded(v, stream_first=False)


@registered
def store_rebuild_from_self(v: CorpusViews) -> DataFrame:
    """A store is rebuilt from its own French and Spanish rows."""
    store = CorpusStore(v.spark, scratch_path(v.spark, "store"))
    store.load_sentences(v.sentences)
    store.load_sentences(store.read("sentences").filter(F.col("language").isin("fr", "es")))
    return _with_token_counts(store)


@registered
def store_append_repeat(v: CorpusViews) -> DataFrame:
    """English is stored, then everything is appended: stored keys are refused, new ones are added."""
    store = CorpusStore(v.spark, scratch_path(v.spark, "store"))
    store.load_sentences(v.sentences.filter(F.col("language").eqNullSafe("en")))
    refused = store.load_sentences(v.sentences.withColumn("text", F.concat("text", F.lit(" again"))), rebuild=False)
    held = _with_token_counts(store).withColumn("n_refused", F.lit(0).cast("bigint"))
    return held.unionByName(refused.filter("stored").select(ID, F.col("n_rows").alias("n_refused")), allowMissingColumns=True)


@registered
def stream_interrupted(v: CorpusViews) -> DataFrame:
    """A micro-batch stops after a part of its rows and comes again; some rows have no id, many ids repeat."""
    base = scratch_path(v.spark, "stream")
    rows = v.sentences.withColumn(ID, F.when(F.col(ID) % 10 != 3, F.col(ID)))
    first = rows.filter(F.col("language").isin("en", "fr"))
    second = rows.filter(F.col("language").isin("fr", "de"))
    write = batch_writer(f"{base}/store", f"{base}/checkpoints")
    write(first, 0)
    write(second.filter("language = 'de'"), 1)
    write(second, 1)
    store = CorpusStore(v.spark, f"{base}/store")
    found = store.read("sentences").groupBy(ID, "language", F.md5("text").alias("text_md5"))
    tokens = store.read("sentence_tokens").groupBy("language").agg(F.count(F.lit(1)).alias("n_tokens"))
    return found.agg(F.count(F.lit(1)).alias("n_rows")).join(tokens, "language")


@registered
def normalize_query_tokens(v: CorpusViews) -> DataFrame:
    keys = retrieval.batch_keys(v.vocab_queries)
    return keys.select(
        "query_id",
        F.size("keys").cast("bigint").alias("n_tokens"),
        F.array_join("keys", " ").alias("tokens"),
    )


# --- vocabulary search ---------------------------------------------------------


def _search_ids(v: CorpusViews, words, language, match_all, limit, offset) -> DataFrame:
    keys = retrieval.resolve_query_tokens(v.spark, words)
    hits = retrieval.match_text(v.sentences, keys, language, match_all)
    return retrieval.page(hits.select(ID), limit, offset)


@registered
def vocab_match_all(v: CorpusViews) -> DataFrame:
    keys = retrieval.resolve_query_tokens(v.spark, FREQUENT_PAIR)
    return retrieval.match_text(v.sentences, keys, "en").select(ID)


@registered
def vocab_match_any(v: CorpusViews) -> DataFrame:
    keys = retrieval.resolve_query_tokens(v.spark, FREQUENT_ANY)
    return retrieval.match_text(v.sentences, keys, match_all=False).select(ID)


@registered
def vocab_paged(v: CorpusViews) -> DataFrame:
    return _search_ids(v, FREQUENT_PAIR, "en", True, 100, 5)


@registered
def vocab_deep_page(v: CorpusViews) -> DataFrame:
    """A page far into a list of hits in which ids repeat: every occurrence of a frequent word."""
    hits = retrieval.token_rows(v.sentences).filter(F.col("normalized_token") == "the").select(ID)
    page = retrieval.page(hits, 700, 450, top_rows=0)
    return page.groupBy(ID).agg(F.count(F.lit(1)).alias("n_hits"))


@registered
def index_match_all(v: CorpusViews) -> DataFrame:
    """Look the words up in the stored index."""
    keys = retrieval.resolve_query_tokens(v.spark, FREQUENT_PAIR)
    return retrieval.match_index(_stored_index(v), keys, "en")


@registered
def index_match_any(v: CorpusViews) -> DataFrame:
    keys = retrieval.resolve_query_tokens(v.spark, FREQUENT_ANY)
    return retrieval.match_index(_stored_index(v), keys, match_all=False)


@registered
def vocab_batch(v: CorpusViews) -> DataFrame:
    return retrieval.search_batch(v.vocab_queries, retrieval.key_rows(v.sentences))


@registered
def vocab_batch_any(v: CorpusViews) -> DataFrame:
    tokens = retrieval.key_rows(v.sentences)
    return retrieval.search_batch(v.vocab_queries, tokens, match_all=False, limit=20, offset=3)


@registered
def vocab_with_extras(v: CorpusViews) -> DataFrame:
    found = retrieval.search_vocabulary(
        v.tables(), ["THE", "of"], language="en", target_language="fr", limit=100
    )
    ends = ("first_translations", "last_translations")
    return found.summary().withColumns({c: F.coalesce(c, F.lit(-1)) for c in ends})


@registered
def index_with_extras(v: CorpusViews) -> DataFrame:
    """The same page found through a stored index."""
    tables = {**v.tables(), "sentence_tokens": _stored_index(v)}
    found = retrieval.search_vocabulary(tables, "the of", language="en", target_language="fr")
    ends = ("first_translations", "last_translations")
    return found.summary().withColumns({c: F.coalesce(c, F.lit(-1)) for c in ends})


@registered
def vocab_nested(v: CorpusViews) -> DataFrame:
    """A page of nested results without audio, with the children read back from the arrays."""
    found = retrieval.search_vocabulary(
        v.tables(), ["the", "of"], language="en", limit=50, offset=10, include_audio=False
    )
    copies = lambda name: F.aggregate(name, F.lit(0).cast("bigint"), lambda n, x: n + x["copies"])
    return found.nested().groupBy(F.col("sentence.sentence_id").alias(ID)).agg(
        F.sum(copies("translations")).alias("n_translations"),
        F.sum(F.size("audio")).alias("n_audio"),
        F.sum(copies("grammar_patterns")).alias("n_grammar_patterns"),
    )


# --- lookups -------------------------------------------------------------------


def _translation_rows(rows: DataFrame) -> DataFrame:
    return rows.select(ID, "translation_id", "language", F.md5("text").alias("text_md5"))


@registered
def translations(v: CorpusViews) -> DataFrame:
    return _translation_rows(retrieval.translations_of(v.links, v.sentences))


@registered
def translations_target_lang(v: CorpusViews) -> DataFrame:
    """German translations of the trusted sentences."""
    return _translation_rows(
        retrieval.translations_of(v.links, v.sentences, written(v.quality_ids, "trusted"), target_language="de")
    )


@registered
def audio_by_sentence(v: CorpusViews) -> DataFrame:
    return retrieval.audio_of(v.sentence_audio, written(v.quality_ids, "trusted")).drop("local_path", "downloaded_at")


@registered
def grammar_by_sentence(v: CorpusViews) -> DataFrame:
    return retrieval.grammar_of(v.sentence_grammar_patterns, v.grammar_patterns, v.sentences)


@registered
def nested_translations(v: CorpusViews) -> DataFrame:
    """Nested per sentence, then read back from the arrays."""
    rows = retrieval.translations_of(v.links, v.sentences)
    nested = retrieval.nest_for(v.sentences, retrieval.nest(rows, retrieval.TRANSLATION_ORDER))
    total = F.aggregate("items", F.lit(0).cast("bigint"), lambda n, x: n + x["copies"])

    def end(at):
        item = F.try_element_at("items", F.lit(at))
        return F.when(F.size("items") > 0, F.struct(item["language"], item["translation_id"]))

    return nested.groupBy(ID).agg(
        F.sum(total).alias("n_translations"),
        F.sum(F.size("items")).alias("n_distinct"),
        F.coalesce(F.min(end(1))["translation_id"], F.lit(-1)).alias("first_translation"),
        F.coalesce(F.max(end(-1))["translation_id"], F.lit(-1)).alias("last_translation"),
    )


@registered
def nested_order(v: CorpusViews) -> DataFrame:
    """The place of every child in its parent's arrays, parts of seven children at most."""
    rows = retrieval.translations_of(v.links, v.sentences)
    nested = retrieval.nest(rows, retrieval.TRANSLATION_ORDER, part_rows=7)
    each = nested.select(ID, "part", F.posexplode("items").alias("place", "item"))
    return each.select(
        ID, (F.col("part") * 7 + F.col("place")).cast("bigint").alias("place"),
        "item.translation_id", "item.language", "item.copies", F.md5("item.text").alias("text_md5"),
    )


@registered
def nested_children(v: CorpusViews) -> DataFrame:
    """Audio and grammar of the first trusted sentences, read back from the nested page."""
    found = retrieval.search_vocabulary(v.tables(), ["the", "of"], language="en", include_translations=False)
    nested = found.nested().select(F.col(f"sentence.{ID}").alias(ID), "audio", "grammar_patterns")
    audio = nested.select(ID, F.explode("audio").alias("x")).select(
        ID, F.lit("audio").alias("kind"), F.col("x.audio_id").alias("key"),
        F.concat_ws("|", "x.username", "x.license", "x.download_url").alias("content"), "x.copies",
    )
    grammar = nested.select(ID, F.explode("grammar_patterns").alias("x")).select(
        ID, F.lit("grammar").alias("kind"), F.col("x.pattern_id").alias("key"),
        F.concat_ws("|", "x.name", "x.pattern_source", "x.evidence_text", "x.annotation_source").alias("content"), "x.copies",
    )
    return audio.unionByName(grammar).groupBy(ID, "kind", "key", "content").agg(F.sum("copies").alias("n_rows"))


@registered
def grouped_lookup(v: CorpusViews) -> DataFrame:
    """One call for the translations of many ids, some of them unknown: those of the benchmark's items."""
    asked = [row[0] for row in v.vocab_queries.select("query_id").collect()]
    nested = retrieval.grouped_translations(v.tables(), [*asked, *asked, 10**12])
    total = F.aggregate("items", F.lit(0).cast("bigint"), lambda n, x: n + x["copies"])
    return nested.groupBy(ID).agg(F.sum(total).alias("n_translations"))


@registered
def requested_ids(v: CorpusViews) -> DataFrame:
    asked = [row[0] for row in v.vocab_queries.select((F.col("query_id") / 3).cast("bigint")).collect()]
    return retrieval.requested(v.spark, asked)


@registered
def sentence_by_id(v: CorpusViews) -> DataFrame:
    return _brief(v.sentences.filter(F.col(ID) == 42))


@registered
def sentence_with_translations(v: CorpusViews) -> DataFrame:
    found = retrieval.sentence_with_translations(v.tables(), 7)
    return found.sentences.select(ID, F.col("language").alias("source_language")).join(
        found.translations.select(ID, "translation_id", "language"), ID, "left"
    )


@registered
def translation_pairs(v: CorpusViews) -> DataFrame:
    pairs = analytics.translation_pairs(v.sentences, v.links, "en", "fr")
    return pairs.select(
        ID, "translation_id",
        F.md5("source_text").alias("source_md5"), F.md5("target_text").alias("target_md5"),
    )


@registered
def tagged_sentences(v: CorpusViews) -> DataFrame:
    return _brief(analytics.tagged_sentences(v.sentences, v.tags, "OK"))


# --- quality -------------------------------------------------------------------


@registered
def quality_sentences(v: CorpusViews) -> DataFrame:
    return _brief(quality.keep_trusted(v.sentences, v.quality_ids))


@registered
def quality_links(v: CorpusViews) -> DataFrame:
    return quality.keep_trusted(v.links_raw, v.quality_ids, ID, "translation_id")


@registered
def quality_tags(v: CorpusViews) -> DataFrame:
    return quality.keep_trusted(v.tags, v.quality_ids)


@registered
def quality_flag(v: CorpusViews) -> DataFrame:
    return quality.flag_trusted(v.sentences.select(ID, "language"), v.quality_ids)


@registered
def quality_from_correctness(v: CorpusViews) -> DataFrame:
    return quality.ids_from_correctness(v.sentences_detailed)


@registered
def quality_retention(v: CorpusViews) -> DataFrame:
    report = quality.retention(v.sentences, v.quality_ids)
    return report.withColumn("kept_percent", F.round("kept_percent", 4))


@registered
def quality_union(v: CorpusViews) -> DataFrame:
    toxic = v.tags.filter(F.col("tag_name") == "toxic")
    return quality.add_ids(v.quality_ids, toxic)


@registered
def quality_id_count(v: CorpusViews) -> DataFrame:
    return quality.trusted_count(v.quality_ids)


# --- referential filtering -----------------------------------------------------


@registered
def loaded_links(v: CorpusViews) -> DataFrame:
    return integrity.keep_known(v.links_raw, v.sentences, ID, "translation_id")


@registered
def loaded_tags(v: CorpusViews) -> DataFrame:
    english = retrieval.sentences_in_language(v.sentences, "en")
    return integrity.keep_known(v.tags, english)


@registered
def loaded_audio(v: CorpusViews) -> DataFrame:
    english = retrieval.sentences_in_language(v.sentences, "en")
    rows = integrity.keep_known(v.sentence_audio, english)
    return rows.select("source", "audio_id", ID, "license", "status")


@registered
def loaded_annotations(v: CorpusViews) -> DataFrame:
    return integrity.keep_known(v.sentence_grammar_patterns, v.sentences)


# --- audio ---------------------------------------------------------------------


@registered
def audio_parse(v: CorpusViews) -> DataFrame:
    rows = audio.audio_rows(v.audio_export, allowed=v.sentences)
    return rows.drop("local_path", "downloaded_at")


@registered
def audio_license(v: CorpusViews) -> DataFrame:
    return v.audio_export.select("audio_id", is_reusable_license(F.col("license")).alias("reusable"))


@registered
def audio_download_plan(v: CorpusViews) -> DataFrame:
    stamp = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    planned = audio.plan_downloads(v.sentence_audio, "/audio/", fetched_at=stamp)
    stamped = F.col("downloaded_at").cast("string").alias("downloaded_at")
    return planned.select("audio_id", "local_path", stamped, "status")


# --- validation ----------------------------------------------------------------


@registered
def pk_duplicates(v: CorpusViews) -> DataFrame:
    """Order numbers repeat over the order lines, as ids would in a faulty export."""
    return integrity.duplicate_keys(v.links_raw, ID)


@registered
def composite_pk_duplicates(v: CorpusViews) -> DataFrame:
    by_user = v.sentence_audio.withColumn("audio_id", F.col("username"))
    return integrity.duplicate_keys(by_user, "source", "audio_id")


@registered
def not_null_violations(v: CorpusViews) -> DataFrame:
    """The users' licences stand in for a status that is partly missing."""
    rows = v.sentence_audio.withColumn("status", F.col("license"))
    return integrity.null_violations(rows, "sentence_audio")


@registered
def fk_violations(v: CorpusViews) -> DataFrame:
    """Order lines as links, and benchmark passages in the token index that are no sentences."""
    alien = v.vocab_queries.select(
        (F.col("query_id") + 10_000_000).alias(ID), F.lit("en").alias("language"), F.col("words").alias("text")
    )
    known = retrieval.sentences_in_language(v.sentences, "es").select(ID, "language", "text")
    tokens = retrieval.token_rows(known.unionByName(alien))
    return integrity.reference_violations({**v.tables(), "links": v.links_raw, "sentence_tokens": tokens})


@registered
def length_violations(v: CorpusViews) -> DataFrame:
    rows = v.sentences.withColumn("username", F.col("text"))
    return integrity.length_violations(rows, "sentences")


# --- statistics ----------------------------------------------------------------


@registered
def count_by_language(v: CorpusViews) -> DataFrame:
    return analytics.count_by_language(v.sentences)


@registered
def tag_counts(v: CorpusViews) -> DataFrame:
    return analytics.count_tags(v.tags)


@registered
def table_row_counts(v: CorpusViews) -> DataFrame:
    return analytics.row_counts(v.tables())


@registered
def length_stats(v: CorpusViews) -> DataFrame:
    stats = analytics.length_statistics(v.sentences)
    return stats.withColumns(
        {c: F.round(c, 4) for c in ("mean_length", "std_length")}
    ).withColumns({c: F.col(c).cast("bigint") for c in ("min_length", "max_length")})


@registered
def top_words(v: CorpusViews) -> DataFrame:
    return analytics.top_words(v.sentences, 10)


@registered
def word_counts(v: CorpusViews) -> DataFrame:
    return spread(v.sentences, ID).select(ID, word_count(F.col("text")).cast("bigint").alias("n_words"))


# --- write paths ---------------------------------------------------------------


@registered
def write_read_roundtrip(v: CorpusViews) -> DataFrame:
    base = scratch_path(v.spark, "datasets")
    save_by_language(v.sentences, base)
    save_dataset(v.links, base, "links")
    degree = read_dataset(v.spark, base, "links").groupBy(ID).agg(F.count(F.lit(1)).alias("n_links"))
    english = read_language(v.spark, base, "sentences", "en")
    return _brief(english).join(degree, ID, "left").fillna(0, "n_links")


@registered
def partition_overwrite(v: CorpusViews) -> DataFrame:
    """A second write of shortened French rows leaves the other languages alone."""
    base = scratch_path(v.spark, "datasets")
    save_by_language(v.sentences, base)
    french = retrieval.sentences_in_language(v.sentences, "fr")
    save_by_language(french.withColumn("text", F.substring("text", 1, 10)), base)
    return _brief(read_languages(v.spark, base, ["en", "fr", "xx"]))


@registered
def partitioned_roundtrip(v: CorpusViews) -> DataFrame:
    base = scratch_path(v.spark, "datasets")
    save_partitioned(v.sentences.drop("date_added", "date_modified"), base, "by_source", "language", "username")
    return _brief(read_dataset(v.spark, base, "by_source").filter(F.col("language") == "de"))


@registered
def compact_roundtrip(v: CorpusViews) -> DataFrame:
    base, target = scratch_path(v.spark, "datasets"), scratch_path(v.spark, "compacted")
    save_by_language(v.sentences, base)
    return _brief(compact_dataset(v.spark, base, "sentences", target, "language"))


def _row_digest(df: DataFrame, *columns: str) -> DataFrame:
    """Row count, and the sum of a digest of every row, whatever their order."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(number).alias("digest"))


#: Columns by which a stored table is compared with what was loaded.
_DIGESTED = {
    "sentences": (ID, "language", "text", "username"),
    "sentence_tokens": (ID, "language", "normalized_token", "position"),
    "links": (ID, "translation_id"),
    "tags": (ID, "tag_name"),
    "grammar_patterns": ("pattern_id", "language", "name"),
    "sentence_grammar_patterns": (ID, "pattern_id", "evidence_text"),
    "sentence_audio": ("audio_id", ID, "license", "download_url"),
}


@registered
def store_load(v: CorpusViews) -> DataFrame:
    """Load every table into a served store, then digest the rows that each holds."""
    store = CorpusStore(v.spark, scratch_path(v.spark, "store"))
    store.load_sentences(v.sentences)
    for table, df in v.tables().items():
        if table != "sentences":
            store.load(table, df)
    return union_by_name([
        _row_digest(df, *_DIGESTED[table]).select(F.lit(table).alias("table_name"), "n_rows", "digest")
        for table, df in store.tables().items()
    ])


@registered
def store_compact(v: CorpusViews) -> DataFrame:
    """Five loads become one, in place."""
    store = CorpusStore(v.spark, scratch_path(v.spark, "store"))
    for k in range(5):
        store.load_sentences(v.sentences.filter(F.col(ID) % 5 == k), rebuild=False)
    return _with_token_counts(store.compact())


@registered
def clustered_order(v: CorpusViews) -> DataFrame:
    """Written files hold their rows in the order of ids."""
    base = scratch_path(v.spark, "datasets")
    save_dataset(v.links_raw, base, "links")
    rows = read_dataset(v.spark, base, "links").select(
        ID, F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("place")
    )
    before = F.lag(ID).over(Window.partitionBy("file").orderBy("place"))
    return rows.withColumn("before", before).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("before") > F.col(ID)).alias("n_out_of_order")
    )


@registered
def surrogate_id_count(v: CorpusViews) -> DataFrame:
    """Numbered links: every row has a number of its own."""
    rows = surrogate_ids(v.links_raw, after=5)
    each = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return each.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_ids"), (F.min("id") > 5).alias("after"))


# --- exports and jobs ----------------------------------------------------------


def _exported(v: CorpusViews, *names: str) -> str:
    """Export files written from the given tables: line breaks in texts become spaces, some texts are empty or missing."""
    base = scratch_path(v.spark, "exports")
    one_line = F.regexp_replace("text", "[\\t\\r\\n]", " ")
    text = F.when(F.col(ID) % 97 != 0, F.when(F.col(ID) % 89 == 0, "").otherwise(one_line))
    frames = {
        "sentences": v.sentences.select(ID, "language", text.alias("text")),
        "detailed": v.sentences.select(
            ID, "language", text.alias("text"), "username", F.lit("2021-02-03 04:05:06").alias("added"), F.lit(None)
        ),
        "links": v.links_raw,
        "tags": v.tags,
        "quality": v.quality_ids.select(F.concat(F.lit(" "), F.col(ID).cast("string"))),
    }
    for name in names:
        df = frames[name]
        fields = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in df.columns]
        df.select(F.concat_ws("\t", *fields).alias("value")).write.text(f"{base}/{name}")
    return base


def _audio_export(v: CorpusViews, base: str) -> str:
    """The audio export as text, absent fields at the end left out."""
    rows = v.audio_export
    user = F.col("sentence_id").cast("bigint")
    fields = [F.coalesce(c, F.lit("")) for c in ("sentence_id", "audio_id", "username", "license", "attribution_url")]
    line = F.when(user % 11 == 0, F.concat_ws("\t", *fields[:2])).when(user % 13 == 0, fields[0])
    rows.select(line.otherwise(F.concat_ws("\t", *fields)).alias("value")).write.option("compression", "bzip2").text(f"{base}/audio")
    return f"{base}/audio"


@registered
def export_sentences(v: CorpusViews) -> DataFrame:
    return _brief(exports.read_sentences(v.spark, f"{_exported(v, 'sentences')}/sentences", ["en", "fr", "xx"]))


@registered
def export_detailed(v: CorpusViews) -> DataFrame:
    base = _exported(v, "sentences", "detailed")
    rows = exports.read_detailed_sentences(v.spark, f"{base}/detailed", f"{base}/sentences")
    basic = exports.read_detailed_sentences(v.spark, f"{base}/none", f"{base}/sentences", ["de"])
    added = F.col("date_added").cast("string").alias("date_added")
    full = rows.select(ID, "language", F.md5("text").alias("text_md5"), "username", added, F.col("date_modified").isNull().alias("unmodified"))
    return full.unionByName(basic.select(ID, "language", F.md5("text").alias("text_md5")), allowMissingColumns=True)


@registered
def export_links(v: CorpusViews) -> DataFrame:
    return exports.read_links(v.spark, f"{_exported(v, 'links')}/links")


@registered
def export_tags(v: CorpusViews) -> DataFrame:
    return exports.read_tags(v.spark, f"{_exported(v, 'tags')}/tags")


@registered
def export_quality_ids(v: CorpusViews) -> DataFrame:
    base = _exported(v, "quality")
    v.sentences.select(F.md5("text").alias("value")).write.mode("append").text(f"{base}/quality")
    return exports.read_quality_ids(v.spark, f"{base}/quality")


@registered
def export_audio(v: CorpusViews) -> DataFrame:
    path = _audio_export(v, scratch_path(v.spark, "exports"))
    rows = exports.extract_audio(v.spark, path, allowed=v.sentences)
    return rows.drop("local_path", "downloaded_at")


@registered
def audio_fetch(v: CorpusViews) -> DataFrame:
    """Every licensed recording is fetched by a function handed in; each tenth fails."""
    base = scratch_path(v.spark, "recordings")

    def fetch(url: str, path: str) -> None:
        if url.endswith("7"):
            raise OSError("refused")
        with open(path, "w") as out:
            out.write(url)

    rows = audio.download(v.sentence_audio, base, fetch, fetched_at=F.to_timestamp(F.lit("2024-01-01 00:00:00")))
    path = F.regexp_replace("local_path", "^.*/recordings-[0-9a-f]+/", "")
    return rows.select("audio_id", "status", path.alias("path"), F.col("downloaded_at").isNotNull().alias("stamped"))


def _job_inputs(v: CorpusViews) -> ExtractInputs:
    base = _exported(v, "sentences", "links", "tags", "quality")
    return ExtractInputs(
        f"{base}/sentences", f"{base}/links", f"{base}/tags", _audio_export(v, base), f"{base}/quality"
    )


def _digests(tables: dict[str, DataFrame]) -> DataFrame:
    columns = {**_DIGESTED, "sentences": (ID, "language", "text")}
    return union_by_name([
        _row_digest(df, *columns[table]).select(F.lit(table).alias("table_name"), "n_rows", F.coalesce("digest", F.lit(0)).alias("digest"))
        for table, df in tables.items()
    ])


@registered
def job_extract(v: CorpusViews) -> DataFrame:
    """Trusted English and German sentences, and what belongs to trusted sentences."""
    out = scratch_path(v.spark, "datasets")
    jobs.extract(v.spark, _job_inputs(v), out, ["en", "de"])
    return _digests({t: read_dataset(v.spark, out, t) for t in ("sentences", "links", "tags", "sentence_audio")})


@registered
def job_load(v: CorpusViews) -> DataFrame:
    """All trusted sentences are extracted, the German ones loaded with what refers to them."""
    out = scratch_path(v.spark, "datasets")
    jobs.extract(v.spark, _job_inputs(v), out)
    return _digests(jobs.load(v.spark, out, scratch_path(v.spark, "store"), ["de", "xx"]).tables())


@registered
def job_run(v: CorpusViews) -> DataFrame:
    store = jobs.run(
        v.spark, _job_inputs(v), scratch_path(v.spark, "datasets"), scratch_path(v.spark, "store"), ["en", "fr"],
        compact_into=scratch_path(v.spark, "compacted"),
    )
    return _digests(store.tables())
