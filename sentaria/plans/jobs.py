"""The two jobs users run, and both in a row.

``extract`` turns raw exports into datasets, ``load`` turns datasets into the served
store. Files are the hand-over between them, so each can be run on its own.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from sentaria.operators.integrity import keep_known
from sentaria.operators.quality import keep_trusted
from sentaria.plans.sizing import written
from sentaria.schemas import SCHEMAS
from sentaria.sinks.parquet import save_by_language, save_dataset
from sentaria.sinks.store import CorpusStore
from sentaria.sources.datasets import read_dataset, read_languages
from sentaria.sources.exports import (
    extract_audio,
    read_links,
    read_quality_ids,
    read_sentences,
    read_tags,
)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ExtractInputs:
    """Export files; an optional one that is None is left out of the job."""

    sentences: str
    links: str | None = None
    tags: str | None = None
    audio: str | None = None
    quality_ids: str | None = None
    file_format: str = "tsv"


def extract(
    spark: SparkSession,
    inputs: ExtractInputs,
    output_dir: str,
    languages: Iterable[str] | None = None,
    fetch: Callable[[str, str], object] | None = None,
    audio_dir: str = "audio",
    reusable_only: bool = True,
) -> None:
    """Write the language, quality and audio filtered datasets.

    Links and tags follow the quality list only; the chosen languages restrict
    sentences and audio here and the rest at load time. What is extracted is stored before it is
    sorted: a sort by ranges computes its input twice, and audio asks for the sentences again.
    """
    sentences = read_sentences(spark, inputs.sentences, languages, inputs.file_format)
    trusted = None
    if inputs.quality_ids:
        trusted = written(read_quality_ids(spark, inputs.quality_ids), "trusted")
        if trusted.isEmpty():
            log.warning("no trusted ids in %s; nothing is filtered", inputs.quality_ids)
        sentences = keep_trusted(sentences, trusted)
    sentences = written(sentences, "extracted")
    save_by_language(sentences, output_dir, "sentences")

    if inputs.links:
        links = read_links(spark, inputs.links, inputs.file_format)
        if trusted is not None:
            links = keep_trusted(links, trusted, "sentence_id", "translation_id")
        save_dataset(written(links, "extracted"), output_dir, "links")
    if inputs.tags:
        tags = read_tags(spark, inputs.tags, inputs.file_format)
        if trusted is not None:
            tags = keep_trusted(tags, trusted)
        save_dataset(written(tags, "extracted"), output_dir, "tags")
    if inputs.audio:
        audio = extract_audio(
            spark, inputs.audio, sentences.select("sentence_id"), fetch, audio_dir, reusable_only
        )
        save_dataset(written(audio, "extracted"), output_dir, "sentence_audio")


# Child datasets and the columns that must name a loaded sentence.
_CHILDREN = {
    "links": ("sentence_id", "translation_id"),
    "tags": ("sentence_id",),
    "sentence_audio": ("sentence_id",),
    "grammar_patterns": (),
    "sentence_grammar_patterns": ("sentence_id",),
}


def load(
    spark: SparkSession,
    datasets_dir: str,
    store_dir: str,
    languages: Iterable[str] | None = None,
    compact_into: str | None = None,
) -> CorpusStore:
    """Rebuild the served store from the datasets of the chosen languages (default all).

    Without any sentence the store is left as it is. A child dataset that was never
    extracted is skipped; children of sentences that were not loaded are dropped.
    """
    store = CorpusStore(spark, store_dir)
    chosen = list(languages or [])
    try:
        # rows without a language belong to "all"
        sentences = read_languages(spark, datasets_dir, chosen) if chosen else read_dataset(spark, datasets_dir)
    except FileNotFoundError:
        sentences = None
    if sentences is None or sentences.isEmpty():
        log.warning("no sentences for %s; nothing loaded", chosen or "any language")
        return store
    # all tables of the load show up together
    with store.rebuilding() as version:
        version.load_sentences(sentences)
        loaded = version.read("sentences")
        for table, id_columns in _CHILDREN.items():
            try:
                rows = read_dataset(spark, datasets_dir, table)
            except FileNotFoundError:
                log.info("no %s dataset to load", table)
                continue
            if id_columns:
                rows = keep_known(rows, loaded, *id_columns)
            version.load(table, rows.select(SCHEMAS[table].names))
    return store.compact(compact_into) if compact_into else store


def run(
    spark: SparkSession,
    inputs: ExtractInputs,
    output_dir: str,
    store_dir: str,
    languages: Iterable[str] | None = None,
    compact_into: str | None = None,
    **options,
) -> CorpusStore:
    """Extract, then load; with ``compact_into``, return the compacted copy."""
    extract(spark, inputs, output_dir, languages, **options)
    return load(spark, output_dir, store_dir, languages, compact_into)
