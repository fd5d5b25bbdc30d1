"""Table schemas, keys and column rules of the sentence corpus.

Spark does not enforce keys at write time, so the keys, references and length
limits below are read by the validation reports in ``operators.integrity``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


_ID, _STR, _TS = LongType(), StringType(), TimestampType()

# Table and column names are the corpus' public data model.
SCHEMAS: dict[str, StructType] = {
    "sentences": _table(
        sentence_id=_ID, language=_STR, text=_STR, username=_STR, date_added=_TS, date_modified=_TS
    ),
    "sentence_tokens": _table(
        sentence_id=_ID, language=_STR, token=_STR, normalized_token=_STR, position=IntegerType()
    ),
    "links": _table(sentence_id=_ID, translation_id=_ID),
    "tags": _table(sentence_id=_ID, tag_name=_STR),
    "grammar_patterns": _table(
        pattern_id=_STR, language=_STR, name=_STR, description=_STR,
        pattern_text=_STR, source=_STR, metadata_json=_STR,
    ),
    "sentence_grammar_patterns": _table(
        sentence_id=_ID, pattern_id=_STR, evidence_text=_STR, confidence=DoubleType(), source=_STR
    ),
    "sentence_audio": _table(
        source=_STR, audio_id=_STR, sentence_id=_ID, username=_STR, license=_STR,
        attribution_url=_STR, download_url=_STR, local_path=_STR, downloaded_at=_TS, status=_STR,
    ),
}

# The only columns with a declared default.
DEFAULTS: dict[str, dict[str, str]] = {
    "sentence_audio": {"source": "tatoeba", "status": "metadata"},
}

# Parents before children.
LOAD_ORDER: tuple[str, ...] = tuple(SCHEMAS)

# Keys, required columns and references of the public data model.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "sentences": ("sentence_id",),
    "grammar_patterns": ("pattern_id",),
    "sentence_audio": ("source", "audio_id"),
}

REQUIRED: dict[str, tuple[str, ...]] = {
    "sentences": ("sentence_id", "language", "text"),
    "sentence_tokens": ("sentence_id", "language", "token", "normalized_token", "position"),
    "links": ("sentence_id", "translation_id"),
    "tags": ("sentence_id", "tag_name"),
    "grammar_patterns": ("pattern_id", "language", "name"),
    "sentence_grammar_patterns": ("sentence_id", "pattern_id"),
    "sentence_audio": ("source", "audio_id", "sentence_id", "status"),
}


class Reference(NamedTuple):
    """A child column whose values must exist in a parent key column."""

    table: str
    column: str
    parent: str
    parent_column: str


REFERENCES: tuple[Reference, ...] = (
    Reference("sentence_tokens", "sentence_id", "sentences", "sentence_id"),
    Reference("links", "sentence_id", "sentences", "sentence_id"),
    Reference("links", "translation_id", "sentences", "sentence_id"),
    Reference("tags", "sentence_id", "sentences", "sentence_id"),
    Reference("sentence_grammar_patterns", "sentence_id", "sentences", "sentence_id"),
    Reference("sentence_grammar_patterns", "pattern_id", "grammar_patterns", "pattern_id"),
    Reference("sentence_audio", "sentence_id", "sentences", "sentence_id"),
)

# Longest text, in characters, that the relational layout accepts.
MAX_LENGTHS: dict[str, dict[str, int]] = {
    "sentences": {"language": 10, "username": 100},
    "sentence_tokens": {"language": 10},
    "tags": {"tag_name": 100},
    "grammar_patterns": {"language": 10},
    "sentence_audio": {"status": 50},
}

# Tables stored as one directory per language.
BY_LANGUAGE: tuple[str, ...] = ("sentences", "sentence_tokens")
