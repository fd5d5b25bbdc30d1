"""Exact-token text functions.

A token is a maximal run of letters and digits in the NFKC form of the text; its
lookup key is the full Unicode case fold of that run. Spark has no built-in for
either step and ``lower`` is not a case fold (it keeps a sharp s, for instance), so both
go to the ICU classes on Spark's own classpath. They stay inside the JVM.

Three facts shape the expressions below:

* ``java_method`` throws on NULL, hence the ``coalesce``.
* Pure ASCII is already NFKC and folds like ``lower``; comparing the byte length
  with the character length detects it cheaply and skips the reflective call.
* ``java_method`` counts as non-deterministic, so Catalyst moves no filter below
  it. Filter and project before tokenising, and never put these expressions in a
  join condition.

Folding happens per token, after splitting: the fold of a dotted capital I holds a
combining mark, which would cut a word in two if the whole text were folded first.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

# Fixed values.
_NORMALIZER = "com.ibm.icu.text.Normalizer"
_CHARACTER = "com.ibm.icu.lang.UCharacter"
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
ASCII_PATTERN = "[A-Za-z0-9]+"

TOKEN_TYPE = ArrayType(
    StructType(
        [
            StructField("token", StringType()),
            StructField("normalized_token", StringType()),
            StructField("position", IntegerType()),
        ]
    )
)


def _is_ascii(value: Column) -> Column:
    return F.octet_length(value) == F.char_length(value)


def _runs(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def nfkc(value: Column) -> Column:
    """NFKC form; NULL becomes the empty string."""
    present = F.coalesce(value, F.lit(""))
    composed = F.java_method(F.lit(_NORMALIZER), F.lit("compose"), present, F.lit(True))
    return F.when(_is_ascii(present), present).otherwise(composed)


def fold_case(value: Column) -> Column:
    """Full Unicode case fold; NULL becomes the empty string."""
    present = F.coalesce(value, F.lit(""))
    folded = F.java_method(F.lit(_CHARACTER), F.lit("foldCase"), present, F.lit(True))
    return F.when(_is_ascii(present), F.lower(present)).otherwise(folded)


def normalize_token(value: Column) -> Column:
    """Lookup key of one word that has not been through :func:`split_tokens`."""
    return fold_case(nfkc(value))


def split_tokens(text: Column) -> Column:
    """Tokens in order of appearance, case kept. Any part of an NFKC text is NFKC."""
    return F.when(_is_ascii(text), _runs(text, ASCII_PATTERN)).otherwise(
        _runs(nfkc(text), TOKEN_PATTERN)
    )


def normalized_tokens(text: Column) -> Column:
    """Lookup keys in order of appearance, repeats kept.

    ASCII text is lowered as a whole; only other text is folded token by token.
    """
    return F.when(_is_ascii(text), _runs(F.lower(text), ASCII_PATTERN)).otherwise(
        F.transform(_runs(nfkc(text), TOKEN_PATTERN), fold_case)
    )


def tokenize_text(text: Column) -> Column:
    """``array<struct<token, normalized_token, position>>``, positions from zero."""
    return F.transform(
        split_tokens(text),
        lambda token, position: F.struct(
            token.alias("token"),
            fold_case(token).alias("normalized_token"),
            position.alias("position"),
        ),
    )


def query_tokens(words: Column, *, is_list: bool = False) -> Column:
    """Distinct lookup keys of a query, in order of first appearance.

    ``words`` is one string, or with ``is_list`` an array of strings; a string of
    several words gives several keys. No shuffle: it is one expression per row.
    """
    if not is_list:
        return F.array_distinct(normalized_tokens(words))
    return F.array_distinct(F.flatten(F.transform(words, normalized_tokens)))


def resolve_query_tokens(spark: SparkSession, words: str | Iterable[object]) -> list[str]:
    """Lookup keys for literal query words.

    The keys come from the same expression that builds the index, and as plain
    literals they can be pushed down into its Parquet scan.
    """
    values = [words] if isinstance(words, str) else [str(word) for word in words]
    if not values:
        return []
    words_column = F.array(*[F.lit(value) for value in values])
    row = spark.range(1).select(query_tokens(words_column, is_list=True).alias("keys"))
    return list(row.first()["keys"])


def text_contains(text: Column, keys: list[str], match_all: bool = True) -> Column:
    """Whether the text holds all (or any) of the lookup keys; evaluated per row."""
    wanted = F.array(*[F.lit(key) for key in keys])
    found = normalized_tokens(text)
    if match_all:
        return F.size(F.array_except(wanted, found)) == 0
    return F.arrays_overlap(wanted, found)
