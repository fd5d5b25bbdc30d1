"""Small scalar column helpers shared by the readers and operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str.strip and str.split see it, the audio
# download address, and the export's spelling of a missing value.
_SPACE = r"[\s\x1c-\x1f]"
AUDIO_URL_PREFIX = "https://tatoeba.org/audio/download/"
EXPORT_NULL = "\\N"


def strip(value: Column) -> Column:
    """Drop leading and trailing white space, tabs and Unicode spaces included.

    Text that begins and ends with a visible ASCII character is left as it is, without a pattern search.
    """
    first, last = F.ascii(value), F.ascii(F.substring(value, -1, 1))
    bare = first.between(33, 126) & last.between(33, 126)
    return F.when(bare, value).otherwise(F.regexp_replace(value, f"(?U)^{_SPACE}+|{_SPACE}+$", ""))


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def parse_int(value: Column) -> Column:
    """BIGINT of a decimal integer (sign, spaces and ``_`` separators allowed), else NULL."""
    text = strip(value)
    number = value.try_cast("bigint")
    # digits as Spark would write them need no pattern
    return F.when(number.cast("string") == value, number).when(
        text.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"),
        F.regexp_replace(text, "_", "").try_cast("bigint"),
    )


def words(text: Column) -> Column:
    """White-space separated words; empty text gives an empty array."""
    return F.filter(F.split(text, f"(?U){_SPACE}+"), lambda word: word != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def is_reusable_license(value: Column) -> Column:
    """A licence permits reuse when it says anything at all."""
    return ~F.coalesce(strip(value), F.lit("")).isin("", EXPORT_NULL)


def audio_url(audio_id: Column) -> Column:
    return F.concat(F.lit(AUDIO_URL_PREFIX), audio_id)
