"""Corpus statistics and the documented two- and three-way joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentaria.functions.scalar import words
from sentaria.plans.sizing import spread

ID = "sentence_id"


def count_by_language(sentences: DataFrame) -> DataFrame:
    """Sentence count per language, largest first."""
    counts = sentences.groupBy("language").agg(F.count(F.lit(1)).alias("n_sentences"))
    return counts.orderBy(F.desc("n_sentences"), "language")


def count_tags(tags: DataFrame) -> DataFrame:
    """Tag count per sentence, largest first."""
    counts = tags.groupBy(ID).agg(F.count(F.lit(1)).alias("n_tags"))
    return counts.orderBy(F.desc("n_tags"), ID)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: ``table_name, n_rows``."""
    return reduce(
        DataFrame.union,
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
            for name, df in tables.items()
        ],
    )


def length_statistics(sentences: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of text length.

    The text is read into a histogram of lengths, combined on the map side; everything
    else is computed from that small frame, the deviation around the exact mean.
    """
    histogram = (
        sentences.groupBy(F.char_length("text").alias("n"))
        .agg(F.count(F.lit(1)).alias("w"))
        .filter(F.col("n").isNotNull())
    )
    n, w = F.col("n"), F.col("w")
    total = F.sum((n * w).cast("decimal(38,0)")).cast("double")
    mean = histogram.agg(F.try_divide(total, F.sum(w))).scalar()
    squares = F.sum(w * (n - mean) * (n - mean))
    return (
        histogram.agg(
            F.coalesce(F.sum(w), F.lit(0)).alias("n_sentences"),
            F.sqrt(F.when(F.sum(w) > 1, squares / (F.sum(w) - 1))).alias("std_length"),
            F.min(n).alias("min_length"),
            F.max(n).alias("max_length"),
            F.percentile(n, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), w).alias("q"),
        )
        .select(
            "n_sentences",
            mean.alias("mean_length"),
            "std_length",
            "min_length",
            F.col("q")[0].alias("q25_length"),
            F.col("q")[1].alias("q50_length"),
            F.col("q")[2].alias("q75_length"),
            "max_length",
        )
    )


def top_words(sentences: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent lower-cased, space-separated words; ties by word."""
    return (
        spread(sentences.select(ID, "text"), ID)
        .select(F.explode(words(F.lower("text"))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(k)
    )


def longer_than(sentences: DataFrame, n_chars: int = 50) -> DataFrame:
    return sentences.filter(F.char_length("text") > n_chars)


def translation_pairs(
    sentences: DataFrame, links: DataFrame, source_language: str, target_language: str
) -> DataFrame:
    """Linked sentence pairs of two languages, one row per link row."""
    def side(language: str, id_name: str, text_name: str) -> DataFrame:
        chosen = sentences.filter(F.col("language") == language)
        return chosen.select(F.col(ID).alias(id_name), F.col("text").alias(text_name))

    return (
        links.select(ID, "translation_id")
        .join(side(source_language, ID, "source_text"), ID)
        .join(side(target_language, "translation_id", "target_text"), "translation_id")
        .select(ID, "translation_id", "source_text", "target_text")
    )


def tagged_sentences(sentences: DataFrame, tags: DataFrame, tag_name: str = "OK") -> DataFrame:
    """Sentences with a tag; a tag given twice gives the sentence twice."""
    chosen = tags.filter(F.col("tag_name") == tag_name).select(ID)
    return sentences.join(chosen, ID)
