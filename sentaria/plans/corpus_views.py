"""The corpus tables as views over the given benchmark tables.

A document stands for a sentence, an order line for a link or an annotation, a label
for a tag, an event for a row of the audio export, a part for a grammar pattern and a
benchmark passage for a query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentaria.operators.audio import audio_rows
from sentaria.operators.integrity import keep_known


class CorpusViews:
    """Lazy frames; nothing is read before a query runs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._opened[name]

    @property
    def sentences(self) -> DataFrame:
        return self.base("documents").select(
            F.col("doc_id").alias("sentence_id"),
            F.col("lang").alias("language"),
            "text",
            F.col("source").alias("username"),
            F.lit(None).cast("timestamp").alias("date_added"),
            F.lit(None).cast("timestamp").alias("date_modified"),
        )

    @property
    def links_raw(self) -> DataFrame:
        return self.base("lineitem").select(
            F.col("l_orderkey").alias("sentence_id"), F.col("l_partkey").alias("translation_id")
        )

    @property
    def links(self) -> DataFrame:
        return keep_known(self.links_raw, self.sentences, "sentence_id", "translation_id")

    @property
    def tags(self) -> DataFrame:
        name = F.when(F.col("kind") == "quality", F.lit("OK")).otherwise(F.lit("toxic"))
        kinds = F.array(
            F.struct(F.lit("quality").alias("kind"), F.col("quality").alias("flag")),
            F.struct(F.lit("toxic").alias("kind"), F.col("toxic").alias("flag")),
        )
        return (
            self.base("labels")
            .select(F.col("doc_id").alias("sentence_id"), F.inline(kinds))
            .filter(F.col("flag") == 1)
            .select("sentence_id", name.alias("tag_name"))
        )

    @property
    def quality_ids(self) -> DataFrame:
        good = self.base("labels").filter(F.col("quality") == 1)
        return good.select(F.col("doc_id").alias("sentence_id")).distinct()

    @property
    def sentences_detailed(self) -> DataFrame:
        correctness = F.when(F.col("quality") == 1, 0).when(F.col("quality") == 0, -1)
        labels = self.base("labels").select(
            F.col("doc_id").alias("sentence_id"), correctness.alias("correctness")
        )
        return self.sentences.select("sentence_id", "language").join(labels, "sentence_id", "left")

    @property
    def audio_export(self) -> DataFrame:
        user = F.col("user_id").cast("string")
        by_event = {"view": "CC BY 4.0", "click": " CC0 1.0 ", "signup": "", "error": "\\N"}
        licence: Column = F.lit(None)
        for event, text in by_event.items():
            licence = F.when(F.col("event_type") == event, F.lit(text)).otherwise(licence)
        link = F.concat(F.lit("https://example.com/"), user)
        return self.base("events").select(
            user.alias("sentence_id"),
            F.col("event_id").cast("string").alias("audio_id"),
            F.concat(F.lit("user"), user).alias("username"),
            licence.alias("license"),
            F.when(F.col("event_id") % 2 == 0, link).otherwise("").alias("attribution_url"),
        )

    @property
    def sentence_audio(self) -> DataFrame:
        return audio_rows(self.audio_export)

    @property
    def grammar_patterns(self) -> DataFrame:
        turn = F.col("p_partkey") % 4
        language = F.when(turn == 0, "en").when(turn == 1, "de").when(turn == 2, "es").otherwise("fr")
        return self.base("part").select(
            F.concat(F.lit("pat-"), F.col("p_partkey").cast("string")).alias("pattern_id"),
            language.alias("language"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("description"),
            F.col("p_name").alias("pattern_text"),
            F.col("p_brand").alias("source"),
            F.lit("{}").alias("metadata_json"),
        )

    @property
    def sentence_grammar_patterns(self) -> DataFrame:
        return self.base("lineitem").select(
            F.col("l_orderkey").alias("sentence_id"),
            F.concat(F.lit("pat-"), F.col("l_partkey").cast("string")).alias("pattern_id"),
            F.col("l_returnflag").alias("evidence_text"),
            (F.col("l_discount") + 0.0).alias("confidence"),
            F.col("l_linestatus").alias("source"),
        )

    @property
    def vocab_queries(self) -> DataFrame:
        return self.base("benchmark").select(
            F.col("item_id").alias("query_id"), F.col("text").alias("words")
        )

    def tables(self) -> dict[str, DataFrame]:
        """The served tables, without a token index."""
        names = (
            "sentences", "links", "tags", "grammar_patterns",
            "sentence_grammar_patterns", "sentence_audio",
        )
        return {name: getattr(self, name) for name in names}
