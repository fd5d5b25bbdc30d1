"""Readers for the raw corpus exports: tab-separated text, or Parquet with the same columns."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sentaria.functions.scalar import EXPORT_NULL, strip
from sentaria.operators.audio import RAW_FIELDS, audio_rows
from sentaria.operators.audio import download as download_files
from sentaria.schemas import SCHEMAS
from sentaria.sources.datasets import is_missing_path

_BASIC = ("sentence_id", "language", "text")


def _read(spark: SparkSession, path: str, schema: StructType, file_format: str) -> DataFrame:
    """Typed columns of an export. Text has neither quotes nor escapes: only the mark of a missing value is special.

    An empty field is an empty text. A field that is not of its type, or is not there, is NULL.
    """
    if file_format == "parquet":
        return spark.read.parquet(path)
    lines = spark.read.text(path).select(F.split("value", "\t", -1).alias("fields"))
    raw = _once(F.struct(*[F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(schema.names)]), lines)

    def typed(name: str, kind) -> Column:
        value = F.nullif(name, F.lit(EXPORT_NULL))
        return value if isinstance(kind, StringType) else strip(value).try_cast(kind)

    return raw.select(*[typed(f.name, f.dataType).alias(f.name) for f in schema.fields])


def _once(fields: Column, lines: DataFrame) -> DataFrame:
    """The fields as columns. A filter on columns that are derived from them is not moved below, where it would parse each line anew."""
    return lines.select(F.inline(F.array(fields)))


def _pick(schema: StructType, names: Iterable[str]) -> StructType:
    return StructType([schema[name] for name in names])


def _with_ids(sentences: DataFrame) -> DataFrame:
    """Rows whose id is a number; a sentence that nothing can refer to is left out."""
    return sentences.filter(F.col("sentence_id").isNotNull())


def in_languages(df: DataFrame, languages: Iterable[str] | None) -> DataFrame:
    """Keep the listed languages; no list, or an empty one, keeps all rows."""
    wanted = [languages] if isinstance(languages, str) else list(languages or [])
    return df.filter(F.col("language").isin(wanted)) if wanted else df


def read_sentences(
    spark: SparkSession,
    path: str,
    languages: Iterable[str] | None = None,
    file_format: str = "tsv",
) -> DataFrame:
    """``sentence_id, language, text``; the filter and the projection reach the scan."""
    raw = _read(spark, path, _pick(SCHEMAS["sentences"], _BASIC), file_format)
    if "lang" in raw.columns:
        raw = raw.withColumnRenamed("lang", "language")
    return in_languages(_with_ids(raw.select(*_BASIC)), languages)


def read_detailed_sentences(
    spark: SparkSession,
    detailed_path: str,
    basic_path: str,
    languages: Iterable[str] | None = None,
    file_format: str = "tsv",
) -> DataFrame:
    """All six sentence columns, absent ones NULL; the basic export if there is no detailed one."""
    wanted = SCHEMAS["sentences"]
    try:
        raw = _read(spark, detailed_path, wanted, file_format)
        if "lang" in raw.columns:
            raw = raw.withColumnRenamed("lang", "language")
        raw.select(*_BASIC)
    except AnalysisException:
        return read_sentences(spark, basic_path, languages, file_format)
    columns = [
        (F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in wanted.fields
    ]
    return in_languages(_with_ids(raw.select(*columns)), languages)


def read_links(spark: SparkSession, path: str, file_format: str = "tsv") -> DataFrame:
    schema = SCHEMAS["links"]
    return _read(spark, path, schema, file_format).select(*schema.names)


def read_tags(spark: SparkSession, path: str, file_format: str = "tsv") -> DataFrame:
    schema = SCHEMAS["tags"]
    return _read(spark, path, schema, file_format).select(*schema.names)


def read_quality_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of a one-id-per-line file; other lines are ignored, a missing file is empty, with a warning."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        warnings.warn(f"no list of trusted ids at {path}: it filters nothing", stacklevel=2)
        return spark.createDataFrame([], StructType([StructField("sentence_id", LongType())]))
    line = strip(F.col("value"))
    ids = lines.select(F.when(line.rlike("^[0-9]+$"), line.try_cast("bigint")).alias("sentence_id"))
    return ids.filter(F.col("sentence_id").isNotNull()).distinct()


# --- audio export --------------------------------------------------------------

_CSV_FIELDS = ", ".join(f"{name} string" for name in (*RAW_FIELDS, "_corrupt"))
#: A header of an archive's member ends in so many zero characters or more, whatever its format.
_HEADER_END = "\\x00{12,}"
_HEADER_BYTES, _KIND_AT = 512, 156


def _export_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the lines of plain or compressed text, or of each archive's first regular member.

    ``.bz2`` is read in splits, archives too: an archive is text with a header before the first
    line of each member. Members are told apart by those headers, which are found by one scan
    and give one row for each archive.
    """
    lines = spark.read.text(path)
    if not path.endswith((".tar.bz2", ".tbz2", ".tar")):
        return lines
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    placed = lines.select("value", F.col("_metadata.file_path").alias("file"), place.alias("place"))
    heads = placed.filter(F.col("value").rlike(_HEADER_END)).withColumn(
        "head", F.encode(F.regexp_extract("value", f"(?s)^.*{_HEADER_END}", 0), "UTF-8")
    )
    kind = F.decode(F.substring("head", F.length("head") - _HEADER_BYTES + _KIND_AT + 1, F.lit(1)), "UTF-8")
    regular = (F.length("head") >= _HEADER_BYTES) & kind.isin("0", "\x00")
    starts = heads.groupBy("file").agg(
        F.min(F.when(regular, F.col("place"))).alias("first"), F.sort_array(F.collect_list("place")).alias("all")
    )
    # one row for each archive, with a place for each member
    ends = F.get(F.filter("all", lambda p: p > F.col("first")), F.lit(0))
    spans = starts.filter("first IS NOT NULL").select("file", "first", ends.alias("next"))
    inside = placed.join(F.broadcast(spans), "file").filter(
        (F.col("place") >= F.col("first")) & (F.col("next").isNull() | (F.col("place") < F.col("next")))
    )
    return inside.select(F.regexp_replace("value", f"(?s)^.*{_HEADER_END}", "").alias("value"))


def read_audio_fields(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The export's five text fields, from plain or ``.bz2`` text, or ``.tar.bz2`` archives.

    All of these are split over many tasks. ``multi_line`` allows line breaks inside quotes
    at the price of one task per file, and not in archives.

    A row needs two fields; missing ones are empty and surplus ones are ignored.
    """
    options = {
        "sep": "\t", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt",
    }
    if multi_line:
        rows = spark.read.schema(_CSV_FIELDS).csv(path, multiLine=True, **options)
    else:
        lines = _export_lines(spark, path).filter(F.length("value") > 0)
        rows = _once(F.col("r"), lines.select(F.from_csv("value", _CSV_FIELDS, options).alias("r")))
    # Spark flags short and long rows alike; one with a tab still has two fields.
    usable = F.col("_corrupt").isNull() | (F.instr("_corrupt", "\t") > 0)
    return rows.filter(usable).select(*RAW_FIELDS)


def read_audio_export(
    spark: SparkSession, path: str, allowed: DataFrame | None = None, multi_line: bool = False
) -> DataFrame:
    """Typed audio rows; ``allowed`` None keeps all ids, an empty frame keeps none."""
    return audio_rows(read_audio_fields(spark, path, multi_line), allowed)


def extract_audio(
    spark: SparkSession,
    path: str,
    allowed: DataFrame | None = None,
    fetch=None,
    audio_dir: str = "audio",
    reusable_only: bool = True,
) -> DataFrame:
    """Audio metadata, followed by the download step when a ``fetch`` function is given."""
    rows = read_audio_export(spark, path, allowed)
    return rows if fetch is None else download_files(rows, audio_dir, fetch, reusable_only)
