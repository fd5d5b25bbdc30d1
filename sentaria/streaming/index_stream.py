"""Incremental loading: new sentence files in, sentences and token index out.

Each micro-batch is conformed, stored and then indexed by the served store's own writers,
so the index describes stored sentences only and a store takes streams and batch loads in
any order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sentaria.operators.conform import conform
from sentaria.plans.sizing import discard, written
from sentaria.schemas import SCHEMAS
from sentaria.sinks.folders import Folders
from sentaria.sinks.keyed import PLACE, placed, split_placed
from sentaria.sinks.store import CorpusStore

_SALT, _SALTS = "_salt", 64


def deduplicated(
    stream: DataFrame,
    event_time: str | None = None,
    delay: str = "1 day",
    origin: Column | None = None,
) -> DataFrame:
    """Keep the first row of each sentence id.

    Without an event time the ids seen are kept for good, so state grows with the
    corpus. With one, ids are forgotten ``delay`` after the watermark has passed.

    Repeats of one id meet in one task. ``origin``, for instance the input file, adds a
    first round per id and origin, so an id repeated throughout the input arrives there
    once per origin bucket. It doubles the state.
    """
    if event_time is not None:
        stream = stream.withWatermark(event_time, delay)

    def first_rows(rows: DataFrame, *keys: str) -> DataFrame:
        if event_time is None:
            return rows.dropDuplicates(list(keys))
        return rows.dropDuplicatesWithinWatermark(list(keys))

    if origin is None:
        return first_rows(stream, "sentence_id")
    salted = stream.withColumn(_SALT, F.pmod(F.xxhash64(origin), F.lit(_SALTS)))
    return first_rows(first_rows(salted, "sentence_id", _SALT), "sentence_id").drop(_SALT)


def _stream_name(spark: SparkSession, checkpoint_dir: str) -> str:
    """The name of a stream's loads: made up once and kept with its checkpoints.

    Without its checkpoints a stream starts anew, and its loads do not take the place of old ones.
    """
    files, path = Folders(spark), f"{checkpoint_dir.rstrip('/')}/stream-name"
    if (name := files.text(path)) is None:
        files.create(checkpoint_dir)
        files.replace_text(path, uuid.uuid4().hex)
        name = files.text(path)
    return name


def batch_writer(base_dir: str, checkpoint_dir: str, distinct_ids: bool = False, from_files: bool = False):
    """What stores and indexes one micro-batch, as ``foreachBatch`` calls it.

    Rows take the store's own write path, so streamed and batch-loaded rows share folders
    and layout. A micro-batch is one load of the store, named by the stream and the batch:
    one that was interrupted and comes again takes the place of its first try, whatever
    ids it or earlier loads hold.

    ``distinct_ids`` keeps the first row of each id, and none without an id. What came before is
    looked up in the store, in the row groups that may hold one of the batch's ids, so a
    stream of any age keeps no state of its own. The batch's own first try does not count.

    ``from_files``: a batch is rows of files as they stand, which are read again wherever they
    are needed. Any other batch is written to the scratch folder first, until it is loaded.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = CorpusStore(spark, base_dir).create_tables()
        rows = placed(conform(batch, "sentences"))
        if not from_files:
            rows = copy = written(rows, "batch")
        try:
            if not rows.isEmpty():
                load = f"{_stream_name(spark, checkpoint_dir)}-{batch_id}"
                if distinct_ids:
                    rows, _ = split_placed(rows, version.held("sentences", without=load), "sentences")
                version.load_sentences(rows.drop(PLACE), load=load)
        finally:
            if not from_files:
                discard(copy)

    return write


def start_sentences(
    spark: SparkSession,
    source_dir: str,
    base_dir: str,
    checkpoint_dir: str,
    source_schema: StructType | None = None,
    distinct_ids: bool = False,
    event_time: str | None = None,
    spread_repeats: bool = False,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Stream Parquet sentence files into the stored sentences and their index.

    ``distinct_ids`` as in :func:`batch_writer`. With an ``event_time`` as well, repeats that
    arrive close to each other are dropped by :func:`deduplicated` before they reach a
    batch; ``spread_repeats`` turns on its first round per input file.
    """
    arriving = (
        spark.readStream.schema(source_schema or SCHEMAS["sentences"])
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source_dir)
    )
    with_state = distinct_ids and event_time is not None
    if with_state:
        origin = F.col("_metadata.file_path") if spread_repeats else None
        arriving = deduplicated(arriving, event_time, origin=origin)
    return (
        conform(arriving, "sentences")
        .writeStream.foreachBatch(batch_writer(base_dir, checkpoint_dir, distinct_ids, from_files=not with_state))
        .option("checkpointLocation", f"{checkpoint_dir}/sentences")
        .trigger(availableNow=True)
        .start()
    )


def update_index(
    spark: SparkSession, source_dir: str, base_dir: str, checkpoint_dir: str, **options
) -> None:
    """Process everything that has arrived since the last call, then return."""
    start_sentences(spark, source_dir, base_dir, checkpoint_dir, **options).awaitTermination()
