"""Audio metadata: row normalising, download planning and the injected fetch step."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentaria.functions.scalar import (
    audio_url,
    blank_to_null,
    is_reusable_license,
    parse_int,
    strip,
)
from sentaria.operators.conform import conform
from sentaria.operators.integrity import keep_allowed
from sentaria.plans.sizing import spread
from sentaria.schemas import SCHEMAS

# Fixed values.
SOURCE, METADATA = "tatoeba", "metadata"
SKIPPED, DOWNLOADED, FAILED = "skipped_license", "downloaded", "download_error"
RAW_FIELDS = ("sentence_id", "audio_id", "username", "license", "attribution_url")


def audio_rows(raw: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Typed audio rows from the export's five text fields.

    Rows whose sentence id is no integer are dropped. Fields are trimmed; an empty one
    is NULL, except ``audio_id``. The literal backslash-N licence stays as it is.
    """
    optional = {c: blank_to_null(strip(F.col(c))) for c in RAW_FIELDS[2:]}
    audio_id = strip(F.coalesce("audio_id", F.lit("")))
    rows = raw.select(
        F.lit(SOURCE).alias("source"),
        audio_id.alias("audio_id"),
        parse_int(F.col("sentence_id")).alias("sentence_id"),
        *[value.alias(name) for name, value in optional.items()],
        audio_url(audio_id).alias("download_url"),
        F.lit(METADATA).alias("status"),
    ).filter(F.col("sentence_id").isNotNull())
    return conform(keep_allowed(rows, allowed), "sentence_audio")


def plan_downloads(
    audio: DataFrame,
    audio_dir: str,
    reusable_only: bool = True,
    fetched_at: Column | None = None,
) -> DataFrame:
    """Each row's outcome when every fetch succeeds; a column expression, no I/O.

    A skipped row changes its status only. ``fetched_at`` defaults to the current time.
    """
    wanted = is_reusable_license(F.col("license")) if reusable_only else F.lit(True)
    folder = F.coalesce(blank_to_null(F.col("source")), F.lit(SOURCE))
    file_name = F.concat(F.col("audio_id"), F.lit(".mp3"))
    path = F.concat_ws("/", F.lit(audio_dir.rstrip("/") or "/"), folder, file_name)
    stamp = F.current_timestamp() if fetched_at is None else fetched_at
    return audio.withColumns(
        {
            "status": F.when(wanted, F.lit(DOWNLOADED)).otherwise(F.lit(SKIPPED)),
            "local_path": F.when(wanted, path).otherwise(F.col("local_path")),
            "downloaded_at": F.when(wanted, stamp).otherwise(F.col("downloaded_at")),
        }
    )


def download(
    audio: DataFrame,
    audio_dir: str,
    fetch: Callable[[str, str], object],
    reusable_only: bool = True,
    fetched_at: Column | None = None,
) -> DataFrame:
    """Run ``fetch(url, path)`` for planned rows, inside the tasks, and record outcomes.

    An existing file is kept but stamped anew. A file appears under its final name only
    when complete, so a retried task neither trusts half a file nor fetches twice.
    ``audio_dir`` must be a folder every executor sees.
    """
    # a fetch takes long: a small table is dealt over all cores, rows of one file to one task
    planned = spread(plan_downloads(audio, audio_dir, reusable_only, fetched_at), "audio_id")
    columns = SCHEMAS["sentence_audio"].names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tempfile

        made: set[str] = set()
        with tempfile.TemporaryDirectory() as own:
            for batch in batches:
                due = batch["status"] == DOWNLOADED
                failed = [
                    index
                    for index, url, path in batch.loc[due, ["download_url", "local_path"]].itertuples()
                    if not _fetched(fetch, str(url), path, own, made)
                ]
                batch.loc[failed, "status"] = FAILED
                batch.loc[failed, "local_path"] = None
                batch.loc[failed, "downloaded_at"] = pd.NaT
                yield batch

    return planned.select(columns).mapInPandas(run, SCHEMAS["sentence_audio"])


def _fetched(fetch: Callable[[str, str], object], url: str, path: str, own: str, made: set[str]) -> bool:
    """Fetch to a new file in the task's folder ``own``, and move it to ``path`` on any file system when it is complete.

    ``made`` are the folders that the task has created.
    """
    import os
    import uuid

    from pyarrow import fs

    name = uuid.uuid4().hex
    try:
        files, target = fs.FileSystem.from_uri(path if "://" in path else path.removeprefix("file:"))
        if files.get_file_info(target).type == fs.FileType.NotFound:
            if (folder := os.path.dirname(target)) not in made:
                files.create_dir(folder, recursive=True)
                made.add(folder)
            partial = f"{target}.{name}.part"
            fetch(url, f"{own}/{name}")
            fs.copy_files(f"{own}/{name}", partial, source_filesystem=fs.LocalFileSystem(), destination_filesystem=files)
            files.move(partial, target)
        return True
    except Exception:  # any fetch failure is an outcome of the row, not of the job
        return False
    finally:
        if os.path.exists(f"{own}/{name}"):
            os.remove(f"{own}/{name}")
