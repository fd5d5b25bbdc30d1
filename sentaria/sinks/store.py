"""The served corpus: one Parquet dataset per declared table, in versions.

A version is a folder that holds all tables, and one small pointer file names the version
that readers see. A rebuild fills a new version and replaces the pointer last, so it shows
up whole or not at all, and whoever has resolved the pointer goes on reading the old
tables. Within a version every load is a folder of its own, moved into place when it is
complete. A load that is written again under its name takes the place of its first try.
Small loads are merged into larger ones, as they are, so that many small appends leave few
files; a list of what was merged is replaced like the pointer.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import accumulate, groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentaria.operators.conform import conform
from sentaria.operators.retrieval import token_rows
from sentaria.plans.sizing import input_bytes, written
from sentaria.schemas import BY_LANGUAGE, LOAD_ORDER, PRIMARY_KEYS, SCHEMAS
from sentaria.sinks.folders import Folders
from sentaria.sinks.keyed import split_by_key
from sentaria.sinks.parquet import dataset_path, write_dataset, write_token_index, write_width

POINTER = "current"
VERSIONS = "versions"
_LOAD = "load"
_MERGED, _MERGES = "merged", "_merges"
#: So many loads of a like size become one, and the factor between sizes that are not alike.
MERGE_LOADS = 8
SIZE_STEP = 8
_LEAST_BYTES = 1 << 20
#: A load's sentences are indexed in so many shares at most, of so many stored bytes at least.
INDEX_SHARES = 8
SHARE_BYTES = 8 << 20


def _shares(files: list[tuple[str, int]]) -> list[list[str]]:
    """Files in runs of a like size: few runs, so that a language stays in one or two of them."""
    size = max(SHARE_BYTES, -(-sum(n for _, n in files) // INDEX_SHARES))
    ends = accumulate(n for _, n in files)
    placed = [((end - (n + 1) // 2) // size, path) for (path, n), end in zip(files, ends)]
    return [[path for _, path in run] for _, run in groupby(placed, key=lambda x: x[0])]


def _share_width(rows: DataFrame) -> int:
    """Range partitions of stored sentences: two files for each share, if there is enough to share."""
    size = input_bytes(rows)
    return max(write_width(rows), 1 if size is None else min(2 * INDEX_SHARES, size // SHARE_BYTES))


def _partitions(table: str) -> tuple[str, ...]:
    return ("language",) if table in BY_LANGUAGE else ()


@dataclass(frozen=True)
class StoreVersion:
    """The tables of one version."""

    spark: SparkSession
    folder: str

    def create_tables(self) -> None:
        files = Folders(self.spark)
        for table in LOAD_ORDER:
            files.create(dataset_path(self.folder, table))

    def _merges(self, table: str) -> dict[str, list[str]]:
        """The loads that each merged load stands for."""
        text = Folders(self.spark).text(f"{dataset_path(self.folder, table)}/{_MERGES}")
        return json.loads(text) if text else {}

    def loads(self, table: str) -> list[str]:
        """Names of the loads that a reader sees: no merged load that is not listed, no load that was merged."""
        names = Folders(self.spark).names(dataset_path(self.folder, table), f"{_LOAD}=")
        merges = self._merges(table)
        gone = {name for parts in merges.values() for name in parts}
        return sorted(n for n in names if n not in gone and (not n.startswith(_MERGED) or n in merges))

    def read(self, table: str, without: str | None = None) -> DataFrame:
        """The rows of a table; ``without`` leaves one load out."""
        base = dataset_path(self.folder, table)
        names = [name for name in self.loads(table) if name != without]
        if not names:
            # planned in the JVM: an empty list of rows would start Python workers, and be of unknown size
            return self.spark.range(0).select([F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMAS[table].fields])
        paths = [f"{base}/{_LOAD}={name}" for name in names]
        rows = self.spark.read.schema(SCHEMAS[table]).option("basePath", base).parquet(*paths)
        return rows.select(SCHEMAS[table].names)

    def held(self, table: str, without: str | None = None) -> DataFrame | None:
        """:meth:`read`, None if no load is there."""
        return self.read(table, without) if set(self.loads(table)) - {without} else None

    def tables(self) -> dict[str, DataFrame]:
        return {table: self.read(table) for table in LOAD_ORDER}

    def _write(self, rows: DataFrame, table: str, path: str, languages: DataFrame | None = None) -> None:
        if table == "sentence_tokens":
            write_token_index(rows, path, languages=languages)
        else:
            keys = PRIMARY_KEYS.get(table, ())
            order = (*keys, "sentence_id") if "sentence_id" not in keys else keys
            width = _share_width(rows) if table == "sentences" else None
            write_dataset(rows, path, partition_by=_partitions(table), order=order, lookup_keys=keys, width=width)

    def append(
        self, df: DataFrame, table: str, languages: DataFrame | None = None, load: str | None = None
    ) -> None:
        """Conform and add the rows as one load, in place of an earlier load of that name.

        ``languages`` as in ``write_token_index``. Rows show up together, when their folder
        is moved into place. A load's name is made up unless given.
        """
        rows = conform(df, table)
        name = load or uuid.uuid4().hex
        path = dataset_path(self.folder, table)
        # a name that Spark's readers pass over
        coming = f"{path}/_coming-{name}"
        self._write(rows, table, coming, languages)
        Folders(self.spark).move(coming, f"{path}/{_LOAD}={name}")
        self._merge(table, name)

    def _mergeable(self, table: str, newest: str) -> list[str]:
        """Loads of a like size, enough of them to be merged.

        The newest load stays, and the newest of each stream: those may be written again.
        """
        last: dict[str, int] = {}
        for name in (names := self.loads(table)):
            stream, _, batch = name.rpartition("-")
            if stream and batch.isdigit():
                last[stream] = max(last.get(stream, -1), int(batch))
        fixed = {newest, *(f"{stream}-{batch}" for stream, batch in last.items())}
        files, tiers = Folders(self.spark), defaultdict(list)
        for name in names:
            if name not in fixed:
                n_bytes = files.n_bytes(f"{dataset_path(self.folder, table)}/{_LOAD}={name}")
                tiers[math.floor(math.log(max(n_bytes, _LEAST_BYTES), SIZE_STEP))].append(name)
        return next((tier for _, tier in sorted(tiers.items()) if len(tier) >= MERGE_LOADS), [])

    def _merge(self, table: str, newest: str) -> None:
        """Merge loads until no size has many. Readers see the merged rows once all along.

        Loads that earlier merges stand for are deleted first: a reader of those has had
        the time of several appends to finish.
        """
        if len(self.loads(table)) <= MERGE_LOADS:
            return
        while parts := self._mergeable(table, newest):
            files, base = Folders(self.spark), dataset_path(self.folder, table)
            merges = self._merges(table)
            for past in merges.values():
                for name in past:
                    files.delete(f"{base}/{_LOAD}={name}")
            paths = [f"{base}/{_LOAD}={name}" for name in parts]
            rows = self.spark.read.schema(SCHEMAS[table]).option("basePath", base).parquet(*paths)
            name = f"{_MERGED}{uuid.uuid4().hex}"
            self._write(rows.select(SCHEMAS[table].names), table, f"{base}/_coming-{name}")
            files.move(f"{base}/_coming-{name}", f"{base}/{_LOAD}={name}")
            standing = {n: [] for n in merges if n not in parts}
            files.replace_text(f"{base}/{_MERGES}", json.dumps({**standing, name: parts}))

    def load_sentences(self, df: DataFrame, load: str | None = None) -> None:
        """Add sentences and their token rows.

        Token rows are made from the sentences as they are stored, file by file in shares: shuffled, they
        take several times the space of their texts, and a share's are gone when the next one begins.
        """
        name = load or uuid.uuid4().hex
        self.append(df, "sentences", load=name)
        files, held = Folders(self.spark), f"{dataset_path(self.folder, 'sentences')}/{_LOAD}={name}"
        path = dataset_path(self.folder, "sentence_tokens")
        coming = f"{path}/_coming-{name}"
        files.delete(coming)
        files.create(coming)
        for share in _shares(files.files(held, ".parquet")):
            rows = self.spark.read.schema(SCHEMAS["sentences"]).option("basePath", held).parquet(*share)
            tokens = conform(token_rows(rows), "sentence_tokens")
            write_token_index(tokens, coming, mode="append", languages=rows)
        files.move(coming, f"{path}/{_LOAD}={name}")
        self._merge("sentence_tokens", name)

    def load(self, table: str, df: DataFrame) -> None:
        self.append(df, table)


@dataclass(frozen=True)
class CorpusStore:
    """Reads and loads the served tables. One writer at a time rebuilds or compacts."""

    spark: SparkSession
    base_dir: str

    def _pointer(self) -> str:
        return f"{self.base_dir.rstrip('/')}/{POINTER}"

    def _new_version(self) -> StoreVersion:
        version = StoreVersion(self.spark, f"{self.base_dir.rstrip('/')}/{VERSIONS}/{uuid.uuid4().hex}")
        version.create_tables()
        return version

    def _publish(self, version: StoreVersion) -> None:
        Folders(self.spark).replace_text(self._pointer(), version.folder.rsplit("/", 1)[-1])

    def current(self) -> StoreVersion:
        """The version that the pointer names now; ``FileNotFoundError`` if there is none."""
        name = Folders(self.spark).text(self._pointer())
        if name is None:
            raise FileNotFoundError(f"{self.base_dir}: no stored corpus")
        return StoreVersion(self.spark, f"{self.base_dir.rstrip('/')}/{VERSIONS}/{name.strip()}")

    def read(self, table: str) -> DataFrame:
        return self.current().read(table)

    def tables(self) -> dict[str, DataFrame]:
        """All tables of one version, whatever is rebuilt meanwhile."""
        return self.current().tables()

    def create_tables(self) -> StoreVersion:
        """The current version, or a first one without rows."""
        try:
            return self.current()
        except FileNotFoundError:
            self._publish(self._new_version())
            return self.current()

    def reset_tables(self) -> None:
        """Empty every table, all at once."""
        self._publish(self._new_version())

    @contextmanager
    def rebuilding(self) -> Iterator[StoreVersion]:
        """A new version to fill. It replaces the current one at the end, or never if filling it fails.

        The current tables stay readable, so rows may come from them.
        """
        version = self._new_version()
        try:
            yield version
        except BaseException:
            Folders(self.spark).delete(version.folder)
            raise
        self._publish(version)

    def load_sentences(self, df: DataFrame, rebuild: bool = True) -> DataFrame | None:
        """Load sentences and index them.

        A rebuild takes all rows and leaves every other table empty. Without it rows are
        added to what is there; those whose id is stored already, or that repeat an id, are
        refused and returned as in :meth:`load`.
        """
        if rebuild:
            rows = written(conform(df, "sentences"), "rebuild")
            with self.rebuilding() as version:
                version.load_sentences(rows)
            return None
        version = self.create_tables()
        new, refused = split_by_key(conform(df, "sentences"), version.held("sentences"), "sentences")
        version.load_sentences(new)
        return refused

    def load(self, table: str, df: DataFrame) -> DataFrame | None:
        """Append links, tags, audio, grammar patterns or annotations.

        Where a table has a key, rows whose key is stored already, is null or repeats within
        ``df`` are refused: one row of a repeated new key is added, the least one. What was
        refused is returned, one row for each key: the key, ``stored`` and ``n_rows``.
        """
        version = self.create_tables()
        if table not in PRIMARY_KEYS:
            version.append(df, table)
            return None
        new, refused = split_by_key(conform(df, table), version.held(table), table)
        version.append(new, table)
        return refused

    def prune(self) -> None:
        """Delete all versions but the current one. Only for stores without readers of older ones."""
        files, keep = Folders(self.spark), self.current().folder
        for folder in files.children(f"{self.base_dir.rstrip('/')}/{VERSIONS}"):
            if folder.rsplit("/", 1)[-1] != keep.rsplit("/", 1)[-1]:
                files.delete(folder)

    def compact(self, target_dir: str | None = None) -> "CorpusStore":
        """Few clustered files instead of many loads: as a new version, or as a store in another folder."""
        source = self.current()
        target = self if target_dir is None else CorpusStore(self.spark, target_dir)
        with target.rebuilding() as version:
            for table in LOAD_ORDER:
                version.append(source.read(table), table)
        return target
