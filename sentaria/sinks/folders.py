"""Files and folders of any file system that Spark reads, through Hadoop's own calls."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Folders:
    spark: SparkSession

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def create(self, path: str) -> None:
        files, where = self._at(path)
        files.mkdirs(where)

    def exists(self, path: str) -> bool:
        files, where = self._at(path)
        return files.exists(where)

    def delete(self, path: str) -> None:
        files, where = self._at(path)
        files.delete(where, True)

    def children(self, path: str) -> list[str]:
        files, where = self._at(path)
        return [str(s.getPath()) for s in files.listStatus(where)] if files.exists(where) else []

    def names(self, path: str, prefix: str) -> list[str]:
        """What follows ``prefix`` in the names of a folder's children."""
        found = (child.rstrip("/").rsplit("/", 1)[-1] for child in self.children(path))
        return [name[len(prefix) :] for name in found if name.startswith(prefix)]

    def files(self, path: str, suffix: str) -> list[tuple[str, int]]:
        """The files below a folder whose names end so, with their bytes, in the order of their paths."""
        files, where = self._at(path)
        found, listed = files.listFiles(where, True), []
        while found.hasNext():
            status = found.next()
            if (name := status.getPath().toString()).endswith(suffix):
                listed.append((name, status.getLen()))
        return sorted(listed)

    def n_bytes(self, path: str) -> int:
        files, where = self._at(path)
        return files.getContentSummary(where).getLength()

    def move(self, source: str, target: str) -> None:
        """Move a folder into place, instead of one that is there."""
        files, to = self._at(target)
        _, come_from = self._at(source)
        files.delete(to, True)
        if not files.rename(come_from, to):
            raise OSError(f"cannot move {source} to {target}")

    def text(self, path: str) -> str | None:
        """The content of a small file, None if it is not there."""
        files, where = self._at(path)
        if not files.exists(where):
            return None
        stream = files.open(where)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace_text(self, path: str, content: str) -> None:
        """Write a small file beside its place and rename it over the old one: readers see either."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        files, where = self._at(path)
        _, coming = self._at(f"{path}.coming")
        stream = files.create(coming, True)
        try:
            stream.write(bytearray(content.encode()))
        finally:
            stream.close()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        absolute = files.makeQualified(where)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(absolute.toUri(), conf).rename(
            files.makeQualified(coming), absolute, options
        )
