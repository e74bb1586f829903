"""Tables of one job that replace those of the job before together.

Each job writes its tables to a folder of its own below the target. When all are complete
it puts a manifest in place, by one rename, that names this folder; a reader asks the
manifest first. So a reader finds all tables of one job or all of another, and a job that
stops midway leaves the last complete tables as they were.
"""

from __future__ import annotations

import json
import uuid
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession

from starloom.sinks.writers import save_as

MANIFEST = "_published.json"


class _Folder:
    """The few file operations needed, on any file system Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        context = spark.sparkContext
        self._jvm = context._jvm
        self._configuration = context._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._files = self._path("").getFileSystem(self._configuration)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def read(self, name: str) -> str | None:
        path = self._path(name)
        if not self._files.exists(path):
            return None
        stream = self._files.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Put a file in place of an older one; a reader sees either, whole."""
        fresh = self._path(f"{name}-{uuid.uuid4().hex}")
        stream = self._files.create(fresh, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fresh.toUri(), self._configuration
        )
        option = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self._jvm.java.lang.reflect.Array.newInstance(option.getClass(), 1)
        options[0] = option
        files.rename(fresh, self._path(name), options)

    def remove(self, name: str) -> None:
        self._files.delete(self._path(name), True)


def _manifest(folder: _Folder) -> dict | None:
    text = folder.read(MANIFEST)
    return None if text is None else json.loads(text)


class PublishedTables:
    """A writer of tables that appear together at the end of a `with` block.

    The tables of the job before stay for readers that have begun with them, and are
    removed by the job after. A block that ends in an error removes what it wrote; the
    folder of a job that was killed stays, is named by no manifest, and may be removed by
    hand. Of two jobs at once, the one that ends last stays.
    """

    def __init__(self, spark: SparkSession, kind: str, folder: str):
        self._folder = _Folder(spark, folder)
        self._kind = kind
        self._version = f"tables-{uuid.uuid4().hex}"
        self._tables: list[str] = []

    def __enter__(self) -> PublishedTables:
        return self

    def __call__(self, rows: DataFrame, table: str) -> None:
        save_as(rows, self._kind, path=f"{self._folder.root}/{self._version}/{table}")
        self._tables.append(table)

    def __exit__(
        self,
        error: type[BaseException] | None,
        value: BaseException | None,
        trace: TracebackType | None,
    ) -> None:
        if error is not None:
            self._folder.remove(self._version)
            return
        last = _manifest(self._folder) or {}
        manifest = {
            "version": self._version,
            "format": self._kind,
            "tables": self._tables,
            "last": last.get("version"),
        }
        self._folder.replace(MANIFEST, json.dumps(manifest))
        if last.get("last"):
            self._folder.remove(last["last"])


class PublishedReader:
    """The tables of one job; the manifest is read once, so all come from the same job."""

    def __init__(self, spark: SparkSession, folder: str):
        folder = folder.rstrip("/")
        manifest = _manifest(_Folder(spark, folder))
        if manifest is None:
            raise FileNotFoundError(f"no published tables in {folder}")
        self._spark = spark
        self._root = f"{folder}/{manifest['version']}"
        self.format: str = manifest["format"]
        self.tables: list[str] = manifest["tables"]

    def __call__(self, table: str) -> DataFrame:
        if table not in self.tables:
            raise KeyError(table)
        return self._spark.read.format(self.format).load(f"{self._root}/{table}")


def is_published(spark: SparkSession, folder: str) -> bool:
    return _manifest(_Folder(spark, folder)) is not None
