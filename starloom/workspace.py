"""Tables a job writes for its own later stages.

Anything that several later stages read (a star table, the totals per product, rows
sorted for ranking) is written once as Parquet instead of being computed again for
each reader. The files outlive a lost executor, are read column by column, and tell
the planner their true size.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines of the cluster see, as the session names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="starloom-")
    raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What a query within shuffles goes when it ends.

    Otherwise the files stay until the driver happens to collect its garbage, beside the
    written rows that replace them.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


class Workspace:
    """A fresh folder below the shared one, written by one job and gone with it."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        parent = (folder or shared_folder(spark)).rstrip("/")
        application = spark.sparkContext.applicationId
        self.root = f"{parent}/starloom-{application}-{uuid.uuid4().hex}"
        self._saved: dict[int, tuple[DataFrame, str]] = {}
        files, path = self._files()
        files.mkdirs(path)
        files.deleteOnExit(path)

    def fresh_path(self, label: str) -> str:
        return f"{self.root}/{label}-{uuid.uuid4().hex}"

    def save(self, rows: DataFrame, label: str) -> DataFrame:
        path = self.fresh_path(label)
        with shuffles_freed(self.spark):
            rows.write.parquet(path)
        saved = self.spark.read.schema(rows.schema).parquet(path)
        self._saved[id(saved)] = saved, path
        return saved

    def release(self, *tables: DataFrame) -> None:
        """Remove tables that `save` gave, once nothing reads from them any more."""
        files, _ = self._files()
        for table in tables:
            _, path = self._saved.pop(id(table))
            files.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), True)

    def discard(self) -> None:
        """Remove this workspace's own folder once nothing reads from it any more."""
        files, path = self._files()
        files.delete(path, True)

    def _files(self):
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(context._jsc.hadoopConfiguration()), path
