"""Tables written between stages to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors share, from ``spark.checkpoint.dir``.

    A session with a local master, which has no other executors, may do without
    the setting, as in tests: it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not is_local(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fairlead-stages-"))
    return spark.sparkContext.getCheckpointDir()


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


class Folder:
    """A file or folder in any store that Spark reaches, through its own file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        context = spark.sparkContext
        self._hadoop = context._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._hadoop.getFileSystem(context._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._files.exists(self._hadoop)

    def child(self, name: str) -> Folder:
        return Folder(self.spark, f"{self.path}/{name}")

    def children(self) -> list[str]:
        """Names of what lies in the folder, sorted."""
        return sorted(status.getPath().getName() for status in self._files.listStatus(self._hadoop))

    def modified_ns(self) -> int:
        """Time of the last change, in nanoseconds since 1970."""
        return self._files.getFileStatus(self._hadoop).getModificationTime() * 1_000_000

    def remove(self) -> str:
        """Deletes it with all it holds; returns its path."""
        self._files.delete(self._hadoop, True)
        return self.path


class StageStore:
    """Writes intermediate results as Parquet, under a folder of its own.

    A written table survives lost executors, is computed once however often it
    is read, and later readers prune its columns and rows. ``root`` defaults to
    the shared folder of the session. As a context manager, or by
    :meth:`close`, a store removes its own folder and no other; readers
    of its tables end before.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{root or shared_folder(spark)}/run-{uuid.uuid4().hex}"

    def __enter__(self) -> StageStore:
        return self

    def __exit__(self, *error) -> None:
        self.close()

    def path(self, name: str) -> str:
        """A path of this store that nothing else uses."""
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Writes ``df`` and returns a reader of the written table."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Removes the tables of this store."""
        Folder(self.spark, self.root).remove()
