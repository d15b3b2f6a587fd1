"""Written tables between the steps of a text operator."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fairlead.sources.stages import StageStore

DROP_SHUFFLE_FILES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Stages(StageStore):
    """A stage store whose writes leave no shuffle files behind.

    The written table replaces the shuffles that made it; dropping them when the
    write ends keeps the disk use of a chain of steps near that of its
    largest step.
    """

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        conf = self.spark.conf
        before = conf.get(DROP_SHUFFLE_FILES)
        conf.set(DROP_SHUFFLE_FILES, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            conf.set(DROP_SHUFFLE_FILES, before)
        return self.spark.read.schema(df.schema).parquet(path)
