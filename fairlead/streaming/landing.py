"""Lands daily files as typed, valid points inside the area.

The row-level stages keep no state, so the batch operators run on a stream
unchanged. The stream's checkpoint records which files were read: each file is
landed exactly once, however often the landing runs. The stages that look at
whole tracks start from the landed table, for example with
``EncounterAnalysis(spark.read.parquet(path), store)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from fairlead.config import DEFAULT_CONFIG, EncounterConfig
from fairlead.operators.area import in_circle
from fairlead.operators.quality import valid_rows
from fairlead.sources.position_files import (
    FEED_COLUMNS,
    file_day,
    normalize_columns,
    standardize_types,
)


def feed_stream(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.csv",
    header: list[str] | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """Typed points of the files in ``folder``, old and new.

    ``header`` names the columns in file order, by default the full feed; a
    file with another header stops the stream.
    """
    columns = header or list(FEED_COLUMNS)
    rows = (
        spark.readStream.schema(StructType([StructField(c, StringType()) for c in columns]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    named = rows.select("*", file_day().alias("file_day"))
    return named.transform(normalize_columns).transform(standardize_types)


def land(
    points: DataFrame, path: str, checkpoint: str, cfg: EncounterConfig = DEFAULT_CONFIG
) -> StreamingQuery:
    """Appends the valid points of a stream to a table by day, then stops.

    Run it again, or on a schedule, to pick up the files that came since.
    """
    kept = in_circle(valid_rows(points, cfg), cfg)
    return (
        kept.writeStream.partitionBy("file_day")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .format("parquet")
        .start(path)
    )
