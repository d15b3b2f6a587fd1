"""Session settings the jobs are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Times are instants in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Partition counts, join strategies and skew splits follow actual sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The proximity join costs far more per byte than a plain join, so split
    # its large partitions early.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    # Building long plans is faster without recording where each Column was made.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.parquet.compression.codec": "zstd",
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """``builder`` with the settings above."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
