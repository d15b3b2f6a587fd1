"""Local Spark session of the tests and checks."""

from __future__ import annotations

from pyspark.sql import SparkSession

from fairlead.session import tuned


def local_session(cores: int) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fairlead-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = tuned(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
