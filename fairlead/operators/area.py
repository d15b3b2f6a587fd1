"""Restriction to the area of interest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.config import DEFAULT_CONFIG, EncounterConfig
from fairlead.functions.geo import bounding_box, great_circle_nm


def in_box(points: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Cheap range filter that Parquet scans can skip row groups with."""
    south, north, west, east = bounding_box(cfg.center_lat, cfg.center_lon, cfg.radius_nm)
    return points.where(
        F.col("latitude").between(south, north) & F.col("longitude").between(west, east)
    )


def with_center_distance(points: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    distance = great_circle_nm(
        F.col("latitude"), F.col("longitude"), F.lit(cfg.center_lat), F.lit(cfg.center_lon)
    )
    return points.withColumn("distance_to_center_nm", distance)


def in_circle(points: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Box first, then the exact radius; adds ``distance_to_center_nm``."""
    boxed = with_center_distance(in_box(points, cfg), cfg)
    return boxed.where(F.col("distance_to_center_nm") <= cfg.radius_nm)
