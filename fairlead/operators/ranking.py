"""Dense positions in a global order without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairlead.operators.severity import severity_order
from fairlead.sources.stages import StageStore


def with_rank(df: DataFrame, order: list[Column], store: StageStore, name: str = "rank") -> DataFrame:
    """Adds ``name``: 1 for the first row in ``order``, which must be total.

    Rows are range-partitioned by the order and written once with the number
    of their partition, so that both passes see the same partitions. One count
    per partition gives the offsets; the position inside a partition comes from
    a window over that partition.
    """
    ranged = df.repartitionByRange(*order).withColumn("slot", F.spark_partition_id())
    slotted = store.keep(ranged, "rank_slots")
    # One row per slot: as many rows as there are shuffle partitions.
    before = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slotted.groupBy("slot").count().select(
        "slot", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("slot").orderBy(*order)
    placed = slotted.withColumn("place", F.row_number().over(within)).join(offsets, "slot")
    return placed.select(*df.columns, (F.col("offset") + F.col("place")).alias(name))


def rank_events(events: DataFrame, store: StageStore) -> DataFrame:
    """``event_rank`` of each scored event, 1 for the most severe."""
    return with_rank(events, severity_order(), store, "event_rank")
