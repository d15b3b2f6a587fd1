"""Connected components of an edge table by repeated minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.sources.stages import StageStore


def connected_components(edges: DataFrame, store: StageStore, a: str = "a", b: str = "b") -> DataFrame:
    """(vertex, component): the smallest vertex reachable, for all vertices of ``edges``.

    Each round gives a vertex the smallest label among itself and its
    neighbours and then follows the label once more, so paths shrink at least
    by half. Labels are written every round: lineage stays short and a lost
    executor costs one round. Ends when no label changes; vertices without an
    edge do not appear.
    """
    pair = edges.select(F.col(a).alias("v"), F.col(b).alias("u"))
    both = store.keep(pair.unionByName(pair.select(F.col("u").alias("v"), F.col("v").alias("u"))), "edges")
    labels = store.keep(
        both.groupBy("v").agg(F.min("u").alias("least")).select(
            F.col("v").alias("vertex"), F.least("v", "least").alias("component")
        ),
        "labels",
    )
    while True:
        offered = (
            both.join(labels.withColumnsRenamed({"vertex": "u", "component": "offer"}), "u")
            .groupBy("v")
            .agg(F.min("offer").alias("offer"))
        )
        lower = labels.join(offered, F.col("vertex") == F.col("v")).select(
            "vertex", F.col("component").alias("was"), F.least("component", "offer").alias("next")
        )
        further = labels.select(F.col("vertex").alias("next"), F.col("component").alias("jump"))
        stepped = lower.join(further, "next").select(
            "vertex", F.least("next", "jump").alias("component"), "was"
        )
        written = store.keep(stepped, "labels")
        labels = written.select("vertex", "component")
        if written.where(F.col("component") != F.col("was")).isEmpty():
            return labels
