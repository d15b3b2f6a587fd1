"""Event tracks, slow-down ratios and ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairlead.config import DEFAULT_CONFIG, EncounterConfig
from fairlead.functions.exact import exact_mean
from fairlead.operators.confirm import PAIR, by_vessel, points_in_windows
from fairlead.operators.quality import distinct_observations

TRACK_COLUMNS = (
    "file_day", "pair_id", "collision_ts", "pair_mmsi_1", "pair_mmsi_2", "mmsi", "name",
    "ts", "latitude", "longitude", "sog", "navigational_status", "vessel_in_pair",
)


def extract_tracks(
    points: DataFrame, events: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Reports of both vessels around each confirmed encounter.

    Both vessels come from one join, so there is nothing to unite afterwards,
    and clean points repeat no observation.
    """
    wanted = by_vessel(events).select(
        *PAIR,
        "collision_ts",
        "window_start",
        "window_end",
        F.col("mmsi_1").alias("pair_mmsi_1"),
        F.col("mmsi_2").alias("pair_mmsi_2"),
        "mmsi",
        "vessel_in_pair",
    )
    reported = points.select(
        "file_day", "mmsi", "ts", "name", "latitude", "longitude", "sog", "navigational_status"
    )
    return points_in_windows(reported, wanted, cfg).select(*TRACK_COLUMNS)


def unite_tracks(
    first: DataFrame, second: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Tracks of the two vessels in one table, each observation once."""
    keys = [*PAIR, "mmsi", "ts", "latitude", "longitude"]
    return distinct_observations(first.unionByName(second), keys, cfg)


def sog_before_encounter() -> Column:
    return F.when(F.col("ts") < F.col("collision_ts"), F.col("sog"))


def sog_after_encounter() -> Column:
    return F.when(F.col("ts") > F.col("collision_ts"), F.col("sog"))


def or_silent(mean: Column, cfg: EncounterConfig) -> Column:
    return F.coalesce(mean, F.lit(cfg.silent_sog))


def sog_before_after(tracks: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Mean speed before and after the encounter and their ratio, per vessel.

    A side without any reported speed counts as a silent transponder. A vessel
    that reports standing still afterwards has no ratio. The means are exact, so
    they agree to the bit with :func:`score_severity` in any layout.
    """
    means = tracks.groupBy(*PAIR, "mmsi").agg(
        exact_mean(sog_before_encounter()).alias("before"), exact_mean(sog_after_encounter()).alias("after")
    )
    before, after = or_silent(F.col("before"), cfg), or_silent(F.col("after"), cfg)
    return means.select(
        *PAIR,
        "mmsi",
        before.alias("mean_sog_before"),
        after.alias("mean_sog_after"),
        F.try_divide(before, after).alias("sog_proportion"),
    )


def pair_severity(ratios: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Least and mean ratio of each pair, for pairs that slowed down enough."""
    both = ratios.groupBy(*PAIR).agg(
        F.min("sog_proportion").alias("min_pair_proportion"),
        F.avg("sog_proportion").alias("mean_pair_proportion"),
    )
    return both.where(F.col("min_pair_proportion") >= cfg.min_slowdown_ratio)


def score_severity(tracks: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Tracks of the pairs that slowed down, with ``mean_pair_proportion``.

    Same outcome as joining the tracks with :func:`pair_severity`, but windows
    over one shuffle by pair replace two aggregations and a join that would
    compute the tracks twice. A pair holds some twenty minutes of two vessels.
    """
    vessel = Window.partitionBy(*PAIR, "vessel_in_pair")
    pair = Window.partitionBy(*PAIR)
    before = or_silent(exact_mean(sog_before_encounter(), vessel), cfg)
    after = or_silent(exact_mean(sog_after_encounter(), vessel), cfg)
    rated = tracks.repartition(*PAIR).withColumn("ratio", F.try_divide(before, after))
    for n in (1, 2):
        of_vessel = F.when(F.col("vessel_in_pair") == n, F.col("ratio"))
        rated = rated.withColumn(f"ratio_{n}", F.max(of_vessel).over(pair))
    # A vessel without a ratio leaves the verdict to the other one.
    first, second = F.col("ratio_1"), F.col("ratio_2")
    mean = F.coalesce((first + second) / 2, first, second)
    return (
        rated.where(F.least(first, second) >= cfg.min_slowdown_ratio)
        .withColumn("mean_pair_proportion", mean)
        .select(*tracks.columns, "mean_pair_proportion")
    )


SEVERITY_ORDER = ("mean_pair_proportion", "collision_ts", "pair_id", "file_day")


def severity_order() -> list[Column]:
    """Most severe event first; time, pair and day settle ties."""
    worst, *ties = SEVERITY_ORDER
    return [F.col(worst).desc_nulls_last(), *(F.col(c).asc() for c in ties)]


def rank_tracks(scored: DataFrame) -> DataFrame:
    """All track rows in report order, by a range-partitioned global sort."""
    return scored.orderBy(*severity_order(), "vessel_in_pair", "ts")


def scored_events(scored: DataFrame) -> DataFrame:
    """One row per event of the scored tracks."""
    return scored.groupBy(*PAIR, "collision_ts", "pair_mmsi_1", "pair_mmsi_2").agg(
        F.first("mean_pair_proportion").alias("mean_pair_proportion")
    )


def top_events(scored: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` most severe events (a top-k, no full sort)."""
    return scored_events(scored).orderBy(*severity_order()).limit(n)
