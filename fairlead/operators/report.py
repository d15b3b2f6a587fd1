"""Per-event reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.config import DEFAULT_CONFIG, EncounterConfig
from fairlead.functions.exact import exact_mean
from fairlead.operators.confirm import COLLISION_PLACES, PAIR
from fairlead.operators.severity import or_silent, sog_after_encounter, sog_before_encounter, top_events


def top_event_tracks(scored: DataFrame, n: int = 1) -> DataFrame:
    """Track rows of the ``n`` most severe events, by vessel and time."""
    wanted = top_events(scored, n).select(*PAIR)
    return scored.join(wanted, list(PAIR), "left_semi").orderBy(*PAIR, "vessel_in_pair", "ts")


def _nearest_report() -> Column:
    """Sort key first: distance in time to the encounter, then the earlier report."""
    off = F.abs(F.col("ts") - F.col("collision_ts")).alias("off_sec")
    return F.struct(off, "ts", "latitude", "longitude", "sog")


def impact_points(tracks: DataFrame) -> DataFrame:
    """Report of each vessel that is nearest in time to the encounter."""
    nearest = tracks.groupBy(*PAIR, "collision_ts", "vessel_in_pair", "mmsi").agg(
        F.min(_nearest_report()).alias("hit")
    )
    return nearest.select(
        *PAIR, "collision_ts", "vessel_in_pair", "mmsi",
        "hit.ts", "hit.latitude", "hit.longitude", "hit.sog", "hit.off_sec",
    )


def event_summary(
    scored: DataFrame, events: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG
) -> DataFrame:
    """One row per scored event: when, who, where, how fast, and how much slower afterwards.

    ``impact_`` columns are the nearest reports in time, ``collision_`` columns
    the interpolated places and distance, which ``events`` (the confirmed
    encounters) hold. The mean speeds before and after and their ratio
    are those that scored the event.
    """

    def vessel(n: int) -> list[Column]:
        here = F.col("vessel_in_pair") == n
        named = here & F.col("name").isNotNull()
        return [
            F.min(F.when(here, _nearest_report())).alias(f"hit_{n}"),
            F.min(F.when(named, F.struct("ts", "name"))).alias(f"named_{n}"),
            or_silent(exact_mean(F.when(here, sog_before_encounter())), cfg).alias(f"mean_sog_before_{n}"),
            or_silent(exact_mean(F.when(here, sog_after_encounter())), cfg).alias(f"mean_sog_after_{n}"),
        ]

    found = scored.groupBy(*PAIR, "collision_ts", "pair_mmsi_1", "pair_mmsi_2").agg(
        F.first("mean_pair_proportion").alias("mean_pair_proportion"), *vessel(1), *vessel(2)
    )
    # Events stored before they had interpolated places have none.
    absent = {c: F.lit(None).cast("double") for c in COLLISION_PLACES if c not in events.columns}
    places = events.withColumns(absent).select(*PAIR, "collision_distance_m", *COLLISION_PLACES)

    def described(n: int) -> list[Column]:
        mmsi, hit = F.col(f"pair_mmsi_{n}"), f"hit_{n}"
        label = F.coalesce(f"named_{n}.name", F.concat(F.lit("Vessel "), mmsi))
        before, after = F.col(f"mean_sog_before_{n}"), F.col(f"mean_sog_after_{n}")
        return [
            mmsi.alias(f"mmsi_{n}"),
            label.alias(f"vessel_{n}"),
            F.round(f"{hit}.latitude", 5).alias(f"impact_latitude_{n}"),
            F.round(f"{hit}.longitude", 5).alias(f"impact_longitude_{n}"),
            F.col(f"{hit}.sog").alias(f"impact_sog_{n}"),
            F.col(f"collision_latitude_{n}"),
            F.col(f"collision_longitude_{n}"),
            before,
            after,
            F.try_divide(before, after).alias(f"sog_proportion_{n}"),
        ]

    return found.join(places, list(PAIR)).select(
        *PAIR, "collision_ts", "collision_distance_m", "mean_pair_proportion",
        *described(1), *described(2),
    )
