"""Confirmation of candidates on tracks interpolated to one second.

Points are expected to hold at most one row per (file_day, mmsi, ts), as
``clean_points`` delivers them. A candidate's window is at most half an hour
of two vessels, which bounds every group below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairlead.config import DEFAULT_CONFIG, EncounterConfig
from fairlead.functions.geo import bucket, buckets_touched, great_circle_nm, leg_position, metres
from fairlead.operators.approach import seconds_of_closest, seconds_within

PAIR = ("file_day", "pair_id")


def candidate_windows(candidates: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Names each candidate and spans the time its tracks are examined in."""
    ts_1, ts_2 = F.col("ts_1"), F.col("ts_2")
    timed = candidates.withColumns(
        {
            "center_ts": ((ts_1 + ts_2) / 2).cast("bigint"),
            "window_start": F.least(ts_1, ts_2) - F.lit(cfg.track_window_sec),
            "window_end": F.greatest(ts_1, ts_2) + F.lit(cfg.track_window_sec),
        }
    )
    return timed.select(
        "file_day",
        F.concat_ws("_", "mmsi_1", "mmsi_2", "center_ts").alias("pair_id"),
        "mmsi_1", "mmsi_2", "name_1", "name_2",
        "ts_1", "ts_2", "center_ts", "window_start", "window_end",
    )


def by_vessel(windows: DataFrame) -> DataFrame:
    """One row per vessel of each pair: ``vessel_in_pair`` 1 or 2 and its ``mmsi``."""
    vessel = F.inline(
        F.array(
            F.struct(F.lit(1).alias("vessel_in_pair"), F.col("mmsi_1").alias("mmsi")),
            F.struct(F.lit(2).alias("vessel_in_pair"), F.col("mmsi_2").alias("mmsi")),
        )
    )
    return windows.select("*", vessel)


def points_in_windows(
    points: DataFrame, windows: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Reports of ``mmsi`` between ``window_start`` and ``window_end``, both included.

    A point lies in one time slice and a window is copied to the slices it
    touches, two at most by default. So the range join has equi-keys, meets
    each match once, and splits a busy vessel over many tasks.
    """
    slice_sec = cfg.window_chunk_sec
    sliced_windows = windows.withColumn(
        "slice",
        F.explode(buckets_touched(F.col("window_start"), F.col("window_end"), slice_sec)),
    )
    sliced_points = points.withColumn("slice", bucket(F.col("ts"), slice_sec))
    return (
        sliced_points.join(sliced_windows, ["file_day", "mmsi", "slice"])
        .where(F.col("ts").between(F.col("window_start"), F.col("window_end")))
        .drop("slice")
    )


def pair_points(
    points: DataFrame, windows: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Positions of both vessels of every candidate inside its window."""
    wanted = by_vessel(windows).select(
        *PAIR, "vessel_in_pair", "mmsi", "window_start", "window_end"
    )
    located = points.select("file_day", "mmsi", "ts", "latitude", "longitude")
    return points_in_windows(located, wanted, cfg).select(
        *PAIR, "vessel_in_pair", "ts", "latitude", "longitude"
    )


def segments(pair_pts: DataFrame) -> DataFrame:
    """Straight legs from each position to the next one later in time.

    Of several next positions in one second the least (latitude, longitude)
    counts. Looking at the track backwards turns "all later positions" into a
    growing frame, which Spark aggregates incrementally.
    """
    later = (
        Window.partitionBy(*PAIR, "vessel_in_pair")
        .orderBy(F.col("ts").desc())
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    following = F.min(F.struct("ts", "latitude", "longitude")).over(later)
    return (
        pair_pts.distinct()
        .withColumn("next", following)
        .where(F.col("next").isNotNull())
        .select(
            *PAIR,
            "vessel_in_pair",
            F.col("ts").alias("start_ts"),
            F.col("latitude").alias("start_lat"),
            F.col("longitude").alias("start_lon"),
            F.col("next.ts").alias("end_ts"),
            F.col("next.latitude").alias("end_lat"),
            F.col("next.longitude").alias("end_lon"),
        )
    )


LEG = ("start_ts", "start_lat", "start_lon", "end_ts", "end_lat", "end_lon")


def overlapping_segments(legs: DataFrame) -> DataFrame:
    """Legs of the two vessels of a pair that share more than an instant.

    One sweep in time order instead of a join: whenever a leg starts, the leg
    of the other vessel that started last is the only one that can be under
    way. When both start together, only the second of the two rows sees the
    other, so every overlap comes out once. Needs one position per vessel and
    second; :func:`overlapping_segments_by_join` has no such condition.
    """
    so_far = (
        Window.partitionBy(*PAIR)
        .orderBy("start_ts", "vessel_in_pair")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    leg = F.struct(*LEG)

    def latest(vessel: int):
        return F.last(F.when(F.col("vessel_in_pair") == vessel, leg), ignorenulls=True).over(so_far)

    met = legs.select(*PAIR, latest(1).alias("a"), latest(2).alias("b"))
    return _flatten_overlaps(met)


def overlapping_segments_by_join(legs: DataFrame) -> DataFrame:
    """:func:`overlapping_segments` as an interval join, for tracks with ties."""
    first = legs.where("vessel_in_pair = 1").select(*PAIR, F.struct(*LEG).alias("a"))
    second = legs.where("vessel_in_pair = 2").select(*PAIR, F.struct(*LEG).alias("b"))
    return _flatten_overlaps(first.join(second, list(PAIR)))


def _flatten_overlaps(met: DataFrame) -> DataFrame:
    begin = F.greatest("a.start_ts", "b.start_ts")
    finish = F.least("a.end_ts", "b.end_ts")
    return met.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (begin < finish)).select(
        *PAIR,
        *(F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("a", "b") for c in LEG),
        begin.alias("overlap_start"),
        finish.alias("overlap_end"),
    )


def interpolated_seconds(
    overlaps: DataFrame, first: str = "overlap_start", last: str = "overlap_end"
) -> DataFrame:
    """Both positions at every second from ``first`` to ``last`` of each overlap, ends included."""
    ticking = overlaps.withColumn("interp_ts", F.explode(F.sequence(first, last)))
    return ticking.select(
        *PAIR,
        "interp_ts",
        *(
            leg_position(side, axis, F.col("interp_ts")).alias(f"{axis}_{side}")
            for side in ("a", "b")
            for axis in ("lat", "lon")
        ),
    )


def encounter_seconds(
    positions: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Seconds at which the two vessels were within ``encounter_distance_m``."""
    distance_nm = great_circle_nm(
        F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b")
    )
    near = positions.withColumn("distance_nm", distance_nm).where(
        F.col("distance_nm") <= F.lit(cfg.encounter_distance_nm)
    )
    return near.withColumn("distance_m", metres(F.col("distance_nm"))).drop("distance_nm")


PLACES = ("lat_a", "lon_a", "lat_b", "lon_b")


def close_seconds(overlaps: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """:func:`encounter_seconds` of overlaps, from the closed form instead of all their seconds."""
    near = seconds_within(overlaps, cfg)
    return encounter_seconds(interpolated_seconds(near, "first", "last"), cfg)


def closest_seconds(encounters: DataFrame) -> DataFrame:
    """Closest second of each pair and both interpolated places, the earliest second on ties."""
    hit = F.min(F.struct("distance_m", "interp_ts", *PLACES)).alias("hit")
    return encounters.groupBy(*PAIR).agg(hit).select(
        *PAIR,
        F.col("hit.interp_ts").alias("collision_ts"),
        F.round("hit.distance_m", 3).alias("collision_distance_m"),
        F.col("hit.lat_a").alias("collision_latitude_1"),
        F.col("hit.lon_a").alias("collision_longitude_1"),
        F.col("hit.lat_b").alias("collision_latitude_2"),
        F.col("hit.lon_b").alias("collision_longitude_2"),
    )


#: Interpolated places of both vessels at the closest second.
COLLISION_PLACES = tuple(f"collision_{axis}_{n}" for n in (1, 2) for axis in ("latitude", "longitude"))


def confirm_encounters(
    points: DataFrame, candidates: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Candidates whose interpolated tracks came close at the same second."""
    windows = candidate_windows(candidates, cfg)
    # One shuffle by pair carries all steps up to the closest second.
    together = pair_points(points, windows, cfg).repartition(*PAIR)
    closest = (
        together.transform(segments)
        .transform(overlapping_segments)
        .transform(seconds_of_closest, cfg)
        .transform(interpolated_seconds, "first", "last")
        .transform(encounter_seconds, cfg)
        .transform(closest_seconds)
    )
    named = windows.select(*PAIR, "mmsi_1", "mmsi_2", "name_1", "name_2")
    return closest.join(named, list(PAIR)).select(
        *PAIR, "mmsi_1", "mmsi_2", "name_1", "name_2",
        "collision_ts", "collision_distance_m", *COLLISION_PLACES,
        (F.col("collision_ts") - F.lit(cfg.track_window_sec)).alias("window_start"),
        (F.col("collision_ts") + F.lit(cfg.track_window_sec)).alias("window_end"),
    )
