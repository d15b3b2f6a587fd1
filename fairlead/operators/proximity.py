"""Pairs of vessels that were close in space and time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.config import DEFAULT_CONFIG, EncounterConfig
from fairlead.functions.geo import (
    EDGE_PAD_DEG,
    bucket,
    buckets_touched,
    great_circle_nm,
    metres,
    reach_lat_deg,
    reach_lon_deg,
)
from fairlead.operators.quality import distinct_observations

POINT_COLUMNS = (
    "file_day", "ts", "mmsi", "name", "latitude", "longitude", "sog", "navigational_status",
)
PLACE_COLUMNS = ("file_day", "ts", "mmsi", "latitude", "longitude")
CELL = ("t_cell", "lat_cell", "lon_cell")


def proximity_points(points: DataFrame) -> DataFrame:
    """The columns of the pair search for reports with a time, vessel and place."""
    return points.select(*POINT_COLUMNS).na.drop(subset=["ts", "mmsi", "latitude", "longitude"])


def candidate_points(points: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """:func:`proximity_points` without repeated observations."""
    return distinct_observations(proximity_points(points), cfg=cfg)


def with_overlapping_windows(
    points: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Each report once per sliding window it falls into.

    Windows are two gaps long and start every gap, so a report lies in two of
    them. The pair search itself does not need them, see :class:`Grid`.
    """
    latest = bucket(F.col("ts"), cfg.pair_gap_sec)
    return points.withColumn("window_id", F.explode(F.array(latest, latest - 1)))


@dataclass(frozen=True)
class Grid:
    """Cells of the proximity join and how far a report reaches beyond its own."""

    cell_sec: int
    cell_lat: float
    cell_lon: float
    reach_lat: float
    reach_lon: float | Column

    def locate(self, points: DataFrame) -> DataFrame:
        """Each report with the one cell it lies in."""
        sides = (("ts", self.cell_sec), ("latitude", self.cell_lat), ("longitude", self.cell_lon))
        return points.withColumns({c: bucket(F.col(x), w) for c, (x, w) in zip(CELL, sides)})

    def spread(self, points: DataFrame, gap_sec: int) -> DataFrame:
        """Each report once per cell within its reach."""

        def touched(axis: str, reach: float | Column, width: float) -> Column:
            x = F.col(axis)
            return F.explode(buckets_touched(x - reach, x + reach, width))

        t_cell, lat_cell, lon_cell = CELL
        return (
            points.withColumn(t_cell, touched("ts", gap_sec, self.cell_sec))
            .withColumn(lat_cell, touched("latitude", self.reach_lat, self.cell_lat))
            .withColumn(lon_cell, touched("longitude", self.reach_lon, self.cell_lon))
        )


def band_grid(cfg: EncounterConfig = DEFAULT_CONFIG) -> Grid:
    """Grid for the full lat/lon tolerances."""
    return Grid(
        cell_sec=cfg.band_cell_sec,
        cell_lat=cfg.band_cell_deg,
        cell_lon=cfg.band_cell_deg,
        reach_lat=cfg.pair_lat_tolerance + EDGE_PAD_DEG,
        reach_lon=cfg.pair_lon_tolerance + EDGE_PAD_DEG,
    )


def near_grid(cfg: EncounterConfig = DEFAULT_CONFIG) -> Grid:
    """Grid cut to the reach of ``pair_distance_m``, far below the tolerances."""
    limit = cfg.pair_distance_nm
    reach_lat = reach_lat_deg(limit, cfg.pair_lat_tolerance)
    cell_lat = reach_lat * cfg.near_cell_factor
    return Grid(
        cell_sec=cfg.near_cell_sec,
        cell_lat=cell_lat,
        # Twice the degrees are about as many metres at temperate latitudes.
        cell_lon=2 * cell_lat,
        reach_lat=reach_lat,
        reach_lon=reach_lon_deg(F.col("latitude"), limit, reach_lat, cfg.pair_lon_tolerance),
    )


def cell_counts(points: DataFrame, grid: Grid) -> DataFrame:
    """Reports of each cell and a bound of the ``copies`` that reach it.

    Rows are counted per cell once; the copies are bounded by the neighbours' counts.
    """
    keys = ["file_day", *CELL]
    counts = grid.locate(points).groupBy(*keys).count()
    around = counts
    for cell in CELL:
        near = F.explode(F.array(*(F.col(cell) + step for step in (-1, 0, 1))))
        around = around.withColumn(cell, near)
    return counts.join(around.groupBy(*keys).agg(F.sum("count").alias("copies")), keys)


def crowded_cells(
    points: DataFrame, grid: Grid, cfg: EncounterConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Cells with more than ``crowded_cell_rows`` reports on either side of the join.

    ``shares`` and ``right_shares`` tell how many parts the reports of the cell,
    and the copies that reach it from its neighbours, are dealt into.
    """
    keys = ["file_day", *CELL]

    def shares(rows: str) -> Column:
        return F.ceil(F.col(rows) / F.lit(cfg.crowded_cell_rows)).cast("int")

    return (
        cell_counts(points, grid)
        .where(F.col("copies") > cfg.crowded_cell_rows)
        .select(*keys, shares("count").alias("shares"), shares("copies").alias("right_shares"))
    )


def _deal(rows: DataFrame, own: str, other: str, vessel: str, ts: str) -> DataFrame:
    """Each row in one of its side's shares, copied to all shares of the other side."""
    mine, theirs = F.coalesce(own, F.lit(1)), F.coalesce(other, F.lit(1))
    return (
        rows.withColumn(f"of_{own}", F.pmod(F.xxhash64(vessel, ts), mine).cast("int"))
        .withColumn(f"of_{other}", F.explode(F.sequence(F.lit(0), theirs - 1)))
        .drop(own, other)
    )


def _meet_in_cells(
    points: DataFrame,
    grid: Grid,
    cfg: EncounterConfig,
    condition: Column | None = None,
    crowded: DataFrame | None = None,
) -> DataFrame:
    """Self-join of reports of two vessels, ``mmsi < b_mmsi``, inside the tolerances.

    The left report lies in exactly one cell of a time/latitude/longitude grid;
    the right report is copied to each cell within its reach. A pair therefore
    meets once, the join has equi-keys that spread over space and time, and no
    duplicates need removing. The exact predicates are part of the join.

    Reports of ``crowded`` cells are dealt into shares on both sides, and each
    left share meets each right share of its cell, so neither input of a task
    grows with the cell.
    """
    keys = ["file_day", *CELL]
    left = grid.locate(points)
    right = grid.spread(points, cfg.pair_gap_sec).select(
        *keys, *(F.col(c).alias(f"b_{c}") for c in points.columns if c != "file_day")
    )
    if crowded is not None:
        left = _deal(left.join(crowded, keys, "left"), "shares", "right_shares", "mmsi", "ts")
        right = _deal(right.join(crowded, keys, "left"), "right_shares", "shares", "b_mmsi", "b_ts")
        keys = [*keys, "of_shares", "of_right_shares"]
    close = (
        (F.col("mmsi") < F.col("b_mmsi"))
        & (F.abs(F.col("ts") - F.col("b_ts")) <= cfg.pair_gap_sec)
        & (F.abs(F.col("latitude") - F.col("b_latitude")) <= cfg.pair_lat_tolerance)
        & (F.abs(F.col("longitude") - F.col("b_longitude")) <= cfg.pair_lon_tolerance)
    )
    if condition is not None:
        close = close & condition
    # The work per row far exceeds its size, so the cells are always shuffled:
    # a broadcast would leave the pairing to the few tasks of a small scan.
    met = left.join(right.hint("merge"), keys).where(close)
    return met.withColumn("time_diff_sec", F.abs(F.col("ts") - F.col("b_ts"))).drop(*keys[1:])


def band_pairs(
    points: DataFrame,
    cfg: EncounterConfig = DEFAULT_CONFIG,
    crowded: DataFrame | None = None,
) -> DataFrame:
    """All report pairs inside the time gap and the lat/lon tolerances."""
    return _meet_in_cells(points, band_grid(cfg), cfg, crowded=crowded)


def near_pairs(
    points: DataFrame,
    cfg: EncounterConfig = DEFAULT_CONFIG,
    crowded: DataFrame | None = None,
) -> DataFrame:
    """Report pairs within ``pair_distance_m``; adds ``distance_m``.

    The lat/lon tolerances apply as well.
    """
    distance_nm = great_circle_nm(
        F.col("latitude"), F.col("longitude"), F.col("b_latitude"), F.col("b_longitude")
    )
    within = distance_nm <= F.lit(cfg.pair_distance_nm)
    met = _meet_in_cells(points, near_grid(cfg), cfg, within, crowded)
    return met.withColumn("distance_m", metres(distance_nm))


def closest_pairs(near: DataFrame, points: DataFrame) -> DataFrame:
    """The closest of the report pairs of each two vessels on each day.

    Ties go to the smaller time difference, then to the earlier reports. The
    minimum combines inside the map tasks, so two vessels sailing in company
    send one row per task, and it carries times and places only: name, speed and
    status come from the reports of ``points`` that won.
    """
    places = ("latitude", "longitude", "b_latitude", "b_longitude")
    best = F.min(F.struct("distance_m", "time_diff_sec", "ts", "b_ts", *places))
    won = (
        near.groupBy("file_day", "mmsi", "b_mmsi")
        .agg(best.alias("best"))
        .select("file_day", F.col("mmsi").alias("mmsi_1"), F.col("b_mmsi").alias("mmsi_2"), "best.*")
    )
    return with_reports(won, points)


def with_reports(won: DataFrame, points: DataFrame) -> DataFrame:
    """Candidate rows of pairs of times and places, with the rest of both reports from ``points``."""
    for n, prefix in ((1, ""), (2, "b_")):
        report = points.select(
            "file_day",
            F.col("mmsi").alias(f"mmsi_{n}"),
            *(F.col(c).alias(f"{prefix}{c}") for c in ("ts", "latitude", "longitude")),
            F.col("name").alias(f"name_{n}"),
            F.col("sog").alias(f"sog_{n}"),
            F.col("navigational_status").alias(f"status_{n}"),
        )
        keys = [f"{prefix}{c}" for c in ("ts", "latitude", "longitude")]
        won = won.join(report, ["file_day", f"mmsi_{n}", *keys])
    # Columns of the candidate table, in output order.
    return won.select(
        "file_day",
        "mmsi_1",
        "mmsi_2",
        "name_1",
        "name_2",
        F.col("ts").alias("ts_1"),
        F.col("b_ts").alias("ts_2"),
        "time_diff_sec",
        F.round("distance_m", 3).alias("distance_m"),
        F.col("latitude").alias("latitude_1"),
        F.col("longitude").alias("longitude_1"),
        F.col("b_latitude").alias("latitude_2"),
        F.col("b_longitude").alias("longitude_2"),
        "sog_1",
        "sog_2",
        "status_1",
        "status_2",
    )


def find_candidates(
    points: DataFrame,
    cfg: EncounterConfig = DEFAULT_CONFIG,
    *,
    distinct: bool = False,
    crowded: DataFrame | None = None,
) -> DataFrame:
    """Closest approach of every two vessels per day, from clean points.

    ``distinct=True`` states that no observation occurs twice, which holds for
    the output of ``clean_points``, and saves the de-duplication.
    """
    usable = proximity_points(points) if distinct else candidate_points(points, cfg)
    return closest_pairs(near_pairs(usable.select(*PLACE_COLUMNS), cfg, crowded), usable)
