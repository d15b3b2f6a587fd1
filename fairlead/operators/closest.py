"""The closest approach of every two vessels, without listing their close report pairs.

Two vessels in company have as many close report pairs as the product of
their reports. Here the pairs of vessels are narrowed in three steps instead:

1. Chunks of tracks (a few minutes of a vessel in one cell) meet by their boxes
   in space and time. Boxes give a lower and mostly an upper bound of the
   distance; only chunk pairs whose lower bound does not exceed the least
   upper bound of their vessels are opened.
2. In the opened chunks every report is compared with the latest report of the
   other vessel, one pass in time order. The least distance found is a bound
   that few of all the pairs undercut.
3. Reports are joined on a grid as fine as that bound.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairlead.config import DEFAULT_CONFIG, EARTH_RADIUS_NM, EncounterConfig
from fairlead.functions.geo import (
    EDGE_PAD_DEG,
    bucket,
    buckets_touched,
    great_circle_nm,
    half_chord,
    metres,
    reach_lat_deg,
    reach_lon_deg,
)
from fairlead.operators.proximity import (
    CELL,
    PLACE_COLUMNS,
    cell_counts,
    closest_pairs,
    near_grid,
    near_pairs,
    with_reports,
)
from fairlead.sources.stages import StageStore

VESSELS = ("file_day", "mmsi_1", "mmsi_2")
EXTENT = ("ts", "latitude", "longitude")
#: Keeps bounds on the safe side of rounding.
SLACK = 1e-9


def chunked(points: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Reports with the chunk they belong to: a cell of the near grid and ``chunk``, half a gap of time."""
    located = near_grid(cfg).locate(points).drop("t_cell")
    return located.withColumn("chunk", bucket(F.col("ts"), cfg.pair_gap_sec // 2))


CHUNK = ("chunk", "lat_cell", "lon_cell")


def chunk_boxes(points: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Extent of every chunk in time, latitude and longitude."""
    sides = [f(c).alias(f"{name}_{c}") for c in EXTENT for f, name in ((F.min, "min"), (F.max, "max"))]
    return chunked(points, cfg).groupBy("file_day", "mmsi", *CHUNK).agg(*sides)


def _gap(c: str) -> Column:
    """How far the extents of two boxes are apart, 0 if they overlap."""
    apart = F.greatest(F.col(f"b_min_{c}") - F.col(f"max_{c}"), F.col(f"min_{c}") - F.col(f"b_max_{c}"))
    return F.greatest(apart, F.lit(0))


def _span(c: str) -> Column:
    """Largest difference between values of two boxes."""
    return F.greatest(F.col(f"b_max_{c}") - F.col(f"min_{c}"), F.col(f"max_{c}") - F.col(f"b_min_{c}"))


def _cosines(side: str) -> tuple[Column, Column]:
    """Least and largest cosine of the latitudes of a box."""
    low, high = F.col(f"{side}min_latitude"), F.col(f"{side}max_latitude")
    nearest = F.when(low * high <= 0, 0.0).otherwise(F.least(F.abs(low), F.abs(high)))
    farthest = F.greatest(F.abs(low), F.abs(high))
    return F.cos(F.radians(farthest)), F.cos(F.radians(nearest))


def box_distances(met: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Adds ``at_least`` and ``at_most``: bounds of the distance of reports of two boxes, in nm.

    ``at_most`` is NULL unless every pair of reports is inside the time gap, the
    tolerances and the pair distance: then some pair that counts is that close.
    """
    (least_a, most_a), (least_b, most_b) = _cosines(""), _cosines("b_")

    def distance(lat: Column, lon: Column, cosines: Column) -> Column:
        return half_chord(F.radians(lat), F.radians(lon), cosines) * F.lit(2 * EARTH_RADIUS_NM)

    low = distance(_gap("latitude"), _gap("longitude"), least_a * least_b) * (1 - SLACK)
    high = distance(_span("latitude"), _span("longitude"), most_a * most_b) * (1 + SLACK)
    all_count = (
        (_span("ts") <= cfg.pair_gap_sec)
        & (_span("latitude") <= cfg.pair_lat_tolerance)
        & (_span("longitude") <= cfg.pair_lon_tolerance)
        & (high <= cfg.pair_distance_nm)
    )
    return met.withColumns({"at_least": low, "at_most": F.when(all_count, high)})


def chunk_pairs(points: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Pairs of chunks of two vessels that may hold a near report pair, with both bounds.

    The left chunk lies in one cell of the join; the right one is copied to the
    cells within reach of its box, so every pair of chunks meets once.
    """
    limit, grid = cfg.pair_distance_nm, near_grid(cfg)
    per_cell = cfg.near_cell_sec // (cfg.pair_gap_sec // 2)
    boxes = chunk_boxes(points, cfg)
    left = boxes.withColumn("t_cell", bucket(F.col("chunk"), per_cell))
    reach_lat = reach_lat_deg(limit, cfg.pair_lat_tolerance)
    poleward = F.greatest(F.abs("min_latitude"), F.abs("max_latitude"))
    reach_lon = reach_lon_deg(poleward, limit, reach_lat, cfg.pair_lon_tolerance)
    chunk_sec = cfg.pair_gap_sec // 2

    def touched(c: str, reach: Column | float, width: float) -> Column:
        return F.explode(buckets_touched(F.col(f"min_{c}") - reach, F.col(f"max_{c}") + reach, width))

    spread = (
        boxes.withColumn("t_cell", touched("ts", F.lit(cfg.pair_gap_sec), per_cell * chunk_sec))
        .withColumn("near_lat", touched("latitude", F.lit(reach_lat), grid.cell_lat))
        .withColumn("near_lon", touched("longitude", reach_lon, grid.cell_lon))
    )
    right = spread.select(
        "file_day", "t_cell", F.col("near_lat").alias("lat_cell"), F.col("near_lon").alias("lon_cell"),
        F.col("mmsi").alias("b_mmsi"), F.col("chunk").alias("b_chunk"),
        F.col("lat_cell").alias("b_lat_cell"), F.col("lon_cell").alias("b_lon_cell"),
        *(F.col(f"{m}_{c}").alias(f"b_{m}_{c}") for c in EXTENT for m in ("min", "max")),
    )
    may_meet = (
        (F.col("mmsi") < F.col("b_mmsi"))
        & (_gap("ts") <= cfg.pair_gap_sec)
        & (_gap("latitude") <= cfg.pair_lat_tolerance)
        & (_gap("longitude") <= cfg.pair_lon_tolerance)
    )
    met = left.join(right.hint("merge"), ["file_day", "t_cell", "lat_cell", "lon_cell"]).where(may_meet)
    bounded = box_distances(met, cfg).where(F.col("at_least") <= limit)
    return bounded.select(
        "file_day", F.col("mmsi").alias("mmsi_1"), F.col("b_mmsi").alias("mmsi_2"),
        *CHUNK, *(f"b_{c}" for c in CHUNK), "at_least", "at_most",
    )


def open_chunks(pairs: DataFrame) -> DataFrame:
    """(vessels, mmsi, chunk): chunks of chunk pairs no worse than the best upper bound of their vessels."""
    best = F.min("at_most").over(Window.partitionBy(*VESSELS))
    opened = pairs.withColumn("best", best).where(F.col("best").isNull() | (F.col("at_least") <= F.col("best")))

    def side(n: int, prefix: str) -> DataFrame:
        cells = (F.col(f"{prefix}{c}").alias(c) for c in CHUNK)
        return opened.select(*VESSELS, F.col(f"mmsi_{n}").alias("mmsi"), *cells)

    return side(1, "").unionByName(side(2, "b_")).distinct()


def _counts(a: str, b: str, cfg: EncounterConfig) -> Column:
    """Whether two reports are inside the time gap and the tolerances."""
    return (
        (F.abs(F.col(f"{a}ts") - F.col(f"{b}ts")) <= cfg.pair_gap_sec)
        & (F.abs(F.col(f"{a}latitude") - F.col(f"{b}latitude")) <= cfg.pair_lat_tolerance)
        & (F.abs(F.col(f"{a}longitude") - F.col(f"{b}longitude")) <= cfg.pair_lon_tolerance)
    )


def _distance(a: str, b: str) -> Column:
    return great_circle_nm(*(F.col(f"{p}{c}") for p in (a, b) for c in ("latitude", "longitude")))


def bounded_reports(
    points: DataFrame, chunks: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Reports of opened chunks with ``bound``, the best (distance, gap) known for their vessels.

    In time order each report is compared with the latest one of the other
    vessel, so the bound costs one sort of each two vessels' reports. Without a
    pair that counts, the bound is the pair distance at the full gap.
    """
    rows = chunked(points, cfg).join(chunks, ["file_day", "mmsi", *CHUNK])
    rows = rows.select(*VESSELS, (F.col("mmsi") == F.col("mmsi_1")).alias("is_first"), *EXTENT)
    so_far = (
        Window.partitionBy(*VESSELS)
        .orderBy("ts", "is_first", "latitude", "longitude")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    whole = Window.partitionBy(*VESSELS)
    here = F.struct(*EXTENT)
    latest = {
        first: F.last(F.when(F.col("is_first") == F.lit(first), here), ignorenulls=True).over(so_far)
        for first in (True, False)
    }
    other = F.when(F.col("is_first"), latest[False]).otherwise(latest[True])
    compared = rows.withColumn("other", other).select("*", *(F.col(f"other.{c}").alias(f"o_{c}") for c in EXTENT))
    # Both orders of two places may round differently: the first vessel's comes first, as in the join.
    distance = F.when(F.col("is_first"), _distance("", "o_")).otherwise(_distance("o_", ""))
    found = F.when(
        _counts("", "o_", cfg) & (distance <= cfg.pair_distance_nm),
        F.struct(distance.alias("distance"), F.abs(F.col("ts") - F.col("o_ts")).alias("gap")),
    )
    widest = F.struct(
        F.lit(cfg.pair_distance_nm).alias("distance"), F.lit(cfg.pair_gap_sec).cast("bigint").alias("gap")
    )
    return compared.select(
        *VESSELS,
        "is_first",
        *EXTENT,
        F.coalesce(F.min(found).over(whole), widest).alias("bound"),
        F.max(F.abs("latitude")).over(whole).alias("poleward"),
    )


def undercutting_pairs(bounded: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Report pairs of two vessels no worse than their bound, with (distance_nm, time_diff_sec).

    The cells are twice as wide as the bound, per pair of vessels; a report of
    the first lies in one, one of the second is copied to those within reach.
    """
    distance = F.col("bound.distance")
    reach_lat = F.least(F.degrees(distance / EARTH_RADIUS_NM), F.lit(cfg.pair_lat_tolerance)) + EDGE_PAD_DEG
    pole = F.radians(F.least(F.col("poleward") + reach_lat, F.lit(90.0)))
    half_sine = F.sin(distance / (2 * EARTH_RADIUS_NM)) / F.cos(pole)
    wide = F.nanvl(F.degrees(2 * F.asin(half_sine)), F.lit(math.inf))
    reach_lon = F.least(wide, F.lit(cfg.pair_lon_tolerance)) + EDGE_PAD_DEG
    sized = bounded.withColumns({"reach_latitude": reach_lat, "reach_longitude": reach_lon})
    time_width = 2 * cfg.pair_gap_sec

    def cell(c: str) -> Column:
        return F.floor(F.col(c) / (2 * F.col(f"reach_{c}")))

    def cells(c: str) -> Column:
        reach = F.col(f"reach_{c}")
        return F.explode(F.sequence(F.floor((F.col(c) - reach) / (2 * reach)), F.floor((F.col(c) + reach) / (2 * reach))))

    left = sized.where("is_first").select(
        *VESSELS, *EXTENT, "bound", bucket(F.col("ts"), time_width).alias("t_cell"),
        cell("latitude").alias("lat_cell"), cell("longitude").alias("lon_cell"),
    )
    gap = cfg.pair_gap_sec
    right = (
        sized.where("NOT is_first")
        .withColumn("t_cell", F.explode(buckets_touched(F.col("ts") - gap, F.col("ts") + gap, time_width)))
        .withColumn("lat_cell", cells("latitude"))
        .withColumn("lon_cell", cells("longitude"))
        .select(*VESSELS, *CELL, *(F.col(c).alias(f"b_{c}") for c in EXTENT))
    )
    measured = F.struct(
        _distance("", "b_").alias("distance"), F.abs(F.col("ts") - F.col("b_ts")).alias("gap")
    )
    met = left.join(right.hint("merge"), [*VESSELS, *CELL])
    return (
        met.where(_counts("", "b_", cfg) & (measured <= F.col("bound")))
        .withColumns({"distance_nm": _distance("", "b_"), "time_diff_sec": F.abs(F.col("ts") - F.col("b_ts"))})
        .select(*VESSELS, *EXTENT, *(f"b_{c}" for c in EXTENT), "distance_nm", "time_diff_sec")
    )


def is_sparse(points: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> bool:
    """Whether joining the reports of each cell takes few comparisons, and none for a crowded cell."""
    places = points.select(*PLACE_COLUMNS)
    load = cell_counts(places, near_grid(cfg)).agg(
        F.sum(F.col("count") * F.col("copies")).alias("comparisons"),
        F.sum("count").alias("reports"),
        F.max("copies").alias("most"),
    )
    comparisons, reports, most = load.first()
    return not reports or (
        comparisons <= cfg.comparisons_per_report * reports and most <= cfg.crowded_cell_rows
    )


def closest_on_each_day(
    points: DataFrame, store: StageStore, cfg: EncounterConfig = DEFAULT_CONFIG
) -> DataFrame:
    """The closest near report pair of each two vessels on each day, by the cheaper of two ways.

    Both give the same rows: a sparse sea is joined report by report, a busy
    one goes through :func:`closest_approaches`.
    """
    if is_sparse(points, cfg):
        return closest_pairs(near_pairs(points.select(*PLACE_COLUMNS), cfg), points)
    return closest_approaches(points, store, cfg)


def closest_approaches(
    points: DataFrame, store: StageStore, cfg: EncounterConfig = DEFAULT_CONFIG
) -> DataFrame:
    """The closest near report pair of each two vessels on each day, as :func:`~.proximity.closest_pairs`.

    ``points`` are distinct observations with a time, vessel and place. Rows
    written and joined grow with the reports of vessels that meet, not with
    the number of their close report pairs.
    """
    places = points.select(*PLACE_COLUMNS)
    chunks = store.keep(open_chunks(chunk_pairs(places, cfg)), "open_chunks")
    bounded = store.keep(bounded_reports(places, chunks, cfg), "bounded_reports")
    sides = ("latitude", "longitude", "b_latitude", "b_longitude")
    best = F.min(F.struct("distance_nm", "time_diff_sec", "ts", "b_ts", *sides)).alias("best")
    won = undercutting_pairs(bounded, cfg).groupBy(*VESSELS).agg(best).select(*VESSELS, "best.*")
    return with_reports(won.withColumn("distance_m", metres(F.col("distance_nm"))), points)
