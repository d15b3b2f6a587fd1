"""Motion between consecutive reports of a vessel.

The previous report is found over valid reports inside the area, before
stationary, slow or implausible ones are removed: it may itself be dropped
later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairlead.config import DEFAULT_CONFIG, EncounterConfig
from fairlead.functions.geo import bucket, great_circle_nm
from fairlead.operators.area import in_circle
from fairlead.operators.quality import tie_breakers, valid_rows, without_stationary_status

VESSEL = ("file_day", "mmsi")

def with_previous(
    points: DataFrame,
    cfg: EncounterConfig = DEFAULT_CONFIG,
    tail: tuple[str, str] = ("latitude", "longitude"),
) -> DataFrame:
    """Adds ``prev_ts``, ``prev_latitude``, ``prev_longitude`` per vessel and day.

    ``tail`` names the position the next report looks back on.

    A vessel may own a large share of all rows, so its track is cut into time
    chunks that sort independently. Only the first and last report of each
    chunk go on to a second, per-vessel window that links the chunks. Both
    passes read the same shuffle. A chunk holds one row per second at most after
    :func:`fold_simultaneous`; fold first where reports may repeat very often.
    """
    order = ["ts", "latitude", "longitude"]
    order += tie_breakers(points, cfg, [*VESSEL, *order, *tail])
    by_chunk = Window.partitionBy(*VESSEL, "chunk").orderBy(*order)
    by_vessel = Window.partitionBy(*VESSEL).orderBy(*order)
    # Carrying the position as one column keeps both passes on the same columns
    # of the shuffle, which lets Spark run it once.
    here = F.struct("ts", F.col(tail[0]).alias("lat"), F.col(tail[1]).alias("lon"))
    kept = [c for c in points.columns if c in ("latitude", "longitude") or c not in tail]

    chunked = points.select(
        *kept, here.alias("here"), bucket(F.col("ts"), cfg.track_chunk_sec).alias("chunk")
    ).withColumns(
        {
            "prev": F.lag("here").over(by_chunk),
            "chunk_end": F.lead(F.lit(True)).over(by_chunk).isNull(),
        }
    )
    inner = chunked.where(F.col("prev").isNotNull())
    edges = chunked.where(F.col("prev").isNull() | F.col("chunk_end"))
    opening = (
        edges.withColumn("carried", F.lag("here").over(by_vessel))
        .where(F.col("prev").isNull())
        .withColumn("prev", F.col("carried"))
        .drop("carried")
    )
    return inner.unionByName(opening).select(
        *kept,
        F.col("prev.ts").alias("prev_ts"),
        F.col("prev.lat").alias("prev_latitude"),
        F.col("prev.lon").alias("prev_longitude"),
    )


def with_steps(tracked: DataFrame) -> DataFrame:
    """Seconds, nautical miles and implied knots since the previous report.

    The first report of a vessel has NULL in all three; the speed is also NULL
    when no time has passed.
    """
    step = great_circle_nm(
        F.col("prev_latitude"), F.col("prev_longitude"), F.col("latitude"), F.col("longitude")
    )
    stepped = tracked.withColumns(
        {"time_diff_sec": F.col("ts") - F.col("prev_ts"), "step_distance_nm": step}
    )
    hours = F.col("time_diff_sec") / 3600.0
    speed = F.when(F.col("time_diff_sec") > 0, F.col("step_distance_nm") / hours)
    return stepped.withColumn("implied_speed_knots", speed)


def moving(stepped: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Reported speed or covered distance shows motion; a NULL shows none."""
    return stepped.where(
        (F.coalesce("sog", F.lit(0.0)) >= cfg.min_moving_sog)
        | (F.coalesce("step_distance_nm", F.lit(0.0)) >= cfg.min_moving_step_nm)
    )


def plausible(stepped: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Drops jumps, overspeed and reports at the time of their predecessor.

    The first report of a vessel always passes, and reported speed counts only
    where none could be derived.
    """
    speed = F.coalesce("implied_speed_knots", "sog", F.lit(0.0))
    step = F.coalesce("step_distance_nm", F.lit(0.0))
    follows = (
        (F.col("time_diff_sec") > 0)
        & (step <= cfg.max_step_nm)
        & (speed <= cfg.max_speed_knots)
    )
    return stepped.where(F.col("prev_ts").isNull() | follows)


def fold_simultaneous(points: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """One row per vessel and second, folded inside the map tasks first.

    Of several reports in one second only the first in order can pass
    :func:`plausible` (the others have no time since their predecessor), and
    the next second looks back on the last of them. So the first row is kept
    and the last position goes along as ``tail_latitude``/``tail_longitude``.
    """
    keys = [*VESSEL, "ts"]
    lead_columns = ["latitude", "longitude"]
    lead_columns += tie_breakers(points, cfg, [*keys, *lead_columns])
    rest = lead_columns + [c for c in points.columns if c not in keys and c not in lead_columns]
    folded = points.groupBy(*keys).agg(
        F.min(F.struct(*rest)).alias("head"),
        F.max(F.struct("latitude", "longitude")).alias("tail"),
    )
    return folded.select(
        *keys,
        "head.*",
        F.col("tail.latitude").alias("tail_latitude"),
        F.col("tail.longitude").alias("tail_longitude"),
    )


def clean_points(points: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Valid, moving, plausible reports inside the area.

    At most one row per (file_day, mmsi, ts) comes out.
    """
    in_area = in_circle(valid_rows(points, cfg), cfg)
    folded = fold_simultaneous(in_area, cfg)
    tracked = with_previous(folded, cfg, tail=("tail_latitude", "tail_longitude"))
    kept = (
        with_steps(tracked)
        .transform(without_stationary_status, cfg)
        .transform(moving, cfg)
        .transform(plausible, cfg)
    )
    return kept.select(*in_area.columns)
