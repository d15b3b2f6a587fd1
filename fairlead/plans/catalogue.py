"""Named queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query runs its operator over positions derived from the whole ``events``
table. Measures are rounded so that engines with different math libraries
agree; clock times are epoch seconds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.config import DEFAULT_CONFIG as CFG
from fairlead.functions.geo import bucket, great_circle_nm, metres
from fairlead.operators import area, confirm, motion, proximity, quality, report, severity
from fairlead.plans.analysis import EncounterAnalysis
from fairlead.plans.daily_job import DailyJob
from fairlead.sources import day_tables, position_files
from fairlead.sources.event_feed import ais_points
from fairlead.sources.position_files import FEED_DATE_FORMAT
from fairlead.sources.stages import StageStore
from fairlead.streaming.proximity import land_near_pairs, near_pairs_on_stream

Query = Callable[[SparkSession, str], DataFrame]

POINT = (
    "event_id", "file_day", "mmsi", "ts", "latitude", "longitude", "sog", "navigational_status",
)
PAIR_ROW = (
    "mmsi", "b_mmsi", "ts", "b_ts", "time_diff_sec",
    "latitude", "longitude", "b_latitude", "b_longitude",
)

#: Digits of the speeds in a summary.
SPEEDS = {
    f"{c}_{n}": 6
    for c in ("impact_sog", "mean_sog_before", "mean_sog_after", "sog_proportion")
    for n in (1, 2)
}


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def analysis(spark: SparkSession, sf_dir: str) -> EncounterAnalysis:
    return EncounterAnalysis(ais_points(spark, sf_dir), StageStore(spark), CFG)


# --- Files ------------------------------------------------------------------


def _feed_files(spark: SparkSession, feed: DataFrame) -> list[str]:
    """Writes feed rows as CSV, one folder per day, and returns the files."""
    path = StageStore(spark).path("feed")
    date_text = F.substring_index("# Timestamp", " ", 1)
    dated = feed.withColumn("day", F.to_date(date_text, FEED_DATE_FORMAT))
    dated.write.option("header", True).partitionBy("day").csv(path)
    return position_files.discover_files(spark, path, "*.csv", nested=True)


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _feed_files(spark, position_files.as_feed(ais_points(spark, sf_dir)))
    return position_files.read_feed(spark, files).select(
        F.col("# Timestamp").alias("time_text"),
        F.col("MMSI").alias("mmsi"),
        F.col("Name").alias("name"),
        F.col("Latitude").try_cast("double").alias("latitude"),
        "file_day",
    )


def scan_mixed_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One read of files of three layouts: as they are, more columns in another order, no name."""
    points = ais_points(spark, sf_dir)

    def files(part: int) -> list[str]:
        feed = position_files.as_feed(points.where(F.col("event_id") % 3 == part))
        if part == 0:
            feed = feed.drop("Name")
        if part == 1:
            feed = feed.select(F.lit("x").alias("Extra"), *reversed(feed.columns))
        return _feed_files(spark, feed)

    read = position_files.read_points(spark, [f for part in range(3) for f in files(part)])
    return rounded(
        read.select("mmsi", "ts", "latitude", "longitude", "sog", "name", "file_day"), sog=6
    )


def normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = position_files.normalize_columns(
        position_files.as_feed(ais_points(spark, sf_dir))
    )
    return named.withColumns({c: F.col(c).try_cast("double") for c in ("latitude", "longitude", "sog")})


def standardize_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows of a feed with padded text, words for numbers and odd dates."""
    points = ais_points(spark, sf_dir)
    feed = position_files.normalize_columns(position_files.as_feed(points))
    status = F.col("navigational_status")
    short_day = F.regexp_replace("timestamp", "^0", "")
    damaged = feed.withColumns(
        {
            "mmsi": F.concat(F.lit("  "), "mmsi", F.lit(" ")),
            "latitude": F.when(status == "Moored", "n/a").otherwise(F.col("latitude")),
            "timestamp": F.when(status == "At anchor", short_day).otherwise(F.col("timestamp")),
        }
    )
    return position_files.standardize_types(damaged).select(
        "mmsi", "name", "navigational_status", "ts", "latitude", "longitude", F.round("sog", 6).alias("sog")
    )


def typed_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean points written as CSV by day and read back with their types."""
    clean = _clean(spark, sf_dir).select(*POINT, "name")
    path = StageStore(spark).path("clean_csv")
    day_tables.write_days(clean, path, "csv")
    return rounded(day_tables.read_days(spark, path, clean.schema, "csv"), sog=6)


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean points written by day twice: the second write replaces the first."""
    run = analysis(spark, sf_dir)
    clean = run.clean.select(*POINT, "name")
    path = run.store.path("clean_days")
    for _ in range(2):
        day_tables.write_days(clean, path)
    return rounded(day_tables.read_days(spark, path, clean.schema), sog=6)


def pending_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-minute slots of the feed for which no encounter candidate is stored.

    Slots stand in for days because the small tables span a single day.
    """
    run = analysis(spark, sf_dir)

    def slots(df: DataFrame, ts: str) -> DataFrame:
        return df.select(bucket(F.col(ts), 600).alias("file_day"))

    left = day_tables.pending_days(slots(run.points, "ts"), slots(run.candidates, "ts_1"))
    return left.select(F.col("file_day").alias("slot"))


# --- Points -----------------------------------------------------------------


def _inside(spark: SparkSession, sf_dir: str) -> DataFrame:
    return area.in_circle(quality.valid_rows(ais_points(spark, sf_dir), CFG), CFG)


def _stepped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return motion.with_steps(motion.with_previous(_inside(spark, sf_dir), CFG))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return motion.clean_points(ais_points(spark, sf_dir), CFG)


def haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    distance = great_circle_nm(
        F.col("latitude"), F.col("longitude"), F.lit(CFG.center_lat), F.lit(CFG.center_lon)
    )
    located = ais_points(spark, sf_dir).where(F.col("latitude").isNotNull())
    return located.select("event_id", F.round(metres(distance), 3).alias("distance_m"))


def distance_to_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxed = area.in_box(quality.valid_rows(ais_points(spark, sf_dir), CFG), CFG)
    measured = area.with_center_distance(boxed, CFG).select("event_id", "distance_to_center_nm")
    return rounded(measured, distance_to_center_nm=6)


def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.valid_rows(ais_points(spark, sf_dir), CFG).select(*POINT, "name")


def validity_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validity_reasons(ais_points(spark, sf_dir), CFG)


def bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxed = area.in_box(quality.valid_rows(ais_points(spark, sf_dir), CFG), CFG)
    return boxed.select("event_id", "mmsi", "ts", "latitude", "longitude")


def geofence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _inside(spark, sf_dir).select(
        "event_id", "mmsi", "ts", "latitude", "longitude", "distance_to_center_nm"
    )
    return rounded(found, distance_to_center_nm=6)


def status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.without_stationary_status(_inside(spark, sf_dir), CFG).select(*POINT)


def dedup_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distinct_observations(ais_points(spark, sf_dir), cfg=CFG).select(*POINT)


def track_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return motion.with_previous(_inside(spark, sf_dir), CFG).select(
        "event_id", "mmsi", "ts", "prev_ts", "prev_latitude", "prev_longitude"
    )


def track_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    stepped = _stepped(spark, sf_dir).select(
        "event_id", "mmsi", "ts", "time_diff_sec", "step_distance_nm", "implied_speed_knots"
    )
    return rounded(stepped, step_distance_nm=6, implied_speed_knots=4)


def moving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return motion.moving(_stepped(spark, sf_dir), CFG).select(*POINT)


def plausible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return motion.plausible(_stepped(spark, sf_dir), CFG).select(*POINT)


def clean_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _clean(spark, sf_dir).select(*POINT, "name", "distance_to_center_nm")
    return rounded(found, distance_to_center_nm=6)


# --- Pairs ------------------------------------------------------------------


def candidate_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proximity.candidate_points(_clean(spark, sf_dir), CFG)


def overlapping_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proximity.with_overlapping_windows(_clean(spark, sf_dir), CFG).select(
        "event_id", "mmsi", "ts", "window_id"
    )


def pair_band_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis(spark, sf_dir).band_pairs.select(*PAIR_ROW)


def near_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = analysis(spark, sf_dir).near_pairs.select(*PAIR_ROW, "distance_m")
    return rounded(near, distance_m=3)


def near_pairs_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near pairs by the stream join over the files of the clean points."""
    store, clean = StageStore(spark), _clean(spark, sf_dir).select(*proximity.PLACE_COLUMNS)
    points, out = store.path("clean_points"), store.path("near_pairs")
    clean.write.parquet(points)
    stream = spark.readStream.schema(clean.schema).parquet(points)
    land_near_pairs(stream, out, store.path("checkpoint"), cfg=CFG).awaitTermination()
    schema = near_pairs_on_stream(clean, cfg=CFG).schema
    near = spark.read.schema(schema).parquet(out).select(*PAIR_ROW, "distance_m")
    return rounded(near, distance_m=3)


def closest_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis(spark, sf_dir).closest_pairs


# --- Encounters -------------------------------------------------------------


def candidate_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confirm.candidate_windows(closest_pair(spark, sf_dir), CFG)


def pair_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis(spark, sf_dir).pair_points


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confirm.segments(pair_points(spark, sf_dir).repartition(*confirm.PAIR))


def segment_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confirm.overlapping_segments(segments(spark, sf_dir))


def interpolated_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confirm.interpolated_seconds(segment_overlap(spark, sf_dir))


def encounter_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    met = confirm.close_seconds(segment_overlap(spark, sf_dir), CFG)
    return rounded(met.select("file_day", "pair_id", "interp_ts", "distance_m"), distance_m=3)


def confirmed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = analysis(spark, sf_dir)
    return confirm.confirm_encounters(run.clean, run.candidates, CFG)


# --- Severity ---------------------------------------------------------------


def event_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analysis(spark, sf_dir).tracks, sog=6)


def track_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = analysis(spark, sf_dir).tracks
    first, second = (tracks.where(F.col("vessel_in_pair") == n) for n in (1, 2))
    return rounded(severity.unite_tracks(first, second, CFG), sog=6)


def _ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return severity.sog_before_after(analysis(spark, sf_dir).tracks, CFG)


def sog_before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratios = _ratios(spark, sf_dir)
    return rounded(ratios, mean_sog_before=6, mean_sog_after=6, sog_proportion=6)


def pair_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = severity.pair_severity(_ratios(spark, sf_dir), CFG)
    return rounded(rated, min_pair_proportion=6, mean_pair_proportion=6)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored tracks without a stage table, for queries that read them once."""
    return severity.score_severity(analysis(spark, sf_dir).tracks, CFG)


def ranked_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = severity.rank_tracks(_scored(spark, sf_dir))
    return rounded(ranked, sog=6, mean_pair_proportion=6)


def event_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analysis(spark, sf_dir).ranked_events, mean_pair_proportion=6)


def top_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(severity.top_events(_scored(spark, sf_dir)), mean_pair_proportion=6)


# --- Reports ----------------------------------------------------------------


def top_event_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = report.top_event_tracks(analysis(spark, sf_dir).scored)
    return rounded(top, sog=6, mean_pair_proportion=6)


def impact_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(report.impact_points(_scored(spark, sf_dir)), sog=6)


def event_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        analysis(spark, sf_dir).summary, collision_distance_m=3, mean_pair_proportion=6, **SPEEDS
    )


def all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day in one job, from raw positions to ranked encounters."""
    run = analysis(spark, sf_dir)
    pair = list(confirm.PAIR)
    ranks = run.ranked_events.select(*pair, "event_rank", "mean_pair_proportion")
    found = run.events.join(ranks, pair).select(
        "event_rank", *pair, "mmsi_1", "mmsi_2",
        "collision_ts", "collision_distance_m", "mean_pair_proportion",
    )
    return rounded(found, mean_pair_proportion=6)


def daily_job_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job over CSV files that come in two deliveries, and its summary of all days.

    The second delivery reopens every day; then all that it replaced is removed.
    """
    points = ais_points(spark, sf_dir)
    early, late = (
        _feed_files(spark, position_files.as_feed(points.where(F.col("event_id") % 2 == part))) for part in range(2)
    )
    job = DailyJob(spark, StageStore(spark).path("daily_job"), CFG)
    job.process(early)
    job.process(late)
    job.report()
    job.vacuum(retention_sec=0)
    summary = spark.read.parquet(f"{job.report_folder}/event_summary")
    return rounded(summary, collision_distance_m=3, mean_pair_proportion=6, **SPEEDS)


def queries() -> dict[str, Query]:
    return {
        "scan_csv": scan_csv,
        "scan_mixed_layouts": scan_mixed_layouts,
        "normalize_columns": normalize_columns,
        "standardize_types": standardize_types,
        "typed_points": typed_points,
        "sink_roundtrip": sink_roundtrip,
        "pending_days": pending_days,
        "haversine": haversine,
        "distance_to_center": distance_to_center,
        "valid_rows": valid_rows,
        "validity_reasons": validity_reasons,
        "bbox": bbox,
        "geofence": geofence,
        "status_filter": status_filter,
        "dedup_points": dedup_points,
        "track_lag": track_lag,
        "track_steps": track_steps,
        "moving": moving,
        "plausible": plausible,
        "clean_points": clean_points,
        "candidate_points": candidate_points,
        "overlapping_windows": overlapping_windows,
        "pair_band_join": pair_band_join,
        "near_pairs": near_pairs,
        "near_pairs_stream": near_pairs_stream,
        "closest_pair": closest_pair,
        "candidate_windows": candidate_windows,
        "pair_points": pair_points,
        "segments": segments,
        "segment_overlap": segment_overlap,
        "interpolated_tracks": interpolated_tracks,
        "encounter_seconds": encounter_seconds,
        "confirmed_events": confirmed_events,
        "event_tracks": event_tracks,
        "track_union": track_union,
        "sog_before_after": sog_before_after,
        "severity": pair_severity,
        "ranked_tracks": ranked_tracks,
        "event_ranking": event_ranking,
        "top_event": top_event,
        "top_event_tracks": top_event_tracks,
        "impact_points": impact_points,
        "event_summary": event_summary,
        "all_days": all_days,
        "daily_job_files": daily_job_files,
    }
