"""The batch job over daily files: incremental by day, one Spark job per stage."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.config import DEFAULT_CONFIG, EncounterConfig
from fairlead.operators.closest import closest_on_each_day
from fairlead.operators.confirm import PAIR, confirm_encounters
from fairlead.operators.motion import clean_points
from fairlead.operators.proximity import proximity_points
from fairlead.operators.quality import Watch
from fairlead.operators.ranking import rank_events
from fairlead.operators.report import event_summary, impact_points, top_event_tracks
from fairlead.operators.severity import extract_tracks, score_severity, scored_events
from fairlead.sources.day_tables import RETENTION_SEC, DayTable, begun, new_version
from fairlead.sources.position_files import bad_lines, discover_files, files_by_day, read_points
from fairlead.sources.stages import Folder, StageStore


# --- Fixed values: columns of the day tables ---
CLEAN_SCHEMA = (
    "timestamp timestamp, mmsi string, name string, imo string, callsign string,"
    " type_of_mobile string, latitude double, longitude double, sog double, cog double,"
    " heading double, rot double, navigational_status string, ship_type string,"
    " cargo_type string, draught string, destination string, eta string,"
    " data_source_type string, distance_to_center_nm double, ts bigint, file_day string"
)
CANDIDATE_SCHEMA = (
    "mmsi_1 string, mmsi_2 string, name_1 string, name_2 string, timestamp_1 timestamp,"
    " timestamp_2 timestamp, time_diff_sec bigint, distance_m double, latitude_1 double,"
    " longitude_1 double, latitude_2 double, longitude_2 double, sog_1 double, sog_2 double,"
    " status_1 string, status_2 string, ts_1 bigint, ts_2 bigint, file_day string"
)
EVENT_SCHEMA = (
    "pair_id string, mmsi_1 string, mmsi_2 string, name_1 string, name_2 string,"
    " collision_ts bigint, collision_distance_m double, collision_latitude_1 double,"
    " collision_longitude_1 double, collision_latitude_2 double, collision_longitude_2 double,"
    " window_start bigint, window_end bigint,"
    " file_day string"
)
TRACK_SCHEMA = (
    "pair_id string, collision_timestamp timestamp, pair_mmsi_1 string, pair_mmsi_2 string,"
    " mmsi string, name string, timestamp timestamp, latitude double, longitude double,"
    " sog double, navigational_status string, vessel_in_pair int, mean_pair_proportion double,"
    " collision_ts bigint, ts bigint, file_day string"
)
# --- End of fixed values ---

#: Lines with more or fewer fields than their header.
BAD_LINE = "bad_line"
BAD_SCHEMA = "file string, line string, file_day string"
COUNTS_SCHEMA = "version string, measure string, count bigint"


def with_times(df: DataFrame, **seconds: str) -> DataFrame:
    """Adds timestamp columns for epoch-second columns: ``name="seconds_column"``."""
    return df.withColumns({name: F.timestamp_seconds(c) for name, c in seconds.items()})


class DailyJob:
    """Turns a folder of daily CSV files into ranked encounters under ``root``.

    Tables by day: ``clean_points``, ``bad_lines``, ``candidates``, ``events``
    and ``event_tracks``; ``quality_counts`` says per cleaning how many rows each
    rule rejected. A day that a stage has finished is not computed again,
    unless it has got another file: then the day is read from all its files
    and goes through all stages anew. Reports over all days go to a new
    folder below ``root/reports`` each time: ``ranked_tracks``,
    ``event_summary``, ``top_event_tracks`` and ``impact_points``. Run
    :meth:`vacuum` now and then.
    """

    def __init__(self, spark: SparkSession, root: str, cfg: EncounterConfig = DEFAULT_CONFIG):
        self.spark = spark
        self.root = root
        self.cfg = cfg
        self.clean = DayTable(spark, root, "clean_points", CLEAN_SCHEMA)
        self.bad_lines = DayTable(spark, root, "bad_lines", BAD_SCHEMA)
        self.counts_path = f"{root}/quality_counts"
        self.candidates = DayTable(spark, root, "candidates", CANDIDATE_SCHEMA)
        self.events = DayTable(spark, root, "events", EVENT_SCHEMA)
        self.tracks = DayTable(spark, root, "event_tracks", TRACK_SCHEMA)

    def run(self, folder: str, pattern: str = "*.csv", nested: bool = False) -> DataFrame:
        """Processes all pending days and returns the ranked tracks of all days."""
        self.process(discover_files(self.spark, folder, pattern, nested))
        return self.report()

    def process(self, files: list[str]) -> None:
        """Brings the day tables up to date with ``files``.

        A day is made from all files it has ever been given.
        """
        known = self.clean.latest()
        by_day = {
            day: sorted({*given, *known.get(day, ("", []))[1]})
            for day, given in files_by_day(files).items()
        }
        cfg, requested = self.cfg, list(by_day)

        days = self.clean.pending(by_day)
        if days:
            self._clean(days, sorted(f for made_from in days.values() for f in made_from))

        days = self._behind(self.candidates, self.clean, requested)
        if days:
            with StageStore(self.spark, f"{self.root}/stages") as store:
                found = closest_on_each_day(proximity_points(self.clean.read(list(days))), store, cfg)
                timed = with_times(found, timestamp_1="ts_1", timestamp_2="ts_2")
                self.candidates.write(timed, days)

        days = self._behind(self.events, self.candidates, requested)
        if days:
            points, candidates = self.clean.read(list(days)), self.candidates.read(list(days))
            self.events.write(confirm_encounters(points, candidates, cfg), days)

        days = self._behind(self.tracks, self.events, requested)
        if days:
            tracks = extract_tracks(self.clean.read(list(days)), self.events.read(list(days)), cfg)
            timed = with_times(score_severity(tracks, cfg), timestamp="ts", collision_timestamp="collision_ts")
            self.tracks.write(timed, days)

    def _clean(self, days: dict[str, list[str]], files: list[str]) -> None:
        """Writes the clean points of whole days, with what was wrong in their files.

        The one pass that writes the points also counts rows, failures of each rule
        and bad lines; only if there are bad lines they are read again, into a
        table of their own.
        """
        watch = Watch(BAD_LINE, self.cfg)
        points = watch.over(read_points(self.spark, files, BAD_LINE))
        needed = [c for c in self.clean.schema.names if c in points.columns]
        self.clean.write(clean_points(points.select(*needed), self.cfg), days)
        counts = watch.counts()
        version = new_version()
        rows = [(version, name, count) for name, count in counts.items()]
        self.spark.createDataFrame(rows, COUNTS_SCHEMA).coalesce(1).write.mode("append").parquet(self.counts_path)
        bad = bad_lines(self.spark, files) if counts["bad_lines"] else self.spark.createDataFrame([], BAD_SCHEMA)
        self.bad_lines.write(bad, days)

    def quality_counts(self) -> DataFrame:
        """(version, measure, count) of every cleaning: rows, bad_lines and failures of each rule."""
        return self.spark.read.schema(COUNTS_SCHEMA).parquet(self.counts_path)

    @staticmethod
    def _behind(table: DayTable, upstream: DayTable, requested: list[str]) -> dict[str, list[str]]:
        """Requested days of ``table`` that are older than those they come from."""
        made = upstream.latest()
        return table.pending({day: [made[day][0]] for day in requested})

    def report(self, top: int = 1) -> DataFrame:
        """Writes the reports over all days; returns the ranked tracks, worst event first.

        ``event_rank`` is stored, so the order survives storage and files need
        no order of their own. Empty tables without events.
        """
        folder = f"{self.root}/reports/{new_version()}"
        scored, events = self.tracks.read(), self.events.read()
        with StageStore(self.spark, f"{self.root}/stages") as store:
            ranks = rank_events(scored_events(scored), store).select(*PAIR, "event_rank")
            tables = {
                "ranked_tracks": scored.join(ranks, list(PAIR)),
                "event_summary": event_summary(scored, events, self.cfg).join(ranks, list(PAIR)),
                "top_event_tracks": top_event_tracks(scored, top),
                "impact_points": impact_points(scored),
            }
            for name, table in tables.items():
                table.write.parquet(f"{folder}/{name}")
        self.report_folder = folder
        ranked = self.spark.read.parquet(f"{folder}/ranked_tracks")
        return ranked.orderBy("event_rank", "vessel_in_pair", "ts")

    def vacuum(self, retention_sec: int = RETENTION_SEC) -> list[str]:
        """Removes replaced days, leavings of broken runs and older reports; returns their paths.

        Whatever was readable in the last ``retention_sec`` seconds stays, and the
        newest report always.
        """
        gone = []
        for table in (self.clean, self.bad_lines, self.candidates, self.events, self.tracks):
            gone += table.vacuum(retention_sec)
        before = time.time_ns() - int(retention_sec * 1e9)
        reports = Folder(self.spark, f"{self.root}/reports")
        names = reports.children() if reports.exists() else []
        # A report is read until the next one is there.
        gone += [reports.child(old).remove() for old, new in zip(names, names[1:]) if begun(new) < before]
        stages = Folder(self.spark, f"{self.root}/stages")
        for name in stages.children() if stages.exists() else []:
            if stages.child(name).modified_ns() < before:
                gone.append(stages.child(name).remove())
        return gone

    def export_csv(self, df: DataFrame, name: str) -> None:
        """A report as CSV with a header, in the order of its rows."""
        df.write.mode("overwrite").option("header", True).csv(f"{self.root}/{name}_csv")
