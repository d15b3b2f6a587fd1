"""The stages of one analysis, wired together."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.config import DEFAULT_CONFIG, EncounterConfig
from fairlead.operators.closest import closest_on_each_day
from fairlead.operators.confirm import candidate_windows, confirm_encounters, pair_points
from fairlead.operators.motion import clean_points
from fairlead.operators.proximity import (
    PLACE_COLUMNS,
    Grid,
    band_grid,
    band_pairs,
    crowded_cells,
    near_grid,
    near_pairs,
    proximity_points,
)
from fairlead.operators.ranking import rank_events
from fairlead.operators.report import event_summary
from fairlead.operators.severity import (
    extract_tracks,
    rank_tracks,
    score_severity,
    scored_events,
)
from fairlead.sources.stages import StageStore


def crowded(
    points: DataFrame, grid: Grid, store: StageStore, cfg: EncounterConfig
) -> DataFrame | None:
    """Crowded cells of a proximity grid, None when there are none.

    The cells are written and counted first, and broadcast only when few.
    """
    cells = store.keep(crowded_cells(points, grid, cfg), "crowded_cells")
    n = cells.count()
    if n == 0:
        return None
    return F.broadcast(cells) if n <= cfg.broadcast_rows else cells


def all_near_pairs(clean: DataFrame, store: StageStore, cfg: EncounterConfig) -> DataFrame:
    """Near pairs of clean points (times and places), with crowded cells divided among tasks."""
    points = proximity_points(clean).select(*PLACE_COLUMNS)
    return near_pairs(points, cfg, crowded(points, near_grid(cfg), store, cfg))


class EncounterAnalysis:
    """From typed position reports of any number of days to ranked events.

    All days go through one job each stage, with ``file_day`` in every key.
    Stages that feed several others (clean points, candidates, encounters,
    scored tracks) are written once to the stage store; the rest stays lazy.
    """

    def __init__(
        self, points: DataFrame, store: StageStore, cfg: EncounterConfig = DEFAULT_CONFIG
    ):
        self.points = points
        self.store = store
        self.cfg = cfg

    @cached_property
    def clean(self) -> DataFrame:
        return self.store.keep(clean_points(self.points, self.cfg), "clean_points")

    @property
    def band_pairs(self) -> DataFrame:
        points = proximity_points(self.clean)
        cells = crowded(points, band_grid(self.cfg), self.store, self.cfg)
        return band_pairs(points, self.cfg, cells)

    @property
    def near_pairs(self) -> DataFrame:
        return all_near_pairs(self.clean, self.store, self.cfg)

    @property
    def closest_pairs(self) -> DataFrame:
        return closest_on_each_day(proximity_points(self.clean), self.store, self.cfg)

    @cached_property
    def candidates(self) -> DataFrame:
        return self.store.keep(self.closest_pairs, "candidates")

    @property
    def windows(self) -> DataFrame:
        return candidate_windows(self.candidates, self.cfg)

    @property
    def pair_points(self) -> DataFrame:
        return pair_points(self.clean, self.windows, self.cfg)

    @cached_property
    def events(self) -> DataFrame:
        confirmed = confirm_encounters(self.clean, self.candidates, self.cfg)
        return self.store.keep(confirmed, "events")

    @property
    def tracks(self) -> DataFrame:
        return extract_tracks(self.clean, self.events, self.cfg)

    @cached_property
    def scored(self) -> DataFrame:
        return self.store.keep(score_severity(self.tracks, self.cfg), "scored_tracks")

    @property
    def ranked_tracks(self) -> DataFrame:
        return rank_tracks(self.scored)

    @property
    def ranked_events(self) -> DataFrame:
        return rank_events(scored_events(self.scored), self.store)

    @property
    def summary(self) -> DataFrame:
        return event_summary(self.scored, self.events, self.cfg)
