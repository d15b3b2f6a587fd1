"""Row-level validity, status and duplicate handling."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fairlead.config import DEFAULT_CONFIG, MMSI_PATTERN, EncounterConfig


def validity_rules(cfg: EncounterConfig = DEFAULT_CONFIG) -> dict[str, Column]:
    """Named predicates a usable report has to meet, cheapest first."""
    lat, lon, mmsi, name = (F.col(c) for c in ("latitude", "longitude", "mmsi", "name"))
    return {
        "has_time": F.col("ts").isNotNull(),
        "has_latitude": lat.isNotNull(),
        "has_longitude": lon.isNotNull(),
        "latitude_set": lat != 0.0,
        "longitude_set": lon != 0.0,
        "latitude_on_globe": F.abs(lat) <= 90.0,
        "longitude_on_globe": F.abs(lon) <= 180.0,
        "mmsi_well_formed": mmsi.rlike(MMSI_PATTERN),
        "mmsi_assigned": ~mmsi.isin(*cfg.placeholder_mmsi),
        "not_rescue_craft": name.isNull() | ~name.rlike(cfg.rescue_name_pattern),
    }


def valid_rows(points: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """Reports that meet every rule; a NULL outcome counts as failed."""
    return points.where(reduce(lambda a, b: a & b, validity_rules(cfg).values()))


def validity_reasons(points: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG) -> DataFrame:
    """(rule, failed_rows): how many reports each rule rejects, in one pass."""
    counts = points.agg(*failure_counts(cfg))
    return counts.unpivot([], list(validity_rules(cfg)), "rule", "failed_rows")


def failure_counts(cfg: EncounterConfig = DEFAULT_CONFIG) -> list[Column]:
    """Aggregates: how many reports each rule rejects, named after the rule."""
    rules = validity_rules(cfg)
    return [F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]


class Watch:
    """Counts reports on their way to wherever they are written.

    Write what :meth:`over` returns; then :meth:`counts` holds ``rows``, the counts of
    :func:`validity_reasons` and, with the column ``bad_line``, ``bad_lines``: no
    second pass over the files is needed.
    """

    def __init__(self, bad_line: str | None = None, cfg: EncounterConfig = DEFAULT_CONFIG):
        self._observation = Observation()
        self._measures = [F.count(F.lit(1)).alias("rows"), *failure_counts(cfg)]
        if bad_line:
            self._measures.append(F.count(bad_line).alias("bad_lines"))

    def over(self, points: DataFrame) -> DataFrame:
        self._points = points
        return points.observe(self._observation, *self._measures)

    def counts(self) -> dict[str, int]:
        """The counts, once the points were written."""
        try:
            return self._observation.get
        except Py4JJavaError:
            # Adaptive execution drops the counters with a stage that turns out
            # to give no rows; then the points are counted on their own.
            return self._points.agg(*self._measures).first().asDict()


def without_stationary_status(
    points: DataFrame, cfg: EncounterConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Drops anchored, moored and similar reports, and those without a status."""
    return points.where(~F.col("navigational_status").isin(*cfg.stationary_statuses))


def tie_breakers(points: DataFrame, cfg: EncounterConfig, used: list[str]) -> list[str]:
    """Columns that complete ``used`` to a total order of the rows."""
    if cfg.row_id in points.columns:
        return [cfg.row_id]
    return [c for c in points.columns if c not in used]


def distinct_observations(
    points: DataFrame,
    keys: list[str] | None = None,
    cfg: EncounterConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """One row per observation, always the same one: the least by content.

    Partial aggregation folds copies inside each map task, so a heavily
    duplicated observation is never shuffled copy by copy.
    """
    keys = keys or ["file_day", "mmsi", "ts", "latitude", "longitude"]
    order = tie_breakers(points, cfg, keys)
    rest = order + [c for c in points.columns if c not in keys and c not in order]
    if not rest:
        return points.distinct()
    kept = points.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(*keys, "kept.*").select(*points.columns)
