"""Thresholds and vocabularies of the encounter analysis.

Every operator takes an :class:`EncounterConfig`, so a deployment changes the
area or a threshold in one place.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values -----------------------------------------------------------
# They decide which rows survive and must stay as they are for equal results.

METRES_PER_NM = 1852.0
EARTH_RADIUS_NM = 3440.065

# MMSI numbers that transponders send when nobody programmed them.
PLACEHOLDER_MMSI = (
    "123456789",
    "987654321",
    "111111111",
    "222222222",
    "333333333",
    "444444444",
    "555555555",
    "666666666",
    "777777777",
    "888888888",
    "999999999",
)

# Unanchored and case-insensitive: any name that contains one of the words.
RESCUE_NAME_PATTERN = (
    r"(?i)(rescue|sar|pilot|coast guard|guard|lifeboat|redning|raddning|pobl)"
)

MMSI_PATTERN = r"^\d{9}$"

# Statuses of vessels that do not sail.
STATIONARY_STATUSES = (
    "At anchor",
    "Moored",
    "Aground",
    "Not under command",
    "Restricted manoeuverability",
    "Engaged in fishing",
)

# --- End of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class EncounterConfig:
    """Parameters of one run; the defaults reproduce the published analysis."""

    # Area of interest
    center_lat: float = 55.225
    center_lon: float = 14.245
    radius_nm: float = 50.0

    # Row quality
    placeholder_mmsi: tuple[str, ...] = PLACEHOLDER_MMSI
    rescue_name_pattern: str = RESCUE_NAME_PATTERN
    stationary_statuses: tuple[str, ...] = STATIONARY_STATUSES

    # Motion between consecutive reports of one vessel
    min_moving_sog: float = 2.0
    min_moving_step_nm: float = 0.02
    max_step_nm: float = 5.0
    max_speed_knots: float = 40.0

    # Candidate pairs: two reports close in space and time
    pair_distance_m: float = 150.0
    pair_gap_sec: int = 600
    pair_lat_tolerance: float = 0.01
    pair_lon_tolerance: float = 0.01

    # Confirmation on interpolated tracks
    track_window_sec: int = 600
    encounter_distance_m: float = 100.0

    # Severity
    silent_sog: float = 0.01
    min_slowdown_ratio: float = 1.1

    # Unique row id used as the last tie-breaker between reports of one vessel
    # at one time and place. Without such a column all other columns break ties.
    row_id: str = "event_id"

    # Physical layout (no influence on results).
    # Length of the time slices that bound per-vessel groups.
    track_chunk_sec: int = 3600
    # Length of the time slices of the windows-to-points join.
    window_chunk_sec: int = 1800
    # Grid of the proximity join over the wide lat/lon tolerance.
    band_cell_sec: int = 1800
    band_cell_deg: float = 0.05
    # Grid of the proximity join limited to ``pair_distance_m``: each cell side
    # is this many times the reach, in latitude and in longitude.
    near_cell_sec: int = 1800
    near_cell_factor: float = 4.0
    # Reports in one cell above which its pairing is divided among tasks.
    crowded_cell_rows: int = 20_000
    # Comparisons per report up to which closest pairs are sought report by report.
    comparisons_per_report: int = 2_000
    # Rows of a side table, checked before the join, up to which it is broadcast.
    broadcast_rows: int = 100_000

    @property
    def pair_distance_nm(self) -> float:
        return self.pair_distance_m / METRES_PER_NM

    @property
    def encounter_distance_nm(self) -> float:
        return self.encounter_distance_m / METRES_PER_NM


DEFAULT_CONFIG = EncounterConfig()
