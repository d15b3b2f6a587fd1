"""Independent SQL for every named query, for DuckDB over the same tables.

Each statement is the plain formulation of its query: theta joins, correlated
ranks and self-joins where the Spark side uses grids, sweeps and windows.
"""

from __future__ import annotations

from fairlead.config import (
    EARTH_RADIUS_NM,
    METRES_PER_NM,
    MMSI_PATTERN,
    PLACEHOLDER_MMSI,
    RESCUE_NAME_PATTERN,
    STATIONARY_STATUSES,
    EncounterConfig,
)
from fairlead.sources.event_feed import AIS_POINTS_SQL

CFG = EncounterConfig()


def _distance(lat_a: str, lon_a: str, lat_b: str, lon_b: str) -> str:
    h = (
        f"(pow(sin(radians({lat_b} - {lat_a}) / 2), 2) + cos(radians({lat_a}))"
        f" * cos(radians({lat_b})) * pow(sin(radians({lon_b} - {lon_a}) / 2), 2))"
    )
    return f"({EARTH_RADIUS_NM} * 2 * atan2(sqrt({h}), sqrt(1 - {h})))"


def _listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_BOX = (
    f"abs(latitude - {CFG.center_lat}) <= {CFG.radius_nm} / 60.0 AND abs(longitude - {CFG.center_lon})"
    f" <= {CFG.radius_nm} / (60.0 * cos(radians({CFG.center_lat})))"
)
_STATUS = f"navigational_status NOT IN ({_listed(STATIONARY_STATUSES)})"
_MOVING = (
    f"(coalesce(sog, 0) >= {CFG.min_moving_sog}"
    f" OR coalesce(step_distance_nm, 0) >= {CFG.min_moving_step_nm})"
)
_PLAUSIBLE = (
    "(prev_ts IS NULL OR (time_diff_sec > 0"
    f" AND coalesce(step_distance_nm, 0) <= {CFG.max_step_nm}"
    f" AND coalesce(implied_speed_knots, sog, 0) <= {CFG.max_speed_knots}))"
)
_RULES = {
    "has_time": "ts IS NOT NULL",
    "has_latitude": "latitude IS NOT NULL",
    "has_longitude": "longitude IS NOT NULL",
    "latitude_set": "latitude <> 0",
    "longitude_set": "longitude <> 0",
    "latitude_on_globe": "abs(latitude) <= 90",
    "longitude_on_globe": "abs(longitude) <= 180",
    "mmsi_well_formed": f"regexp_matches(mmsi, '{MMSI_PATTERN}')",
    "mmsi_assigned": f"mmsi NOT IN ({_listed(PLACEHOLDER_MMSI)})",
    "not_rescue_craft": f"(name IS NULL OR NOT regexp_matches(name, '{RESCUE_NAME_PATTERN}'))",
}

_POINT = "event_id, file_day, mmsi, ts, latitude, longitude, sog, navigational_status"

# Named steps, each built on the ones before it.
_STEPS: dict[str, str] = {
    "ais": AIS_POINTS_SQL.format(events="events"),
    "valid": f"SELECT * FROM ais WHERE {' AND '.join(_RULES.values())}",
    "measured": (
        f"SELECT *, {_distance('latitude', 'longitude', str(CFG.center_lat), str(CFG.center_lon))}"
        f" AS distance_to_center_nm FROM valid WHERE {_BOX}"
    ),
    "inside": f"SELECT * FROM measured WHERE distance_to_center_nm <= {CFG.radius_nm}",
    "lagged": """
        SELECT *, lag(ts) OVER w AS prev_ts, lag(latitude) OVER w AS prev_latitude,
               lag(longitude) OVER w AS prev_longitude
        FROM inside
        WINDOW w AS (PARTITION BY file_day, mmsi ORDER BY ts, latitude, longitude, event_id)""",
    "stepped": f"""
        SELECT *, CASE WHEN time_diff_sec > 0
                       THEN step_distance_nm / (time_diff_sec / CAST(3600 AS DOUBLE)) END
                  AS implied_speed_knots
        FROM (SELECT *, ts - prev_ts AS time_diff_sec,
                {_distance('prev_latitude', 'prev_longitude', 'latitude', 'longitude')}
                AS step_distance_nm
              FROM lagged) s""",
    "clean": f"SELECT * FROM stepped WHERE {_STATUS} AND {_MOVING} AND {_PLAUSIBLE}",
    "band": f"""
        SELECT a.file_day, a.mmsi, a.ts, a.name, a.latitude, a.longitude, a.sog,
               a.navigational_status, b.mmsi AS b_mmsi, b.ts AS b_ts, b.name AS b_name,
               b.latitude AS b_latitude, b.longitude AS b_longitude, b.sog AS b_sog,
               b.navigational_status AS b_status, abs(a.ts - b.ts) AS time_diff_sec
        FROM clean a JOIN clean b
          ON a.file_day = b.file_day AND a.mmsi < b.mmsi
         AND abs(a.ts - b.ts) <= {CFG.pair_gap_sec}
         AND abs(a.latitude - b.latitude) <= {CFG.pair_lat_tolerance}
         AND abs(a.longitude - b.longitude) <= {CFG.pair_lon_tolerance}""",
    "near": f"""
        SELECT * FROM (SELECT *,
            {_distance('latitude', 'longitude', 'b_latitude', 'b_longitude')} AS distance_nm
          FROM band) d
        WHERE distance_nm <= {CFG.pair_distance_m} / {METRES_PER_NM}""",
    "closest": f"""
        SELECT *, distance_nm * {METRES_PER_NM} AS distance_m FROM (
          SELECT *, row_number() OVER (PARTITION BY file_day, mmsi, b_mmsi
                      ORDER BY distance_nm, time_diff_sec, ts, b_ts) AS pair_rank
          FROM near) r
        WHERE pair_rank = 1""",
    "windows": f"""
        SELECT file_day, concat(mmsi, '_', b_mmsi, '_', CAST((ts + b_ts) // 2 AS VARCHAR))
                 AS pair_id,
               mmsi AS mmsi_1, b_mmsi AS mmsi_2, name AS name_1, b_name AS name_2,
               ts AS ts_1, b_ts AS ts_2, (ts + b_ts) // 2 AS center_ts,
               least(ts, b_ts) - {CFG.track_window_sec} AS window_start,
               greatest(ts, b_ts) + {CFG.track_window_sec} AS window_end
        FROM closest""",
    "pair_pts": """
        SELECT DISTINCT w.file_day, w.pair_id, 1 AS vessel_in_pair, p.ts, p.latitude, p.longitude
        FROM windows w JOIN clean p ON p.file_day = w.file_day AND p.mmsi = w.mmsi_1
         AND p.ts >= w.window_start AND p.ts <= w.window_end
        UNION ALL
        SELECT DISTINCT w.file_day, w.pair_id, 2 AS vessel_in_pair, p.ts, p.latitude, p.longitude
        FROM windows w JOIN clean p ON p.file_day = w.file_day AND p.mmsi = w.mmsi_2
         AND p.ts >= w.window_start AND p.ts <= w.window_end""",
    "legs": """
        SELECT file_day, pair_id, vessel_in_pair, start_ts, start_lat, start_lon,
               end_ts, end_lat, end_lon
        FROM (SELECT l.file_day, l.pair_id, l.vessel_in_pair, l.ts AS start_ts,
                     l.latitude AS start_lat, l.longitude AS start_lon, r.ts AS end_ts,
                     r.latitude AS end_lat, r.longitude AS end_lon,
                     row_number() OVER (
                       PARTITION BY l.file_day, l.pair_id, l.vessel_in_pair, l.ts,
                                    l.latitude, l.longitude
                       ORDER BY r.ts, r.latitude, r.longitude) AS pick
              FROM pair_pts l JOIN pair_pts r
                ON l.file_day = r.file_day AND l.pair_id = r.pair_id
               AND l.vessel_in_pair = r.vessel_in_pair AND l.ts < r.ts) n
        WHERE pick = 1""",
    "shared_legs": """
        SELECT a.file_day, a.pair_id,
               a.start_ts AS a_start_ts, a.start_lat AS a_start_lat, a.start_lon AS a_start_lon,
               a.end_ts AS a_end_ts, a.end_lat AS a_end_lat, a.end_lon AS a_end_lon,
               b.start_ts AS b_start_ts, b.start_lat AS b_start_lat, b.start_lon AS b_start_lon,
               b.end_ts AS b_end_ts, b.end_lat AS b_end_lat, b.end_lon AS b_end_lon,
               greatest(a.start_ts, b.start_ts) AS overlap_start,
               least(a.end_ts, b.end_ts) AS overlap_end
        FROM legs a JOIN legs b
          ON a.file_day = b.file_day AND a.pair_id = b.pair_id
         AND a.vessel_in_pair = 1 AND b.vessel_in_pair = 2
         AND greatest(a.start_ts, b.start_ts) < least(a.end_ts, b.end_ts)""",
    "ticks": """
        SELECT *, unnest(generate_series(overlap_start, overlap_end)) AS interp_ts FROM shared_legs""",
    "positions": """
        SELECT file_day, pair_id, interp_ts,
               a_start_lat + fa * (a_end_lat - a_start_lat) AS lat_a,
               a_start_lon + fa * (a_end_lon - a_start_lon) AS lon_a,
               b_start_lat + fb * (b_end_lat - b_start_lat) AS lat_b,
               b_start_lon + fb * (b_end_lon - b_start_lon) AS lon_b
        FROM (SELECT *, (interp_ts - a_start_ts) / CAST(a_end_ts - a_start_ts AS DOUBLE) AS fa,
                     (interp_ts - b_start_ts) / CAST(b_end_ts - b_start_ts AS DOUBLE) AS fb
              FROM ticks) f""",
    "meetings": f"""
        SELECT *, distance_nm * {METRES_PER_NM} AS distance_m
        FROM (SELECT *, {_distance('lat_a', 'lon_a', 'lat_b', 'lon_b')} AS distance_nm
              FROM positions) d
        WHERE distance_nm <= {CFG.encounter_distance_m} / {METRES_PER_NM}""",
    "hits": f"""
        SELECT h.file_day, h.pair_id, w.mmsi_1, w.mmsi_2, w.name_1, w.name_2,
               h.interp_ts AS collision_ts, h.distance_m AS collision_distance_m,
               h.lat_a AS collision_latitude_1, h.lon_a AS collision_longitude_1,
               h.lat_b AS collision_latitude_2, h.lon_b AS collision_longitude_2,
               h.interp_ts - {CFG.track_window_sec} AS window_start,
               h.interp_ts + {CFG.track_window_sec} AS window_end
        FROM (SELECT *, row_number() OVER (PARTITION BY file_day, pair_id
                          ORDER BY distance_m, interp_ts) AS pick FROM meetings) h
        JOIN windows w ON w.file_day = h.file_day AND w.pair_id = h.pair_id
        WHERE pick = 1""",
    "tracks": """
        SELECT h.file_day, h.pair_id, h.collision_ts, h.mmsi_1 AS pair_mmsi_1,
               h.mmsi_2 AS pair_mmsi_2, p.mmsi, p.name, p.ts, p.latitude, p.longitude, p.sog,
               p.navigational_status, 1 AS vessel_in_pair
        FROM hits h JOIN clean p ON p.file_day = h.file_day AND p.mmsi = h.mmsi_1
         AND p.ts >= h.window_start AND p.ts <= h.window_end
        UNION ALL
        SELECT h.file_day, h.pair_id, h.collision_ts, h.mmsi_1, h.mmsi_2, p.mmsi, p.name, p.ts,
               p.latitude, p.longitude, p.sog, p.navigational_status, 2
        FROM hits h JOIN clean p ON p.file_day = h.file_day AND p.mmsi = h.mmsi_2
         AND p.ts >= h.window_start AND p.ts <= h.window_end""",
    "ratios": f"""
        SELECT *, CASE WHEN mean_sog_after <> 0 THEN mean_sog_before / mean_sog_after END
                  AS sog_proportion
        FROM (SELECT file_day, pair_id, mmsi,
                coalesce(avg(CASE WHEN ts < collision_ts THEN sog END), {CFG.silent_sog})
                  AS mean_sog_before,
                coalesce(avg(CASE WHEN ts > collision_ts THEN sog END), {CFG.silent_sog})
                  AS mean_sog_after
              FROM tracks GROUP BY file_day, pair_id, mmsi) m""",
    "severe": f"""
        SELECT file_day, pair_id, min(sog_proportion) AS min_pair_proportion,
               avg(sog_proportion) AS mean_pair_proportion
        FROM ratios GROUP BY file_day, pair_id
        HAVING min(sog_proportion) >= {CFG.min_slowdown_ratio}""",
    "scored": """
        SELECT t.*, s.mean_pair_proportion
        FROM tracks t JOIN severe s ON s.file_day = t.file_day AND s.pair_id = t.pair_id""",
    "ranked": """
        SELECT *, row_number() OVER (ORDER BY mean_pair_proportion DESC NULLS LAST,
                                     collision_ts, pair_id, file_day) AS event_rank
        FROM (SELECT DISTINCT file_day, pair_id, collision_ts, pair_mmsi_1, pair_mmsi_2,
                              mean_pair_proportion FROM scored) e""",
    "impacts": """
        SELECT * FROM (SELECT *, abs(ts - collision_ts) AS off_sec, row_number() OVER (
            PARTITION BY file_day, pair_id, vessel_in_pair
            ORDER BY abs(ts - collision_ts), ts) AS pick FROM scored) i
        WHERE pick = 1""",
    "labels_of_vessels": """
        SELECT file_day, pair_id, vessel_in_pair, name FROM (
          SELECT *, row_number() OVER (PARTITION BY file_day, pair_id, vessel_in_pair
                                       ORDER BY ts) AS pick
          FROM scored WHERE name IS NOT NULL) l
        WHERE pick = 1""",
}


def sql(select: str, upto: str, steps: dict[str, str] = _STEPS) -> str:
    """``select`` over the steps up to and including ``upto``."""
    names = list(steps)
    wanted = names[: names.index(upto) + 1]
    ctes = ",\n".join(f"{name} AS ({steps[name].strip()})" for name in wanted)
    return f"WITH {ctes}\n{select.strip()}"


def _steps_over_files() -> dict[str, str]:
    """The steps over daily files: days are dates, and no row id settles ties of a second."""
    day = "strftime(make_timestamp(ts * 1000000), '%Y-%m-%d') AS file_day"
    lagged = _STEPS["lagged"].replace(
        "latitude, longitude, event_id", "latitude, longitude, sog NULLS FIRST, navigational_status NULLS FIRST"
    )
    return _STEPS | {"ais": f"SELECT * EXCLUDE (file_day), {day} FROM ({_STEPS['ais']})", "lagged": lagged}


_PAIR_ROW = """mmsi, b_mmsi, ts, b_ts, time_diff_sec, latitude, longitude,
    b_latitude, b_longitude"""
_TRACK = """file_day, pair_id, collision_ts, pair_mmsi_1, pair_mmsi_2, mmsi, name, ts,
    latitude, longitude, round(sog, 6) AS sog, navigational_status, vessel_in_pair"""
_RANKED_TRACK = f"{_TRACK}, round(mean_pair_proportion, 6) AS mean_pair_proportion"
_EVENT = """file_day, pair_id, mmsi_1, mmsi_2, collision_ts,
    round(collision_distance_m, 3) AS collision_distance_m"""

_PLACES = """collision_latitude_1, collision_longitude_1, collision_latitude_2,
    collision_longitude_2"""


def _unpivoted_rules() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce({rule}, FALSE))"
        " AS failed_rows FROM ais"
        for name, rule in _RULES.items()
    )


def oracle_sql() -> dict[str, str]:
    """One statement per named query with the same column names."""
    center = _distance("latitude", "longitude", str(CFG.center_lat), str(CFG.center_lon))
    clean_row = f"{_POINT.replace('sog', 'round(sog, 6) AS sog')}, name"
    time_text = "strftime(make_timestamp(ts * 1000000), '%d/%m/%Y %H:%M:%S')"
    return {
        "scan_csv": sql(
            f"""SELECT {time_text} AS time_text, mmsi, name, latitude,
                  strftime(make_timestamp(ts * 1000000), '%Y-%m-%d') AS file_day FROM ais""",
            "ais",
        ),
        "scan_mixed_layouts": sql(
            """SELECT mmsi, ts, latitude, longitude, round(sog, 6) AS sog,
                 CASE WHEN event_id % 3 = 0 THEN NULL ELSE name END AS name,
                 strftime(make_timestamp(ts * 1000000), '%Y-%m-%d') AS file_day FROM ais""",
            "ais",
        ),
        "normalize_columns": sql(
            f"""SELECT {time_text} AS timestamp, mmsi, latitude, longitude, navigational_status,
                  sog, name FROM ais""",
            "ais",
        ),
        "standardize_types": sql(
            """SELECT mmsi, name, navigational_status, longitude, round(sog, 6) AS sog,
                 CASE WHEN navigational_status = 'At anchor'
                       AND day(make_timestamp(ts * 1000000)) < 10 THEN NULL ELSE ts END AS ts,
                 CASE WHEN navigational_status = 'Moored' THEN NULL ELSE latitude END AS latitude
               FROM ais""",
            "ais",
        ),
        "typed_points": sql(f"SELECT {clean_row} FROM clean", "clean"),
        "sink_roundtrip": sql(f"SELECT {clean_row} FROM clean", "clean"),
        "pending_days": sql(
            """SELECT DISTINCT CAST(floor(ts / 600) AS BIGINT) AS slot FROM ais
               WHERE floor(ts / 600) NOT IN (SELECT floor(ts / 600) FROM closest)""",
            "closest",
        ),
        "haversine": sql(
            f"SELECT event_id, round({center} * {METRES_PER_NM}, 3) AS distance_m"
            " FROM ais WHERE latitude IS NOT NULL",
            "ais",
        ),
        "distance_to_center": sql(
            "SELECT event_id, round(distance_to_center_nm, 6) AS distance_to_center_nm"
            " FROM measured",
            "measured",
        ),
        "valid_rows": sql(f"SELECT {_POINT}, name FROM valid", "valid"),
        "validity_reasons": sql(_unpivoted_rules(), "ais"),
        "bbox": sql("SELECT event_id, mmsi, ts, latitude, longitude FROM measured", "measured"),
        "geofence": sql(
            "SELECT event_id, mmsi, ts, latitude, longitude,"
            " round(distance_to_center_nm, 6) AS distance_to_center_nm FROM inside",
            "inside",
        ),
        "status_filter": sql(f"SELECT {_POINT} FROM inside WHERE {_STATUS}", "inside"),
        "dedup_points": sql(
            f"""SELECT {_POINT} FROM (SELECT *, row_number() OVER (
                  PARTITION BY file_day, mmsi, ts, latitude, longitude ORDER BY event_id) AS pick
                FROM ais) d WHERE pick = 1""",
            "ais",
        ),
        "track_lag": sql(
            "SELECT event_id, mmsi, ts, prev_ts, prev_latitude, prev_longitude FROM lagged",
            "lagged",
        ),
        "track_steps": sql(
            """SELECT event_id, mmsi, ts, time_diff_sec,
                 round(step_distance_nm, 6) AS step_distance_nm,
                 round(implied_speed_knots, 4) AS implied_speed_knots FROM stepped""",
            "stepped",
        ),
        "moving": sql(f"SELECT {_POINT} FROM stepped WHERE {_MOVING}", "stepped"),
        "plausible": sql(f"SELECT {_POINT} FROM stepped WHERE {_PLAUSIBLE}", "stepped"),
        "clean_points": sql(
            f"SELECT {_POINT}, name, round(distance_to_center_nm, 6) AS distance_to_center_nm"
            " FROM clean",
            "clean",
        ),
        "candidate_points": sql(
            "SELECT file_day, ts, mmsi, name, latitude, longitude, sog, navigational_status"
            " FROM clean",
            "clean",
        ),
        "overlapping_windows": sql(
            f"""SELECT event_id, mmsi, ts, CAST(floor(ts / {CFG.pair_gap_sec}) AS BIGINT) - k
                  AS window_id
                FROM clean CROSS JOIN (SELECT unnest([0, 1]) AS k) o""",
            "clean",
        ),
        "pair_band_join": sql(f"SELECT {_PAIR_ROW} FROM band", "band"),
        "near_pairs": sql(
            f"SELECT {_PAIR_ROW}, round(distance_nm * {METRES_PER_NM}, 3) AS distance_m FROM near",
            "near",
        ),
        "near_pairs_stream": sql(
            f"SELECT {_PAIR_ROW}, round(distance_nm * {METRES_PER_NM}, 3) AS distance_m FROM near",
            "near",
        ),
        "closest_pair": sql(
            """SELECT file_day, mmsi AS mmsi_1, b_mmsi AS mmsi_2, name AS name_1,
                 b_name AS name_2, ts AS ts_1, b_ts AS ts_2, time_diff_sec,
                 round(distance_m, 3) AS distance_m, latitude AS latitude_1,
                 longitude AS longitude_1, b_latitude AS latitude_2, b_longitude AS longitude_2,
                 sog AS sog_1, b_sog AS sog_2, navigational_status AS status_1,
                 b_status AS status_2
               FROM closest""",
            "closest",
        ),
        "candidate_windows": sql("SELECT * FROM windows", "windows"),
        "pair_points": sql("SELECT * FROM pair_pts", "pair_pts"),
        "segments": sql("SELECT * FROM legs", "legs"),
        "segment_overlap": sql("SELECT * FROM shared_legs", "shared_legs"),
        "interpolated_tracks": sql(
            "SELECT file_day, pair_id, interp_ts, lat_a, lon_a, lat_b, lon_b FROM positions",
            "positions",
        ),
        "encounter_seconds": sql(
            "SELECT file_day, pair_id, interp_ts, round(distance_m, 3) AS distance_m"
            " FROM meetings",
            "meetings",
        ),
        "confirmed_events": sql(
            f"SELECT {_EVENT}, {_PLACES}, name_1, name_2, window_start, window_end FROM hits", "hits"
        ),
        "event_tracks": sql(f"SELECT {_TRACK} FROM tracks", "tracks"),
        "track_union": sql(f"SELECT {_TRACK} FROM tracks", "tracks"),
        "sog_before_after": sql(
            """SELECT file_day, pair_id, mmsi, round(mean_sog_before, 6) AS mean_sog_before,
                 round(mean_sog_after, 6) AS mean_sog_after,
                 round(sog_proportion, 6) AS sog_proportion FROM ratios""",
            "ratios",
        ),
        "severity": sql(
            """SELECT file_day, pair_id, round(min_pair_proportion, 6) AS min_pair_proportion,
                 round(mean_pair_proportion, 6) AS mean_pair_proportion FROM severe""",
            "severe",
        ),
        "ranked_tracks": sql(f"SELECT {_RANKED_TRACK} FROM scored", "scored"),
        "event_ranking": sql(
            """SELECT event_rank, file_day, pair_id, collision_ts, pair_mmsi_1, pair_mmsi_2,
                 round(mean_pair_proportion, 6) AS mean_pair_proportion FROM ranked""",
            "ranked",
        ),
        "top_event": sql(
            """SELECT file_day, pair_id, collision_ts, pair_mmsi_1, pair_mmsi_2,
                 round(mean_pair_proportion, 6) AS mean_pair_proportion
               FROM ranked WHERE event_rank = 1""",
            "ranked",
        ),
        "top_event_tracks": sql(
            f"""SELECT {_RANKED_TRACK} FROM scored WHERE (file_day, pair_id) IN
                (SELECT (file_day, pair_id) FROM ranked WHERE event_rank = 1)""",
            "ranked",
        ),
        "impact_points": sql(
            """SELECT file_day, pair_id, collision_ts, vessel_in_pair, mmsi, ts, latitude,
                 longitude, round(sog, 6) AS sog, off_sec FROM impacts""",
            "impacts",
        ),
        "event_summary": sql(_summary_select(), "labels_of_vessels"),
        "daily_job_files": sql(
            _summary_select("e.event_rank, "), "labels_of_vessels", _steps_over_files()
        ),
        "all_days": sql(
            """SELECT r.event_rank, h.file_day, h.pair_id, h.mmsi_1, h.mmsi_2, h.collision_ts,
                 round(h.collision_distance_m, 3) AS collision_distance_m,
                 round(r.mean_pair_proportion, 6) AS mean_pair_proportion
               FROM ranked r JOIN hits h ON h.file_day = r.file_day AND h.pair_id = r.pair_id""",
            "ranked",
        ),
    }


def _summary_select(more: str = "") -> str:
    vessel = """e.pair_mmsi_{n} AS mmsi_{n},
        coalesce(l{n}.name, concat('Vessel ', e.pair_mmsi_{n})) AS vessel_{n},
        round(i{n}.latitude, 5) AS impact_latitude_{n},
        round(i{n}.longitude, 5) AS impact_longitude_{n},
        round(i{n}.sog, 6) AS impact_sog_{n},
        h.collision_latitude_{n}, h.collision_longitude_{n},
        round(r{n}.mean_sog_before, 6) AS mean_sog_before_{n},
        round(r{n}.mean_sog_after, 6) AS mean_sog_after_{n},
        round(r{n}.sog_proportion, 6) AS sog_proportion_{n}"""
    joins = """LEFT JOIN impacts i{n} ON i{n}.file_day = e.file_day AND i{n}.pair_id = e.pair_id
          AND i{n}.vessel_in_pair = {n}
        LEFT JOIN labels_of_vessels l{n} ON l{n}.file_day = e.file_day
          AND l{n}.pair_id = e.pair_id AND l{n}.vessel_in_pair = {n}
        JOIN ratios r{n} ON r{n}.file_day = e.file_day AND r{n}.pair_id = e.pair_id
          AND r{n}.mmsi = e.pair_mmsi_{n}"""
    return f"""SELECT {more}e.file_day, e.pair_id, e.collision_ts,
          round(h.collision_distance_m, 3) AS collision_distance_m,
          round(e.mean_pair_proportion, 6) AS mean_pair_proportion,
          {vessel.format(n=1)}, {vessel.format(n=2)}
        FROM ranked e JOIN hits h ON h.file_day = e.file_day AND h.pair_id = e.pair_id
        {joins.format(n=1)} {joins.format(n=2)}"""
