"""Hand-made cases for the rules that decide single rows."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from fairlead.config import EARTH_RADIUS_NM, EncounterConfig
from fairlead.functions.geo import bounding_box, great_circle_nm
from fairlead.operators import area, confirm, motion, proximity, quality, report, severity

CFG = EncounterConfig()


def degrees_north(metres):
    return math.degrees(metres / 1852 / EARTH_RADIUS_NM)


def ids(df, column="event_id"):
    return sorted(row[column] for row in df.select(column).collect())


def test_validity(make_points):
    rows = [
        {},
        {"ts": None},
        {"latitude": None},
        {"longitude": None},
        {"latitude": 0.0},
        {"longitude": 0.0},
        {"latitude": 90.0},
        {"latitude": -91.0},
        {"longitude": 180.5},
        {"mmsi": "12345678"},
        {"mmsi": None},
        {"mmsi": "123456789"},
        {"name": None},
        {"name": "SARAH"},
        {"name": "Safeguard"},
        {"name": "Tug"},
    ]
    assert ids(quality.valid_rows(make_points(rows), CFG)) == [0, 6, 12, 15]


def test_validity_reasons_count_every_failed_rule(make_points):
    failed = quality.validity_reasons(make_points([{}, {"latitude": None}, {"name": "SAR 1"}]))
    counts = {r.rule: r.failed_rows for r in failed.collect()}
    assert counts["has_latitude"] == counts["latitude_set"] == counts["not_rescue_craft"] == 1
    assert counts["has_time"] == 0


def test_status_filter_drops_null_and_is_case_sensitive(make_points):
    rows = [{"navigational_status": s} for s in (None, "Moored", "moored", "At anchor", "Sailing")]
    assert ids(quality.without_stationary_status(make_points(rows), CFG)) == [2, 4]


def test_dedup_keeps_the_first_by_content(make_points):
    rows = [{"ts": 1000, "event_id": e, "sog": s} for e, s in ((7, 1.0), (3, 9.0), (5, 2.0))]
    kept = quality.distinct_observations(make_points(rows), cfg=CFG).collect()
    assert [(r.event_id, r.sog) for r in kept] == [(3, 9.0)]


def test_haversine_known_values(spark):
    row = spark.range(1).select(
        great_circle_nm(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)).alias("quarter"),
        great_circle_nm(F.lit(10.0), F.lit(20.0), F.lit(-10.0), F.lit(-160.0)).alias("antipode"),
        great_circle_nm(F.lit(5.0), F.lit(5.0), F.lit(5.0), F.lit(5.0)).alias("same"),
        great_circle_nm(F.lit(5.0), F.lit(None).cast("double"), F.lit(5.0), F.lit(5.0)).alias("n"),
    ).first()
    assert row.quarter == pytest.approx(EARTH_RADIUS_NM * math.pi / 2)
    assert row.antipode == pytest.approx(EARTH_RADIUS_NM * math.pi)
    assert row.same == 0.0 and row.n is None


def test_geofence_box_then_circle(make_points):
    _, north, _, east = bounding_box(CFG.center_lat, CFG.center_lon, CFG.radius_nm)
    rows = [
        {"latitude": CFG.center_lat, "longitude": CFG.center_lon},
        {"latitude": north - 0.001, "longitude": east - 0.001},
        {"latitude": north + 0.001, "longitude": CFG.center_lon},
    ]
    points = make_points(rows)
    assert ids(area.in_box(points, CFG)) == [0, 1]
    assert ids(area.in_circle(points, CFG)) == [0]


def steps_of(make_points, rows):
    return motion.with_steps(motion.with_previous(make_points(rows), CFG))


def test_previous_crosses_chunks_but_not_days_or_vessels(make_points):
    rows = [
        {"ts": 10, "latitude": 1.0},
        {"ts": 20, "latitude": 2.0},
        {"ts": 5 * CFG.track_chunk_sec, "latitude": 3.0},
        {"ts": 5 * CFG.track_chunk_sec + 1, "latitude": 4.0},
        {"ts": 30, "file_day": 2},
        {"ts": 30, "mmsi": "219000002"},
    ]
    prev = {r.event_id: r.prev_latitude for r in steps_of(make_points, rows).collect()}
    assert prev == {0: None, 1: 1.0, 2: 2.0, 3: 3.0, 4: None, 5: None}


def test_moving_by_speed_or_step(make_points):
    rows = [
        {"sog": 0.5},
        {"sog": 0.5, "latitude": 55.2001},
        {"sog": None, "latitude": 55.2011},
        {"sog": 2.0, "latitude": 55.2011},
        {"sog": None, "latitude": 55.2011},
    ]
    assert ids(motion.moving(steps_of(make_points, rows), CFG)) == [2, 3]


def test_plausible(make_points):
    rows = [
        {"sog": 102.3},
        {"latitude": 55.2001},
        {"latitude": 55.3},
        {"ts": 1030 + CFG.track_chunk_sec, "latitude": 55.3},
        {"ts": 1030 + CFG.track_chunk_sec, "latitude": 55.301},
        {"ts": 1040 + CFG.track_chunk_sec, "latitude": 55.301, "sog": 102.3},
    ]
    # 0: nothing before it; 2: a jump; 4: no time since its predecessor;
    # 5: the implied speed is fine, so the reported one does not matter.
    assert ids(motion.plausible(steps_of(make_points, rows), CFG)) == [0, 1, 3, 5]


def test_outlier_also_costs_the_next_good_report(make_points):
    rows = [{"latitude": 55.2}, {"latitude": 55.6}, {"latitude": 55.2001}, {"latitude": 55.2002}]
    assert ids(motion.clean_points(make_points(rows), CFG)) == [0, 3]


def test_previous_may_be_a_moored_report(make_points):
    rows = [
        {},
        {"latitude": 55.6, "ts": 1010, "navigational_status": "Moored"},
        {"latitude": 55.2001, "ts": 1020},
    ]
    assert ids(motion.clean_points(make_points(rows), CFG)) == [0]


def test_folding_ties_equals_looking_at_every_row(make_points):
    rows = []
    for i in range(120):
        rows.append(
            {
                "ts": 1000 + 700 * (i // 3) + (i % 3 == 0) * 10,
                "latitude": 55.2 + (i * 7 % 5) * 0.0004,
                "longitude": 14.2 + (i * 3 % 4) * 0.0004,
                "mmsi": f"21900000{i % 2}",
            }
        )
    points = make_points(rows)
    inside = area.in_circle(quality.valid_rows(points, CFG), CFG)
    plain = motion.with_steps(motion.with_previous(inside, CFG))
    plain = motion.plausible(
        motion.moving(quality.without_stationary_status(plain, CFG), CFG), CFG
    )
    cleaned = motion.clean_points(points, CFG)
    assert ids(cleaned) == ids(plain)
    assert cleaned.count() == cleaned.select("mmsi", "ts").distinct().count() > 0


def two_vessels(make_points, **second):
    return make_points([{"ts": 5000}, {"mmsi": "219000002", "ts": 5000} | second])


@pytest.mark.parametrize(
    "second, found",
    [
        ({"latitude": 55.2 + degrees_north(149.9)}, True),
        ({"latitude": 55.2 + degrees_north(150.1)}, False),
        ({"ts": 5600}, True),
        ({"ts": 5601}, False),
        ({"ts": 4400}, True),
        ({"longitude": 14.2022}, True),
        ({"longitude": 14.2026}, False),
        ({"mmsi": "219000001"}, False),
        ({"file_day": 2}, False),
    ],
)
def test_candidate_limits(make_points, second, found):
    assert proximity.find_candidates(two_vessels(make_points, **second), CFG).count() == found


def test_tolerances_bind_where_meridians_converge(make_points):
    rows = [
        {"ts": 5000, "latitude": 89.0, "longitude": 14.2},
        {"ts": 5000, "latitude": 89.0, "longitude": 14.209, "mmsi": "219000002"},
        {"ts": 5000, "latitude": 89.0, "longitude": 14.215, "mmsi": "219000003"},
    ]
    found = proximity.near_pairs(proximity.proximity_points(make_points(rows)), CFG)
    assert sorted((r.mmsi, r.b_mmsi) for r in found.collect()) == [
        ("219000001", "219000002"), ("219000002", "219000003"),
    ]


def test_closest_pair_breaks_ties_by_time(make_points):
    rows = [
        {"ts": 5000},
        {"ts": 5100},
        {"ts": 5060, "mmsi": "219000002"},
        {"ts": 5040, "mmsi": "219000002"},
    ]
    best = proximity.find_candidates(make_points(rows), CFG).first()
    assert (best.ts_1, best.ts_2, best.time_diff_sec) == (5000, 5040, 40)


def windows_for(spark, **kw):
    row = {"file_day": 1, "mmsi_1": "219000001", "mmsi_2": "219000002", "name_1": "A",
           "name_2": None, "ts_1": 1005, "ts_2": 1000} | kw
    return spark.createDataFrame(
        [tuple(row.values())],
        "file_day bigint, mmsi_1 string, mmsi_2 string, name_1 string, name_2 string,"
        " ts_1 bigint, ts_2 bigint",
    )


def test_candidate_window(spark):
    w = confirm.candidate_windows(windows_for(spark), CFG).first()
    assert w.pair_id == "219000001_219000002_1002"
    assert (w.center_ts, w.window_start, w.window_end) == (1002, 400, 1605)


def confirmed(spark, make_points, first, second):
    rows = [{"ts": t, "latitude": y, "longitude": x} for t, y, x in first]
    rows += [
        {"ts": t, "latitude": y, "longitude": x, "mmsi": "219000002"} for t, y, x in second
    ]
    return confirm.confirm_encounters(
        make_points(rows), windows_for(spark, ts_1=1000, ts_2=1000), CFG
    ).collect()


def test_crossing_between_reports_is_found(spark, make_points):
    hit = confirmed(
        spark, make_points,
        [(900, 55.19, 14.2), (1100, 55.21, 14.2)],
        [(900, 55.2, 14.19), (1100, 55.2, 14.21)],
    )
    assert [(h.collision_ts, h.collision_distance_m) for h in hit] == [(1000, 0.0)]
    assert (hit[0].window_start, hit[0].window_end) == (400, 1600)


def test_encounter_distance_limit(spark, make_points):
    def at(metres):
        y = 55.2 + degrees_north(metres)
        track = [(900, 55.2, 14.2), (1100, 55.2, 14.3)]
        return confirmed(spark, make_points, track, [(t, y, x) for t, _, x in track])

    assert len(at(99.9)) == 1
    assert at(100.1) == []


def test_contact_of_one_instant_is_no_overlap(spark, make_points):
    assert confirmed(
        spark, make_points,
        [(900, 55.2, 14.2), (1000, 55.2, 14.2)],
        [(1000, 55.2, 14.2), (1100, 55.2, 14.2)],
    ) == []


def test_earliest_second_wins_ties(spark, make_points):
    still = [(900, 55.2, 14.2), (1000, 55.2, 14.2), (1100, 55.2, 14.2)]
    hit = confirmed(spark, make_points, still, still)
    assert [h.collision_ts for h in hit] == [900]


TRACK_SCHEMA = (
    "file_day bigint, pair_id string, collision_ts bigint, pair_mmsi_1 string,"
    " pair_mmsi_2 string, mmsi string, name string, ts bigint, latitude double,"
    " longitude double, sog double, navigational_status string, vessel_in_pair int"
)


def tracks(spark, pairs):
    """pairs: {pair_id: (speeds of vessel 1, of vessel 2)}, (offset, speed) each."""
    rows = []
    for pair_id, both in pairs.items():
        for n, speeds in enumerate(both, 1):
            for offset, sog in speeds:
                rows.append((1, pair_id, 1000, "1", "2", str(n), None, 1000 + offset,
                             55.0 + offset / 1000, 14.0, sog, "Under way", n))
    return spark.createDataFrame(rows, TRACK_SCHEMA)


SPEEDS = {
    "slowed": ([(-10, 10.0), (10, 5.0)], [(-10, 8.0), (10, 4.0)]),
    "just": ([(-10, 11.0), (10, 10.0)], [(-10, 22.0), (10, 20.0)]),
    "one only": ([(-10, 10.0), (10, 5.0)], [(-10, 8.0), (10, 8.0)]),
    "silent after": ([(-10, 10.0), (10, None)], [(-10, 4.0), (10, 2.0)]),
    "silent before": ([(10, 10.0)], [(-10, 4.0), (10, 2.0)]),
    "stopped": ([(-10, 10.0), (10, 0.0)], [(-10, 6.0), (10, 4.0)]),
    "both stopped": ([(-10, 10.0), (10, 0.0)], [(-10, 6.0), (10, 0.0)]),
    "at the second": ([(-10, 10.0), (0, 99.0), (10, 5.0)], [(-10, 8.0), (0, 99.0), (10, 4.0)]),
    "absent": ([(-10, 10.0), (10, 5.0)], []),
}
EXPECTED = {
    "slowed": 2.0, "just": 1.1, "silent after": 501.0, "stopped": 1.5,
    "at the second": 2.0, "absent": 2.0,
}


def test_severity_of_pairs(spark):
    made = tracks(spark, SPEEDS)
    rated = severity.pair_severity(severity.sog_before_after(made, CFG), CFG)
    got = {r.pair_id: r.mean_pair_proportion for r in rated.collect()}
    assert got == pytest.approx(EXPECTED)
    scored = severity.score_severity(made, CFG)
    windowed = {r.pair_id: r.mean_pair_proportion for r in scored.collect()}
    assert windowed == pytest.approx(EXPECTED)
    assert scored.count() == made.where(F.col("pair_id").isin(*EXPECTED)).count()


def test_ranking_and_top_event(spark):
    scored = severity.score_severity(tracks(spark, SPEEDS), CFG)
    order = [r.pair_id for r in severity.rank_tracks(scored).collect()]
    assert list(dict.fromkeys(order)) == [
        "silent after", "absent", "at the second", "slowed", "stopped", "just",
    ]
    assert severity.top_events(scored).first().pair_id == "silent after"
    top = report.top_event_tracks(scored).collect()
    assert [(r.vessel_in_pair, r.ts) for r in top] == [(1, 990), (1, 1010), (2, 990), (2, 1010)]


def test_union_keeps_each_observation_once(spark):
    made = tracks(spark, {"p": SPEEDS["slowed"]})
    first, second = (made.where(F.col("vessel_in_pair") == n) for n in (1, 2))
    united = severity.unite_tracks(first.unionByName(first), second, CFG)
    assert united.count() == made.count()


def test_impact_points_take_the_earlier_of_two_equally_near(spark):
    hits = report.impact_points(tracks(spark, {"p": ([(-5, 1.0), (5, 2.0)], [(7, 3.0)])}))
    assert {r.vessel_in_pair: r.ts for r in hits.collect()} == {1: 995, 2: 1007}


def test_summary_labels(spark):
    made = tracks(spark, {"p": SPEEDS["slowed"]}).withColumn(
        "name", F.when((F.col("vessel_in_pair") == 2) & (F.col("ts") > 1000), F.lit("BETA"))
    )
    scored = severity.score_severity(made, CFG)
    events = spark.createDataFrame([(1, "p", 42.5)],
                                   "file_day bigint, pair_id string, collision_distance_m double")
    line = report.event_summary(scored, events).first()
    assert (line.vessel_1, line.vessel_2) == ("Vessel 1", "BETA")
    assert line.collision_distance_m == 42.5
