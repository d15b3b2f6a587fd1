"""Operators against brute force on random inputs."""

from __future__ import annotations

import itertools
import math
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fairlead.config import EARTH_RADIUS_NM, EncounterConfig
from fairlead.functions.geo import great_circle_nm
from fairlead.operators import confirm, proximity

CFG = EncounterConfig()
FEW = settings(
    max_examples=4,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
SEED = st.integers(0, 10**6)


def distance_nm(a, b):
    (y1, x1), (y2, x2) = (map(math.radians, p) for p in (a, b))
    h = (
        math.sin((y2 - y1) / 2) ** 2
        + math.cos(y1) * math.cos(y2) * math.sin((x2 - x1) / 2) ** 2
    )
    return 2 * EARTH_RADIUS_NM * math.asin(math.sqrt(h))


def random_reports(seed, n=250):
    """Dense reports around a point that may be south, west or far north."""
    rng = random.Random(seed)
    lat0 = rng.choice([55.2, -33.9, 0.0, 78.2])
    lon0 = rng.choice([14.2, -71.6, 0.0])
    return [
        {
            "mmsi": f"21900000{rng.randrange(5)}",
            "ts": rng.randrange(0, 9000),
            "latitude": lat0 + rng.uniform(-0.02, 0.02),
            "longitude": lon0 + rng.uniform(-0.02, 0.02),
            "file_day": rng.randrange(2),
        }
        for _ in range(n)
    ]


def brute_pairs(rows):
    for (i, a), (j, b) in itertools.permutations(enumerate(rows), 2):
        if (
            a["mmsi"] < b["mmsi"]
            and a["file_day"] == b["file_day"]
            and abs(a["ts"] - b["ts"]) <= CFG.pair_gap_sec
            and abs(a["latitude"] - b["latitude"]) <= CFG.pair_lat_tolerance
            and abs(a["longitude"] - b["longitude"]) <= CFG.pair_lon_tolerance
        ):
            yield i, j


def found_pairs(df):
    return sorted((r.event_id, r.b_event_id) for r in df.collect())


@FEW
@given(SEED)
def test_grid_join_equals_comparing_everything(make_points, seed):
    rows = random_reports(seed)
    points = make_points(rows)
    want = sorted(brute_pairs(rows))
    assert found_pairs(proximity.band_pairs(points, CFG)) == want
    near = [
        (i, j)
        for i, j in want
        if distance_nm(
            (rows[i]["latitude"], rows[i]["longitude"]),
            (rows[j]["latitude"], rows[j]["longitude"]),
        ) <= CFG.pair_distance_nm
    ]
    assert found_pairs(proximity.near_pairs(points, CFG)) == near


@FEW
@given(SEED)
def test_sharing_out_crowded_cells_changes_nothing(make_points, seed):
    points = make_points(random_reports(seed))
    tight = EncounterConfig(crowded_cell_rows=5)
    for grid, pairs in (
        (proximity.band_grid(tight), proximity.band_pairs),
        (proximity.near_grid(tight), proximity.near_pairs),
    ):
        crowded = proximity.crowded_cells(points, grid, tight)
        assert crowded.where("shares > 1 OR right_shares > 1").count() == crowded.count()
        if pairs is proximity.band_pairs:
            assert crowded.count() > 0
        assert found_pairs(pairs(points, tight, crowded)) == found_pairs(pairs(points, tight))


def random_pair_points(seed, ties):
    """Tracks of twelve pairs; with ``ties`` a vessel may be twice in a second."""
    rng = random.Random(seed)
    rows = set()
    for pair in range(12):
        for vessel in (1, 2):
            times = [rng.randrange(0, 120) for _ in range(rng.randrange(0, 12))]
            times = times if ties else set(times)
            for t in times:
                rows.add((1, f"p{pair}", vessel, t, 55 + rng.randrange(4) / 8, 14.0))
    return sorted(rows)


PAIR_POINTS = (
    "file_day bigint, pair_id string, vessel_in_pair int, ts bigint,"
    " latitude double, longitude double"
)


def brute_segments(rows):
    legs = []
    for day, pair, vessel, t, y, x in rows:
        later = [r for r in rows if r[:3] == (day, pair, vessel) and r[3] > t]
        if later:
            legs.append((day, pair, vessel, t, y, x, *min(r[3:] for r in later)))
    return sorted(legs)


@FEW
@given(SEED)
def test_segments_lead_to_the_next_later_position(spark, seed):
    rows = random_pair_points(seed, ties=True)
    legs = confirm.segments(spark.createDataFrame(rows, PAIR_POINTS))
    assert sorted(map(tuple, legs.collect())) == brute_segments(rows)


@FEW
@given(SEED)
def test_sweep_equals_interval_join(spark, seed):
    rows = random_pair_points(seed, ties=False)
    legs = confirm.segments(spark.createDataFrame(rows, PAIR_POINTS)).persist()
    swept = sorted(map(tuple, confirm.overlapping_segments(legs).collect()))
    joined = sorted(map(tuple, confirm.overlapping_segments_by_join(legs).collect()))
    legs.unpersist()
    want = sorted(
        (a[0], a[1], *a[3:], *b[3:], max(a[3], b[3]), min(a[6], b[6]))
        for a in brute_segments(rows)
        for b in brute_segments(rows)
        if a[:2] == b[:2] and (a[2], b[2]) == (1, 2) and max(a[3], b[3]) < min(a[6], b[6])
    )
    assert swept == joined == want


@FEW
@given(SEED)
def test_closest_pair_ignores_row_order_and_partitioning(make_points, seed):
    points = make_points(random_reports(seed))
    again = points.orderBy(F.rand(seed)).repartition(7)
    runs = [
        sorted(map(str, proximity.find_candidates(p, CFG).collect())) for p in (points, again)
    ]
    assert runs[0] == runs[1]


@FEW
@given(st.lists(st.tuples(*[st.floats(-89, 89), st.floats(-179, 179)] * 2), min_size=1, max_size=30))
def test_haversine(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    a, b, c, d = (F.col(x) for x in "abcd")
    for got, back, *rest in df.select(
        great_circle_nm(a, b, c, d), great_circle_nm(c, d, a, b), "a", "b", "c", "d"
    ).collect():
        want = distance_nm((rest[0], rest[1]), (rest[2], rest[3]))
        assert math.isclose(got, want, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(got, back, rel_tol=1e-9, abs_tol=1e-9)
