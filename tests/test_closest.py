"""The closest approach found by bounds equals the one found among all close pairs."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from fairlead.config import EncounterConfig
from fairlead.operators import closest, proximity
from fairlead.plans.analysis import EncounterAnalysis
from fairlead.sources.event_feed import ais_points
from fairlead.sources.stages import StageStore
from tests.conftest import SMALL
from tests.test_properties import random_reports

CFG = EncounterConfig()


def both_ways(points, store, cfg=CFG):
    points = proximity.candidate_points(points, cfg)
    places = points.select(*proximity.PLACE_COLUMNS)
    listed = proximity.closest_pairs(proximity.near_pairs(places, cfg), points)
    bounded = closest.closest_approaches(points, store, cfg)
    assert bounded.columns == listed.columns
    return tuple(sorted(map(str, df.collect())) for df in (bounded, listed))


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_bounds_find_what_listing_finds(spark, make_points, seed):
    """Anywhere on the globe, over two days, with an odd number of reports a vessel."""
    bounded, listed = both_ways(make_points(random_reports(seed, 400)), StageStore(spark))
    assert bounded == listed and listed


def test_other_thresholds(spark, make_points):
    cfg = EncounterConfig(pair_distance_m=900.0, pair_gap_sec=90, pair_lat_tolerance=0.004, pair_lon_tolerance=0.003)
    bounded, listed = both_ways(make_points(random_reports(5, 500)), StageStore(spark), cfg)
    assert bounded == listed and listed


def harbour(n, seed=6, vessels=6):
    """``n`` reports each of moored vessels, all within some sixty metres, in one hour."""
    rng = random.Random(seed)
    rows = []
    for v in range(vessels):
        lat, lon = 55.2 + rng.uniform(0, 3e-4), 14.2 + rng.uniform(0, 6e-4)
        for i in range(n):
            rows.append(
                {
                    "mmsi": f"21900000{v}",
                    "ts": 3600 + i * 3600 // n,
                    "latitude": round(lat + rng.gauss(0, 4e-5), 6),
                    "longitude": round(lon + rng.gauss(0, 8e-5), 6),
                }
            )
    return rows


def test_ties_at_one_place(spark, make_points):
    """Rounded places repeat: the smallest time difference, then the earliest reports win."""
    rows = harbour(120, vessels=4)
    for row in rows:
        row["latitude"], row["longitude"] = round(row["latitude"], 4), round(row["longitude"], 4)
    same = [{"mmsi": f"21900001{v}", "ts": 3600 + 60 * i, "latitude": 55.2, "longitude": 14.2} for v in range(2) for i in range(50)]
    bounded, listed = both_ways(make_points(rows + same), StageStore(spark))
    assert bounded == listed and len(listed) >= 15


def test_rows_grow_with_the_reports_of_a_harbour(spark, make_points):
    """Ten times the reports: close pairs grow a hundredfold, joined rows about tenfold."""
    listed, joined = {}, {}
    for n in (150, 1_500):
        points = proximity.candidate_points(make_points(harbour(n)), CFG)
        places = points.select(*proximity.PLACE_COLUMNS)
        store = StageStore(spark)
        chunks = store.keep(closest.open_chunks(closest.chunk_pairs(places, CFG)), "open_chunks")
        bounded = store.keep(closest.bounded_reports(places, chunks, CFG), "bounded_reports")
        assert bounded.count() <= 2 * 6 * 5 * n  # each report once for each other vessel
        joined[n] = closest.undercutting_pairs(bounded, CFG).count()
        listed[n] = proximity.near_pairs(places, CFG).count()
        best = closest.closest_approaches(points, store, CFG)
        pairs = proximity.closest_pairs(proximity.near_pairs(places, CFG), points)
        assert sorted(map(str, best.collect())) == sorted(map(str, pairs.collect()))
    assert listed[1_500] > 80 * listed[150]
    assert joined[1_500] < 20 * joined[150] and joined[1_500] < listed[1_500] / 100


def test_box_bounds_hold(spark, make_points):
    """No report pair of two chunks is closer than the lower or, where given, the least is not above the upper bound."""
    points = proximity.candidate_points(make_points(random_reports(7, 600)), CFG).select(*proximity.PLACE_COLUMNS)
    chunked = closest.chunked(points, CFG)
    pairs = closest.chunk_pairs(points, CFG)
    a = chunked.select("file_day", F.col("mmsi").alias("mmsi_1"), *closest.CHUNK, *(F.col(c).alias(f"a_{c}") for c in closest.EXTENT))
    b = chunked.select(
        "file_day", F.col("mmsi").alias("mmsi_2"), *(F.col(c).alias(f"b_{c}") for c in closest.CHUNK), *(F.col(c).alias(f"c_{c}") for c in closest.EXTENT)
    )
    met = pairs.join(a, ["file_day", "mmsi_1", *closest.CHUNK]).join(b, ["file_day", "mmsi_2", *(f"b_{c}" for c in closest.CHUNK)])
    found = met.withColumn("distance", closest._distance("a_", "c_")).groupBy(*pairs.columns).agg(F.min("distance").alias("least"))
    rows = found.collect()
    assert rows and all(r.at_least <= r.least for r in rows)
    assert all(r.least <= r.at_most for r in rows if r.at_most is not None)
    assert len(rows) == pairs.count()


def test_a_busy_sea_takes_the_bounds(spark):
    points = ais_points(spark, SMALL)
    sparse = EncounterAnalysis(points, StageStore(spark), CFG)
    busy = EncounterAnalysis(points, StageStore(spark), EncounterConfig(comparisons_per_report=1))
    crowded = EncounterAnalysis(points, StageStore(spark), EncounterConfig(crowded_cell_rows=3))
    ways = [run.closest_pairs for run in (sparse, busy, crowded)]
    plans = [df._jdf.queryExecution().toString() for df in ways]
    assert ["bound" in p for p in plans] == [False, True, True]
    rows = [sorted(map(str, df.collect())) for df in ways]
    assert rows[0] == rows[1] == rows[2] and rows[0]


def test_no_reports(spark, make_points):
    store = StageStore(spark)
    points = proximity.candidate_points(make_points([]), CFG)
    assert closest.is_sparse(points, CFG)
    assert closest.closest_approaches(points, store, CFG).isEmpty()
    one = proximity.candidate_points(make_points(harbour(3, vessels=1)), CFG)
    assert closest.closest_approaches(one, store, CFG).isEmpty()


def test_bound_is_a_distance_of_reports(spark, make_points):
    """The bound of every two vessels is not below their closest approach, nor above the pair distance."""
    points = proximity.candidate_points(make_points(harbour(60)), CFG)
    store = StageStore(spark)
    places = points.select(*proximity.PLACE_COLUMNS)
    bounded = closest.bounded_reports(places, closest.open_chunks(closest.chunk_pairs(places, CFG)), CFG)
    bounds = {(r.mmsi_1, r.mmsi_2): r.bound.distance for r in bounded.select("mmsi_1", "mmsi_2", "bound").distinct().collect()}
    best = {(r.mmsi_1, r.mmsi_2): r.distance_m for r in closest.closest_approaches(points, store, CFG).collect()}
    assert set(best) <= set(bounds)
    for pair, metres in best.items():
        assert metres <= bounds[pair] * 1852 + 1e-3 and bounds[pair] <= CFG.pair_distance_nm
    assert not math.isnan(sum(bounds.values()))
