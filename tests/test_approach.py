"""The closed form of the closest approach against every second."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fairlead.config import EncounterConfig
from fairlead.operators import confirm, severity
from fairlead.operators.approach import seconds_of_closest, seconds_within
from fairlead.plans import catalogue
from fairlead.plans.analysis import EncounterAnalysis
from fairlead.sources.event_feed import ais_points
from fairlead.sources.stages import StageStore
from tests.conftest import SMALL

CFG = EncounterConfig()
LEGS = ", ".join(
    ["file_day bigint", "pair_id string"]
    + [f"{s}_{c}" for s in "ab" for c in ("start_ts bigint", "start_lat double", "start_lon double", "end_ts bigint", "end_lat double", "end_lon double")]
    + ["overlap_start bigint", "overlap_end bigint"]
)


def overlap(i, rng, lat, lon, kind):
    """Two legs that pass each other, keep their offset, stand still or lie far apart."""
    t = rng.randrange(1000, 2000)
    length = rng.choice([2, 7, 60, 600, 1200])
    spread = rng.choice([1e-5, 5e-4, 2e-3])

    def place():
        return lat + rng.uniform(-spread, spread), lon + rng.uniform(-spread, spread)

    a = (t, *place(), t + length, *place())
    if kind == "still":
        a = (a[0], a[1], a[2], a[3], a[1], a[2])
        b = (a[0], a[1] + rng.uniform(-4e-4, 4e-4), a[2], a[3], a[1], a[2])
        b = (*b[:4], b[1], b[2])
    elif kind == "company":
        off = rng.uniform(-4e-4, 4e-4)
        a = (a[0], a[1], a[2], a[3], a[1] + 0.05, a[2] + 0.05)
        b = (a[0], a[1] + off, a[2], a[3], a[4] + off, a[5])
    elif kind == "far":
        b = (a[0], min(a[1] + 5, 89.0), a[2] + 20, a[3], min(a[4] + 5, 89.0), a[5] + 20)
    elif kind == "across":
        b = (a[0], a[1], 179.9999, a[3], a[4], -179.9999)
    else:
        shift = rng.randrange(-length + 1, length)
        b = (t + shift, *place(), t + shift + rng.choice([length, 2 * length]), *place())
    start, end = max(a[0], b[0]), min(a[3], b[3])
    return (1, f"p{i}", *a, *b, start, end) if start < end else None


def overlaps(spark, seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lat, lon = rng.choice([(55.2, 14.2), (-33.9, 151.2), (0.0, 0.0), (84.0, 10.0), (-0.0001, -179.99)])
        row = overlap(i, rng, lat, lon, rng.choice(["pass", "pass", "pass", "still", "company", "far", "across"]))
        rows += [row] if row else []
    return spark.createDataFrame(rows, LEGS)


def seconds(df):
    return sorted((r.pair_id, r.interp_ts, r.distance_m) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("metres", [100.0, 3.0, 40_000.0])
def test_same_seconds_and_closest_as_the_grid(spark, seed, metres):
    cfg = EncounterConfig(encounter_distance_m=metres)
    legs = overlaps(spark, seed).persist()
    grid = confirm.encounter_seconds(confirm.interpolated_seconds(legs), cfg)
    assert seconds(confirm.close_seconds(legs, cfg)) == seconds(grid)
    few = confirm.encounter_seconds(confirm.interpolated_seconds(seconds_of_closest(legs, cfg), "first", "last"), cfg)
    best = sorted(map(str, confirm.closest_seconds(few).collect()))
    assert best == sorted(map(str, confirm.closest_seconds(grid).collect())) and best
    legs.unpersist()


def test_passing_vessels_take_a_few_seconds_each(spark):
    """The intervals of vessels that pass are two to four seconds long, whatever the legs' length."""
    rng = random.Random(4)
    rows = [overlap(i, rng, 55.2, 14.2, "pass") for i in range(600)]
    legs = spark.createDataFrame([r for r in rows if r], LEGS)
    found = seconds_of_closest(legs, EncounterConfig(encounter_distance_m=1e6))
    lengths = [r.n for r in found.select((F.col("last") - F.col("first") + 1).alias("n")).collect()]
    whole = [r[-1] - r[-2] + 1 for r in rows if r]
    assert len(lengths) == len(whole) and sum(lengths) < 5 * len(lengths) and sum(whole) > 100 * len(whole)


def test_far_legs_have_no_seconds(spark):
    rng = random.Random(5)
    rows = [overlap(i, rng, 55.2, 14.2, "far") for i in range(50)]
    legs = spark.createDataFrame([r for r in rows if r], LEGS)
    assert seconds_within(legs, CFG).isEmpty() and seconds_of_closest(legs, CFG).isEmpty()


def test_no_overlaps(spark):
    legs = spark.createDataFrame([], LEGS)
    assert seconds_within(legs, CFG).isEmpty() and seconds_of_closest(legs, CFG).isEmpty()


def test_confirmation_lists_no_grid_of_seconds(spark):
    """Seconds written out per overlap: a handful instead of one for each second."""
    run = EncounterAnalysis(ais_points(spark, "/root/testdata/sf0.01"), StageStore(spark), CFG)
    legs = confirm.overlapping_segments(confirm.segments(run.pair_points))
    few = confirm.interpolated_seconds(seconds_of_closest(legs, CFG), "first", "last").count()
    every = confirm.interpolated_seconds(legs).count()
    text = catalogue.confirmed_events(spark, SMALL)._jdf.queryExecution().toString()
    assert "sequence(first" in text and "sequence(overlap_start" not in text
    assert 0 < few < every / 20


def test_means_are_the_same_bits_in_any_layout(spark):
    """Both forms of the speed ratios agree exactly, however the rows lie."""
    rng = random.Random(6)
    rows = [
        (1, f"p{i % 7}", 1000, "1", "2", str(1 + v), "N", 1000 + rng.randrange(-600, 600), 55.0, 14.0,
         rng.choice([None, float("nan"), float("inf"), rng.uniform(0, 40), rng.uniform(0, 40), 0.1, 1e-15, 3e300]), "x", 1 + v)
        for i in range(700) for v in (0, 1)
    ]
    schema = (
        "file_day bigint, pair_id string, collision_ts bigint, pair_mmsi_1 string, pair_mmsi_2 string, mmsi string,"
        " name string, ts bigint, latitude double, longitude double, sog double, navigational_status string,"
        " vessel_in_pair int"
    )
    cfg = EncounterConfig(min_slowdown_ratio=0.0)
    tracks = spark.createDataFrame(rows, schema)
    seen = set()
    for layout in (tracks, tracks.repartition(13), tracks.orderBy(F.rand(1)), tracks.orderBy(F.rand(2)).repartition(5)):
        scored = severity.score_severity(layout, cfg)
        by_window = {(r.pair_id, r.mean_pair_proportion) for r in scored.collect()}
        by_join = {
            (r.pair_id, r.mean_pair_proportion)
            for r in severity.pair_severity(severity.sog_before_after(layout, cfg), cfg).collect()
        }
        assert by_window == by_join and len(by_window) == 7
        seen.add(frozenset(by_window))
    assert len(seen) == 1
