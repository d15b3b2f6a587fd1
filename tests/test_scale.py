"""Skewed inputs and the shape of the plans."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fairlead.config import EncounterConfig
from fairlead.operators import confirm, motion, proximity, severity
from fairlead.plans.analysis import EncounterAnalysis
from fairlead.operators.ranking import with_rank
from fairlead.sources.event_feed import ais_points
from fairlead.sources.stages import StageStore
from tests.conftest import SMALL

CFG = EncounterConfig()


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles_by_pair(df) -> int:
    text = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning\(file_day#\d+L?, pair_id", text))


LAZY = [
    "valid_rows", "geofence", "dedup_points", "track_steps", "clean_points", "near_pairs",
    "pair_band_join", "closest_pair", "confirmed_events", "event_tracks", "ranked_tracks",
    "event_summary", "event_ranking",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert bad not in text
    if name != "event_ranking":
        assert "SinglePartition" not in text


def test_both_lag_passes_read_one_shuffle(spark):
    text = executed(motion.clean_points(ais_points(spark, SMALL), CFG))
    final = text.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert len(re.findall(r"FileScan parquet", final)) == 1


def test_confirmation_and_scoring_shuffle_by_pair_once(spark):
    run = EncounterAnalysis(ais_points(spark, SMALL), StageStore(spark), CFG)
    together = run.pair_points.repartition(*confirm.PAIR)
    closest = (
        together.transform(confirm.segments)
        .transform(confirm.overlapping_segments)
        .transform(confirm.interpolated_seconds)
        .transform(confirm.encounter_seconds, CFG)
        .transform(confirm.closest_seconds)
    )
    assert shuffles_by_pair(closest) == 1
    assert shuffles_by_pair(severity.score_severity(run.tracks, CFG)) == 1


def test_stage_tables_prune_columns_and_rows(spark):
    run = EncounterAnalysis(ais_points(spark, SMALL), StageStore(spark), CFG)
    text = plan(run.clean.where("latitude > 55.2").select("mmsi", "latitude"))
    assert re.search(r"PushedFilters: \[IsNotNull\(latitude\), GreaterThan\(latitude,55.2\)\]", text)
    assert "ReadSchema: struct<mmsi:string,latitude:double>" in text


def test_one_vessel_with_most_rows_and_many_copies(spark, make_points):
    """A busy vessel is cut into chunks and copies of a report fold early."""
    rows = [
        {"ts": 1000 + 10 * i, "latitude": 55.2 + (i % 40) * 0.0002, "event_id": i}
        for i in range(3000)
    ]
    rows += [{"ts": 2000, "event_id": 10_000 + i, "latitude": 55.2} for i in range(3000)]
    rows += [{"mmsi": "219000002", "ts": 1000 + 50 * i, "event_id": 20_000 + i} for i in range(200)]
    points = make_points(rows)
    split = motion.clean_points(points, CFG)
    whole = motion.clean_points(points, EncounterConfig(track_chunk_sec=10**9))
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
    assert split.count() > 2000


def test_crowded_cells_are_used_when_there_are_any(spark):
    points = ais_points(spark, SMALL)
    plain = EncounterAnalysis(points, StageStore(spark), CFG)
    shared = EncounterAnalysis(points, StageStore(spark), EncounterConfig(crowded_cell_rows=3))
    assert "shares" in plan(shared.near_pairs) and "shares" not in plan(plain.near_pairs)
    assert sorted(map(str, shared.closest_pairs.collect())) == sorted(
        map(str, plain.closest_pairs.collect())
    )


def test_inputs_of_a_crowded_cell_stay_bounded(make_points):
    cfg = EncounterConfig(crowded_cell_rows=50)
    grid = proximity.near_grid(cfg)
    largest = {}
    for n in (400, 4000):
        rows = [
            {"mmsi": str(219000000 + i % 40), "ts": 1000 + i % 97, "latitude": 55.2, "longitude": 14.2}
            for i in range(n)
        ]
        points = proximity.proximity_points(make_points(rows))
        cells = proximity.crowded_cells(points, grid, cfg)
        keys = ["file_day", *proximity.CELL]
        sides = (
            proximity._deal(grid.locate(points).join(cells, keys, "left"), "shares", "right_shares", "mmsi", "ts"),
            proximity._deal(
                grid.spread(points, cfg.pair_gap_sec).join(cells, keys, "left"), "right_shares", "shares", "mmsi", "ts"
            ),
        )
        parts = [*keys, "of_shares", "of_right_shares"]
        # Copies that reach a cell without reports meet nothing.
        left, right = sides[0], sides[1].join(sides[0].select(*parts).distinct(), parts, "left_semi")
        largest[n] = [side.groupBy(*parts).count().agg(F.max("count")).first()[0] for side in (left, right)]
    assert all(count <= 2 * cfg.crowded_cell_rows for counts in largest.values() for count in counts)


def test_rank_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(
            F.pmod(F.col("id") * 7919, F.lit(13)).alias("score"), F.col("id").alias("tie")
        )
        ranked = with_rank(df, [F.col("score").desc(), F.col("tie").asc()], StageStore(spark))
        rows = ranked.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows.sort(key=lambda r: (-r.score, r.tie))
    assert [r["rank"] for r in rows] == list(range(1, 5001))


def test_scored_tracks_do_not_depend_on_layout(spark):
    run = EncounterAnalysis(ais_points(spark, SMALL), StageStore(spark), CFG)
    tracks = run.tracks
    runs = [
        sorted(map(str, severity.score_severity(t, CFG).collect()))
        for t in (tracks, tracks.repartition(9), tracks.orderBy(F.col("ts").desc()))
    ]
    assert runs[0] == runs[1] == runs[2]


def test_band_pairs_meet_once(spark):
    run = EncounterAnalysis(ais_points(spark, SMALL), StageStore(spark), CFG)
    met = run.band_pairs
    assert met.count() == met.select("mmsi", "b_mmsi", "ts", "b_ts").distinct().count()
    assert met.where(F.col("time_diff_sec") > CFG.pair_gap_sec).isEmpty()
    assert proximity.POINT_COLUMNS[0] in met.columns
