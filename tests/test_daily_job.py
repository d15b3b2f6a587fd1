"""Files in, day tables and reports out."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fairlead.config import EncounterConfig
from fairlead.operators import quality
from fairlead.operators.severity import rank_tracks
from fairlead.plans.analysis import EncounterAnalysis
from fairlead.plans.daily_job import DailyJob
from fairlead.sources import position_files
from fairlead.sources.day_tables import DayTable, pending_days, write_days
from fairlead.sources.event_feed import ais_points
from fairlead.sources.stages import StageStore
from tests.conftest import SMALL

HEADER = "# Timestamp,MMSI,Latitude,Longitude,Navigational status,ROT,SOG,COG,Heading,Name"


def write_file(path, *lines, header=HEADER):
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def collision_day(path, date, lat=55.2, ratio=2):
    """Two vessels that cross at noon and slow down afterwards."""
    lines = []
    for step in range(-6, 7):
        seconds = 12 * 3600 + step * 60
        clock = f"{seconds // 3600:02d}:{seconds % 3600 // 60:02d}:{seconds % 60:02d}"
        sog = 10 if step <= 0 else 10 / ratio
        off = step * 0.003
        lines.append(f"{date} {clock},219000001,{lat + off},14.2,Sailing,,{sog},,,ALPHA")
        lines.append(f"{date} {clock},219000002,{lat},{14.2 + off},Sailing,,{sog},,,")
    return write_file(path, *lines)


def test_discovery(spark, tmp_path):
    for name in ("ais-2021-12-02.csv", "ais-2021-12-01.csv", "other.txt"):
        write_file(tmp_path / name)
    files = position_files.discover_files(spark, str(tmp_path), "ais-*.csv")
    assert [f.rsplit("/", 1)[1] for f in files] == ["ais-2021-12-01.csv", "ais-2021-12-02.csv"]
    with pytest.raises(FileNotFoundError):
        position_files.discover_files(spark, str(tmp_path), "none*.csv")


def test_day_labels(spark, tmp_path):
    (tmp_path / "day=2021-12-05").mkdir()
    (tmp_path / "export-2024-01-01").mkdir()
    labels = {
        "x-2021-12-01.csv": "2021-12-01",
        "loose.csv": "loose",
        "a b+c.csv": "a b+c",
        "day=2021-12-05/part-0.csv": "2021-12-05",
        "day=2021-12-05/late-2021-12-06.csv": "2021-12-06",
        "export-2024-01-01/monday.csv": "monday",
        "export-2024-01-01/tuesday.csv": "tuesday",
    }
    for name in labels:
        write_file(tmp_path / name, "a,b,c,d,e,f,g,h,i,j")
    paths = position_files.discover_files(spark, str(tmp_path), nested=True)
    assert sorted(map(position_files.day_of_path, paths)) == sorted(labels.values())
    # A column for the partition folder would be inferred from the layout.
    flat = [p for p in paths if "day=" not in p]
    got = {r.file_day for r in position_files.read_feed(spark, flat).collect()}
    assert got == {position_files.day_of_path(p) for p in flat}
    dated = [p for p in paths if "day=" in p]
    got = {r.file_day for r in position_files.read_feed(spark, dated).collect()}
    assert got == {"2021-12-05", "2021-12-06"}
    (tmp_path / "more").mkdir()
    again = write_file(tmp_path / "more" / "monday.csv")
    with pytest.raises(ValueError, match="monday"):
        position_files.files_by_day([*paths, again])


def test_dirty_values_become_null(spark, tmp_path):
    path = write_file(
        tmp_path / "a-2021-12-01.csv",
        "01/12/2021 00:00:05, 219000001 ,55.5,14.2, Moored ,,8.5,,,  ALPHA ",
        "1/12/2021 00:00:05,219000001,north,14.2,,x,fast,1e1,,",
        "31/02/2021 00:00:05,219000001,,14.2",
    )
    rows = position_files.read_points(spark, path).orderBy("longitude", F.desc("ts")).collect()
    good, bad, short = sorted(rows, key=lambda r: (r.ts is None, r.latitude is None, r.cog is None))
    assert (good.ts, good.mmsi, good.name, good.navigational_status, good.sog) == (
        1638316805, "219000001", "ALPHA", "Moored", 8.5,
    )
    assert (bad.ts, bad.latitude, bad.rot, bad.sog, bad.cog) == (None, None, None, None, 10.0)
    assert (short.ts, short.latitude, short.longitude, short.name) == (None, None, 14.2, None)


def test_times_are_utc_in_any_session_zone(spark, tmp_path):
    path = write_file(tmp_path / "a-2021-12-01.csv", "01/12/2021 00:00:05,219000001,55.5,14.2")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        read = position_files.read_points(spark, path)
        assert read.first().ts == 1638316805
        assert position_files.as_feed(read).first()[0] == "01/12/2021 00:00:05"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_another_layout_fails_instead_of_shifting(spark, tmp_path):
    a = write_file(tmp_path / "a.csv", "01/12/2021 00:00:05,219000001,55.5,14.2")
    b = write_file(tmp_path / "b.csv", "219000001,01/12/2021 00:00:05,55.5,14.2",
                   header=HEADER.replace("# Timestamp,MMSI", "MMSI,# Timestamp"))
    with pytest.raises(Exception, match="(?i)header"):
        position_files.read_feed(spark, [a, b]).collect()
    both = position_files.read_points(spark, a).unionByName(
        position_files.read_points(spark, b), allowMissingColumns=True
    )
    assert {(r.mmsi, r.ts) for r in both.collect()} == {("219000001", 1638316805)}


def test_incremental_job(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    collision_day(raw / "ais-2021-12-01.csv", "01/12/2021", ratio=2)
    write_file(raw / "ais-2021-12-02.csv")
    job = DailyJob(spark, out)
    first = job.run(str(raw))
    assert {r.file_day for r in first.collect()} == {"2021-12-01"}
    top = first.first()
    assert top.mean_pair_proportion == pytest.approx(2.0)
    assert (top.pair_mmsi_1, top.pair_mmsi_2, top.vessel_in_pair) == ("219000001", "219000002", 1)
    assert top.collision_timestamp.isoformat() == "2021-12-01T12:00:00"

    # A finished day is not touched again, a new one is added.
    collision_day(raw / "ais-2021-12-01.csv", "01/12/2021", ratio=50)
    collision_day(raw / "ais-2021-12-03.csv", "03/12/2021", ratio=4)
    second = job.run(str(raw)).collect()
    assert [d for d in dict.fromkeys(r.file_day for r in second)] == ["2021-12-03", "2021-12-01"]
    assert {round(r.mean_pair_proportion, 6) for r in second} == {2.0, 4.0}
    assert {r.file_day for r in job.clean.done().collect()} == {
        "2021-12-01", "2021-12-02", "2021-12-03",
    }
    summary = spark.read.parquet(f"{job.report_folder}/event_summary").orderBy("file_day").collect()
    assert [(r.vessel_1, r.vessel_2) for r in summary] == [("ALPHA", "Vessel 219000002")] * 2
    candidates = job.candidates.read().collect()
    assert {r.timestamp_1.hour for r in candidates} == {12}

    assert [r.event_rank for r in summary] == [2, 1]
    top = spark.read.parquet(f"{job.report_folder}/top_event_tracks")
    assert {r.file_day for r in top.collect()} == {"2021-12-03"}
    hits = spark.read.parquet(f"{job.report_folder}/impact_points")
    assert {(r.file_day, r.vessel_in_pair, r.off_sec) for r in hits.collect()} == {
        (day, n, 0) for day in ("2021-12-01", "2021-12-03") for n in (1, 2)
    }
    job.export_csv(rank_tracks(job.tracks.read()), "ranked_tracks")
    text = spark.read.option("header", True).csv(f"{out}/ranked_tracks_csv")
    assert text.count() == len(second)


def test_nothing_found_gives_empty_tables_with_all_columns(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_file(raw / "ais-2021-12-02.csv")
    job = DailyJob(spark, str(tmp_path / "out"))
    report = job.run(str(raw))
    assert report.count() == 0
    assert set(report.columns) == {*job.tracks.schema.names, "event_rank"}


def test_late_file_reopens_its_day_in_all_stages(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    collision_day(raw / "ais-2021-12-01.csv", "01/12/2021")
    whole = (raw / "ais-2021-12-01.csv").read_text().splitlines()
    (raw / "ais-2021-12-01.csv").write_text("\n".join(l for l in whole if "219000002" not in l) + "\n")
    job = DailyJob(spark, out)
    assert job.run(str(raw)).count() == 0
    write_file(raw / "ais-2021-12-01_part2.csv", *(l for l in whole[1:] if "219000002" in l))
    # The late file alone is asked for; the day still has both.
    assert {r.mmsi for r in job.run(str(raw), "*part2*").collect()} == {"219000001", "219000002"}
    assert job.clean.read().count() == len(whole) - 1
    records = job.events.done().count()
    job.run(str(raw))
    assert job.events.done().count() == records


def test_repeated_day_is_replaced_whole(spark, tmp_path):
    table = DayTable(spark, str(tmp_path), "t", "file_day string, x int")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "file_day string, x int")
    table.write(rows, {"a": ["1"], "b": ["1"]})
    assert table.pending({"a": ["1"], "b": ["2"], "c": []}) == {"b": ["2"], "c": []}
    table.write(rows.where("x = 9"), {"a": ["2"]})
    assert [tuple(r) for r in table.read().collect()] == [("b", 2)]
    # A write that breaks off before its record changes nothing.
    write_days(rows.withColumn("x", F.lit(7)), f"{table.path}/version=9")
    assert [tuple(r) for r in table.read().collect()] == [("b", 2)]
    assert table.read(["a"]).count() == 0
    table.write(rows.where("x = 9"), {"b": ["2"]})
    assert table.read().count() == 0
    files = sum(1 for p in (tmp_path / "t_done").iterdir() if p.suffix == ".parquet")
    assert files <= 4


def test_mixed_layouts_give_the_same_points_as_single_runs(spark, tmp_path):
    lines = ["01/12/2021 00:00:05,219000001,55.5,14.2,Sailing,,8.5,,,ALPHA"]
    plain = write_file(tmp_path / "a-2021-12-01.csv", *lines)
    extra = write_file(tmp_path / "b-2021-12-02.csv", *(f"9,{x}" for x in lines), header=f"Extra,{HEADER}")
    fewer = write_file(
        tmp_path / "c-2021-12-03.csv", "55.5,219000001,14.2,Sailing,03/12/2021 00:00:05,8.5,ALPHA",
        header="Latitude,MMSI,Longitude,Navigational status,# Timestamp,SOG,Name",
    )
    empty = tmp_path / "d-2021-12-04.csv"
    empty.write_text("")
    columns = ["file_day", "mmsi", "ts", "latitude", "longitude", "sog", "name", "navigational_status"]
    read = position_files.read_points
    together = read(spark, [plain, extra, fewer, str(empty)]).select(*columns).collect()
    single = [r for p in (plain, extra, fewer) for r in read(spark, p).select(*columns).collect()]
    assert sorted(together) == sorted(single) and len(single) == 3
    job = DailyJob(spark, str(tmp_path / "out"))
    job.process([plain, extra, fewer, str(empty)])
    assert {r.file_day for r in job.clean.read().collect()} == {"2021-12-01", "2021-12-02", "2021-12-03"}
    assert set(job.clean.latest()) == {f"2021-12-0{n}" for n in (1, 2, 3, 4)}


def test_a_job_leaves_no_stage_tables(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    collision_day(raw / "ais-2021-12-01.csv", "01/12/2021")
    DailyJob(spark, str(tmp_path / "out")).run(str(raw))
    assert list((tmp_path / "out" / "stages").iterdir()) == []
    with StageStore(spark, str(tmp_path / "own")) as store:
        store.keep(spark.range(3), "t")
        other = tmp_path / "own" / "other"
        other.mkdir()
    assert list((tmp_path / "own").iterdir()) == [other]


def test_encounter_across_midnight_is_not_joined(spark, make_points):
    rows = []
    for step in range(-6, 7):
        day = 1 if step < 0 else 2
        ts = 86400 * 2 + step * 60
        off = step * 0.003
        first = {"ts": ts, "latitude": 55.2 + off, "file_day": day}
        second = {"ts": ts, "longitude": 14.2 + off, "file_day": day, "mmsi": "219000002"}
        # Vessel 1 reports before midnight only, vessel 2 after midnight only.
        rows += [first] if step < 0 else [second]
    apart = EncounterAnalysis(make_points(rows), StageStore(spark))
    together = EncounterAnalysis(
        make_points([r | {"file_day": 1} for r in rows]), StageStore(spark)
    )
    near = EncounterConfig(pair_distance_m=1000.0, pair_lat_tolerance=0.1, pair_lon_tolerance=0.1)
    apart.cfg = together.cfg = near
    assert apart.candidates.count() == 0
    assert together.candidates.count() == 1


def test_overwriting_one_day_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    both = spark.createDataFrame([("a", 1), ("b", 2)], "file_day string, x int")
    write_days(both, path)
    write_days(both.where("x = 2").withColumn("x", F.lit(5)), path)
    assert sorted(map(tuple, spark.read.parquet(path).select("file_day", "x").collect())) == [
        ("a", 1), ("b", 5),
    ]
    left = pending_days(both, both.where("x = 1"))
    assert [r.file_day for r in left.collect()] == ["b"]


def test_events_table_through_files_gives_the_same_ranking(spark, tmp_path):
    points = ais_points(spark, SMALL)
    day = F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd")
    raw = str(tmp_path / "raw")
    feed = position_files.as_feed(points)
    dated = feed.withColumn(
        "day", F.to_date(F.substring_index("# Timestamp", " ", 1), position_files.FEED_DATE_FORMAT)
    )
    dated.write.option("header", True).partitionBy("day").csv(raw)
    ranked = DailyJob(spark, str(tmp_path / "out")).run(raw, nested=True)
    # Row ids do not pass through files; without them ties break by content.
    direct = EncounterAnalysis(
        points.drop("event_id").withColumn("file_day", day), StageStore(spark)
    ).ranked_tracks
    columns = ["pair_id", "mmsi", "ts", "latitude", "longitude", "mean_pair_proportion"]
    through_files = [tuple(r) for r in ranked.select(*columns).collect()]
    assert through_files and through_files == [tuple(r) for r in direct.select(*columns).collect()]


def two_versions(spark, path):
    """A table of two days; the first day was written twice, the second time with other rows."""
    table = DayTable(spark, str(path), "t", "x int, file_day string")
    first = spark.createDataFrame([(i, d) for d in ("a", "b") for i in range(50)], "x int, file_day string")
    table.write(first, {"a": ["f1"], "b": ["f2"]})
    running = table.read()
    running.explain()  # plans the read: its files are listed now
    table.write(spark.createDataFrame([(7, "a")], "x int, file_day string"), {"a": ["f1", "f3"]})
    return table, running


def test_vacuum_leaves_a_running_reader_whole(spark, tmp_path):
    table, running = two_versions(spark, tmp_path)
    assert table.vacuum(retention_sec=3600) == []
    assert running.count() == 100
    assert sorted(map(tuple, table.read().collect())) == sorted([(7, "a")] + [(i, "b") for i in range(50)])

    gone = table.vacuum(retention_sec=0)
    # Day a of the first version goes; day b stays in it. The manifest became one file.
    assert [g.rsplit("/", 1)[1] for g in gone if "done" not in g] == ["file_day=a"]
    assert len([f for f in (tmp_path / "t_done").iterdir() if f.suffix == ".parquet"]) == 1
    again = DayTable(spark, str(tmp_path), "t", "x int, file_day string")
    assert again.read().count() == 51
    assert again.pending({"a": ["f1", "f3"], "b": ["f2"]}) == {}
    assert again.pending({"a": ["f1"]}) == {"a": ["f1"]}
    assert again.vacuum(retention_sec=0) == []


def test_vacuum_of_broken_writes_and_emptied_days(spark, tmp_path):
    table, _ = two_versions(spark, tmp_path)
    empty = spark.createDataFrame([], "x int, file_day string")
    table.write(empty, {"a": ["f4"], "b": ["f4"]})
    # A write that ended before its record.
    broken = tmp_path / "t" / f"version={10**18:020d}-dead" / "file_day=a"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"")
    gone = table.vacuum(retention_sec=0)
    assert any("dead" in g for g in gone)
    assert table.read().count() == 0 and table.pending({"a": ["f4"], "b": ["f4"]}) == {}
    left = [p for p in (tmp_path / "t").rglob("*.parquet")]
    assert not [p for p in left if "file_day=" in str(p)]
    table.write(spark.createDataFrame([(1, "b")], "x int, file_day string"), {"b": ["f5"]})
    assert [tuple(r) for r in table.read().collect()] == [(1, "b")]


def test_a_write_under_way_is_no_leaving(spark, tmp_path):
    from fairlead.sources.day_tables import new_version

    table, _ = two_versions(spark, tmp_path)
    young = tmp_path / "t" / f"version={new_version()}" / "file_day=a"
    young.mkdir(parents=True)
    table.vacuum(retention_sec=600)
    assert young.exists()


def test_vacuum_of_a_table_without_writes(spark, tmp_path):
    table = DayTable(spark, str(tmp_path), "t", "x int, file_day string")
    assert table.vacuum(retention_sec=0) == [] and table.read().count() == 0


def test_manifest_of_an_earlier_layout(spark, tmp_path):
    """Records without a time of their own: the version's time stands in."""
    table, _ = two_versions(spark, tmp_path)
    old = spark.read.parquet(table.done_path).drop("recorded").collect()
    schema = "file_day string, version string, inputs array<string>"
    spark.createDataFrame(old, schema).write.mode("overwrite").parquet(table.done_path)
    assert table.vacuum(retention_sec=3600) == [] and table.read().count() == 51
    assert [g.rsplit("/", 1)[1] for g in table.vacuum(retention_sec=0) if "done" not in g] == ["file_day=a"]
    assert table.read().count() == 51


def test_job_vacuum_keeps_the_newest_report(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    collision_day(raw / "ais-2021-12-01.csv", "01/12/2021", ratio=2)
    job = DailyJob(spark, str(tmp_path / "out"))
    job.run(str(raw))
    before = job.report_folder
    collision_day(raw / "ais-2021-12-02.csv", "02/12/2021", ratio=4)
    job.run(str(raw))
    assert not any("reports" in g for g in job.vacuum(retention_sec=3600))
    gone = job.vacuum(retention_sec=0)
    assert [g for g in gone if "reports" in g] == [before]
    assert spark.read.parquet(f"{job.report_folder}/ranked_tracks").count() > 0
    assert {r.file_day for r in job.run(str(raw)).collect()} == {"2021-12-01", "2021-12-02"}


def test_daily_job_over_five_days_equals_sql(spark):
    """The whole run from files against SQL where the feed spans several days."""
    from fairlead.plans import catalogue, oracle
    from tests.oracle_check import compare, connect

    sf, name = "/root/testdata/sf0.1", "daily_job_files"
    rows, problem = compare(spark, connect(sf), sf, catalogue.queries()[name], oracle.oracle_sql()[name])
    assert problem is None and rows > 10
    days = connect(sf).execute(f"SELECT count(DISTINCT file_day) FROM ({oracle.oracle_sql()[name]})").fetchone()
    assert days[0] > 1


def test_bad_lines_and_counts_come_with_the_clean_points(spark, tmp_path):
    """Lines of a wrong number of fields land by day and file; counts equal a pass of their own."""
    raw = tmp_path / "raw"
    raw.mkdir()
    collision_day(raw / "ais-2021-12-01.csv", "01/12/2021")
    good = "02/12/2021 10:00:00,219000001,55.2,14.2,Sailing,,9,,,ALPHA"
    write_file(
        raw / "a b+c-2021-12-02.csv", good, good + ",one more", "02/12/2021 10:00:10,219000001", '"never closed,1', "",
        "02/12/2021 10:00:20,111111111,91,14.2,Sailing,,9,,,PILOT",
    )
    write_file(raw / "empty-2021-12-02.csv", header="")
    job = DailyJob(spark, str(tmp_path / "out"))
    files = position_files.discover_files(spark, str(raw))
    job.process(files)

    bad = {(r.file_day, r.file.rsplit("/", 1)[1], r.line) for r in job.bad_lines.read().collect()}
    assert {(d, f) for d, f, _ in bad} == {("2021-12-02", "a b+c-2021-12-02.csv")}
    assert {line.split(",")[0] for *_, line in bad} == {"02/12/2021 10:00:00", "02/12/2021 10:00:10", '"never closed'}

    points = position_files.read_points(spark, files)
    counts = {r.measure: r["count"] for r in job.quality_counts().collect()}
    reasons = {r.rule: r.failed_rows for r in quality.validity_reasons(points).collect()}
    assert counts == {"rows": points.count(), "bad_lines": len(bad), **reasons}
    assert counts["not_rescue_craft"] == 1 and counts["latitude_set"] == 2  # missing ones fail as well

    # A delivery without bad lines empties the table of its day.
    collision_day(raw / "ais-2021-12-03.csv", "03/12/2021")
    job.process(position_files.discover_files(spark, str(raw)))
    assert job.quality_counts().select("version").distinct().count() == 2
    assert {r.file_day for r in job.bad_lines.done().collect()} == {"2021-12-01", "2021-12-02", "2021-12-03"}


@pytest.mark.parametrize("lines", [(), ("02/12/2021 10:00:00,219000001,91,14.2,Sailing,,9,,,ALPHA", "short,line")])
def test_counts_of_files_without_a_usable_report(spark, tmp_path, lines):
    """The counters of a plan that turns out empty are lost; the counts are not."""
    raw = tmp_path / "raw"
    raw.mkdir()
    write_file(raw / "ais-2021-12-02.csv", *lines)
    job = DailyJob(spark, str(tmp_path / "out"))
    job.process(position_files.discover_files(spark, str(raw)))
    counts = {r.measure: r["count"] for r in job.quality_counts().collect()}
    assert counts["rows"] == len(lines) and counts["bad_lines"] == job.bad_lines.read().count() == len(lines[1:])
    assert counts["latitude_on_globe"] == len(lines)


def jobs_of(spark, action) -> int:
    """Number of Spark jobs that ``action`` starts."""
    context = spark.sparkContext
    context.setJobGroup("counted", "counted")
    try:
        action()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup("counted"))


def test_headers_of_many_files_take_one_job(spark, tmp_path):
    """Hundreds of files of two layouts, long ones and empty ones: one job, beginnings only."""
    for i in range(200):
        write_file(tmp_path / f"{'x y' if i % 2 else 'p+q%'}-{i}.csv", "1,2", header="a,b" if i % 3 else "b,a,c")
    (tmp_path / "empty.csv").write_text("")
    write_file(tmp_path / "long.csv", *(["1,2"] * 200_000), header="a,b")
    paths = position_files.discover_files(spark, str(tmp_path))
    found = {}
    jobs = jobs_of(spark, lambda: found.update(position_files.headers(spark, paths)))
    assert {p.rsplit("/", 1)[1]: h for p, h in found.items()} == {
        **{f"{'x y' if i % 2 else 'p+q%'}-{i}.csv": "a,b" if i % 3 else "b,a,c" for i in range(200)}, "long.csv": "a,b",
    }
    assert jobs <= 2  # one lists the files, one reads
    assert spark.conf.get("spark.sql.files.openCostInBytes") != position_files.FIRST_LINES["spark.sql.files.openCostInBytes"]
    assert {h: len(f) for h, f in position_files.by_layout(spark, paths).items()} == {"a,b": 134, "b,a,c": 67}


def test_headers_start_no_python_process(spark, tmp_path, monkeypatch):
    """With thousands of daily files a process per file takes most of the time."""
    paths = [write_file(tmp_path / f"{i}.csv", "1,2", "3,4", header=f"a,b{i}") for i in range(3)]

    def refuse(*_):
        raise AssertionError("a Python process per file")

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", refuse)
    found = position_files.headers(spark, [str(p) for p in paths])
    assert sorted(found.values()) == ["a,b0", "a,b1", "a,b2"]


def test_many_small_days_are_written_by_several_tasks(spark, tmp_path):
    """One task opens no file for each of many days, and each day is one file still."""
    days = [f"2021-12-{d:02}" for d in range(1, 32)]
    table = DayTable(spark, str(tmp_path), "small", "x int, file_day string")
    merging = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    table.write(spark.createDataFrame([(1, d) for d in days], "x int, file_day string"), {d: [d] for d in days})
    files = [f.name for f in tmp_path.glob("small/version=*/file_day=*/part-*.parquet")]
    assert len(files) == len(days)
    assert len({name.split("-")[1] for name in files}) > 2
    assert sorted(r.file_day for r in table.read().collect()) == days
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == merging


def test_label_is_split_off_without_trying_each_place(spark, tmp_path):
    """Before, a pattern on the whole path took most of the time of reading."""
    rows = position_files.read_feed(spark, str(write_file(tmp_path / "a.b-2021-12-01.csv", "1,2", header="a,b")))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "([^/]*)/*$" not in plan
    assert [r.file_day for r in rows.collect()] == ["2021-12-01"]
