"""Landing of files through a stream."""

from __future__ import annotations

from fairlead.operators import area, quality
from fairlead.sources import position_files
from fairlead.streaming.landing import feed_stream, land
from tests.test_daily_job import HEADER, collision_day


def test_each_file_lands_once_and_like_the_batch(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        points = feed_stream(spark, str(raw), header=HEADER.split(","))
        land(points, out, checkpoint).awaitTermination()
        return spark.read.parquet(out)

    collision_day(raw / "ais-2021-12-01.csv", "01/12/2021")
    assert run().count() == 26
    assert run().count() == 26
    collision_day(raw / "ais-2021-12-02.csv", "02/12/2021")
    landed = run()
    batch = position_files.read_points(spark, str(raw))
    batch = area.in_circle(quality.valid_rows(batch))
    columns = ["file_day", "mmsi", "ts", "latitude", "sog", "distance_to_center_nm"]

    def rows(df):
        typed = df.withColumn("file_day", df.file_day.cast("string")).select(*columns)
        return sorted(map(tuple, typed.collect()))

    assert rows(landed) == rows(batch)
    assert landed.count() == 52
