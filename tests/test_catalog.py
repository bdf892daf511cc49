import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orthoweave.operators import catalog
from orthoweave.plans import frames

T0 = datetime(2024, 1, 1)


def segment_rows(seed=1, n=120):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = T0 + timedelta(seconds=rng.randrange(0, 86400))
        length = rng.choice([0, 1, 59, 60, 61, 300, 3600, 40000])
        rows.append((f"/v/{i:03d}.dav", rng.choice("ab"), start, start + timedelta(seconds=length)))
    # a file whose name claims an end far in the future
    rows.append(("/v/far.dav", "a", T0 + timedelta(hours=5), datetime(9999, 12, 31)))
    return rows


def expected(rows, times):
    out = set()
    for camera in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == camera), key=lambda r: (r[2], r[0]))
        for t in times:
            hit = next((r for r in own if r[2] <= t <= r[3]), None)
            if hit:
                out.add((camera, t, hit[0]))
    return out


SCHEMA = "path string, camera string, start_time timestamp_ntz, end_time timestamp_ntz"


def as_set(df):
    return {(r.camera, r.ts, r.path) for r in df.collect()}


def test_grid_and_join_agree_with_direct_search(spark):
    rows = segment_rows()
    segments = spark.createDataFrame(rows, SCHEMA)
    grid = catalog.make_grid(spark, "2024-01-01 00:00:00", "20240102020000", "7min")
    times = [r.ts for r in catalog.clock_grid(spark, grid).collect()]
    assert times[0] == T0 and max(times) <= datetime(2024, 1, 2, 2) and len(times) == 223
    want = expected(rows, times)
    assert as_set(catalog.match_grid(segments, grid)) == want
    targets = catalog.clock_grid(spark, grid)
    assert as_set(catalog.match_frames(segments, targets)) == want


def test_both_ends_count_and_first_start_wins(spark):
    t = [T0 + timedelta(minutes=m) for m in range(5)]
    rows = [("b", "c", t[1], t[3]), ("a", "c", t[1], t[2]), ("z", "c", t[0], t[1])]
    segments = spark.createDataFrame(rows, SCHEMA)
    targets = spark.createDataFrame([(x,) for x in t], "ts timestamp_ntz")
    assert as_set(catalog.match_frames(segments, targets)) == {
        ("c", t[0], "z"), ("c", t[1], "z"), ("c", t[2], "a"), ("c", t[3], "b")}


def test_fractional_steps_and_bad_limits(spark):
    grid = catalog.make_grid(spark, "20240101000000", "2024-01-01 00:00:02", "0.5s")
    assert [r.ts.microsecond for r in catalog.clock_grid(spark, grid).collect()] == [
        0, 500000, 0, 500000, 0]
    for start, end, step in (("20240101000000", "20240101000000", "1s"), ("x", "20240101000000", "1s"),
                             ("20240101000000", "20240102000000", "0s"),
                             ("20240101000000", "20240102000000", "soon")):
        with pytest.raises(ValueError):
            catalog.make_grid(spark, start, end, step)
    with pytest.raises(ValueError):
        catalog.clock_times(spark, ["20240101000000", "never"])


def test_no_nested_loop_in_interval_join(spark):
    segments = spark.createDataFrame(segment_rows(), SCHEMA)
    targets = spark.createDataFrame([(T0,)], "ts timestamp_ntz")
    plan = catalog.match_frames(segments, targets)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_plan_offsets(spark):
    clips = spark.createDataFrame(
        [("/v/r 1/a_x.mp4", 10.0, 700.0), ("/v/b.mp4", 0.0, 700.0)],
        "path string, fps double, frame_count double")
    rows = frames.plan_offsets(clips, ["0:10", "1:10", "2:00", "bad"], base="/v").collect()
    assert {(r.name, r.offset_folder, r.frame_number) for r in rows} == {
        ("r_1_a_x", "timestamp_0m10", 100), ("r_1_a_x", "timestamp_1m10", 700)}


def test_plan_frames_drops_times_behind_the_last_frame(spark):
    name = "/v/cam_20240101000000_20240101010000.dav"
    clips = spark.createDataFrame([(name, 10.0, 6000.0)], "path string, fps double, frame_count double")
    grid = catalog.make_grid(spark, "2024-01-01 00:05:00", "2024-01-01 00:20:00", "5min")
    rows = frames.plan_frames(clips, grid).orderBy("ts").collect()
    assert [(r.ts_folder, r.frame_number) for r in rows] == [
        ("20240101_000500", 3000), ("20240101_001000", 6000)]


def test_requests_come_in_blocks(spark):
    rows = [("c", "p", T0 + timedelta(minutes=m), m) for m in (70, 5, 65, 1)]
    requests = spark.createDataFrame(rows, "camera string, path string, ts timestamp_ntz, frame_number long")
    blocks = catalog.requests_per_video(requests).orderBy("block_start").collect()
    assert [[q.frame_number for q in b.requests] for b in blocks] == [[1, 5], [65, 70]]


def test_listing_is_distinct(spark):
    paths = spark.createDataFrame([("a.dav",), ("a.dav",), ("b.TXT",), ("c.Mp4",)], "path string")
    assert [r.path for r in catalog.video_files(paths).collect()] == ["a.dav"]
    assert catalog.unparsed_videos(paths).where(F.col("path") == "a.dav").count() == 1


def test_a_segment_of_a_thousand_years(spark):
    """Only the positions of the grid count, in chunks of bounded size."""
    segments = spark.createDataFrame(
        [("a", "/x", "1500-01-01 00:00:00", "2500-01-01 00:00:00")], "camera string, path string, s string, e string"
    ).selectExpr("camera", "path", "cast(s as timestamp_ntz) start_time", "cast(e as timestamp_ntz) end_time")
    grid = catalog.ClockGrid("2024-01-01 00:00:00", 1_000_000, 300_000)
    assert catalog.match_grid(segments, grid).count() == 300_000
