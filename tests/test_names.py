from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orthoweave.functions import names

S, E = "20240101000000", "20240102030405"
START, END = datetime(2024, 1, 1), datetime(2024, 1, 2, 3, 4, 5)


def evaluate(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize("name, camera", [
    (f"/v/a b/cam_x_{S}_{E}(1).dav", "cam_x"),
    (f"cam_{S}_{E}.mp4", "cam"),
    (f"{S}_cam_{E}.mp4", "cam"),
    (f"a_{S}_b_{E}_q.x.dav", "a_b"),
    (f"{S}_{E}_tail.mp4", ""),
    (f"a__{S}_{E}", "a_"),
    (f"a_{S}_{E}_20250101000000.mp4", "a"),
    (f"{S}_{E}.mp4", None),          # two parts only
    (f"cam_{S}.mp4", None),          # one time only
    (f"cam_{S}_20240230000000.mp4", None),   # no such day
    (f"cam_00000101000000_{E}.mp4", None),   # no such year
    (f"cam_{S}_{E}.5.mp4", None),    # the last part is not 14 digits
    (f"cam.v1_{S}_{E}", None),       # everything after the dot is the extension
])
def test_video_name(spark, name, camera):
    found = evaluate(spark, [name], names.parse_video_name)[0]
    if camera is None:
        assert found is None
    else:
        assert (found.camera, found.start_time, found.end_time) == (camera, START, END)


@given(st.lists(st.from_regex(r"[A-Za-z0-9]{1,8}", fullmatch=True).filter(
    lambda p: not (len(p) == 14 and p.isdigit())), min_size=1, max_size=4),
    st.datetimes(min_value=datetime(1970, 1, 1), max_value=datetime(2100, 1, 1)),
    st.sampled_from(["", "(3)"]))
@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_generated_names_round_trip(spark, parts, start, suffix):
    start = start.replace(microsecond=0)
    text = start.strftime("%Y%m%d%H%M%S")
    found = evaluate(spark, [f"/x/{'_'.join(parts)}_{text}_{text}{suffix}.dav"], names.parse_video_name)[0]
    assert (found.camera, found.start_time) == ("_".join(parts), start)


def test_relative_seconds(spark):
    texts = ["0:10", "1:30", "2:45.5", "1:00:00", "12.25", "1:2:3:4", "x", "1:x", "", "1.5:3", " 2 :3"]
    assert evaluate(spark, texts, names.relative_seconds) == [
        10.0, 90.0, 165.5, 3600.0, 12.25, None, None, None, None, None, 123.0]


def test_clock_time(spark):
    texts = ["20250925151530", "2025-09-25 15:15:30", "2025-9-5 1:2:3", "2025-13-01 00:00:00",
             "20251301000000", "2025-09-25", "20250925 151530"]
    assert evaluate(spark, texts, names.parse_clock_time) == [
        datetime(2025, 9, 25, 15, 15, 30), datetime(2025, 9, 25, 15, 15, 30),
        datetime(2025, 9, 5, 1, 2, 3), None, None, None, None]


def test_interval(spark):
    texts = ["1min", " 2 ".strip() + "H", "30s", "1.5hours", "90Seconds", "2 min", "min", "1.2.3s", "5d", "."]
    assert evaluate(spark, texts, names.interval_seconds) == [
        60.0, 7200.0, 30.0, 5400.0, 90.0, None, None, None, None, None]


def test_cameras_and_dates(spark):
    assert evaluate(spark, ["dac1_N910A6_ch3_main", "dvi2_N910A6_ch7_main", "NVR1_N910A6_ch1_main",
                            "dac2_N910A6_ch8_main_x"], names.global_camera) == [
        "N910A6_ch03_main", "N910A6_ch15_main", "NVR1_N910A6_ch1_main", "N910A6_ch16_main"]
    paths = ["/d/20251016_103100/cam.tiff", "/20250101/20251016_1/sub/c.tiff",
             "/d/cam_20251017.tiff", "/d/cam.20251018", "/d/cam.tiff"]
    assert evaluate(spark, paths, lambda c: names.path_date(c, F.lit("19990101"))) == [
        "20251016", "20251016", "20251017", "19990101", "19990101"]
    paths = ["/v/NVR1/x.dav", "/v/a b/c/x.dav", "/v/x.dav", "/other/x.dav"]
    assert evaluate(spark, paths, lambda c: names.qualified_camera(F.lit("cam"), c, "/v/")) == [
        "NVR1_cam", "a_b_c_cam", "cam", "cam"]


def test_extensions_and_folders(spark):
    assert evaluate(spark, ["a.dav", "a.DAV", "a.Dav", "a.txt", "dav", "a.b/c"],
                    names.has_video_extension) == [True, True, False, False, False, False]
    assert evaluate(spark, ["2:45.5"], names.offset_folder) == ["timestamp_2m45s5"]
    assert evaluate(spark, ["2025-10-16 10:31:00.25"], lambda c: names.ts_folder(
        c.cast("timestamp_ntz"))) == ["20251016_103100"]
