import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orthoweave.functions import geometry
from orthoweave.operators import calibration, matching, remap
from orthoweave.plans import orthos, recalibration

RECORD = ("camera string, K array<array<double>>, D array<double>, rvec array<double>, tvec array<double>, "
          "image_width int, image_height int")


def record(camera="c", f=10.0, c=(8.0, 6.0), d=(0.0,) * 4, rvec=(0.0,) * 3, tvec=(0.0,) * 3, size=(16, 12)):
    return (camera, [[f, 0.0, c[0]], [0.0, f, c[1]], [0.0, 0.0, 1.0]], list(d), list(rvec), list(tvec), *size)


def project(spark, rec, points):
    model = geometry.CameraModel.of_record()
    cams = spark.createDataFrame([rec], RECORD).withColumn("R", geometry.rotation_array(model.rvec))
    df = cams.join(spark.createDataFrame(
        [(rec[0], i, *map(float, p)) for i, p in enumerate(points)],
        "camera string, i int, X double, Y double, Z double"), "camera")
    at = geometry.world_to_camera("X", "Y", "Z", geometry.rotation_of("R"), model.tvec)
    df = df.withColumns(dict(zip(("px", "py", "pz"), at)))
    u, v = geometry.fisheye_project((F.col("px"), F.col("py"), F.col("pz")), model)
    return df.select("i", F.col("px").alias("x"), F.col("py").alias("y"), F.col("pz").alias("z"), u.alias("u"), v.alias("v")).orderBy("i").collect()


def test_small_angles_are_a_pinhole(spark):
    points = [(.001, .002, 1), (0, 0, 5)]
    for r, (x, y, z) in zip(project(spark, record(f=1000.0), points), points):
        assert r.u == pytest.approx(8 + 1000 * x / z, abs=1e-3)
        assert r.v == pytest.approx(6 + 1000 * y / z, abs=1e-3)


def test_plane_through_the_camera_gives_null(spark):
    assert project(spark, record(), [(1, 1, 0)])[0].u is None


def test_rotation(spark):
    rows = project(spark, record(rvec=(0.0, 0.0, math.pi / 2), tvec=(0.0, 0.0, 3.0)), [(1, 0, 0)])
    assert (rows[0].x, rows[0].y, rows[0].z) == pytest.approx((0, 1, 3))
    df = spark.createDataFrame([(0.3, -0.7, 1.1)], "a double, b double, c double")
    m = geometry.rotation_matrix((F.col("a"), F.col("b"), F.col("c")))
    r = np.array(df.select(*[x.alias(f"m{i}") for i, x in enumerate(c for row in m for c in row)]).first()).reshape(3, 3)
    assert np.allclose(r @ r.T, np.eye(3)) and np.linalg.det(r) == pytest.approx(1)
    assert np.allclose(r @ [0.3, -0.7, 1.1], [0.3, -0.7, 1.1])


def test_undistortion_inverts_distortion(spark):
    k = tuple(F.lit(v) for v in (0.02, -0.003, 0.0005, 0.0))
    df = spark.range(1, 12).select((F.col("id") / 10.0).alias("t"))
    rows = df.select("t", geometry.undistort_angle(geometry.distort_angle(F.col("t"), k), k).alias("back")).collect()
    assert all(r.back == pytest.approx(r.t, abs=1e-9) for r in rows)


def test_undistorted_view_without_distortion_of_a_long_lens(spark):
    """A long lens is nearly a pinhole, so its undistorted view is the frame itself."""
    cams = spark.createDataFrame([record(f=10000.0)], RECORD)
    for r in remap.undistort_map(cams).collect():
        assert (r.src_x, r.src_y) == pytest.approx((r.col, r.row), abs=0.01)


@pytest.mark.parametrize("balance", [0.0, 1.0])
def test_undistorted_view_is_centred(spark, balance):
    cams = spark.createDataFrame([record(f=9.0, d=(0.05, 0.0, 0.0, 0.0))], RECORD)
    at = {(r.row, r.col): (r.src_x, r.src_y) for r in remap.undistort_map(cams, balance).collect()}
    assert at[(6, 8)] == pytest.approx((8, 6), abs=1e-4)
    xs = [at[(6, c)][0] for c in range(16)]
    assert xs == sorted(xs)


def test_undistorted_frames_keep_their_size(spark):
    cams = spark.createDataFrame([record(size=(4, 3), c=(2.0, 1.5), f=50.0)], RECORD)
    px = spark.createDataFrame([(1, "c", r, c, 7, 7, 7) for r in range(3) for c in range(4)],
                               "ts long, camera string, row int, col int, b int, g int, r int")
    assert orthos.undistort_frames(px, cams).count() == 12


PICKS = "pid long, camera string, X double, Y double, Z double, col_sample double, row_sample double"


PLACES = "camera string, pid long, col_sample double, row_sample double"


def test_first_pairs_of_a_crowd_of_distinct_positions(spark):
    crowd = [("c1", 10 + k, 300.0 + (k * 7 % 40) / 2, 300.0 + k / 99) for k in range(900)]
    ahead = [("c1", 3, 290.0, 300.0), ("c1", 5, 800.0, 800.0), ("c2", 1, 0.0, 0.0), ("c2", 2, 29.0, 3.0),
             ("c3", 1, 5.0, 5.0), ("c3", 2, math.nan, 5.0), ("c3", 3, math.nan, 5.0), ("c3", 4, None, 5.0), ("c3", 5, None, 5.0)]
    picks = spark.createDataFrame(crowd + ahead, PLACES)
    whole = [(*a, *b) for a in crowd + ahead for b in crowd + ahead if a[0] == b[0] and a[1] < b[1]
             and None not in (a[2], b[2]) and math.hypot(a[2] - b[2], a[3] - b[3]) < 30]
    want = sorted((p[0], p[1], p[5]) for p in whole)
    first = [p for p in want if p[0] == "c1"][:5] + [p for p in want if p[0] != "c1"]
    found = calibration.top_close_pairs(picks)
    assert sorted((r.camera, r.i, r.j) for r in found.collect()) == first
    # all 900 picks meet the few that can be first, not each other
    patched = picks.withColumns({c: F.floor(F.col(f"{c0}_sample") / calibration.PATCH) for c, c0 in (("_pc", "col"), ("_pr", "row"))})
    assert [tuple(r) for r in calibration._last_first(patched, 5).collect()] == [("c1", 10)]


@pytest.mark.parametrize("pairs", [calibration.close_pairs, calibration.close_pair_counts, calibration.top_close_pairs])
def test_repeated_picks_are_not_broadcast(spark, pairs):
    """Their size is estimated without the repeats."""
    plan = pairs(spark.createDataFrame([("c1", k, float(k), 0.0) for k in range(9)], PLACES))._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and ("_salt" in line)]
    assert joins and all("SortMergeJoin" in line for line in joins), plan


def test_close_pairs_against_all_pairs(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("ab"), 0.0, 0.0, 0.0, float(rng.randrange(-60, 200)), float(rng.randrange(-60, 200)))
            for i in range(150)]
    rows += [(200 + i, "a", 0.0, 0.0, 0.0, 50.0, 50.0) for i in range(12)]      # copies of one position
    want = sorted((p[1], p[0], q[0]) for p in rows for q in rows
                  if p[0] < q[0] and p[1] == q[1] and math.dist(p[5:], q[5:]) < 30)
    picks = spark.createDataFrame(rows, PICKS)
    assert sorted((r.camera, r.i, r.j) for r in calibration.close_pairs(picks).collect()) == want
    counts = {r.camera: r.n_close_pairs for r in calibration.close_pair_counts(picks).collect()}
    assert counts == {c: sum(w[0] == c for w in want) for c in "ab"}
    top = sorted((r.camera, r.i, r.j) for r in calibration.top_close_pairs(picks).collect())
    assert top == sorted(x for c in "ab" for x in [w for w in want if w[0] == c][:5])


def test_first_pairs_of_many_copies(spark):
    rows = [(i, "a", 0.0, 0.0, 0.0, 5.0, 5.0) for i in range(40)]
    top = calibration.top_close_pairs(spark.createDataFrame(rows, PICKS)).collect()
    assert sorted((r.i, r.j) for r in top) == [(0, j) for j in range(1, 6)]


def test_no_nested_loop_in_pair_join(spark):
    picks = spark.createDataFrame([(1, "a", 0.0, 0.0, 0.0, 5.0, 5.0)], PICKS)
    plan = calibration.close_pairs(picks)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_perfect_calibration_has_no_error_and_wins(spark):
    points = [(i % 4, i // 4, 5.0 + i % 3) for i in range(12)]
    rec = record(f=100.0, d=(0.01, 0.0, 0.0, 0.0), rvec=(0.1, 0.2, 0.0), tvec=(0.0, 0.0, 4.0))
    seen = project(spark, rec, points)
    gcps = spark.createDataFrame(
        [(i, "c", *map(float, p), r.u, r.v) for i, (p, r) in enumerate(zip(points, seen))], PICKS)
    candidates = spark.createDataFrame([(1, *record(f=99.0)), (2, *rec)], "candidate int, " + RECORD)
    best = calibration.best_calibration(gcps, candidates).first()
    assert best.candidate == 2 and best.rms == pytest.approx(0, abs=1e-9) and best.n_gcps == 12


def test_candidates_of_equal_parameters_are_scored_once(spark, monkeypatch):
    gcps = spark.createDataFrame([(i, "c", float(i % 3), float(i), 4.0, 8.0, 6.0) for i in range(6)], PICKS)
    candidates = spark.createDataFrame(
        [(9 - k, *record(f=10.0 + k % 2)) for k in range(8)] + [(1, *record(f=9.0))], "candidate int, " + RECORD)
    rms, scored = calibration.reprojection_rms, []

    def counted(points, cameras, keys):
        scored.append(cameras.count())
        return rms(points, cameras, keys)

    want = rms(gcps, candidates, ["camera", "candidate"]).orderBy(F.round("rms", 9), "candidate").first()
    monkeypatch.setattr(calibration, "reprojection_rms", counted)
    best = calibration.best_calibration(gcps, candidates).first()
    assert scored == [3] and best.candidate == want.candidate and best.rms == pytest.approx(want.rms)


STORE = [("original", "a", 1.0), ("original", "b", 2.0), ("20250101", "a", 3.0), ("20250301", "a", 4.0),
         ("20250301", "b", 5.0)]


@pytest.fixture
def store(spark):
    return spark.createDataFrame(STORE, "version string, camera string, rms double")


def content(df):
    return sorted((r.version, r.camera, r.rms) for r in df.collect())


def test_versions(spark, store):
    dates = spark.createDataFrame([("20241201",), ("20250101",), ("20250201",), ("20250401",)], "date string")

    def of(mode, source=store):
        rows = calibration.resolve_calibration(dates, source, mode=mode).orderBy("date").collect()
        return [r.version for r in rows]

    assert of("latest") == ["20250301", "20250101", "20250301", "20250301"]
    assert of("asof") == ["original", "20250101", "20250101", "20250301"]
    assert of("latest", store.where("version = 'original'")) == ["original"] * 4


def test_store_changes(store):
    copied = calibration.copy_camera(store, "original", "20250101", "b")
    assert content(copied) == [("20250101", "a", 3.0), ("20250101", "b", 2.0)]
    assert content(calibration.delete_camera(store, "20250301", "a")) == [("20250301", "b", 5.0)]
    for change in (lambda: calibration.delete_camera(store, "20250301", "z"),
                   lambda: calibration.copy_camera(store, "20250101", "original", "b")):
        with pytest.raises(KeyError):
            change()


def test_copy_then_restore_gives_the_old_store(store):
    saved = calibration.backup(store, "20250301", "backup_x")
    changed = calibration.with_version(
        store, "20250301", calibration.copy_camera(store, "original", "20250301", "a"))
    assert content(changed) != content(store)
    back = calibration.restore_camera(changed.unionByName(saved), "backup_x", "20250301", "a")
    assert content(calibration.with_version(changed, "20250301", back)) == content(store)


def test_promote(spark, store):
    new = spark.createDataFrame([("a", 0.5), ("z", 0.7)], "camera string, rms double")
    rows = recalibration.promote_calibration(store, new, "20250401", {"a": "NVR1_a"}).collect()
    assert sorted((r.version, r.camera, r.rms) for r in rows) == [
        ("20250401", "NVR1_a", 0.5), ("20250401", "b", 5.0), ("20250401", "z", 0.7),
        ("backup_a_20250401", "a", 4.0)]
    assert {r.camera for r in rows if r.recalibrated} == {"NVR1_a", "z"}


def test_contains_join(spark):
    texts = spark.createDataFrame([("/a/ch10/ch1x",), ("/ch2",), ("c",), ("ch1ch1",)], "path string")
    cameras = spark.createDataFrame([("ch1", 3), ("ch10", 2), ("ch2", 1), ("a/ch10/", 9)], "camera string, cal_order int")
    pairs = {(r.path, r.camera) for r in matching.contains_join(texts, "path", cameras, "camera").collect()}
    assert pairs == {("/a/ch10/ch1x", "ch1"), ("/a/ch10/ch1x", "ch10"), ("/a/ch10/ch1x", "a/ch10/"),
                     ("/ch2", "ch2"), ("ch1ch1", "ch1")}
    assert matching.contains_join(texts, "path", cameras, "camera").count() == len(pairs)
    matched = {r.path: r.camera for r in matching.match_calibration(texts, cameras).collect()}
    assert matched == {"/a/ch10/ch1x": "ch10", "/ch2": "ch2", "ch1ch1": "ch1"}
    plan = matching.match_calibration(texts, cameras)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert matching.contains_join(texts, "path", cameras.where("false"), "camera").count() == 0


def test_contains_join_with_very_many_ids(spark):
    texts = spark.range(50).select(F.format_string("/x/%05d/", F.col("id") * 7).alias("path"))
    ids = spark.range(1000).select(F.format_string("%05d", "id").alias("camera"), F.col("id").alias("cal_order"))
    found = {(r.path, r.camera) for r in matching.contains_join(texts, "path", ids, "camera").collect()}
    assert found == {(f"/x/{i * 7:05d}/", f"{i * 7:05d}") for i in range(50)}


@pytest.mark.parametrize("mode", ["latest", "asof"])
def test_versions_are_searched_once_per_date(spark, store, mode):
    dates = spark.createDataFrame([(k, d) for k in range(40) for d in ("20250201", None, "20241201")], "k long, date string")
    found = calibration.resolve_calibration(dates, store, mode=mode)
    late = "original" if mode == "asof" else "20250301"
    want = {"20250201": "20250101" if mode == "asof" else late, "20241201": late, None: late}
    assert sorted((r.k, r.date or "", r.version) for r in found.collect()) == sorted(
        (k, d or "", v) for k in range(40) for d, v in want.items())
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    search = next(i for i, line in enumerate(plan) if "array_max(" in line)
    assert any("Aggregate [_date" in line for line in plan[search:]), plan
