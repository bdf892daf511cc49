"""Queries on control points, calibrations and the calibration store."""

from __future__ import annotations

from pyspark.sql import functions as F

from orthoweave.functions import geometry, quality
from orthoweave.operators import calibration, matching, remap
from orthoweave.operators import dem as dem_ops
from orthoweave.plans import orthos, recalibration
from orthoweave.suite import views
from orthoweave.suite.oracle_views import projected, undistorted, with_views
from orthoweave.suite.registry import query

# --- points --------------------------------------------------------------------------------


@query("A4_gcp_counts", with_views("gcp", "select camera, count(*) n_gcps from gcp group by camera"))
def gcp_counts(spark, sf_dir):
    return calibration.gcp_counts(views.gcps(spark, sf_dir))


@query("A4_distinct_cameras", with_views("gcp", "select distinct camera from gcp order by camera"))
def distinct_cameras(spark, sf_dir):
    return calibration.distinct_cameras(views.gcps(spark, sf_dir))


@query("F6_min_gcps", with_views("picks", """
    select cast((Z+8)*64 as int) camera, count(*) n_gcps from picks group by 1
    having count(*)>=(select count(*) from picks)//50"""))
def min_gcps(spark, sf_dir):
    """Points grouped by height class, as groups of different sizes; limit is the mean size."""
    picks = views.picks(spark, sf_dir).withColumn("camera", ((F.col("Z") + 8) * 64).cast("int"))
    return calibration.enough_gcps(picks, picks.count() // 50)


_SPREAD_SQL = """
    select camera, max(cs)-min(cs) col_span, max(row_sample)-min(row_sample) row_span
    from (select camera, row_sample, col_sample*(camera+1)/16.0::double cs from picks) group by camera"""


def _narrowed(spark, sf_dir):
    """Picks squeezed sideways, more for the lower cameras."""
    return views.picks(spark, sf_dir).withColumn(
        "col_sample", F.col("col_sample") * (F.col("camera") + 1) / 16)


@query("A8_point_spread", with_views("picks", _SPREAD_SQL))
def point_spread(spark, sf_dir):
    return calibration.point_spread(_narrowed(spark, sf_dir)).select("camera", "col_span", "row_span")


@query("P21_coverage_class", with_views("picks", f"""
    select camera, case when col_span>1500 and row_span>1000 then 'GOOD' else 'MARGINAL' end coverage,
           col_span<1000 or row_span<800 clustered from ({_SPREAD_SQL})"""))
def coverage_class(spark, sf_dir):
    return calibration.point_spread(_narrowed(spark, sf_dir)).select("camera", "coverage", "clustered")


@query("P22_rms_flag", with_views("calib", "select candidate, rms, rms>5.0 rms_warning from calib"))
def rms_flag(spark, sf_dir):
    return views.calibrations(spark, sf_dir).select(
        "candidate", "rms", quality.rms_flag("rms").alias("rms_warning"))


PAIRS = """
    select a.camera, a.pid i, b.pid j,
           sqrt((a.col_sample-b.col_sample)*(a.col_sample-b.col_sample)
                +(a.row_sample-b.row_sample)*(a.row_sample-b.row_sample)) distance
    from picks a join picks b on a.camera=b.camera and a.pid<b.pid
     and abs(a.col_sample-b.col_sample)<30 and abs(a.row_sample-b.row_sample)<30
    where (a.col_sample-b.col_sample)*(a.col_sample-b.col_sample)
        +(a.row_sample-b.row_sample)*(a.row_sample-b.row_sample)<900"""


@query("J8_close_pairs", with_views("picks", f"select camera, i, j, round(distance, 6) distance from ({PAIRS})"))
def close_pairs(spark, sf_dir):
    return calibration.close_pairs(views.picks(spark, sf_dir)).withColumn(
        "distance", F.round("distance", 6))


@query("J8_close_pair_counts", with_views("picks", f"""
    select camera, count(i) n_close_pairs from (select distinct camera from picks) left join ({PAIRS})
    using (camera) group by camera"""))
def close_pair_counts(spark, sf_dir):
    return calibration.close_pair_counts(views.picks(spark, sf_dir))


@query("O3_top_close_pairs", with_views("picks", f"""
    select camera, i, j, cast(row_number() over w as int) pair_rank from ({PAIRS})
    window w as (partition by camera order by i, j) qualify row_number() over w<=5"""))
def top_close_pairs(spark, sf_dir):
    return calibration.top_close_pairs(views.picks(spark, sf_dir)).drop("distance")


# --- projection ----------------------------------------------------------------------------

_POINTS = "select pid, camera cam, camera, X, Y, Z, col_sample, row_sample from gcp"


def _seen(spark, sf_dir):
    """Control points with the last record of their camera and their camera coordinates."""
    records = views.latest_calibrations(spark, sf_dir)
    model = geometry.CameraModel.of_record()
    cameras = records.select("camera", *remap.MODEL_COLUMNS, geometry.rotation_array(model.rvec).alias("R"))
    point = geometry.world_to_camera("X", "Y", "Z", geometry.rotation_of("R"), model.tvec)
    joined = matching.salted_join(views.gcps(spark, sf_dir), cameras, ["camera"], ["pid"])
    return joined.withColumns(dict(zip(("px", "py", "pz"), point))), model


@query("P13_world_to_camera", with_views("gcp latest", """
    select pid, round(pcx,6) x, round(pcy,6) y, round(pcz,6) z from project""", projected(_POINTS, "latest")))
def world_to_camera(spark, sf_dir):
    seen, _ = _seen(spark, sf_dir)
    return seen.select("pid", *[F.round(c, 6).alias(n) for c, n in zip(("px", "py", "pz"), "xyz")])


@query("P14_fisheye_project", with_views("gcp latest", """
    select pid, round(a*sc*f+cx, 5) u, round(b*sc*f+cy, 5) v from project""", projected(_POINTS, "latest")))
def fisheye_project(spark, sf_dir):
    seen, model = _seen(spark, sf_dir)
    u, v = geometry.fisheye_project((F.col("px"), F.col("py"), F.col("pz")), model)
    return seen.select("pid", F.round(u, 5).alias("u"), F.round(v, 5).alias("v"))


_SQUARED = ("(a*sc*f+cx-col_sample)*(a*sc*f+cx-col_sample)"
            "+(b*sc*f+cy-row_sample)*(b*sc*f+cy-row_sample)")


@query("A5_reprojection_rms", with_views("gcp latest", f"""
    select camera, round(sqrt(avg({_SQUARED})), 5) rms, count(*) n_gcps from project group by camera""",
    projected(_POINTS, "latest")))
def reprojection_rms(spark, sf_dir):
    found = calibration.reprojection_rms(
        views.gcps(spark, sf_dir), views.latest_calibrations(spark, sf_dir))
    return found.withColumn("rms", F.round("rms", 5))


@query("C11_best_calibration", with_views("gcp calib", f"""
    select camera, candidate, round(rms, 5) rms, n_gcps from (
      select camera, candidate, sqrt(avg({_SQUARED})) rms, count(*) n_gcps from project group by 1,2)
    qualify row_number() over (partition by camera order by round(rms, 9), candidate)=1""",
    projected("select pid, camera, X, Y, Z, col_sample, row_sample from gcp", "calib")))
def best_calibration(spark, sf_dir):
    found = calibration.best_calibration(
        views.gcps(spark, sf_dir), views.calibrations(spark, sf_dir))
    return found.withColumn("rms", F.round("rms", 5))


@query("P15_fisheye_undistort_map", with_views("calib", """
    select camera, row, col, round(src_x::double, 3)+0.0::double src_x,
           round(src_y::double, 3)+0.0::double src_y from umap""",
    undistorted("select * replace (candidate as camera) from calib")))
def fisheye_undistort_map(spark, sf_dir):
    """Map of every camera record's undistorted view."""
    records = views.calibrations(spark, sf_dir, small=True).withColumn("camera", F.col("candidate"))
    built = remap.undistort_map(records)
    return built.select("camera", "row", "col", *[
        (F.round(F.col(c).cast("double"), 3) + 0.0).alias(c) for c in ("src_x", "src_y")])


# --- names ---------------------------------------------------------------------------------

CAMERAS = """
    select 'N910A6_ch'||cast(n as varchar)||'_main' camera, n cal_order from (select unnest([3,2,1,5,7]) n)
    union all select 'dac'||cast(n as varchar), 10+n from (select unnest([2]) n)"""


def _cameras(spark, sf_dir):
    """Five channels and one recorder folder as camera names, in calibration order."""
    regions = views.table(spark, sf_dir, "region").select(
        F.get(F.array(*[F.lit(n) for n in (3, 2, 1, 5, 7)]), F.col("r_regionkey")).alias("n"))
    channels = regions.select(
        F.concat(F.lit("N910A6_ch"), F.col("n").cast("string"), F.lit("_main")).alias("camera"),
        F.col("n").alias("cal_order"))
    folder = regions.where("n = 2").select(
        F.concat(F.lit("dac"), F.col("n").cast("string")).alias("camera"),
        (F.col("n") + 10).alias("cal_order"))
    return channels.unionByName(folder)


_MATCHED = """
    select distinct path, camera from segs s join cams c on contains(s.path, c.camera)
    qualify row_number() over (partition by path order by cal_order)=1"""


def _matches(sql):
    return with_views("segs", sql, {"cams": CAMERAS})


def _paths(spark, sf_dir):
    return views.segments(spark, sf_dir).select("path").distinct()


@query("J2_match_calibration", _matches("""
    select path, arg_min(c.camera, cal_order) camera from segs s join cams c on contains(s.path, c.camera)
    group by path"""))
def match_calibration(spark, sf_dir):
    return matching.match_calibration(_paths(spark, sf_dir), _cameras(spark, sf_dir))


@query("F4_frames_without_calibration", _matches("""
    select distinct path from segs s where not exists (select 1 from cams c where contains(s.path, c.camera))"""))
def frames_without_calibration(spark, sf_dir):
    paths = _paths(spark, sf_dir)
    return matching.frames_without_calibration(
        paths, matching.match_calibration(paths, _cameras(spark, sf_dir)))


@query("J3_image_for_camera", _matches("""
    select c.camera, min(path) path from segs s join cams c
      on contains(regexp_extract(s.path, '[^/]*$'), c.camera) group by c.camera"""))
def image_for_camera(spark, sf_dir):
    return matching.image_for_camera(_cameras(spark, sf_dir), _paths(spark, sf_dir))


@query("F5_cameras_without_image", _matches("""
    select camera from cams c where not exists (
      select 1 from segs s where contains(regexp_extract(s.path, '[^/]*$'), c.camera))"""))
def cameras_without_image(spark, sf_dir):
    cameras = _cameras(spark, sf_dir)
    return matching.cameras_without_image(
        cameras, matching.image_for_camera(cameras, _paths(spark, sf_dir))).select("camera")


def _named_gcps(spark, sf_dir):
    name = F.concat(F.lit("NVR1_N910A6_ch"), F.col("camera").cast("string"), F.lit("_main"))
    return views.gcps(spark, sf_dir).withColumn("camera_name", name).drop("camera")


def _channel_ids(spark, sf_dir):
    return views.gcps(spark, sf_dir).select(
        F.concat(F.lit("ch"), F.col("camera").cast("string")).alias("camera"))


@query("J4_gcp_for_camera_contains", with_views("gcp", """
    select pid, c camera from (select *, 'NVR1_N910A6_ch'||cast(camera as varchar)||'_main' as name from gcp) g
    join (select distinct 'ch'||cast(camera as varchar) c from gcp) on contains(g.name, c)"""))
def gcp_for_camera_contains(spark, sf_dir):
    return matching.gcp_for_camera(
        _named_gcps(spark, sf_dir), _channel_ids(spark, sf_dir), "contains").select("pid", "camera")


@query("J4_gcp_for_camera", with_views("gcp", """
    select pid, 'NVR1_N910A6_ch'||cast(camera as varchar)||'_main' camera from gcp"""))
def gcp_for_camera(spark, sf_dir):
    ids = views.gcps(spark, sf_dir).select(
        F.concat(F.lit("NVR1_N910A6_ch"), F.col("camera").cast("string"), F.lit("_main")).alias("camera"))
    return matching.gcp_for_camera(_named_gcps(spark, sf_dir), ids).select("pid", "camera")


@query("J10_apply_channel_map", with_views("segs", """
    select event_id, 'NVR'||cast(1+camera//8 as varchar)||'_N910A6_ch'||cast(1+camera%8 as varchar)||'_main'
           camera_name from segs"""))
def apply_channel_map(spark, sf_dir):
    segments = views.segments(spark, sf_dir)
    channel = F.col("camera") + 1
    channel_map = segments.select(
        channel.alias("channel"),
        F.concat(F.lit("NVR"), F.expr("1 + camera div 8").cast("string"), F.lit("_N910A6_ch"),
                 (1 + F.col("camera") % 8).cast("string"), F.lit("_main")).alias("camera_name")).distinct()
    return matching.apply_channel_map(segments, channel_map, channel).select("event_id", "camera_name")


# --- store ---------------------------------------------------------------------------------

def _requests(spark, sf_dir):
    """Event dates moved into the months around the stored versions."""
    day = F.date_add(F.lit("2025-09-29").cast("date"), (F.col("event_id") % 14).cast("int"))
    return views.table(spark, sf_dir, "events").select(
        "event_id", F.replace(day.cast("string"), F.lit("-"), F.lit("")).alias("date"))


_DATED = """select event_id, strftime(date '2025-09-29'+cast(event_id%14 as int), '%Y%m%d') date from events"""


@query("J9_resolve_calibration", with_views("calib", f"""
    select event_id, date, case when exists (select 1 from calib where version=date) then date
           else (select max(version) from calib) end as version from ({_DATED})"""))
def resolve_calibration(spark, sf_dir):
    return calibration.resolve_calibration(
        _requests(spark, sf_dir), views.calibrations(spark, sf_dir))


@query("J9_resolve_calibration_asof", with_views("calib", f"""
    select event_id, d.date, coalesce(max(v.version), 'original') as version
    from ({_DATED}) d left join (select distinct version from calib) v on v.version<=d.date group by 1,2"""))
def resolve_calibration_asof(spark, sf_dir):
    return calibration.resolve_calibration(
        _requests(spark, sf_dir), views.calibrations(spark, sf_dir), mode="asof")


def _store(spark, sf_dir):
    """Store rows by name; one record per (version, camera)."""
    return views.calibrations(spark, sf_dir).select(
        "version", F.concat(F.lit("cam"), F.col("camera").cast("string")).alias("camera"),
        "candidate", "rms", "n_gcps")


STORE = {"store": "select version, 'cam'||cast(camera as varchar) camera, candidate, rms, n_gcps from calib"}
_EDGE = "(select min(version) from store)", "(select max(version) from store)"


def _edges(store):
    row = store.agg(F.min("version"), F.max("version")).first()
    return row[0], row[1]


@query("U2_upsert_camera", with_views("calib", f"""
    select '20991231' as version, camera, candidate, case when rms>4 then 0.5::double else rms end rms, n_gcps
    from store where version={_EDGE[0]}""", STORE))
def upsert_camera(spark, sf_dir):
    store = _store(spark, sf_dir)
    first, _ = _edges(store)
    records = store.where((F.col("version") == first) & (F.col("rms") > 4)).withColumn(
        "rms", F.lit(0.5))
    return calibration.upsert_camera(store, first, "20991231", records)


@query("U3_copy_camera", with_views("calib", f"""
    select * from store where not (version={_EDGE[0]} and camera='cam3') union all
    select {_EDGE[0]}, camera, candidate, rms, n_gcps from store where version={_EDGE[1]} and camera='cam3'""",
    STORE))
def copy_camera(spark, sf_dir):
    store = _store(spark, sf_dir)
    first, last = _edges(store)
    return calibration.with_version(
        store, first, calibration.copy_camera(store, last, first, "cam3"))


@query("U4_delete_camera", with_views("calib", f"""
    select * from store where not (version={_EDGE[0]} and camera='cam5')""", STORE))
def delete_camera(spark, sf_dir):
    store = _store(spark, sf_dir)
    first, _ = _edges(store)
    return calibration.with_version(
        store, first, calibration.delete_camera(store, first, "cam5"))


@query("U5_restore_camera", with_views("calib", "select * from store", STORE))
def restore_camera(spark, sf_dir):
    """Backup, change, restore: the store is as before."""
    store = _store(spark, sf_dir)
    first, _ = _edges(store)
    label = calibration.backup_label("cam5", first)
    saved = calibration.backup(store, first, label, "cam5")
    changed = calibration.with_version(
        store, first, calibration.delete_camera(store, first, "cam5"))
    restored = calibration.restore_camera(changed.unionByName(saved), label, first, "cam5")
    return calibration.with_version(changed, first, restored)


@query("U6_backup", with_views("calib", f"""
    select * from store union all
    select 'backup_before_delete', camera, candidate, rms, n_gcps from store where version={_EDGE[0]}""", STORE))
def backup(spark, sf_dir):
    store = _store(spark, sf_dir)
    first, _ = _edges(store)
    return store.unionByName(calibration.backup(store, first, "backup_before_delete"))


@query("U7_rename_camera", with_views("calib", """
    select version, case when camera='cam9' then 'dac2_N910A6_ch2_main' else camera end camera,
           candidate, rms, n_gcps from store""", STORE))
def rename_camera(spark, sf_dir):
    return matching.rename_camera(_store(spark, sf_dir), "cam9", "dac2_N910A6_ch2_main")


@query("A11_calibration_summary", with_views("calib ogrid demfill", """
    select version, camera, rms, n_gcps, width, height, 250.0::double mm_per_pixel, round(min_z,4) min_z,
           round(max_z,4) max_z, coalesce(recalibration_date, 'original') date, rms>5 rms_warning
    from (select version, camera, rms, n_gcps, recalibration_date from calib)
    left join (select camera, width, height from ogrid) using (camera)
    left join (select camera, min(z)::double min_z, max(z)::double max_z from demfill group by camera)
    using (camera)"""))
def calibration_summary(spark, sf_dir):
    grids = remap.camera_grids(views.gcps(spark, sf_dir), 0.25)
    elevated = dem_ops.dem_bilinear(
        dem_ops.ortho_pixels(grids), views.dem(spark, sf_dir), views.dem_transform(spark, sf_dir))
    found = calibration.calibration_summary(
        views.calibrations(spark, sf_dir), grids, dem_ops.z_range(elevated))
    return found.withColumns({
        c: F.round(F.col(c).cast("double"), 4) for c in ("min_z", "max_z")})


# --- jobs ----------------------------------------------------------------------------------

@query("C4_calibrate_maps", with_views("demfill latest", f"""
    select camera, round(rms, 5) rms, n_gcps, width, height, n_pixels, round(min_z, 4) min_z
    from (select camera, count(*) n_pixels, min(z)::double min_z from demfill group by camera)
    join (select camera, width, height from ogrid) using (camera)
    join (select camera, sqrt(avg({_SQUARED})) rms, count(*) n_gcps from project group by camera)
    using (camera)""", projected(_POINTS, "latest")))
def calibrate_maps(spark, sf_dir):
    ortho_map, _, summary = orthos.calibrate_maps(
        views.gcps(spark, sf_dir), views.latest_calibrations(spark, sf_dir),
        views.dem(spark, sf_dir), views.dem_transform(spark, sf_dir), 0.25)
    sizes = ortho_map.groupBy("camera").agg(F.count(F.lit(1)).alias("n_pixels"))
    return summary.join(sizes, "camera").select(
        "camera", F.round("rms", 5).alias("rms"), "n_gcps", "width", "height", "n_pixels",
        F.round(F.col("min_z").cast("double"), 4).alias("min_z"))


@query("C7_recalibration_qc", with_views("picks latest", f"""
    select camera, n_gcps, coalesce(n_close_pairs, 0) n_close_pairs, col_span, row_span, round(rms, 5) rms,
           case when n_gcps<6 then 'reject' when coalesce(n_close_pairs,0)>0 or col_span<1000 or row_span<800
                or rms>5 then 'confirm' else 'accept' end verdict
    from (select camera, count(*) n_gcps, max(col_sample)-min(col_sample) col_span,
                 max(row_sample)-min(row_sample) row_span from picks group by camera)
    left join (select camera, count(*) n_close_pairs from ({PAIRS}) group by camera) using (camera)
    left join (select camera, sqrt(avg({_SQUARED})) rms from project group by camera) using (camera)""",
    projected("select pid, camera, X, Y, Z, col_sample, row_sample from picks", "latest")))
def recalibration_qc(spark, sf_dir):
    found = recalibration.recalibration_qc(
        views.picks(spark, sf_dir), views.latest_calibrations(spark, sf_dir))
    return found.select("camera", "n_gcps", "n_close_pairs", "col_span", "row_span",
                        F.round("rms", 5).alias("rms"), "verdict")


@query("C8_promote_calibration", with_views("calib", """
    select '20991231' as version, case when camera='cam1' then 'dac1_N910A6_ch2_main' else camera end camera,
           candidate, case when rms>2 then 0.25::double else rms end rms, n_gcps,
           case when rms>2 then '20991231' end recalibration_date from src
    union all select 'backup_'||camera||'_20991231', camera, candidate, rms, n_gcps, null from src where rms>2""",
    {**STORE, "src": f"select * from store where version={_EDGE[1]}"}))
def promote_calibration(spark, sf_dir):
    store = _store(spark, sf_dir)
    _, last = _edges(store)
    records = store.where((F.col("version") == last) & (F.col("rms") > 2)).withColumn(
        "rms", F.lit(0.25))
    promoted = recalibration.promote_calibration(
        store, records, "20991231", {"cam1": "dac1_N910A6_ch2_main"})
    return promoted.drop("recalibrated")
