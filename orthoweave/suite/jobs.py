"""Queries on status rows, files and whole runs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from orthoweave.functions import names
from orthoweave.operators import catalog, matching, mosaic, remap, status, tiles
from orthoweave.plans import mosaics, orthos
from orthoweave.plans import run as runs
from orthoweave.session import work_dir
from orthoweave.sources import files, tables
from orthoweave.sources import images as images_source
from orthoweave.suite import views
from orthoweave.suite.oracle_views import VIEWS, undistorted, with_views
from orthoweave.suite.raster import SUITE_TILE, _best, _seam_sql
from orthoweave.suite.registry import query

# --- status --------------------------------------------------------------------------------


@query("A10_stage_summary", with_views("status", """
    select stage, count(*) filter (success) succeeded, count(*) total from status group by stage"""))
def stage_summary(spark, sf_dir):
    return status.stage_summary(views.run_status(spark, sf_dir))


@query("A10_frames_per_camera", with_views("status", """
    select camera, count(*) frames from status where stage='extract' and success group by camera"""))
def frames_per_camera(spark, sf_dir):
    return status.frames_per_camera(views.run_status(spark, sf_dir))


@query("A10_failures", with_views("status", "select stage, ts, camera, error from status where not success"))
def failures(spark, sf_dir):
    return status.failures(views.run_status(spark, sf_dir))


# --- files ---------------------------------------------------------------------------------

@query("F3_has_world_file", with_views("images", """
    select ts, camera from images where (ts*16+camera)%7<>0"""))
def has_world_file(spark, sf_dir):
    rasters = views.images(spark, sf_dir).withColumn(
        "stem", F.concat_ws("_", F.col("ts").cast("string"), names.stem("file")))
    world = rasters.where((F.col("ts") * 16 + F.col("camera")) % 7 != 0).select("stem")
    return matching.has_world_file(rasters, world).select("ts", "camera")


_GEO_SQL = "select ts, res, x_min, y_max from mgrid"


def _geo(spark, sf_dir):
    return mosaic.mosaic_geo(views.images(spark, sf_dir)).withColumn(
        "name", F.concat(F.lit("mosaic_"), F.col("ts").cast("string")))


@query("SNK4_world_file_text", with_views("mgrid", f"""
    select 'mosaic_'||cast(ts as varchar) as name,
           concat_ws(chr(10), res, '0', '0', -res, x_min, y_max) as text
    from (select ts, res, case when x_min=0 then '0' else cast(x_min as varchar) end x_min, y_max from mgrid)"""))
def world_file_text(spark, sf_dir):
    return _geo(spark, sf_dir).select("name", tables.world_file_text().alias("text"))


@query("SRC3_world_files", with_views("mgrid", """
    select 'mosaic_'||cast(ts as varchar) as name, res pixel_width, 0::double rotation_x, 0::double rotation_y,
           -res pixel_height, x_min, y_max from mgrid"""))
def world_files(spark, sf_dir):
    """World files of all mosaics, written and read back."""
    folder = work_dir(spark, "world")
    tables.write_world_files(_geo(spark, sf_dir), folder)
    return files.parse_world_text(tables.read_world_texts(spark, folder))


@query("SRC3_scan_world_files", with_views("mgrid", """
    select 'mosaic_'||cast(ts as varchar) as name, res pixel_width, 0::double rotation_x, 0::double rotation_y,
           -res pixel_height, x_min, y_max from mgrid"""))
def scanned_world_files(spark, sf_dir):
    """The same files found and read by the folder reader."""
    folder = work_dir(spark, "world")
    tables.write_world_files(_geo(spark, sf_dir), folder)
    found = files.scan_world_files(spark, folder, "*.txt")
    return found.withColumn("name", F.regexp_extract("path", "name=([^/]+)/", 1)).drop("path", "stem")


@query("SRC2_image_tiles", with_views("px", """
    select cast(ts as varchar)||'/'||cast(camera as varchar)||'.tif' path, row, col, b, g, r from px"""))
def image_tiles(spark, sf_dir):
    """All images as binary rows cut to tiles, without pixel rows in between."""
    blocks = tiles.to_tiles(views.pixels(spark, sf_dir), views.SIDE)
    cut = files.image_tiles(blocks.select(
        F.concat(F.col("ts").cast("string"), F.lit("/"), F.col("camera").cast("string"), F.lit(".tif")).alias("path"),
        "height", "width", F.lit(3).alias("n_channels"), "data"), SUITE_TILE)
    named = cut.withColumnsRenamed({"path": "camera"})
    return tiles.to_pixels(named, SUITE_TILE).withColumnRenamed("camera", "path")


@query("SRC2_image_pixels", with_views("px", """
    select cast(ts as varchar)||'/'||cast(camera as varchar)||'.tif' path, row, col, b, g, r from px"""))
def image_pixels(spark, sf_dir):
    """All images as binary rows, the form an image folder is read in, unpacked to pixels."""
    blocks = tiles.to_tiles(views.pixels(spark, sf_dir), views.SIDE)
    scanned = blocks.select(
        F.concat(F.col("ts").cast("string"), F.lit("/"), F.col("camera").cast("string"), F.lit(".tif")).alias("path"),
        "height", "width", F.lit(3).alias("n_channels"), "data")
    return files.image_pixels(scanned)


def _written(files_to_write, folder):
    """Writes files, of any content, and gives the folder."""
    images_source.write_files(files_to_write, folder).write.format("noop").mode("overwrite").save()
    return folder


@query("SRC2_scan_images", with_views("px", """
    select 'ts'||cast(ts as varchar)||'/'||cast(camera as varchar)||'.tif' path, row, col, b, g, r from px"""))
def scan_images(spark, sf_dir):
    """All images written as TIFF files, scanned, and cut to tiles by the tasks that decode them."""
    blocks = tiles.to_tiles(views.pixels(spark, sf_dir), views.SIDE)
    path = F.concat(F.lit("ts"), F.col("ts").cast("string"), F.lit("/"), F.col("camera").cast("string"), F.lit(".tif"))
    folder = _written(images_source.as_tiff(blocks.select(path.alias("path"), "height", "width", "data")), work_dir(spark, "images"))
    cut = files.image_tiles(files.scan_images(spark, folder, recursive=True), SUITE_TILE).withColumnRenamed("path", "camera")
    return tiles.to_pixels(cut, SUITE_TILE).withColumn(
        "path", F.regexp_extract("camera", "(ts[^/]*/[^/]*)$", 1)).drop("camera")


@query("SRC1_scan_video_files", with_views("segs", """
    select min(replace(path, '/v/', '')) path from segs group by camera, cast(start_time as date)"""))
def scan_video_files(spark, sf_dir):
    """The first video of every camera and day as a file, beside files of other kinds; the
    folders are listed without reading a file."""
    folder = work_dir(spark, "videos")
    first = views.segments(spark, sf_dir).groupBy("camera", F.to_date("start_time")).agg(
        F.min(F.replace("path", F.lit("/v/"), F.lit(""))).alias("path"))
    other = first.select(F.concat("path", F.lit(".txt")).alias("path"))
    _written(first.select("path").unionByName(other).withColumn("content", F.lit(b"video")), folder)
    return files.scan_video_files(spark, folder, recursive=True).select(
        F.regexp_extract("path", "(dac[^/]*/[^/]*)$", 1).alias("path"))


@query("SRC4_SNK5_gcp_csv", with_views("picks", """
    select 'cam'||cast(camera as varchar) camera_name, X, Y, Z, col_sample, row_sample from picks"""))
def gcp_csv(spark, sf_dir):
    """Picked points written as one CSV folder per camera and read back."""
    folder = work_dir(spark, "gcp")
    picks = views.picks(spark, sf_dir).withColumn(
        "camera_name", F.concat(F.lit("cam"), F.col("camera").cast("string")))
    tables.write_gcp_csv(picks, folder)
    return files.scan_gcp_csv(spark, folder)


@query("SRC5_channel_map", """
    select cast(1+s_suppkey as int) channel, 'NVR1_N910A6_ch'||cast(1+s_suppkey%8 as varchar)||'_main' camera_name
    from supplier""")
def channel_map(spark, sf_dir):
    """A channel map with a space in its header, written and read back."""
    folder = work_dir(spark, "channels")
    k = F.col("s_suppkey")
    views.table(spark, sf_dir, "supplier").select(
        (1 + k).alias("channel"),
        F.concat(F.lit("NVR1_N910A6_ch"), (1 + k % 8).cast("string"), F.lit("_main")).alias("camera name"),
    ).write.option("header", True).csv(folder)
    return files.scan_channel_map(spark, folder)


@query("SRC6_SNK6_calibrations", with_views("calib", """
    select version, candidate, camera, f, case when version=(select min(version) from calib) then rms+1 else rms end rms
    from calib"""))
def calibration_store(spark, sf_dir):
    """The store written, one version replaced, and read back."""
    folder = work_dir(spark, "calibrations")
    store = views.calibrations(spark, sf_dir)
    tables.write_calibrations(store, folder)
    first = store.agg(F.min("version")).first()[0]
    changed = tables.read_calibrations(spark, folder, first).withColumn("rms", F.col("rms") + 1)
    # the changed version goes through a table of its own: a table cannot replace what it reads
    tables.write_calibrations(changed, folder + "-new")
    tables.write_calibrations(tables.read_calibrations(spark, folder + "-new"), folder)
    return tables.read_calibrations(spark, folder).select(
        "version", "candidate", "camera", F.get(F.get("K", F.lit(0)), F.lit(0)).alias("f"), "rms")


@query("SRC7_read_dem", with_views("dem", "select row, col, z from dem"))
def read_dem(spark, sf_dir):
    folder = work_dir(spark, "dem")
    views.dem(spark, sf_dir).write.parquet(folder)
    return tables.read_dem(spark, folder)


def _timed(df):
    """Image numbers as clock times: ts hours after the start of 2024."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return df.withColumn("ts", F.timestamp_add("HOUR", F.col("ts"), start))


_FOLDER_SQL = "strftime(timestamp '2024-01-01' + to_hours(cast(ts as int)), '%Y%m%d_%H%M%S') ts_folder"


@query("SNK1_write_frames", with_views("px", f"select {_FOLDER_SQL}, camera, row, col, b, g, r from px"))
def write_frames(spark, sf_dir):
    """All frames written under their folders and read back."""
    folder = work_dir(spark, "frames")
    tables.write_frames(_timed(views.pixels(spark, sf_dir)), folder)
    return tables.read_stage(spark, folder).drop("ts")


@query("SNK2_write_orthos", with_views("orthopx", f"select {_FOLDER_SQL}, camera, row, col, b, g, r from orthopx"))
def write_orthos(spark, sf_dir):
    """All orthos written with their geotransforms and read back."""
    folder = work_dir(spark, "orthos")
    built = remap.remap_bilinear(views.pixels(spark, sf_dir), views.lookup_map(spark, sf_dir))
    tables.write_orthos(_timed(built), _timed(views.images(spark, sf_dir)), folder)
    return tables.read_stage(spark, f"{folder}/pixels").drop("ts")


@query("SNK2_ortho_geo", with_views("images", """
    select ts, camera, file, width, height, x_min, y_max, pixel_width, pixel_height from images"""))
def ortho_geo(spark, sf_dir):
    """The geotransforms of all orthos, written beside them and read back."""
    folder = work_dir(spark, "orthos")
    images = views.images(spark, sf_dir)
    tables.write_orthos(_timed(views.pixels(spark, sf_dir)), _timed(images), folder)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    geo = tables.read_stage(spark, f"{folder}/geo").withColumn("ts", F.timestamp_diff("HOUR", start, F.col("ts")))
    return geo.select("ts", "camera", "file", "width", "height", "x_min", "y_max", "pixel_width", "pixel_height")


@query("SNK3_mosaic_geo", with_views("mgrid", """
    select ts, res pixel_width, 0::double rotation_x, 0::double rotation_y, -res pixel_height, x_min, y_max
    from mgrid"""))
def stored_mosaic_geo(spark, sf_dir):
    """The geotransforms of all mosaics, written beside them and read back."""
    folder = work_dir(spark, "mosaics")
    images = views.images(spark, sf_dir)
    built = mosaics.build_mosaics(views.pixels(spark, sf_dir), images, "order").withColumn(
        "ts_folder", F.format_string("t%06d", "ts"))
    geo = mosaic.mosaic_geo(images).withColumn("ts_folder", F.format_string("t%06d", "ts"))
    tables.write_mosaics(built, geo, folder)
    return tables.read_stage(spark, f"{folder}/geo").drop("ts_folder", "width", "height")


_MOSAIC_SQL = _best("priority desc, pos", "priority>0").replace(
    'cast(pos as int) as position', 'camera')


@query("SNK3_write_mosaics", _MOSAIC_SQL)
def write_mosaics(spark, sf_dir):
    """All mosaics written with their geotransforms and read back."""
    folder = work_dir(spark, "mosaics")
    images = views.images(spark, sf_dir)
    built = mosaics.build_mosaics(views.pixels(spark, sf_dir), images, "center").withColumn(
        "ts_folder", F.format_string("t%06d", "ts"))
    geo = mosaic.mosaic_geo(images).withColumn("ts_folder", F.format_string("t%06d", "ts"))
    tables.write_mosaics(built, geo, folder)
    return tables.read_stage(spark, f"{folder}/pixels").drop("ts_folder")


# --- jobs ----------------------------------------------------------------------------------

_CALIBRATED = "camera in (select camera from latest where n_gcps>=12)"


def _calibrated(spark, sf_dir):
    """Cameras whose last calibration has enough control points for use."""
    return views.latest_calibrations(spark, sf_dir).where("n_gcps >= 12").select("camera")


def _orthorectified(spark, sf_dir, frames, lookup):
    """Frames are matched to their camera by name; cameras without a usable calibration
    have no ortho."""
    code = F.concat(F.lit("cam"), F.lpad(F.col("camera").cast("string"), 2, "0"))
    path = F.concat(F.lit("/frames/"), F.col("ts").cast("string"), F.lit("/"), code, F.lit(".tiff"))
    listed = views.images(spark, sf_dir).select("ts", path.alias("path"))
    cameras = _calibrated(spark, sf_dir).select(code.alias("camera"), F.col("camera").alias("cal_order"))
    built, _ = orthos.orthorectify(frames.withColumn("path", path).drop("camera"), listed, cameras,
                                   lookup.withColumn("camera", code), SUITE_TILE)
    return built.withColumn("camera", F.substring("camera", 4, 2).cast("int"))


@query("C5_orthorectify", with_views("orthopx latest", f"""
    select ts, camera, row, col, b, g, r from orthopx where {_CALIBRATED}"""))
def orthorectify(spark, sf_dir):
    return _orthorectified(spark, sf_dir, views.pixels(spark, sf_dir), views.lookup_map(spark, sf_dir))


@query("C5_orthorectify_tiles", with_views("orthopx latest", f"""
    select ts, camera, row, col, b, g, r from orthopx where {_CALIBRATED}"""))
def orthorectify_tiles(spark, sf_dir):
    """The job on tiles; pixels the map does not list are not part of the output."""
    frames = tiles.to_tiles(views.pixels(spark, sf_dir), SUITE_TILE)
    lookup = tiles.map_tiles(views.lookup_map(spark, sf_dir), SUITE_TILE, listed=True)
    built = _orthorectified(spark, sf_dir, frames, lookup)
    return tiles.to_pixels(built, SUITE_TILE)


@query("C6_mosaic_center", _MOSAIC_SQL)
def mosaic_center(spark, sf_dir):
    return mosaics.build_mosaics(views.pixels(spark, sf_dir), views.images(spark, sf_dir), "center")


@query("C6_mosaic_order", _best("pos desc", "true").replace('cast(pos as int) as position', 'camera'))
def mosaic_order(spark, sf_dir):
    return mosaics.build_mosaics(views.pixels(spark, sf_dir), views.images(spark, sf_dir), "order")


@query("C6_mosaic_seam", _seam_sql())
def mosaic_seam(spark, sf_dir):
    """The job's default method, on tiles."""
    images = views.images(spark, sf_dir)
    built = mosaics.build_mosaics(tiles.to_tiles(views.pixels(spark, sf_dir), SUITE_TILE), images, size=SUITE_TILE)
    names = mosaic.file_positions(images).select("ts", "position", "camera")
    return tiles.mosaic_tile_pixels(built, SUITE_TILE).join(names, ["ts", "position"]).drop("position")


_UNDISTORTED = {
    **undistorted("select * from latest"),
    "utaps": VIEWS["taps"].replace("lmap", "umap"),
    "upx": VIEWS["orthopx"].replace("join taps", "join utaps"),
}


@query("C9_undistort_frames", with_views("px images latest", """
    select ts, camera, row, col, b, g, r from upx""", _UNDISTORTED))
def undistort_frames(spark, sf_dir):
    """All frames without lens distortion."""
    return orthos.undistort_frames(
        views.pixels(spark, sf_dir), views.latest_calibrations(spark, sf_dir, small=True))


@query("C9_undistort_frames_tiles", with_views("px images latest", """
    select ts, camera, row, col, b, g, r from upx""", _UNDISTORTED))
def undistort_frames_tiles(spark, sf_dir):
    """All frames without lens distortion, on tiles."""
    built = orthos.undistort_frames(
        tiles.to_tiles(views.pixels(spark, sf_dir), SUITE_TILE),
        views.latest_calibrations(spark, sf_dir, small=True), size=SUITE_TILE)
    return tiles.to_pixels(built, SUITE_TILE)


def run_inputs(spark, sf_dir) -> runs.RunInputs:
    """A run on tiles over all hours of the events; cameras without a usable calibration
    are unmatched."""
    name = F.concat(
        F.lit("dac"), (1 + F.floor(F.col("camera") / 8)).cast("string"), F.lit("_N910A6_ch"),
        (1 + F.col("camera") % 8).cast("string"), F.lit("_main"))
    grid = catalog.make_grid(spark, *views.clock_limits(spark, sf_dir), "1h")
    frames = _timed(tiles.to_tiles(views.pixels(spark, sf_dir), SUITE_TILE)).withColumn("camera", name)
    images = _timed(views.images(spark, sf_dir)).select("ts", name.alias("camera"))
    cameras = _calibrated(spark, sf_dir).select(name.alias("camera"), F.col("camera").alias("cal_order"))
    grids = views.images(spark, sf_dir).select(
        "camera", F.lit(12).alias("width"), F.lit(11).alias("height"), "x_min", "y_max",
        "pixel_width", "pixel_height").distinct().withColumn("camera", name)
    lookup = views.lookup_map(spark, sf_dir).withColumn("camera", name)
    return runs.RunInputs(
        paths=views.segments(spark, sf_dir).select("path"), grid=grid, frames=frames,
        ortho_map=lookup, grids=grids, base="/v", fps=F.lit(25.0), images=images, cameras=cameras)


_RUN_VIEWS = {
    "req": """
        select distinct cast(datediff('hour', timestamp '2024-01-01', g.ts) as bigint) ts, s.camera
        from segs s join grid g on g.ts between s.start_time and s.end_time
        where event_id%11<>0""",
    "got": "select r.ts, r.camera, i.ts is not null ok from req r left join images i using (ts, camera)",
    "orth": f"select ts, camera, {_CALIBRATED} ok from got where ok",
}


@query("C10_run_stages", with_views("segs grid images latest", """
    select 'extract' stage, count(*) filter (ok) succeeded, count(*) total from got
    union all select 'ortho', count(*) filter (ok), count(*) from orth
    union all select 'mosaic', count(distinct ts), count(distinct ts) from orth where ok""", _RUN_VIEWS))
def run_stages(spark, sf_dir):
    """Extract, orthorectify and mosaic with stage tables; the summary per stage."""
    return runs.summary(runs.run(
        spark, run_inputs(spark, sf_dir), work_dir(spark, "run"), size=SUITE_TILE))


_BROKEN_VIEWS = {
    **_RUN_VIEWS,
    "got": """
        select r.ts, r.camera, i.ts is not null as found, coalesce((i.ts*16+i.camera)%7=3, false) broken
        from req r left join images i using (ts, camera)""",
    "orth": f"select ts, camera, {_CALIBRATED} ok from got where found and not broken",
}


@query("C10_run_with_broken_frames", with_views("segs grid images latest", """
    select 'extract' stage, case when broken then 'tile (1, 0): 7 bytes for 4 x 4' when not found then 'no frame' end error,
           count(*) items from got group by 2
    union all select 'ortho', case when not ok then 'no matching calibration' end, count(*) from orth group by 2
    union all select 'mosaic', null, count(distinct ts) from orth where ok""", _BROKEN_VIEWS))
def run_with_broken_frames(spark, sf_dir):
    """One image in seven has a tile that is cut off: those fail by name, the run goes on."""
    whole = run_inputs(spark, sf_dir)
    part = lambda pattern: F.regexp_extract("camera", pattern, 1).cast("int") - 1
    number = F.timestamp_diff("HOUR", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")) * 16 + (
        part(r"dac(\d+)_") * 8 + part(r"ch(\d+)_"))
    cut_off = (number % 7 == 3) & (F.col("tile_row") == 1) & (F.col("tile_col") == 0)
    frames = whole.frames.withColumn("data", F.when(cut_off, F.substring("data", 1, 7)).otherwise(F.col("data")))
    found = runs.run(spark, replace(whole, frames=frames), work_dir(spark, "run"), size=SUITE_TILE)
    return found.groupBy("stage", "error").agg(F.count("*").alias("items"))


@query("C10_run_twice", with_views("segs grid images latest", """
    select cast(ts as bigint) as hour_no, count(*) as images from orth where ok group by ts""", _RUN_VIEWS))
def run_twice(spark, sf_dir):
    """Two runs over the two halves of the time into one folder; the orthos of both."""
    whole, folder = run_inputs(spark, sf_dir), work_dir(spark, "runs")
    half = whole.grid.count // 2
    middle = catalog.ClockGrid(str(spark.range(1).select(whole.grid.time_at(F.lit(half))).first()[0]),
                               whole.grid.step_micros, whole.grid.count - half)
    for grid in (replace(whole.grid, count=half), middle):
        runs.run(spark, replace(whole, grid=grid), folder, size=SUITE_TILE)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return tables.read_stage(spark, f"{folder}/orthos/pixels").select("ts", "camera").distinct().groupBy(
        F.timestamp_diff("HOUR", start, F.col("ts")).alias("hour_no")).agg(F.count("*").alias("images"))


# --- tile form -----------------------------------------------------------------------------

@query("J5_remap_tiles", with_views("orthopx", "select ts, camera, row, col, b, g, r from orthopx"))
def remap_tiles(spark, sf_dir):
    """The gather in tile form; a tile is a full block, and pixels the map does not list are
    not part of the output."""
    frame_tiles = tiles.to_tiles(views.pixels(spark, sf_dir), SUITE_TILE)
    lookup = tiles.map_tiles(views.lookup_map(spark, sf_dir), SUITE_TILE, listed=True)
    return tiles.to_pixels(tiles.remap_tiles(frame_tiles, lookup, size=SUITE_TILE), SUITE_TILE)


def _mosaic_tiles(spark, sf_dir, method):
    frame_tiles = tiles.to_tiles(views.pixels(spark, sf_dir), SUITE_TILE)
    built = tiles.mosaic_tiles(frame_tiles, views.images(spark, sf_dir), method, size=SUITE_TILE)
    return tiles.mosaic_tile_pixels(built, SUITE_TILE)


@query("A12_mosaic_center_tiles", _best("priority desc, pos", "priority>0"))
def mosaic_center_tiles(spark, sf_dir):
    """The centre mosaic in tile form."""
    return _mosaic_tiles(spark, sf_dir, "center")


@query("A12_mosaic_order_tiles", _best("pos desc", "true"))
def mosaic_order_tiles(spark, sf_dir):
    """The file-order mosaic in tile form."""
    return _mosaic_tiles(spark, sf_dir, "order")
