"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orthoweave.operators.dem import DemTransform

SIDE = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- rasters: one 8 x 8 image per embedding ------------------------------------------------

def geo_columns(camera: Column) -> dict[str, Column]:
    """Geotransform of a camera's image; neighbours overlap by three columns."""
    return {
        "file": F.concat(F.lpad(camera.cast("string"), 2, "0"), F.lit("_ortho.tif")),
        "width": F.lit(SIDE), "height": F.lit(SIDE),
        "x_min": camera * 1.25, "y_max": 10 + (camera % 3) * 0.25,
        "pixel_width": F.lit(0.25), "pixel_height": F.lit(-0.25),
    }


def _image_keys(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.expr("vec_id div 16").alias("ts"), (F.col("vec_id") % 16).cast("int").alias("camera"),
        *extra)


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image metadata; reads only the key column of the table."""
    return _image_keys(spark, sf_dir).withColumns(geo_columns(F.col("camera")))


def image_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per image with its 64 values."""
    return _image_keys(spark, sf_dir, "embedding")


def explode_pixels(arrays: DataFrame) -> DataFrame:
    """Pixel rows of image arrays; other columns are kept."""
    kept = [c for c in arrays.columns if c != "embedding"]
    value = F.least(F.greatest(F.floor((F.col("e").cast("double") + 0.2) * 510), F.lit(0)), F.lit(255))
    v = value.cast("int")
    return arrays.select(*kept, F.posexplode("embedding").alias("i", "e")).select(
        *kept, F.expr(f"cast(i div {SIDE} as int)").alias("row"), (F.col("i") % SIDE).alias("col"),
        v.alias("b"), (v * 3 % 256).alias("g"), (v * 5 % 256).alias("r"))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_pixels(image_arrays(spark, sf_dir))


# --- videos --------------------------------------------------------------------------------

def _digits(ts: Column) -> Column:
    return F.translate(F.substring(ts.cast("string"), 1, 19), "- :", "")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video segments with their file name, from events; some names lack the end time."""
    ev = table(spark, sf_dir, "events")
    start = F.date_trunc("second", "ts").cast("timestamp_ntz")
    shaped = ev.select(
        "event_id", "user_id", (F.col("user_id") % 16).cast("int").alias("camera"),
        start.alias("start_time"), F.floor("value").alias("minutes"),
    ).withColumn("end_time", F.timestamp_add("MINUTE", F.col("minutes"), F.col("start_time")))
    path = F.concat(
        F.lit("/v/dac"), F.expr("1 + camera div 8").cast("string"),
        F.lit("/N910A6_ch"), (1 + F.col("user_id") % 8).cast("string"), F.lit("_main_"),
        _digits(F.col("start_time")),
        F.when(F.col("event_id") % 11 == 0, "").otherwise(
            F.concat(F.lit("_"), _digits(F.col("end_time")))),
        F.when(F.col("event_id") % 7 == 0, "(1)").otherwise(""),
        F.lit(".dav"))
    return shaped.select("event_id", "camera", "start_time", "end_time", path.alias("path"))


def clock_limits(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """First and last full hour of the events."""
    row = table(spark, sf_dir, "events").agg(
        F.date_trunc("hour", F.min("ts")).cast("timestamp_ntz").cast("string"),
        F.date_trunc("hour", F.max("ts")).cast("timestamp_ntz").cast("string")).first()
    return row[0], row[1]


# --- control points, elevation, calibrations -----------------------------------------------

def gcps(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("pid"), (k % 16).cast("int").alias("camera"),
        (-(k % 16) + (k % 37) / 8.0).alias("X"),
        ((k % 16) * 3 + (k % 29) / 4.0).alias("Y"),
        (F.lit(-8.0) + F.col("p_size") / 64.0).alias("Z"),
        (100 + (k % 37) * 90 + F.col("p_size")).cast("double").alias("col_sample"),
        (100 + (k % 29) * 70).cast("double").alias("row_sample"))


def picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control points, one in five picked a second time close by."""
    first = gcps(spark, sf_dir)
    again = first.where("pid % 5 = 0").withColumns({
        "pid": F.col("pid") + 1000000,
        "col_sample": F.col("col_sample") + 7, "row_sample": F.col("row_sample") + 11})
    return first.unionByName(again)


DEM_COLS = 40


def dem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.expr(f"cast(p_partkey div {DEM_COLS} as int)").alias("row"),
        (F.col("p_partkey") % DEM_COLS).cast("int").alias("col"),
        F.when(F.col("p_size") != 50, F.lit(-8.0) + F.col("p_size") / 64.0).alias("z"))


def dem_transform(spark: SparkSession, sf_dir: str) -> DemTransform:
    """Extent of the elevation grid; the row count comes from the file statistics."""
    top = table(spark, sf_dir, "part").agg(F.max("p_partkey")).first()[0]
    return DemTransform(-16.0, 64.0, 1.0, top // DEM_COLS + 1, DEM_COLS)


def calibrations(spark: SparkSession, sf_dir: str, small: bool = False) -> DataFrame:
    """Versioned camera records; ``small`` ones look at 8 x 8 images."""
    k = F.col("s_suppkey")
    focal = (6.0 + k % 3) if small else (1500.0 + k % 50)
    cx, cy = (4.0, 4.0) if small else (1920.0, 1080.0)
    zero, one = F.lit(0.0), F.lit(1.0)
    day = F.date_add(F.lit("2025-10-01").cast("date"), F.expr("cast(s_suppkey div 16 as int)"))
    return table(spark, sf_dir, "supplier").select(
        k.alias("candidate"), (k % 16).cast("int").alias("camera"),
        F.replace(day.cast("string"), F.lit("-"), F.lit("")).alias("version"),
        F.array(F.array(focal, zero, F.lit(cx)), F.array(zero, focal, F.lit(cy)),
                F.array(zero, zero, one)).alias("K"),
        F.array(0.01 * (k % 5), -0.001 * (k % 3), zero, zero).alias("D"),
        F.array(F.lit(0.1), 0.02 * (k % 3), zero).alias("rvec"),
        F.array(zero, zero, F.lit(20.0)).alias("tvec"),
        ((k % 9) * 0.75).alias("rms"),
        (6 + k % 20).alias("n_gcps"),
        F.when(k >= 16, F.replace(day.cast("string"), F.lit("-"), F.lit(""))).alias(
            "recalibration_date"),
        F.lit(SIDE if small else 3840).alias("image_width"),
        F.lit(SIDE if small else 2160).alias("image_height"))


def latest_calibrations(spark: SparkSession, sf_dir: str, small: bool = False) -> DataFrame:
    """The last record of every camera."""
    store = calibrations(spark, sf_dir, small)
    columns = [c for c in store.columns if c != "camera"]
    last = F.max_by(F.struct(*columns), F.struct("version", "candidate")).alias("c")
    return store.groupBy("camera").agg(last).select("camera", "c.*")


def lookup_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup map into 8 x 8 images, partly outside of them, from part."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        (k % 16).cast("int").alias("camera"),
        F.expr("cast(p_partkey div 16 div 12 as int)").alias("row"),
        F.expr("cast((p_partkey div 16) % 12 as int)").alias("col"),
        (-1.0 + (k * 7 % 41) * 0.25 + F.col("p_size") / 64.0).cast("float").alias("src_x"),
        (-1.0 + (k * 3 % 37) * 0.25 + F.col("p_size") / 128.0).cast("float").alias("src_y"),
        F.lit(SIDE).alias("image_width"), F.lit(SIDE).alias("image_height"))


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = F.array(F.lit("extract"), F.lit("ortho"), F.lit("mosaic"))
    ok = F.col("event_type") != "error"
    return table(spark, sf_dir, "events").select(
        F.get(stages, (F.col("event_id") % 3).cast("int")).alias("stage"),
        F.expr("event_id div 48").alias("ts"),
        (F.col("user_id") % 16).cast("int").alias("camera"),
        ok.alias("success"), F.when(~ok, F.col("props")).alias("error"))
