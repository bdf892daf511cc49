"""A whole run: extract, orthorectify, mosaic, with stage tables and a status summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orthoweave.functions import names
from orthoweave.operators import catalog, matching, mosaic, status, tiles
from orthoweave.plans import frames as frame_plans
from orthoweave.plans import mosaics, orthos
from orthoweave.sources import tables

STAGES = ("extract", "ortho", "mosaic")


@dataclass(frozen=True)
class RunInputs:
    """What a run starts from.

    Decoded frames enter as tiles or pixel rows (ts, camera, ...), with their list
    ``images`` (ts, camera) if it is known; ``cameras`` are the calibrated cameras
    (camera, cal_order), by default those of the lookup map by name. A frame belongs
    to the first of them that its camera name contains.
    """

    paths: DataFrame
    grid: catalog.ClockGrid
    frames: DataFrame
    ortho_map: DataFrame
    grids: DataFrame
    base: str | None = None
    fps: Column | None = None
    images: DataFrame | None = None
    cameras: DataFrame | None = None


def _status(stage: str, wanted: DataFrame, done: DataFrame, keys: list[str], error: str,
            faults: DataFrame | None = None) -> DataFrame:
    """Status rows of what a stage wanted; faults (keys, fault) name what went wrong."""
    found = done.select(*keys).distinct().withColumn("_done", F.lit(True))
    success = F.coalesce("_done", F.lit(False))
    camera = F.col("camera") if "camera" in keys else F.lit(None)
    rows, message = wanted.join(found, keys, "left"), F.lit(error)
    if faults is not None:
        rows, message = rows.join(faults, keys, "left"), F.coalesce("fault", message)
    return rows.select(
        F.lit(stage).alias("stage"), "ts", camera.cast("string").alias("camera"),
        success.alias("success"), F.when(~success, message).alias("error"))


def run(spark: SparkSession, inputs: RunInputs, folder: str, stages: tuple[str, ...] = STAGES,
        method: str = "center", seam_quality: str = "gradient", resolution: float | None = None,
        size: int = tiles.TILE) -> DataFrame:
    """Runs the stages in order and returns the status rows (stage, ts, camera, success, error).

    Each stage reads the table of the one before, so a later run may start at any
    stage. Each stage keeps the list of its images beside its rasters, so status rows
    and later stages read no pixels for it. A run works on the times of its grid only;
    runs over other times add to the tables.
    A frame with a broken tile fails alone: its status row says what is wrong, its tiles stay
    in the frames table with that error, and the run goes on with the others.
    Without a single extracted frame the later stages do not run.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    grid = inputs.grid
    first, last = grid.time_at(F.lit(0)), grid.time_at(F.lit(grid.count - 1))

    def stored(name: str) -> DataFrame:
        return tables.read_stage(spark, f"{folder}/{name}").where(F.col("ts").between(first, last))

    def keep(found: DataFrame, name: str) -> DataFrame:
        tables.write_list(found, f"{folder}/{name}")
        # with its schema, since a list without rows has no file to take one from
        table = spark.read.schema(found.schema).parquet(f"{folder}/{name}")
        return table.where(F.col("ts").between(first, last))

    rows = []
    if "extract" in stages:
        requests = frame_plans.plan_frames(inputs.paths, inputs.grid, inputs.base, inputs.fps)
        requests = keep(requests, "requests")
        known = inputs.frames if inputs.images is None else inputs.images
        listed = known.select("ts", "camera").distinct().join(
            requests.select("ts", "camera"), ["ts", "camera"], "left_semi")
        given = inputs.frames.join(requests.select("ts", "camera"), ["ts", "camera"], "left_semi")
        faults = None
        if orthos.in_tiles(given) and not listed.isEmpty():
            # one pass over the pixels: what is wrong with a tile is written beside it
            tables.write_frames(given.withColumn("error", tiles.tile_fault(size)), f"{folder}/frames", size=size)
            faults = stored("frames").where("error IS NOT NULL").groupBy("ts", "camera").agg(F.min("error").alias("fault"))
            listed = listed.join(faults, ["ts", "camera"], "left_anti")
        listed = keep(listed, "frames_list")
        rows.append(_status("extract", requests.select("ts", "camera"), listed, ["ts", "camera"], "no frame", faults))
        if listed.isEmpty():
            return _all(rows)
        if faults is None:
            tables.write_frames(given.join(listed.select("ts", "camera"), ["ts", "camera"], "left_semi"), f"{folder}/frames", size=size)
    if "ortho" in stages:
        frames, listed = stored("frames"), stored("frames_list").select("ts", "camera")
        if "error" in frames.columns:
            frames = frames.where("error IS NULL").drop("error")
        cameras = inputs.cameras
        if cameras is None:
            cameras = inputs.ortho_map.select("camera").distinct().withColumn("cal_order", F.col("camera"))
        found = matching.match_calibration(listed.select(F.col("camera").alias("path")), cameras).select(
            F.col("path").alias("camera"), F.col("camera").alias("_calibrated"))
        named = matching.with_metadata(frames, found, ["camera"]).drop("camera").withColumnRenamed(
            "_calibrated", "camera")
        matched = listed.join(found, "camera")
        done = keep(matched.select("ts", "camera", F.col("_calibrated").alias("calibrated")), "orthos_list")
        images = done.select("ts", F.col("calibrated").alias("camera")).distinct()
        tables.write_orthos(orthos.gather(named, inputs.ortho_map, images, size), inputs.grids, f"{folder}/orthos", size=size)
        rows.append(_status("ortho", listed, done, ["ts", "camera"], "no matching calibration"))
    if "mosaic" in stages:
        rasters = stored("orthos/pixels")
        listed = stored("orthos_list").select("ts", F.col("calibrated").alias("camera")).distinct()
        images = orthos.ortho_images(listed, tables.read_stage(spark, f"{folder}/orthos/geo"))
        built = mosaics.build_mosaics(rasters, images, method, seam_quality, resolution, size=size)
        tables.write_mosaics(built, mosaic.mosaic_geo(images, resolution), f"{folder}/mosaics", size=size)
        done = stored("mosaics/geo")
        rows.append(_status("mosaic", images.select("ts").distinct(), done, ["ts"], "no mosaic"))
    return _all(rows)


def _all(rows: list[DataFrame]) -> DataFrame:
    merged = rows[0]
    for more in rows[1:]:
        merged = merged.unionByName(more)
    return merged


def summary(status_rows: DataFrame) -> DataFrame:
    """Succeeded and total items per stage."""
    return status.stage_summary(status_rows)
