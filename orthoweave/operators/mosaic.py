"""Mosaic layout and the priority mosaic.

Images are metadata rows (ts, camera, file, width, height, x_min, y_max,
pixel_width, pixel_height). Pixels are rows (ts, camera, row, col, b, g, r).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orthoweave.functions import geometry, pixels
from orthoweave.functions.util import truncated
from orthoweave.operators.matching import with_metadata

METHODS = ("center", "order")

# A priority up to 1 is a multiple of 2**-53, so this factor makes it an integer
# without loss. The range of ties is wider than any number of images, and both fit
# into a DECIMAL that hash aggregation keeps in place.
PRIORITY_SCALE = float(2**53)
TIE_RANGE = 2**32


def with_bounds(images: DataFrame) -> DataFrame:
    """Images with x_max and y_min."""
    return images.withColumns(geometry.image_bounds())


def mosaic_bounds(images: DataFrame) -> DataFrame:
    """Bounds of all images per ts."""
    return with_bounds(images).groupBy("ts").agg(
        F.min("x_min").alias("x_min"), F.max("x_max").alias("x_max"),
        F.min("y_min").alias("y_min"), F.max("y_max").alias("y_max"),
    )


def mosaic_grid(images: DataFrame, resolution: float | None = None) -> DataFrame:
    """Bounds, resolution and size of the mosaic per ts; default resolution of the first file."""
    own = F.min_by("pixel_width", "file") if resolution is None else F.lit(float(resolution))
    grid = with_bounds(images).groupBy("ts").agg(
        F.min("x_min").alias("x_min"), F.max("x_max").alias("x_max"),
        F.min("y_min").alias("y_min"), F.max("y_max").alias("y_max"),
        own.alias("resolution"),
    )
    return grid.withColumns({
        "width": truncated((F.col("x_max") - F.col("x_min")) / F.col("resolution")),
        "height": truncated((F.col("y_max") - F.col("y_min")) / F.abs("resolution")),
    })


def mosaic_geo(images: DataFrame, resolution: float | None = None) -> DataFrame:
    """Geotransform of the mosaic per ts."""
    return mosaic_grid(images, resolution).select(
        "ts",
        F.col("resolution").alias("pixel_width"),
        F.lit(0.0).alias("rotation_x"),
        F.lit(0.0).alias("rotation_y"),
        (-F.col("resolution")).alias("pixel_height"),
        "x_min", "y_max", "width", "height",
    )


def file_positions(images: DataFrame) -> DataFrame:
    """1-based position in file-name order per ts; ranks metadata rows, never pixels."""
    return images.withColumn("position", F.row_number().over(W.partitionBy("ts").orderBy("file")))


def left_to_right(images: DataFrame) -> DataFrame:
    """1-based position by x_min, then file, per ts."""
    return images.withColumn(
        "seq", F.row_number().over(W.partitionBy("ts").orderBy("x_min", "file")))


def check_resolution(images: DataFrame, resolution: float | None) -> None:
    """Images are placed without resampling, so another resolution than theirs is refused."""
    if resolution is None:
        return
    other = images.where(F.col("pixel_width") != F.lit(float(resolution))).select("file").first()
    if other is not None:
        raise ValueError(f"{other.file} does not have resolution {resolution}; pass strict=False")


def place_images(images: DataFrame, resolution: float | None = None, strict: bool = True) -> DataFrame:
    """Images with their clipped region in the mosaic of their ts.

    Adds position, col_start, row_start (first mosaic cell), src_col, src_row
    (first image cell) and region_width, region_height.
    """
    if strict:
        check_resolution(images, resolution)
    grid = mosaic_grid(images, resolution).select(
        "ts", "resolution", F.col("x_min").alias("_gx"), F.col("y_max").alias("_gy"),
        F.col("width").alias("_gw"), F.col("height").alias("_gh"))
    row, col = geometry.mosaic_offset("x_min", "y_max", "_gx", "_gy", "resolution")
    zero = F.lit(0)
    return (
        file_positions(images).join(grid, "ts")
        .withColumns({"_row": row, "_col": col})
        .withColumns({
            "row_start": F.greatest(zero, "_row"),
            "col_start": F.greatest(zero, "_col"),
            "src_row": F.greatest(zero, -F.col("_row")),
            "src_col": F.greatest(zero, -F.col("_col")),
            "_row_end": F.least("_gh", F.col("_row") + F.col("height")),
            "_col_end": F.least("_gw", F.col("_col") + F.col("width")),
        })
        .withColumns({
            "region_height": F.col("_row_end") - F.col("row_start"),
            "region_width": F.col("_col_end") - F.col("col_start"),
        })
        .drop("_gx", "_gy", "_gw", "_gh", "_row", "_col", "_row_end", "_col_end")
    )


PLACEMENT = ("position", "row_start", "col_start", "src_row", "src_col",
             "region_height", "region_width")


def placed_pixels(pixel_rows: DataFrame, placed: DataFrame) -> DataFrame:
    """Pixels joined with the placement of their image, clipped to the mosaic."""
    return to_mosaic(with_metadata(
        pixel_rows, placed.select("ts", "camera", *PLACEMENT), ["ts", "camera"]))


def to_mosaic(rows: DataFrame) -> DataFrame:
    """Adds region_row, region_col, mosaic_row, mosaic_col to pixels that carry a placement."""
    return (
        rows.withColumns({
            "region_row": F.col("row") - F.col("src_row"),
            "region_col": F.col("col") - F.col("src_col"),
        })
        .where("region_row >= 0 AND region_row < region_height"
               " AND region_col >= 0 AND region_col < region_width")
        .withColumns({
            "mosaic_row": F.col("region_row") + F.col("row_start"),
            "mosaic_col": F.col("region_col") + F.col("col_start"),
        })
    )


def _best_payload(method: str, payload: Column) -> tuple[Column, dict[str, Column], Column]:
    """(is candidate, aggregates, chosen payload) of the pixels of one mosaic cell."""
    position = F.col("position").cast("bigint")
    if method == "order":
        return F.lit(True), {"_a": F.max_by(payload, position)}, F.col("_a")
    if method != "center":
        raise ValueError(f"unknown method: {method!r}")
    priority = geometry.centre_priority(
        "region_row", "region_col", "region_height", "region_width")
    scaled = (priority * PRIORITY_SCALE).cast("bigint")
    rank = scaled.cast("decimal(20,0)") * F.lit(TIE_RANGE) - position
    return priority > 0, {"_a": F.max_by(payload, rank)}, F.col("_a")


def priority_argmax(placed: DataFrame, method: str = "center") -> DataFrame:
    """Best valid pixel per mosaic cell: (ts, mosaic_row, mosaic_col, b, g, r, position).

    ``center``: highest priority above 0, ties to the first file. ``order``: the
    last file. Ranks and payload are single numbers, so this stays a hash
    aggregation with a map-side combine.
    """
    payload = F.col("position").cast("bigint") * 16777216 + pixels.pack_bgr()
    candidate, aggregates, chosen = _best_payload(method, payload)
    best = (
        placed.where(pixels.valid_pixel() & candidate)
        .groupBy("ts", "mosaic_row", "mosaic_col")
        .agg(*[a.alias(n) for n, a in aggregates.items()])
        .withColumn("_best", chosen)
    )
    return best.select(
        "ts", "mosaic_row", "mosaic_col", *pixels.unpack_bgr("_best"),
        F.shiftright("_best", 24).cast("int").alias("position"),
    )


def mosaic_priority(pixel_rows: DataFrame, images: DataFrame, method: str = "center",
                    resolution: float | None = None, strict: bool = True) -> DataFrame:
    """Priority mosaic of pixel rows: (ts, mosaic_row, mosaic_col, b, g, r, camera)."""
    placed = place_images(images, resolution, strict)
    best = priority_argmax(placed_pixels(pixel_rows, placed), method)
    names = placed.select("ts", "position", "camera")
    return with_metadata(best, names, ["ts", "position"]).drop("position")
