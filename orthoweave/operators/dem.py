"""Elevation grids: pixel-wise output grids and resampling of a DEM onto them.

A DEM is rows (row, col, z), z NULL where there is no data, plus a
:class:`DemTransform`. Output pixels carry camera, row, col and a geotransform.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orthoweave.functions import geometry

# Fixed value: weight below which a resampled cell counts as empty.
MIN_WEIGHT = 1e-6

GEO = ("x_min", "y_max", "pixel_width", "pixel_height")


@dataclass(frozen=True)
class DemTransform:
    """Corner, cell size and extent of a DEM; rows run to the south."""

    x_min: float
    y_max: float
    cell: float
    rows: int
    cols: int

    def position(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Fractional (row, col) of a world position, from the corner of cell (0, 0)."""
        return (F.lit(self.y_max) - y) / F.lit(self.cell), (x - F.lit(self.x_min)) / F.lit(self.cell)


def ortho_pixels(cameras: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """All pixels (camera, row, col) of the output grids, with their geotransform.

    Rows are listed first and spread over the cluster, then columns, so one
    camera with a large grid is not expanded by one task.
    """
    kept = [c for c in dict.fromkeys(("camera", *GEO, *keep))]
    rows = cameras.where("height > 0 AND width > 0").select(
        *kept, "width", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("row"))
    return rows.repartition("camera", "row").select(
        *kept, "row", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("col"))


def valid_mean(values: DataFrame, z: str = "z") -> DataFrame:
    """Mean of the valid values and the value range per camera."""
    return values.groupBy("camera").agg(
        F.avg(z).alias("mean_z"), F.min(z).alias("min_z"), F.max(z).alias("max_z"))


def z_range(values: DataFrame, z: str = "z") -> DataFrame:
    """Lowest and highest elevation per camera."""
    return values.groupBy("camera").agg(F.min(z).alias("min_z"), F.max(z).alias("max_z"))


def fill_with_mean(values: DataFrame, z: str = "z") -> DataFrame:
    """Empty values replaced by the mean of their camera's valid values."""
    means = valid_mean(values, z).select("camera", "mean_z")
    return values.join(means, "camera", "left").withColumn(
        z, F.coalesce(F.col(z), F.col("mean_z").cast("float"))).drop("mean_z")


def cell_quads(dem: DataFrame) -> DataFrame:
    """Each cell with its right, lower and diagonal neighbour: (dem_row, dem_col, z00..z11).

    Built once on the DEM, so an output pixel needs one lookup, not four.
    """
    offsets = F.array(*[
        F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr in (0, 1) for dc in (0, 1)])
    spread = dem.where("z IS NOT NULL").select("row", "col", "z", F.explode(offsets).alias("o"))

    def corner(dr: int, dc: int) -> Column:
        here = (F.col("o.dr") == dr) & (F.col("o.dc") == dc)
        return F.max(F.when(here, F.col("z").cast("double"))).alias(f"z{dr}{dc}")

    return spread.groupBy(
        (F.col("row") - F.col("o.dr")).cast("bigint").alias("dem_row"),
        (F.col("col") - F.col("o.dc")).cast("bigint").alias("dem_col"),
    ).agg(*[corner(dr, dc) for dr in (0, 1) for dc in (0, 1)])


def dem_bilinear(grid: DataFrame, dem: DataFrame, transform: DemTransform,
                 fill: str | float | None = "mean") -> DataFrame:
    """Grid pixels with bilinear z (FLOAT) at their centres.

    Cells without data get no weight. ``fill`` for pixels that stay empty:
    ``mean`` of the camera, a constant, or None for NULL.
    """
    x, y = geometry.pixel_to_world(centre=True)
    at_row, at_col = transform.position(x, y)
    inside = ((F.col("_r") >= 0) & (F.col("_r") < transform.rows)
              & (F.col("_c") >= 0) & (F.col("_c") < transform.cols))
    located = grid.withColumns({"_r": at_row, "_c": at_col}).withColumns({
        "dem_row": F.when(inside, F.floor(F.col("_r") - 0.5)),
        "dem_col": F.when(inside, F.floor(F.col("_c") - 0.5)),
    })
    fr = F.col("_r") - 0.5 - F.col("dem_row")
    fc = F.col("_c") - 0.5 - F.col("dem_col")
    one, zero = F.lit(1.0), F.lit(0.0)
    weights = {"z00": (one - fr) * (one - fc), "z01": (one - fr) * fc,
               "z10": fr * (one - fc), "z11": fr * fc}
    total, weight = zero, zero
    for name, w in weights.items():
        total = total + F.coalesce(w * F.col(name), zero)
        weight = weight + F.when(F.col(name).isNotNull(), w).otherwise(zero)
    sampled = (
        located.join(cell_quads(dem), ["dem_row", "dem_col"], "left")
        .withColumn("z", F.when(weight > MIN_WEIGHT, total / F.when(weight != 0, weight)).cast("float"))
        .select(*grid.columns, "z")
    )
    return _filled(sampled, fill)


def dem_nearest(grid: DataFrame, dem: DataFrame, transform: DemTransform,
                fill: str | float | None = "mean") -> DataFrame:
    """Grid pixels with the z (FLOAT) of the cell their corner lies in."""
    x, y = geometry.pixel_to_world()
    at_row, at_col = transform.position(x, y)
    cells = dem.where("z IS NOT NULL").select(
        F.col("row").cast("bigint").alias("dem_row"), F.col("col").cast("bigint").alias("dem_col"),
        F.col("z").cast("float").alias("z"))
    sampled = (
        grid.withColumns({"dem_row": F.floor(at_row), "dem_col": F.floor(at_col)})
        .join(cells, ["dem_row", "dem_col"], "left")
        .select(*grid.columns, "z")
    )
    return _filled(sampled, fill)


def _filled(sampled: DataFrame, fill: str | float | None) -> DataFrame:
    if fill is None:
        return sampled
    if fill == "mean":
        return fill_with_mean(sampled)
    return sampled.withColumn("z", F.coalesce("z", F.lit(float(fill)).cast("float")))
