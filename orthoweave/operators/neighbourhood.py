"""Neighbourhood operators on rasters, as two one-dimensional window passes.

Rasters are rows (image keys, row, col, value). A window holds one raster row or
column, never a whole raster. Borders mirror without repeating the edge pixel; a
missing pixel is a border, so values never come from beyond a hole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Side of the variance window and guard of the normalisation.
VARIANCE_SIDE = 15
NORM_GUARD = 1e-10

COST_METHODS = ("gradient", "variance", "combined")


def _neighbours(value: str, window, axis: str) -> tuple[Column, Column]:
    """Value before and after on the axis, mirrored at both ends."""
    here, at = F.col(value), F.col(axis)
    before = F.when(F.lag(axis).over(window) == at - 1, F.lag(value).over(window))
    after = F.when(F.lead(axis).over(window) == at + 1, F.lead(value).over(window))
    return F.coalesce(before, after, here), F.coalesce(after, before, here)


def sobel_gradient(raster: DataFrame, keys: list[str], value: str = "gray",
                   row: str = "row", col: str = "col") -> DataFrame:
    """Adds gx, gy and gradient, the 3 x 3 Sobel derivatives and their length."""
    along = W.partitionBy(*keys, row).orderBy(col)
    left, right = _neighbours(value, along, col)
    passed = raster.withColumns({
        "_dx": right - left, "_sx": left + 2 * F.col(value) + right})
    down = W.partitionBy(*keys, col).orderBy(row)
    dx_up, dx_down = _neighbours("_dx", down, row)
    sx_up, sx_down = _neighbours("_sx", down, row)
    return (
        passed.withColumns({
            "gx": dx_up + 2 * F.col("_dx") + dx_down,
            "gy": sx_down - sx_up,
        })
        .drop("_dx", "_sx")
        .withColumn("gradient", F.sqrt((F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy"))
                                       .cast("double")))
    )


def _mirrored_positions(index: Column, size: Column, radius: int) -> Column:
    """All positions within ``radius`` of the axis that mirror onto ``index``."""
    period = F.greatest(2 * (size - 1), F.lit(1))
    turns = F.ceil(F.lit(float(radius)) / period).cast("int") + 1
    shifts = F.transform(F.sequence(-turns, turns), lambda k: k * period)
    both = F.flatten(F.transform(shifts, lambda s: F.array(s + index, s - index)))
    return F.array_distinct(
        F.filter(both, lambda p: (p >= -radius) & (p <= size - 1 + radius)))


def _box_pass(raster: DataFrame, keys: list[str], across: str, axis: str, size: str,
              sums: dict[str, Column], radius: int) -> DataFrame:
    window = W.partitionBy(*keys, across).orderBy("_p").rangeBetween(-radius, radius)
    padded = raster.withColumn(
        "_p", F.explode(_mirrored_positions(F.col(axis), F.col(size), radius)))
    summed = padded.withColumns({name: F.sum(c).over(window) for name, c in sums.items()})
    return summed.where((F.col("_p") >= 0) & (F.col("_p") < F.col(size))).drop("_p")


def local_variance(raster: DataFrame, keys: list[str], value: str = "gray",
                   row: str = "row", col: str = "col", height: str = "height",
                   width: str = "width", side: int = VARIANCE_SIDE) -> DataFrame:
    """Adds variance, the population variance in a square around each pixel.

    The sums stay integers; only the last step divides.
    """
    radius, area = side // 2, float(side * side)
    v = F.col(value).cast("bigint")
    rows_done = _box_pass(raster, keys, row, col, width, {"_s1": v, "_s2": v * v}, radius)
    done = _box_pass(rows_done, keys, col, row, height,
                     {"_t1": F.col("_s1"), "_t2": F.col("_s2")}, radius)
    mean = F.col("_t1") / F.lit(area)
    return done.withColumn("variance", F.col("_t2") / F.lit(area) - mean * mean).drop(
        "_s1", "_s2", "_t1", "_t2")


def region_max(raster: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Largest value per image; a partial aggregation, so no image fills one task."""
    return raster.groupBy(*keys).agg(*[F.max(v).alias(f"max_{v}") for v in values])


def normalised(raster: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Adds <value>_norm, each value over the largest of its image."""
    joined = raster.join(region_max(raster, keys, values), keys)
    return joined.withColumns({
        f"{v}_norm": F.col(v) / (F.col(f"max_{v}") + F.lit(NORM_GUARD)) for v in values
    }).drop(*[f"max_{v}" for v in values])


def quality_cost(raster: DataFrame, keys: list[str], method: str = "gradient",
                 row: str = "row", col: str = "col") -> DataFrame:
    """Adds cost: normalised gradient, normalised variance, or the mean of both."""
    if method not in COST_METHODS:
        raise ValueError(f"unknown method: {method!r}")
    measures = []
    if method in ("gradient", "combined"):
        raster = sobel_gradient(raster, keys, row=row, col=col)
        measures.append("gradient")
    if method in ("variance", "combined"):
        raster = local_variance(raster, keys, row=row, col=col)
        measures.append("variance")
    scaled = normalised(raster, keys, measures)
    weight = F.lit(1.0 / len(measures))
    cost = weight * F.col(f"{measures[0]}_norm")
    for m in measures[1:]:
        cost = cost + weight * F.col(f"{m}_norm")
    return scaled.withColumn("cost", cost)


def seam_boundary(mask: DataFrame, keys: list[str], value: str = "mask",
                  row: str = "row", col: str = "col") -> DataFrame:
    """Adds boundary: cells outside the mask that touch it, diagonals included."""
    along = W.partitionBy(*keys, row).orderBy(col).rangeBetween(-1, 1)
    down = W.partitionBy(*keys, col).orderBy(row).rangeBetween(-1, 1)
    return (
        mask.withColumn("_any", F.max(F.col(value).cast("int")).over(along))
        .withColumn("_any", F.max("_any").over(down))
        .withColumn("boundary", (F.col("_any") == 1) & ~F.col(value))
        .drop("_any")
    )
