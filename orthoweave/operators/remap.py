"""Lookup maps from output pixels to source pixels, and the bilinear gather.

A map is rows (camera, row, col, src_x, src_y, image_width, image_height).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orthoweave.functions import geometry
from orthoweave.operators import dem as dem_ops

# Source positions are rounded to 1/32 pixel, so the four weights
# are integers that add up to 1024.
SUBPIXEL = 32
WEIGHT_SUM = SUBPIXEL * SUBPIXEL

# Side of the blocks that frame pixels are gathered from.
BLOCK = 64

# Rows of a lookup that a task holds for a key, and timestamps that share a copy of them.
PART_ROWS, PART_TIMES = 8192, 256

MODEL_COLUMNS = ("K", "D", "rvec", "tvec")


def camera_bounds(gcps: DataFrame, padding: float = 0.5) -> DataFrame:
    """Bounds of each camera's control points, widened by ``padding``."""
    pad = F.lit(float(padding))
    return gcps.groupBy("camera").agg(
        (F.min("X") - pad).alias("x_min"), (F.max("X") + pad).alias("x_max"),
        (F.min("Y") - pad).alias("y_min"), (F.max("Y") + pad).alias("y_max"),
        F.count(F.lit(1)).alias("n_gcps"),
    )


def camera_grids(gcps: DataFrame, resolution: float = 0.005, padding: float = 0.5) -> DataFrame:
    """Output size and geotransform per camera."""
    grid = geometry.ortho_grid("x_min", "x_max", "y_min", "y_max", resolution)
    return camera_bounds(gcps, padding).select("camera", "n_gcps", grid.alias("g")).select(
        "camera", "n_gcps", "g.*")


def with_elevation(grids: DataFrame, calibrations: DataFrame, dem: DataFrame,
                   transform: dem_ops.DemTransform, fill: str | float | None = "mean") -> DataFrame:
    """Output pixels of every calibrated camera with their elevation."""
    known = grids.join(calibrations.select("camera"), "camera", "left_semi")
    return dem_ops.dem_bilinear(dem_ops.ortho_pixels(known), dem, transform, fill)


def project_grid(pixels: DataFrame, calibrations: DataFrame) -> DataFrame:
    """The map of output pixels (camera, row, col, z, geotransform) through their camera."""
    cameras = calibrations.select(
        "camera", *MODEL_COLUMNS, "image_width", "image_height",
        geometry.rotation_array(geometry.CameraModel.of_record().rvec).alias("R"))
    model = geometry.CameraModel.of_record()
    x, y = geometry.pixel_to_world()
    point = geometry.world_to_camera(
        x, y, F.col("z").cast("double"), geometry.rotation_of("R"), model.tvec)
    placed = pixels.join(cameras, "camera").withColumn(
        "p", F.struct(*[c.alias(n) for c, n in zip(point, "xyz")]))
    src_x, src_y = geometry.fisheye_project((F.col("p.x"), F.col("p.y"), F.col("p.z")), model)
    return placed.select(
        "camera", "row", "col", "z",
        src_x.cast("float").alias("src_x"), src_y.cast("float").alias("src_y"),
        "image_width", "image_height",
    )


def build_ortho_map(gcps: DataFrame, calibrations: DataFrame, dem: DataFrame,
                    transform: dem_ops.DemTransform, resolution: float = 0.005,
                    padding: float = 0.5, fill: str | float | None = "mean") -> DataFrame:
    """Lookup map of all cameras: grid, elevation, projection."""
    grids = camera_grids(gcps, resolution, padding)
    return project_grid(with_elevation(grids, calibrations, dem, transform, fill), calibrations)


def undistort_map(calibrations: DataFrame, balance: float = 0.0) -> DataFrame:
    """Map that shows each camera's frame without its distortion."""
    model = geometry.CameraModel.of_record()
    views = calibrations.withColumn(
        "_edges", geometry.edge_midpoints("image_width", "image_height", model),
    ).select(
        "camera", *MODEL_COLUMNS, "image_width", "image_height",
        geometry.fitting_view("_edges", "image_width", "image_height", model, balance).alias("view"),
        F.col("image_width").alias("width"), F.col("image_height").alias("height"),
        *[F.lit(0.0).alias(c) for c in dem_ops.GEO],
    )
    grid = dem_ops.ortho_pixels(
        views, keep=(*MODEL_COLUMNS, "image_width", "image_height", "view"))
    src_x, src_y = geometry.undistorted_source("row", "col", "view", model)
    return grid.select(
        "camera", "row", "col",
        src_x.cast("float").alias("src_x"), src_y.cast("float").alias("src_y"),
        "image_width", "image_height",
    )


def map_range(ortho_map: DataFrame) -> DataFrame:
    """Range of the source positions per camera."""
    return ortho_map.groupBy("camera").agg(
        F.min("src_x").alias("min_x"), F.max("src_x").alias("max_x"),
        F.min("src_y").alias("min_y"), F.max("src_y").alias("max_y"),
    )


def _subpixel(position: str, size: str) -> Column:
    """Position in 1/32 pixels; outside the image when no pixel of it can be reached."""
    c = F.col(position).cast("double")
    usable = (c > -1) & (c < F.col(size))  # also false for NaN and NULL
    return F.when(usable, F.rint(c * SUBPIXEL)).otherwise(F.lit(-4.0 * SUBPIXEL)).cast("bigint")


def bilinear_taps(ortho_map: DataFrame) -> DataFrame:
    """Source pixels and integer weights of each output pixel.

    A tap outside the image has no weight and is left out; output pixels that see
    nothing have no tap at all, see :func:`blind_pixels`.
    """
    return _with_taps(ortho_map).select("camera", "row", "col", F.explode("_taps").alias("t")).select(
        "camera", F.col("row").alias("out_row"), F.col("col").alias("out_col"),
        "t.src_row", "t.src_col", "t.weight")


def blind_pixels(ortho_map: DataFrame) -> DataFrame:
    """Output pixels (camera, out_row, out_col) that lie outside their image."""
    return _placed(ortho_map).where(~_sees()).select(
        "camera", F.col("row").alias("out_row"), F.col("col").alias("out_col"))


def _placed(ortho_map: DataFrame) -> DataFrame:
    """The map with the first source pixel of each output pixel and the place inside of it."""
    return ortho_map.withColumns({
        "_sx": _subpixel("src_x", "image_width"), "_sy": _subpixel("src_y", "image_height"),
    }).withColumns({
        "_ix": F.shiftright("_sx", 5), "_fx": F.pmod("_sx", F.lit(SUBPIXEL)),
        "_iy": F.shiftright("_sy", 5), "_fy": F.pmod("_sy", F.lit(SUBPIXEL)),
    })


def _sees() -> Column:
    """Whether any tap has weight; asked of the places, as a question to the taps would
    form all of them again."""
    def reached(first: str, inside: str, size: str) -> Column:
        own = (F.col(first) >= 0) & (F.col(first) < F.col(size))
        return own | ((F.col(first) >= -1) & (F.col(first) + 1 < F.col(size)) & (F.col(inside) > 0))

    return F.coalesce(reached("_ix", "_fx", "image_width") & reached("_iy", "_fy", "image_height"), F.lit(False))


def _tap(dy: int, dx: int) -> tuple[Column, Column, Column]:
    """Row, column and weight of a tap, 0 outside the image."""
    row, col = F.col("_iy") + dy, F.col("_ix") + dx
    wy = F.col("_fy") if dy else SUBPIXEL - F.col("_fy")
    wx = F.col("_fx") if dx else SUBPIXEL - F.col("_fx")
    inside = ((row >= 0) & (row < F.col("image_height"))
              & (col >= 0) & (col < F.col("image_width")))
    return row.cast("int"), col.cast("int"), F.when(inside, wy * wx).otherwise(F.lit(0)).cast("int")


_TAPS = [(dy, dx) for dy in (0, 1) for dx in (0, 1)]


def _with_taps(ortho_map: DataFrame) -> DataFrame:
    every = [F.struct(*[c.alias(n) for c, n in zip(_tap(*d), ("src_row", "src_col", "weight"), strict=True)]) for d in _TAPS]
    return _placed(ortho_map).withColumn("_taps", F.filter(F.array(*every), lambda t: t["weight"] > 0))


def _block_taps(ortho_map: DataFrame) -> DataFrame:
    """Output pixels that see something: the source block of their first tap, its place there,
    and the weights of the four taps, 0 outside the image."""
    block_row, block_col = F.floor(F.col("_iy") / BLOCK), F.floor(F.col("_ix") / BLOCK)
    at = (F.col("_iy") - block_row * BLOCK) * (BLOCK + 1) + (F.col("_ix") - block_col * BLOCK)
    return _placed(ortho_map).where(_sees()).select(
        "camera", block_row.cast("int").alias("block_row"), block_col.cast("int").alias("block_col"),
        "row", "col", at.cast("int").alias("at"), *[_tap(*d)[2].alias(f"w{k}") for k, d in enumerate(_TAPS)])


def _source_blocks(pixel_rows: DataFrame) -> DataFrame:
    """Frames cut into blocks with one more row and column: an array by place of each channel,
    NULL where the frame has no pixel."""
    def blocks(place: str) -> Column:
        own = F.floor(F.col(place) / BLOCK).cast("int")
        return F.explode(F.when(F.col(place) % BLOCK == 0, F.array(own, own - 1)).otherwise(F.array(own)))

    cut = pixel_rows.withColumn("block_row", blocks("row")).withColumn("block_col", blocks("col"))
    at = (F.col("row") - F.col("block_row") * BLOCK) * (BLOCK + 1) + F.col("col") - F.col("block_col") * BLOCK
    cells = F.array_sort(F.collect_list(F.struct(at.cast("int").alias("at"), F.struct("b", "g", "r").alias("px"))))
    grouped = cut.groupBy("ts", "camera", "block_row", "block_col").agg(cells.alias("_cells"))

    def placed(cell: Column, i: Column) -> Column:
        before = F.coalesce(F.get(F.col("_cells"), i - 1)["at"], F.lit(-1))
        missing = F.array_repeat(F.when(F.lit(False), cell["px"]), cell["at"] - before - 1)
        return F.concat(missing, F.array_repeat(cell["px"], F.when(cell["at"] > before, 1).otherwise(0)))

    whole = grouped.withColumn("_px", F.flatten(F.transform("_cells", placed)))
    return whole.select("ts", "camera", "block_row", "block_col", *[
        F.col(f"_px.{band}").alias(f"block_{band}") for band in "bgr"])


def _spread(timed: DataFrame, lookup: DataFrame, on: list[str], images: DataFrame) -> DataFrame:
    """Equi-join of rows of each timestamp with the rows (row, col) of a lookup.

    A key with many lookup rows is cut into parts of them, and its timed rows go to all of
    these; only where a camera has very many timestamps are lookup rows repeated. So a key
    is worked on by many tasks while each lookup row is shuffled once for PART_TIMES
    timestamps. Spark's estimates leave such repeats out: neither side is ever broadcast, and
    both go to as many tasks as the session has shuffle partitions, whatever their bytes.
    """
    parts = lookup.groupBy(*on).agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("_parts"))
    turns = images.groupBy("camera").agg(F.ceil(F.count("*") / PART_TIMES).cast("int").alias("_turns"))

    def sized(rows: DataFrame) -> DataFrame:
        return rows.join(parts, on).join(turns, "camera", "left").withColumn("_turns", F.coalesce("_turns", F.lit(1)))

    def upto(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    keys, extra = [*on, "_part", "_turn"], ["_parts", "_turns"]
    n = int(timed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = sized(timed).withColumn("_turn", F.pmod(F.xxhash64("ts"), "_turns").cast("int")).withColumn("_part", upto("_parts"))
    few = sized(lookup).withColumn("_part", F.pmod(F.xxhash64("row", "col"), "_parts").cast("int")).withColumn("_turn", upto("_turns"))
    return many.drop(*extra).repartition(n, *keys).join(
        few.drop(*extra).repartition(n, *keys).hint("merge"), keys).drop("_part", "_turn")


def remap_bilinear(pixel_rows: DataFrame, ortho_map: DataFrame,
                   images: DataFrame | None = None) -> DataFrame:
    """Output pixels (ts, camera, row, col, b, g, r) gathered from frame pixels.

    Blocks of frame pixels meet the output pixels that look into them, and each of these is
    summed where it is formed: frames and map are shuffled, the output is not. The work of
    one busy camera is spread over its blocks and timestamps. Output pixels that see nothing
    are black in every image; they come from the map and the images (ts, camera), whatever
    the frame holds. Without ``images`` these are found from the pixels.
    """
    images = (pixel_rows if images is None else images).select("ts", "camera").distinct()
    met = _spread(_source_blocks(pixel_rows), _block_taps(ortho_map), ["camera", "block_row", "block_col"], images)
    weights = [F.col(f"w{k}") for k in range(4)]

    def taps(name: str) -> list[Column]:
        return [F.get(f"block_{name}", F.col("at") + d) for d in (0, 1, BLOCK + 1, BLOCK + 2)]

    def channel(name: str) -> Column:
        parts = [F.coalesce(w.cast("bigint") * tap, F.lit(0)) for w, tap in zip(weights, taps(name))]
        return F.shiftright(sum(parts[1:], parts[0]) + WEIGHT_SUM // 2, 10).cast("int").alias(name)

    seen = [(w > 0) & tap.isNotNull() for w, tap in zip(weights, taps("b"))]
    gathered = met.where(seen[0] | seen[1] | seen[2] | seen[3]).select(
        "ts", "camera", "row", "col", channel("b"), channel("g"), channel("r"))
    blind = blind_pixels(ortho_map).withColumnsRenamed({"out_row": "row", "out_col": "col"})
    black = _spread(images, blind, ["camera"], images).select(
        "ts", "camera", "row", "col", *[F.lit(0).alias(band) for band in "bgr"])
    return gathered.unionByName(black)
