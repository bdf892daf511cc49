"""Neighbourhood operators on tiles: gradient, local variance, cost and their maxima.

A tile needs a rim of its neighbours' pixels. Each tile sends the strips that others
need, as gray bytes; one join brings a tile together with its rim, so the strips are
what is shuffled, and tiles stored in buckets of their key stay where they are. Tiles of
one size are worked on together. Raster borders mirror without repeating the edge pixel,
as in the pixel form. Keys are not null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orthoweave.functions.pixels import GRAY_WEIGHTS
from orthoweave.operators.matching import with_metadata
from orthoweave.operators.neighbourhood import COST_METHODS, NORM_GUARD, VARIANCE_SIDE
from orthoweave.operators.tiles import by_key, cells_of, joined, packed, shares

GRADIENT_RIM, VARIANCE_RIM = 1, VARIANCE_SIDE // 2
#: Largest values of a raster, by measure.
MEASURES = ("gradient", "variance")

_INT, _BIN, _DOUBLE = T.IntegerType(), T.BinaryType(), T.DoubleType()


def measures_of(method: str) -> tuple[str, ...]:
    if method not in COST_METHODS:
        raise ValueError(f"unknown method: {method!r}")
    return MEASURES if method == "combined" else (method,)


def rim_of(method: str) -> int:
    return max(VARIANCE_RIM if m == "variance" else GRADIENT_RIM for m in measures_of(method))


# --- kernels -------------------------------------------------------------------------------

def gray_of(block: np.ndarray) -> np.ndarray:
    """Luminance of a block of B, G, R bytes."""
    wb, wg, wr = GRAY_WEIGHTS
    v = block.astype(np.int32)
    return (wb * v[..., 0] + wg * v[..., 1] + wr * v[..., 2] + 16384) >> 15


@lru_cache(maxsize=4096)
def mirrored(first: int, last: int, size: int) -> np.ndarray:
    """Positions first..last-1 of an axis of `size`, mirrored into it."""
    period = max(2 * (size - 1), 1)
    at = np.abs(np.arange(first, last)) % period
    return np.where(at > size - 1, period - at, at)


def padded(canvas: np.ndarray, at: tuple[int, int], core: tuple[int, int, int, int], shape: tuple[int, int], rim: int) -> np.ndarray:
    """The core (top, left, bottom, right) of a raster with a rim, from a canvas that lies at
    `at` and covers what the mirrored rim needs."""
    top, left, bottom, right = core
    rows = mirrored(top - rim, bottom + rim, shape[0]) - at[0]
    cols = mirrored(left - rim, right + rim, shape[1]) - at[1]
    return canvas[np.ix_(rows, cols)]


def sobel(gray: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """gx, gy and length of the 3 x 3 Sobel derivatives inside a rim of one pixel."""
    g = gray.astype(np.int64)
    dx, sx = g[..., 2:] - g[..., :-2], g[..., :-2] + 2 * g[..., 1:-1] + g[..., 2:]
    gx, gy = dx[..., :-2, :] + 2 * dx[..., 1:-1, :] + dx[..., 2:, :], sx[..., 2:, :] - sx[..., :-2, :]
    return gx, gy, np.sqrt((gx * gx + gy * gy).astype(np.float64))


def box_variance(gray: np.ndarray, rim: int = VARIANCE_RIM) -> np.ndarray:
    """Population variance in the square around each pixel inside the rim, from summed-area
    tables in integers."""
    g = gray.astype(np.int64)
    side, area = 2 * rim + 1, float((2 * rim + 1) ** 2)

    def box(values: np.ndarray) -> np.ndarray:
        table = np.zeros((*values.shape[:-2], values.shape[-2] + 1, values.shape[-1] + 1), np.int64)
        values.cumsum(-2).cumsum(-1, out=table[..., 1:, 1:])
        return (table[..., side:, side:] - table[..., :-side, side:] - table[..., side:, :-side]
                + table[..., :-side, :-side])

    mean = box(g) / area
    return box(g * g) / area - mean * mean


def measure(gray: np.ndarray, rim: int, names: tuple[str, ...]) -> dict[str, np.ndarray]:
    """Measures inside a rim that is wide enough for all of them, of one block or of many."""
    inner = lambda by: gray[..., rim - by:gray.shape[-2] - rim + by, rim - by:gray.shape[-1] - rim + by]
    kernels = {"gradient": lambda: sobel(inner(GRADIENT_RIM))[2], "variance": lambda: box_variance(inner(VARIANCE_RIM))}
    return {n: kernels[n]() for n in names}


def weighted_cost(measured: dict[str, np.ndarray], largest: dict[str, float | np.ndarray]) -> np.ndarray:
    """Each measure over its largest value in the raster, averaged."""
    weight = 1.0 / len(measured)
    parts = [weight * (v / (largest[n] + NORM_GUARD)) for n, v in measured.items()]
    return parts[0] if len(parts) == 1 else parts[0] + parts[1]


# --- halo exchange -------------------------------------------------------------------------

def with_raster_size(tiles: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Tiles with raster_height and raster_width, from the tiles' places; reads no pixels."""
    dims = tiles.groupBy(*keys).agg(
        F.max(F.col("tile_row") * size + F.col("height")).alias("raster_height"),
        F.max(F.col("tile_col") * size + F.col("width")).alias("raster_width"))
    return with_metadata(tiles, dims, keys)


def _key_fields(df: DataFrame, keys: list[str]) -> list[T.StructField]:
    return [T.StructField(k, df.schema[k].dataType) for k in keys]


def _spans(first: int, count: int, size: int, whole: int, rim: int) -> Iterator[tuple[int, int, int]]:
    """(tile, begin, end): the pixels begin..end-1 of first..first+count-1 that each tile of an
    axis needs within its rim."""
    for tile in range(max(0, first - rim) // size, min(whole - 1, first + count - 1 + rim) // size + 1):
        begin, end = max(first, tile * size - rim), min(first + count, (tile + 1) * size + rim)
        if begin < end:
            yield tile, begin, end


def send_rims(tiles: DataFrame, keys: list[str], rim: int, size: int) -> DataFrame:
    """Strips of gray bytes for other tiles: the tile that needs them, and where they lie."""
    schema = T.StructType([*_key_fields(tiles, keys), *[T.StructField(n, _INT) for n in (
        "tile_row", "tile_col", "top", "left", "strip_height", "strip_width")], T.StructField("strip", _BIN)])
    arrow = to_arrow_schema(schema)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for tile in batch.to_pylist():
                gray = gray_of(np.frombuffer(tile["data"], np.uint8).reshape(tile["height"], tile["width"], 3)).astype(np.uint8)
                top, left = tile["tile_row"] * size, tile["tile_col"] * size
                for r, r0, r1 in _spans(top, tile["height"], size, tile["raster_height"], rim):
                    for c, c0, c1 in _spans(left, tile["width"], size, tile["raster_width"], rim):
                        if (r, c) != (tile["tile_row"], tile["tile_col"]):
                            yield {
                                **{k: tile[k] for k in keys}, "tile_row": r, "tile_col": c, "top": r0, "left": c0,
                                "strip_height": r1 - r0, "strip_width": c1 - c0,
                                "strip": gray[r0 - top:r1 - top, c0 - left:c1 - left].tobytes()}

    return tiles.mapInArrow(lambda batches: packed(send(batches), arrow), schema)


def _with_rim(tile: dict, strips: list[dict], rim: int, size: int) -> np.ndarray:
    """Gray block of a tile with its rim."""
    height, width = tile["raster_height"], tile["raster_width"]
    top, left = tile["tile_row"] * size, tile["tile_col"] * size
    bottom, right = top + tile["height"], left + tile["width"]
    a, b = max(0, top - rim), max(0, left - rim)
    canvas = np.zeros((min(height, bottom + rim) - a, min(width, right + rim) - b), np.uint8)
    own = np.frombuffer(tile["data"], np.uint8).reshape(tile["height"], tile["width"], 3)
    canvas[top - a:bottom - a, left - b:right - b] = gray_of(own)
    for s in strips:
        # a narrower last tile needs less than its strips hold
        h, w = min(s["strip_height"], canvas.shape[0] - (s["top"] - a)), min(s["strip_width"], canvas.shape[1] - (s["left"] - b))
        if h > 0 and w > 0:
            part = np.frombuffer(s["strip"], np.uint8).reshape(s["strip_height"], s["strip_width"])
            canvas[s["top"] - a:s["top"] - a + h, s["left"] - b:s["left"] - b + w] = part[:h, :w]
    return padded(canvas, (a, b), (top, left, bottom, right), (height, width), rim)


def _exchange(tiles: DataFrame, keys: list[str], rim: int, size: int, fields: list[T.StructField], kernel) -> DataFrame:
    """One row per tile: the keys, its place and size, and what the kernel gives. The kernel
    takes tiles of one size and a stack of their gray blocks with rim, and gives a stack (or
    array) by field."""
    schema = T.StructType([*_key_fields(tiles, keys), *[T.StructField(n, _INT) for n in ("tile_row", "tile_col", "height", "width")], *fields])
    arrow = to_arrow_schema(schema)
    own = [f.name for f in schema.fields[:len(keys) + 4]]

    def value(found: np.ndarray, field: T.StructField):
        return found.tobytes() if field.dataType == _BIN else float(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in shares(batch):
                by_shape: dict[tuple[int, int], list[dict]] = {}
                for tile in part.to_pylist():
                    by_shape.setdefault((tile["height"], tile["width"]), []).append(tile)
                for some in by_shape.values():
                    found = kernel(some, np.stack([_with_rim(tile, tile["_strips"] or [], rim, size) for tile in some]))
                    for i, tile in enumerate(some):
                        yield {**{n: tile[n] for n in own}, **{f.name: value(found[f.name][i], f) for f in fields}}

    place = [*keys, "tile_row", "tile_col"]
    strips = by_key(send_rims(tiles, keys, rim, size), *place).agg(F.collect_list(F.struct(
        "top", "left", "strip_height", "strip_width", "strip")).alias("_strips"))
    return tiles.join(strips.hint("merge"), place, "left").mapInArrow(lambda batches: packed(run(batches), arrow), schema)


# --- operators -----------------------------------------------------------------------------

def _sized(tiles: DataFrame, keys: list[str], size: int) -> DataFrame:
    return tiles if "raster_height" in tiles.columns else with_raster_size(tiles, keys, size)


def sobel_tiles(tiles: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Tiles of gx, gy (int32) and gradient (float64)."""
    def kernel(some: list[dict], gray: np.ndarray) -> dict[str, np.ndarray]:
        gx, gy, length = sobel(gray)
        return {"gx": gx.astype(np.int32), "gy": gy.astype(np.int32), "gradient": length}

    fields = [T.StructField(n, _BIN) for n in ("gx", "gy", "gradient")]
    return _exchange(_sized(tiles, keys, size), keys, GRADIENT_RIM, size, fields, kernel)


def variance_tiles(tiles: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Tiles of the local variance (float64)."""
    return _exchange(_sized(tiles, keys, size), keys, VARIANCE_RIM, size, [T.StructField("variance", _BIN)],
                     lambda some, gray: {"variance": box_variance(gray)})


def region_max_tiles(tiles: DataFrame, keys: list[str], size: int, names: tuple[str, ...] = MEASURES) -> DataFrame:
    """Largest value of each measure per raster, from one number a tile."""
    rim = max(VARIANCE_RIM if n == "variance" else GRADIENT_RIM for n in names)
    found = _exchange(_sized(tiles, keys, size), keys, rim, size, [T.StructField(n, _DOUBLE) for n in names],
                      lambda some, gray: {n: v.max(axis=(-2, -1)) for n, v in measure(gray, rim, names).items()})
    return found.groupBy(*keys).agg(*[F.max(n).alias(f"max_{n}") for n in names])


def cost_tiles(tiles: DataFrame, keys: list[str], size: int, method: str = "gradient") -> DataFrame:
    """Tiles of the cost (float64). The rims travel twice, for the maxima and for the cost;
    no block of measures does."""
    names, rim = measures_of(method), rim_of(method)
    sized = _sized(tiles, keys, size)
    largest = region_max_tiles(sized, keys, size, names)

    def kernel(some: list[dict], gray: np.ndarray) -> dict[str, np.ndarray]:
        tops = {n: np.array([tile[f"max_{n}"] for tile in some])[:, None, None] for n in names}
        return {"cost": weighted_cost(measure(gray, rim, names), tops)}

    return _exchange(with_metadata(sized, largest, keys), keys, rim, size, [T.StructField("cost", _BIN)], kernel)


def to_rows(tiles: DataFrame, keys: list[str], values: dict[str, T.DataType], size: int) -> DataFrame:
    """Rows (keys, row, col, values) of tiles of numbers."""
    schema = T.StructType([*_key_fields(tiles, keys), T.StructField("row", _INT), T.StructField("col", _INT),
                           *[T.StructField(n, t) for n, t in values.items()]])
    arrow = to_arrow_schema(schema)
    kinds = {n: arrow.field(n).type.to_pandas_dtype() for n in values}

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shares(batch):
                tile, _, row, col = cells_of(part, size)
                columns = {"row": row, "col": col, **{n: np.frombuffer(joined(part.column(n)), k) for n, k in kinds.items()}}
                columns |= {k: part.column(k).take(pa.array(tile)) for k in keys}
                yield pa.RecordBatch.from_pydict({f.name: columns[f.name] for f in arrow}, schema=arrow)

    return tiles.mapInArrow(unpack, schema)
