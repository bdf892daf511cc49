"""Tile form of rasters: the same operators with pixels kept in binary blocks.

Frame and ortho tiles are rows (ts, camera, tile_row, tile_col, height, width,
data) with B, G, R bytes in row order. Spark partitions, shuffles and joins
tiles; NumPy works inside one tile. A shuffle then moves about as many bytes as
the images hold, where pixel rows would move twenty times as many.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orthoweave.operators import mosaic
from orthoweave.operators.matching import salted_join, with_metadata
from orthoweave.operators.remap import SUBPIXEL, WEIGHT_SUM

TILE = 256

# Timestamps that share one copy of a lookup tile in a task.
TS_PER_BLOCK = 16

# Pixels that are unpacked at once.
PIXELS_AT_ONCE = 1 << 20

# Bytes, and rows, that go out together.
OUT_BYTES, OUT_ROWS = 4 << 20, 10_000


def _struct(*fields: tuple[str, T.DataType], keys: list[T.StructField] = ()) -> T.StructType:
    return T.StructType([*keys, *[T.StructField(n, t) for n, t in fields]])


_INT, _BIN = T.IntegerType(), T.BinaryType()
_BLOCK = (("tile_row", _INT), ("tile_col", _INT), ("height", _INT), ("width", _INT))


def _key_types(df: DataFrame, *names: str) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType) for n in names]


def _table(schema: pa.Schema, rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def by_key(df: DataFrame, *keys: str) -> GroupedData:
    """Groups whose work is in NumPy. Rows are dealt to as many tasks as the session has
    shuffle partitions: Spark would merge partitions by their bytes, which say little here."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).groupBy(*keys)


def dealt(df: DataFrame, size: int, *keys: str) -> DataFrame:
    """Small tiles dealt as by by_key(); those of full size stay where they are, as many tasks
    as their bytes need have them already."""
    return df if size >= TILE else df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def in_order(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt as by by_key(), those of a group one after the other. A task reads many
    groups as one stream, where a group of its own costs Spark milliseconds."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)


def groups_of(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """(key, rows) of the groups of a task's rows in order. The rows of a group are read as they
    are asked for, however many they are."""
    rows = (row for batch in batches for row in batch.to_pylist())
    return groupby(rows, key=itemgetter(*keys))


def tables_of(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The groups of a task's rows in order as tables, for groups of many rows that are small
    enough to be held."""
    held: list[pa.RecordBatch] = []
    key = lambda batch: [batch.column(k)[0].as_py() for k in keys]
    for batch in batches:
        new = np.zeros(batch.num_rows, bool)
        for k in keys:
            codes = batch.column(k).dictionary_encode("encode").indices.to_numpy()
            new[1:] |= codes[1:] != codes[:-1]
        if not batch.num_rows:
            continue
        starts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for begin, end in zip(starts, starts[1:], strict=False):
            part = batch.slice(begin, end - begin)
            if held and (begin or key(held[0]) != key(part)):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def packed(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about OUT_BYTES of binary values, of OUT_ROWS at most."""
    held, size = [], 0
    blocks = [f.name for f in schema if pa.types.is_binary(f.type)]
    for row in rows:
        held.append(row)
        size += sum(len(row.get(n) or b"") for n in blocks)
        if size >= OUT_BYTES or len(held) >= OUT_ROWS:
            yield from _table(schema, held).to_batches()
            held, size = [], 0
    if held:
        yield from _table(schema, held).to_batches()


def shares(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of tiles, of about PIXELS_AT_ONCE pixels or a tile."""
    sizes = batch.column("height").to_numpy().astype(np.int64) * batch.column("width").to_numpy()
    share = (np.cumsum(sizes) - sizes) // PIXELS_AT_ONCE
    cuts = [*np.flatnonzero(np.diff(share, prepend=-1)).tolist(), len(sizes)]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(begin, end - begin)


def joined(blocks: pa.Array) -> bytes:
    """The bytes of a column, one row after the other."""
    return b"".join(b.as_buffer() for b in blocks)


def cells_of(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all pixels of a batch of tiles: the tile's place in the batch, the place in the
    tile, and row and column in the raster."""
    high, wide, top, left = (batch.column(n).to_numpy() for n in ("height", "width", "tile_row", "tile_col"))
    sizes = high.astype(np.int64) * wide
    tile = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(tile)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row = (at // wide[tile] + top[tile].astype(np.int64) * size).astype(np.int32)
    col = (at % wide[tile] + left[tile].astype(np.int64) * size).astype(np.int32)
    return tile, at, row, col


def tile_fault(size: int = TILE) -> Column:
    """What is wrong with a tile, or NULL: a tile must have bytes for its size, and its size
    and place must fit the grid."""
    def message(text: str, *values: str) -> Column:
        return F.format_string("tile (%s, %s): " + text, "tile_row", "tile_col", *values)

    sides = F.coalesce((F.col("height") > 0) & (F.col("width") > 0) & (F.col("height") <= size) & (F.col("width") <= size), F.lit(False))
    return (
        F.when(F.coalesce((F.col("tile_row") < 0) | (F.col("tile_col") < 0), F.lit(True)), message("no such place"))
        .when(~sides, message("size %s x %s", "height", "width"))
        .when(F.col("data").isNull(), message("no data"))
        .when(F.octet_length("data") != F.col("height") * F.col("width") * 3, F.format_string(
            "tile (%s, %s): %s bytes for %s x %s", "tile_row", "tile_col", F.octet_length("data"), "height", "width")))


# --- conversion ----------------------------------------------------------------------------

def _gapless(cells: str, at: str, width: Column | int) -> Column:
    """Hex digits of cells (at, hex), sorted by ``at``, each ``width`` pixels wide; cells that
    are missing in between are black, and of equal places the first one counts."""
    def piece(cell: Column, i: Column) -> Column:
        before = F.coalesce(F.get(F.col(cells), i - 1)[at], F.lit(-1))
        black = F.repeat(F.lit("000000"), ((cell[at] - before - 1) * width).cast("int"))
        return F.when(cell[at] > before, F.concat(black, cell["hex"])).otherwise("")

    return F.array_join(F.transform(cells, piece), "")


def to_tiles(pixel_rows: DataFrame, size: int = TILE) -> DataFrame:
    """Tiles of dense pixel rows: pixels become the rows of a tile, and these the tile. One
    shuffle; no task holds more than single tiles and the rows of some."""
    keys = ("ts", "camera", "tile_row", "tile_col")
    byte = [F.coalesce(F.col(band), F.lit(0)).bitwiseAND(255) for band in "bgr"]
    placed = pixel_rows.select(
        "ts", "camera", F.floor(F.col("row") / size).cast("int").alias("tile_row"),
        F.floor(F.col("col") / size).cast("int").alias("tile_col"), "row", "col",
        F.lpad(F.hex(byte[0] * 65536 + byte[1] * 256 + byte[2]), 6, "0").alias("hex"))
    placed = placed.withColumns({
        "row": F.col("row") - F.col("tile_row") * size, "col": F.col("col") - F.col("tile_col") * size})
    dealt = placed.repartition(int(pixel_rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    rows = dealt.groupBy(*keys, "row").agg(
        F.array_sort(F.collect_list(F.struct("col", "hex"))).alias("_cells"), (F.max("col") + 1).alias("width"),
    ).select(*keys, "row", "width", _gapless("_cells", "col", 1).alias("hex"))
    blocks = rows.groupBy(*keys).agg(
        (F.max("row") + 1).cast("int").alias("height"), F.max("width").cast("int").alias("width"),
        F.array_sort(F.collect_list(F.struct("row", "hex"))).alias("_short"))
    # rows that end early are black up to the width of the tile
    whole = blocks.withColumn("_rows", F.transform("_short", lambda r: F.struct(
        r["row"].alias("row"), F.rpad(r["hex"], F.col("width") * 6, F.lit("0")).alias("hex"))))
    return whole.select(*keys, "height", "width", F.unhex(_gapless("_rows", "row", F.col("width"))).alias("data"))


def _pixels_of(tile: dict, size: int) -> np.ndarray:
    return np.frombuffer(tile["data"], np.uint8).reshape(tile["height"], tile["width"], 3)


def to_pixels(tiles: DataFrame, size: int = TILE) -> DataFrame:
    """Pixel rows (ts, camera, row, col, b, g, r) of tiles; of tiles with a column ``listed``,
    those pixels whose bit is set."""
    names = [n for n in ("ts", "camera") if n in tiles.columns]
    schema = _struct(*[(n, _INT) for n in ("row", "col", "b", "g", "r")], keys=_key_types(tiles, *names))
    arrow = _arrow(schema)

    def rows_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = batch.column("height").to_numpy().astype(np.int64) * batch.column("width").to_numpy()
        if [len(d.as_buffer()) for d in batch.column("data")] != (3 * sizes).tolist():
            raise ValueError("a tile's bytes do not fit its size")
        block = np.frombuffer(joined(batch.column("data")), np.uint8).reshape(-1, 3)
        tile, at, row, col = cells_of(batch, size)
        if "listed" in batch.schema.names:
            octets = (sizes + 7) // 8
            bits = np.unpackbits(np.frombuffer(joined(batch.column("listed")), np.uint8))
            kept = np.flatnonzero(bits[(np.cumsum(octets) - octets)[tile] * 8 + at])
            tile, row, col, block = tile[kept], row[kept], col[kept], block[kept]
        columns = {"row": row, "col": col, **{band: block[:, k].astype(np.int32) for k, band in enumerate("bgr")}}
        columns |= {n: batch.column(n).take(pa.array(tile)) for n in names}
        return pa.RecordBatch.from_pydict({f.name: columns[f.name] for f in arrow}, schema=arrow)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shares(batch):
                yield rows_of(part)

    return tiles.mapInArrow(unpack, schema)


def map_tiles(ortho_map: DataFrame, size: int = TILE, listed: bool = False) -> DataFrame:
    """Lookup map in tiles: source positions as float32 blocks, far outside where absent.

    Written once per calibration version. A task reads its tiles as one stream and holds one
    of them. With ``listed``, a column of that name holds a bit per pixel, set where the map
    has a row.
    """
    keys = ("camera", "tile_row", "tile_col")
    schema = _struct(*_BLOCK, ("image_height", _INT), ("image_width", _INT),
                     ("src_x", _BIN), ("src_y", _BIN), *([("listed", _BIN)] if listed else []),
                     keys=_key_types(ortho_map, "camera"))
    arrow = _arrow(schema)

    def tile(cells: pa.Table) -> dict:
        camera, tile_row, tile_col = (cells[k][0].as_py() for k in keys)
        row = cells["row"].to_numpy() - tile_row * size
        col = cells["col"].to_numpy() - tile_col * size
        height, width = int(row.max()) + 1, int(col.max()) + 1
        blocks = {}
        for name in ("src_x", "src_y"):
            block = np.full((height, width), np.nan, np.float32)
            block[row, col] = cells[name].to_numpy(zero_copy_only=False)
            blocks[name] = block.tobytes()
        if listed:
            bits = np.zeros((height, width), bool)
            bits[row, col] = True
            blocks["listed"] = np.packbits(bits).tobytes()
        return {
            "camera": camera, "tile_row": tile_row, "tile_col": tile_col, "height": height,
            "width": width, "image_height": cells["image_height"][0].as_py(),
            "image_width": cells["image_width"][0].as_py(), **blocks}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed(map(tile, tables_of(batches, *keys)), arrow)

    placed = ortho_map.select(
        "camera", F.floor(F.col("row") / size).cast("int").alias("tile_row"),
        F.floor(F.col("col") / size).cast("int").alias("tile_col"),
        "row", "col", "src_x", "src_y", "image_height", "image_width")
    return in_order(placed, *keys).mapInArrow(build, schema)


# --- gather --------------------------------------------------------------------------------

def _subpixels(tile: dict, name: str) -> np.ndarray:
    """Source positions in 1/32 pixels, outside where no pixel of the image is reached."""
    at = np.frombuffer(tile[name], np.float32).reshape(tile["height"], tile["width"]).astype(np.float64)
    usable = (at > -1) & (at < tile["image_width" if name == "src_x" else "image_height"])
    return np.where(usable, np.rint(np.where(usable, at, 0) * SUBPIXEL), -4 * SUBPIXEL).astype(np.int64)


def tile_deps(lookup: DataFrame, size: int = TILE) -> DataFrame:
    """Source tiles that each output tile of the map reads."""
    schema = _struct(*[(n, _INT) for n in ("tile_row", "tile_col", "src_tile_row", "src_tile_col")],
                     keys=_key_types(lookup, "camera"))
    arrow = _arrow(schema)

    def deps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile in batch.to_pylist():
                row, col = _subpixels(tile, "src_y") >> 5, _subpixels(tile, "src_x") >> 5
                seen = set()
                for dr in (0, 1):
                    for dc in (0, 1):
                        r, c = row + dr, col + dc
                        ok = ((r >= 0) & (r < tile["image_height"])
                              & (c >= 0) & (c < tile["image_width"]))
                        seen |= set(zip((r[ok] // size).tolist(), (c[ok] // size).tolist()))
                rows = [{"camera": tile["camera"], "tile_row": tile["tile_row"],
                         "tile_col": tile["tile_col"], "src_tile_row": r, "src_tile_col": c}
                        for r, c in sorted(seen)]
                yield from _table(arrow, rows).to_batches()

    return lookup.mapInArrow(deps, schema)


def _canvases(sources: list[dict], size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Source tiles joined to one block if they lie together, else one by one: (top, left, block)."""
    if not sources:
        return
    rows, cols = ([s[k] for s in sources] for k in ("src_tile_row", "src_tile_col"))
    high, wide = max(rows) - min(rows) + 1, max(cols) - min(cols) + 1
    if high * wide > 4 * len(sources):
        for source in sources:
            yield source["src_tile_row"] * size, source["src_tile_col"] * size, _pixels_of(source, size)
        return
    canvas = np.zeros((high * size, wide * size, 3), np.uint8)
    for source in sources:
        top, left = (source["src_tile_row"] - min(rows)) * size, (source["src_tile_col"] - min(cols)) * size
        canvas[top:top + source["height"], left:left + source["width"]] = _pixels_of(source, size)
    yield min(rows) * size, min(cols) * size, canvas


#: Bits of a channel in a packed pixel: room for 255 times the sum of the weights.
_LANE = 21


class Gather:
    """Bilinear gather into the pixels of some output tiles, one tile after the other. Places
    and weights are found once, for all timestamps; the three channels of a pixel go through
    the sum in one 64-bit number."""

    def __init__(self, lookups: list[dict], size: int):
        self.size = size
        sy, sx = (np.concatenate([_subpixels(tile, name).ravel() for tile in lookups]) for name in ("src_y", "src_x"))
        self.row, self.col = sy >> 5, sx >> 5
        fy, fx = (sy & 31).astype(np.uint64), (sx & 31).astype(np.uint64)
        usable = (self.row > -2) & (self.col > -2)
        whole = np.uint64(SUBPIXEL)
        self.weights = [np.where(usable, wy * wx, np.uint64(0)) for wy in (whole - fy, fy) for wx in (whole - fx, fx)]
        # the box that is read, a pixel wider than the image where positions lie on its border
        self.top, self.left = (int(v[usable].min()) if usable.any() else 0 for v in (self.row, self.col))
        self.high, self.wide = (int(v[usable].max()) + 2 - low if usable.any() else 2
                                for v, low in ((self.row, self.top), (self.col, self.left)))
        at = np.where(usable, (self.row - self.top) * self.wide + (self.col - self.left), 0)
        self.taps = [at + d for d in (0, 1, self.wide, self.wide + 1)]
        # source tiles that lie far apart are added one after the other instead
        self.compact = self.high * self.wide <= 16 * max(len(self.row), size * size)

    def _sum(self, canvas: np.ndarray, taps: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
        wide = canvas.astype(np.uint64)
        packed = (wide[..., 0] | wide[..., 1] << np.uint64(_LANE) | wide[..., 2] << np.uint64(2 * _LANE)).ravel()
        total = packed.take(taps[0])
        total *= weights[0]
        for tap, weight in zip(taps[1:], weights[1:], strict=True):
            part = packed.take(tap)
            part *= weight
            total += part
        return total

    def __call__(self, sources: list[dict]) -> np.ndarray:
        if self.compact:
            canvas = np.zeros((self.high, self.wide, 3), np.uint8)
            for s in sources:
                y, x = s["src_tile_row"] * self.size - self.top, s["src_tile_col"] * self.size - self.left
                a, b = max(0, y), min(self.high, y + s["height"])
                c, d = max(0, x), min(self.wide, x + s["width"])
                if a < b and c < d:
                    canvas[a:b, c:d] = _pixels_of(s, self.size)[a - y:b - y, c - x:d - x]
            total = self._sum(canvas, self.taps, self.weights)
        else:
            total = np.zeros(len(self.row), np.uint64)
            for top, left, block in _canvases(sources, self.size):
                height, width = block.shape[:2]
                taps, weights = [], []
                for k, (dr, dc) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
                    r, c = self.row + (dr - top), self.col + (dc - left)
                    inside = (r >= 0) & (r < height) & (c >= 0) & (c < width)
                    taps.append(np.where(inside, r * width + c, 0))
                    weights.append(np.where(inside, self.weights[k], np.uint64(0)))
                total += self._sum(block, taps, weights)
        half, shift, byte = np.uint64(WEIGHT_SUM // 2), np.uint64(WEIGHT_SUM.bit_length() - 1), np.uint64(255)
        out = np.empty((len(self.row), 3), np.uint8)
        for k in range(3):
            lane = total >> np.uint64(k * _LANE)
            lane &= np.uint64((1 << _LANE) - 1)
            lane += half
            out[:, k] = (lane >> shift) & byte
        return out


def remap_tiles(frame_tiles: DataFrame, lookup: DataFrame, deps: DataFrame | None = None,
                size: int = TILE, images: DataFrame | None = None) -> DataFrame:
    """Ortho tiles gathered from frame tiles.

    Frame tiles go to the output tiles that read them. A group then is one output
    tile, or a square of smaller ones of about TILE pixels a side, of about
    ``TS_PER_BLOCK`` timestamps of one camera, so the lookup tiles travel once for all of
    them and a frame tile once for all tiles of the square; the block number also splits
    a camera with very many frames. Every output tile of every image (ts, camera) is
    written, black where it sees nothing or the frame lacks the tiles it reads. Without
    ``images`` these are found from the tiles. The bits ``listed`` of a lookup go with
    its output.
    """
    deps = tile_deps(lookup, size) if deps is None else deps
    images = (frame_tiles if images is None else images).select("ts", "camera").distinct()
    counts = images.groupBy("camera").agg(F.ceil(F.count("*") / F.lit(TS_PER_BLOCK)).cast("int").alias("_n"))
    blocked = images.join(counts, "camera").select(
        "ts", "camera", F.pmod(F.xxhash64("ts"), F.col("_n")).cast("int").alias("block"))
    times = blocked.groupBy("camera", "block").agg(F.collect_list("ts").alias("times"))
    kept = [n for n in ("listed",) if n in lookup.columns]
    schema = _struct(*_BLOCK, ("data", _BIN), *[(n, _BIN) for n in kept], keys=_key_types(frame_tiles, "ts", "camera"))
    arrow = _arrow(schema)

    def binary(parts: list[bytes], sizes: np.ndarray) -> pa.Array:
        ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(parts))])

    def gather(sources: pa.Table, lookups: pa.Table) -> pa.Table:
        if lookups.num_rows == 0:
            return arrow.empty_table()
        by_ts: dict = {}
        for source in sources.to_pylist():
            by_ts.setdefault(source["ts"], []).append(source)
        ts = lookups["times"][0].as_py()
        found = lookups.drop_columns("times").to_pylist()
        gathered = Gather(found, size)
        sizes = np.array([tile["height"] * tile["width"] * 3 for tile in found])
        columns = {n: pa.array([tile[n] for tile in found] * len(ts), arrow.field(n).type)
                   for n in ("camera", "tile_row", "tile_col", "height", "width")}
        columns["ts"] = pa.array(ts, arrow.field("ts").type).take(pa.array(np.repeat(np.arange(len(ts)), len(found))))
        columns["data"] = binary([gathered(by_ts.get(t, [])).tobytes() for t in ts], np.tile(sizes, len(ts)))
        for n in kept:
            bits = [tile[n] for tile in found] * len(ts)
            columns[n] = binary(bits, np.array([len(x) for x in bits]))
        return pa.table({f.name: columns[f.name] for f in arrow}, schema=arrow)

    side = max(1, TILE // size)
    square = [F.floor(F.col(n) / side).cast("int").alias(f"square_{n}") for n in ("tile_row", "tile_col")]
    read = deps.select("camera", *square, "src_tile_row", "src_tile_col").distinct()
    sources = salted_join(
        with_metadata(frame_tiles, blocked, ["ts", "camera"]).withColumnsRenamed(
            {"tile_row": "src_tile_row", "tile_col": "src_tile_col"}),
        read, ["camera", "src_tile_row", "src_tile_col"], ["ts"])
    keys = ["camera", "square_tile_row", "square_tile_col", "block"]
    # a column of its own: both sides of the cogroup come from the same image list
    repeated = lookup.select("*", *square).join(times.withColumn("block", F.col("block") + 0), "camera")
    return by_key(sources, *keys).cogroup(by_key(repeated, *keys)).applyInArrow(gather, schema)


# --- mosaic --------------------------------------------------------------------------------

_PIECE = ("position", "top", "left", "region_top", "region_left", "region_height", "region_width",
          "height", "width")


def _priority(piece: dict, method: str) -> np.ndarray:
    """Priority of each pixel of a piece of a placed image."""
    if method == "order":
        return np.full((piece["height"], piece["width"]), float(piece["position"]))
    cy, cx = piece["region_height"] / 2, piece["region_width"] / 2
    row = piece["region_top"] + np.arange(piece["height"], dtype=np.float64)[:, None] - cy
    col = piece["region_left"] + np.arange(piece["width"], dtype=np.float64)[None, :] - cx
    return 1.0 - np.sqrt(col * col + row * row) / np.sqrt(cx * cx + cy * cy)


def _mosaic_pieces(ortho_tiles: DataFrame, placed: DataFrame, size: int) -> DataFrame:
    """Ortho tiles clipped to the mosaic and cut along its tiles."""
    placed_tiles = with_metadata(
        ortho_tiles, placed.select("ts", "camera", *mosaic.PLACEMENT), ["ts", "camera"])
    # tiles beside the region show nothing
    for tile, side, start, region in (("tile_row", "height", "src_row", "region_height"),
                                      ("tile_col", "width", "src_col", "region_width")):
        first = F.col(tile) * size - F.col(start)
        placed_tiles = placed_tiles.where((first < F.col(region)) & (first + F.col(side) > 0))
    schema = _struct(("tile_row", _INT), ("tile_col", _INT), *[(n, _INT) for n in _PIECE],
                     ("data", _BIN), keys=_key_types(ortho_tiles, "ts"))
    arrow = _arrow(schema)

    def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for tile in batch.to_pylist():
                block = _pixels_of(tile, size)
                # first pixel of the tile in region coordinates
                top = tile["tile_row"] * size - tile["src_row"]
                left = tile["tile_col"] * size - tile["src_col"]
                r0, r1 = max(top, 0), min(top + tile["height"], tile["region_height"])
                c0, c1 = max(left, 0), min(left + tile["width"], tile["region_width"])
                m_row, m_col = tile["row_start"], tile["col_start"]
                for t_row in range((r0 + m_row) // size, (max(r1, r0 + 1) - 1 + m_row) // size + 1):
                    for t_col in range((c0 + m_col) // size, (max(c1, c0 + 1) - 1 + m_col) // size + 1):
                        a0, a1 = max(r0, t_row * size - m_row), min(r1, (t_row + 1) * size - m_row)
                        b0, b1 = max(c0, t_col * size - m_col), min(c1, (t_col + 1) * size - m_col)
                        if a0 >= a1 or b0 >= b1:
                            continue
                        part = block[a0 - top:a1 - top, b0 - left:b1 - left]
                        if not part.any():
                            continue
                        yield {
                            "ts": tile["ts"], "tile_row": t_row, "tile_col": t_col,
                            "position": tile["position"],
                            "top": a0 + m_row - t_row * size, "left": b0 + m_col - t_col * size,
                            "region_top": a0, "region_left": b0,
                            "region_height": tile["region_height"],
                            "region_width": tile["region_width"],
                            "height": part.shape[0], "width": part.shape[1],
                            "data": part.tobytes()}

    return dealt(placed_tiles, size, "ts", "camera", "tile_row", "tile_col").mapInArrow(
        lambda batches: packed(pieces_of(batches), arrow), schema)


def mosaic_tiles(ortho_tiles: DataFrame, images: DataFrame, method: str = "center",
                 resolution: float | None = None, strict: bool = True,
                 size: int = TILE) -> DataFrame:
    """Priority mosaic in tiles (ts, tile_row, tile_col, height, width, data, positions).

    ``positions`` holds the image position per pixel as int32, 0 where empty. The
    pieces of one mosaic tile stream through a fixed-size best-so-far block, so a
    tile that very many images cover needs no more memory than any other.
    """
    if method not in mosaic.METHODS:
        raise ValueError(f"unknown method: {method!r}")
    placed = mosaic.place_images(images, resolution, strict)
    schema = _struct(*_BLOCK, ("data", _BIN), ("positions", _BIN), keys=_key_types(ortho_tiles, "ts"))
    arrow = _arrow(schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (ts, tile_row, tile_col), pieces in groups_of(batches, "ts", "tile_row", "tile_col"):
            best = np.zeros((size, size), np.float64)
            pixels = np.zeros((size, size, 3), np.uint8)
            positions = np.zeros((size, size), np.int32)
            for piece in pieces:
                rows = slice(piece["top"], piece["top"] + piece["height"])
                cols = slice(piece["left"], piece["left"] + piece["width"])
                new = _pixels_of(piece, size)
                rank = _priority(piece, method)
                at = positions[rows, cols]
                # equal priority: the first file wins, in whatever order the pieces come
                better = new.any(axis=2) & (
                    (rank > best[rows, cols])
                    | ((rank == best[rows, cols]) & (at > 0) & (piece["position"] < at)))
                best[rows, cols][better] = rank[better]
                pixels[rows, cols][better] = new[better]
                at[better] = piece["position"]
            yield {"ts": ts, "tile_row": tile_row, "tile_col": tile_col, "height": size, "width": size,
                   "data": pixels.tobytes(), "positions": positions.tobytes()}

    pieces = in_order(_mosaic_pieces(ortho_tiles, placed, size), "ts", "tile_row", "tile_col")
    return pieces.mapInArrow(lambda batches: packed(fold(batches), arrow), schema)


def mosaic_tile_pixels(tiles: DataFrame, size: int = TILE) -> DataFrame:
    """Pixel rows (ts, mosaic_row, mosaic_col, b, g, r, position) of mosaic tiles."""
    names = ("mosaic_row", "mosaic_col", "b", "g", "r", "position")
    schema = _struct(*[(n, _INT) for n in names], keys=_key_types(tiles, "ts"))
    arrow = _arrow(schema)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shares(batch):
                tile, _, row, col = cells_of(part, size)
                position = np.frombuffer(joined(part.column("positions")), np.int32)
                shown = np.flatnonzero(position)
                block = np.frombuffer(joined(part.column("data")), np.uint8).reshape(-1, 3)[shown].astype(np.int32)
                columns = {"ts": part.column("ts").take(pa.array(tile[shown])), "mosaic_row": row[shown], "mosaic_col": col[shown],
                           "b": block[:, 0], "g": block[:, 1], "r": block[:, 2], "position": position[shown]}
                yield pa.RecordBatch.from_pydict({f.name: columns[f.name] for f in arrow}, schema=arrow)

    return tiles.mapInArrow(unpack, schema)
