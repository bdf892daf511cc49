"""Seam mosaic: images are merged left to right along cheapest paths, on tiles.

A cell of the mosaic shows the last image whose seam lies at or left of it, or the first
image there. So the mosaic follows from the seams alone, and seams are all that is
computed step by step: an image needs the seams of earlier ones only where three images
meet. Images are dealt to waves by that rule (from their places, not their pixels), and a
wave cuts the seams of all its images, of all timestamps, at once. A row of cameras whose
neighbours overlap pairwise is one wave.

Inside an image the path moves at most one row a column. A block of tile_size columns
therefore needs tile_size rows above and below and the sums of the column before, and the
blocks of a column of tiles are worked on side by side. Paths are traced back from stored
sums: first from block to block, then inside all blocks at once. No task holds an image or
a timestamp.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orthoweave.functions import pixels
from orthoweave.operators import mosaic, tile_costs, tiles
from orthoweave.operators.matching import with_metadata
from orthoweave.session import work_dir

CELL = ["ts", "mosaic_row", "mosaic_col"]
REGION = ["row_start", "col_start", "region_height", "region_width"]
PAIR = ["ts", "seq"]

_INT, _BIN, _DOUBLE = T.IntegerType(), T.BinaryType(), T.DoubleType()


def _fields(*names: str, kind: T.DataType = _INT) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names]


def _schema(df: DataFrame, *fields: T.StructField) -> T.StructType:
    """ts and seq as in df, then the fields."""
    return T.StructType([*[T.StructField(n, df.schema[n].dataType) for n in PAIR], *fields])


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


def _stored(df: DataFrame, path: str, *by: str) -> DataFrame:
    """Writes a step table and reads it back: the next step does not repeat this one."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def overlap(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Cells where both the new image and the mosaic have data.

    Both sides are rows (ts, mosaic_row, mosaic_col, b, g, r); the mosaic's values
    come back as old_b, old_g, old_r.
    """
    old = existing.where(pixels.valid_pixel()).select(
        *CELL, *[F.col(c).alias(f"old_{c}") for c in "bgr"])
    return new.where(pixels.valid_pixel()).join(old, CELL)


# --- waves ---------------------------------------------------------------------------------

def seam_waves(placed: DataFrame) -> DataFrame:
    """Adds wave and olds, the earlier images of the ts that overlap the image.

    An image waits for the seam of an earlier one if a third, still earlier, meets both
    inside it. Reads metadata only: a group is the image list of one timestamp.
    """
    schema = T.StructType([*placed.schema.fields, T.StructField("wave", _INT), T.StructField("olds", T.ArrayType(_INT))])

    arrow = to_arrow_schema(schema)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for _, group in tiles.groups_of(batches, "ts"):
            images = sorted(group, key=lambda image: image["seq"])
            top, left, height, width = (np.array([image[c] for image in images], np.int64) for c in REGION)
            bottom, right = top + height, left + width
            waves = np.zeros(len(images), np.int32)
            for k, image in enumerate(images):
                a, b = np.maximum(top[:k], top[k]), np.minimum(bottom[:k], bottom[k])
                c, d = np.maximum(left[:k], left[k]), np.minimum(right[:k], right[k])
                before = np.flatnonzero((a < b) & (c < d))
                wave = 1 if len(before) else 0
                for j in before.tolist():
                    i = before[before < j]
                    met = (np.maximum(a[i], a[j]) < np.minimum(b[i], b[j])) & (np.maximum(c[i], c[j]) < np.minimum(d[i], d[j]))
                    if met.any():
                        wave = max(wave, int(waves[j]) + 1)
                waves[k] = wave
                yield {**image, "wave": wave, "olds": [images[j]["seq"] for j in before.tolist()]}

    return tiles.in_order(placed, "ts").mapInArrow(lambda batches: tiles.packed(deal(batches), arrow), schema)


# --- lines from blocks of cost -------------------------------------------------------------
#
# Cost blocks are rows (ts, seq, tile_row, tile_col, step, left, right, low, high, top,
# first_col, height, width, cost): a part of a mosaic tile, infinite where the images do not
# overlap. left and right are the first and last column of the overlap, low and high its first
# and last row of tiles, step counts its columns of tiles. Rows are those of the mosaic.

_EXTENT = ("left", "right", "low", "high")
_PLACE = ("tile_row", "tile_col", "step", *_EXTENT, "top", "first_col", "height", "width")
_BLOCK_FIELDS = [*_fields(*_PLACE), T.StructField("cost", _BIN)]
_SUMS_FIELDS = [*_fields("step", "tile_row", "low", "high", "top"), T.StructField("reach", _BIN), T.StructField("origin", _BIN),
                T.StructField("end", T.StructType([T.StructField("reach", _DOUBLE), T.StructField("row", _INT)]))]


def _spread(df: DataFrame) -> DataFrame:
    """Every row to the blocks above, at and below its own, as far as the overlap has them;
    `own` marks the block itself."""
    to = F.explode(F.expr("sequence(greatest(tile_row - 1, low), least(tile_row + 1, high))")).alias("_to")
    return df.select("*", to).withColumn("own", F.col("tile_row") == F.col("_to")).withColumn("tile_row", F.col("_to")).drop("_to")


def _canvas(parts: list[dict], top: int, bottom: int, first: int, last: int) -> np.ndarray:
    """Cost of the rows top..bottom-1 and the columns first..last."""
    grid = np.full((bottom - top, last - first + 1), np.inf)
    for p in parts:
        block = np.frombuffer(p["cost"]).reshape(p["height"], p["width"])
        a, b = max(top, p["top"]), min(bottom, p["top"] + p["height"])
        c, d = max(first, p["first_col"]), min(last + 1, p["first_col"] + p["width"])
        if a < b and c < d:
            grid[a - top:b - top, c - first:d - first] = block[a - p["top"]:b - p["top"], c - p["first_col"]:d - p["first_col"]]
    return grid


def _sums(parts: list[dict], top: int, bottom: int) -> np.ndarray:
    """Sums of the column before a block."""
    before = np.full(bottom - top, np.inf)
    for p in parts:
        reach = np.frombuffer(p["reach"])
        a, b = max(top, p["sums_top"]), min(bottom, p["sums_top"] + len(reach))
        if a < b:
            before[a - top:b - top] = reach[a - p["sums_top"]:b - p["sums_top"]]
    return before


def _least_of_three(before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest sum of the rows above, at and below, and that row's place; the upper of
    equal ones."""
    wide = np.concatenate(([np.inf], before, [np.inf]))
    three = np.stack([wide[:-2], wide[1:-1], wide[2:]])
    pick = three.argmin(axis=0)
    return np.take_along_axis(three, pick[None], 0)[0], pick - 1 + np.arange(len(before))


def forward(grid: np.ndarray, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Sums after each column, and for each cell of the last one the place from which its
    path comes, in the column before the block."""
    reach = np.empty_like(grid)
    if before is None:
        reach[:, 0], origin = grid[:, 0], np.full(len(grid), -1)
    else:
        least, origin = _least_of_three(before)
        reach[:, 0] = grid[:, 0] + least
    for c in range(1, grid.shape[1]):
        least, at = _least_of_three(reach[:, c - 1])
        reach[:, c] = grid[:, c] + least
        origin = origin[np.clip(at, 0, len(at) - 1)]
    return reach, origin


def _forward_step(blocks: DataFrame, before: DataFrame | None, step: int, size: int) -> DataFrame:
    """Sums at the right end of every block of a step."""
    schema = _schema(blocks, *_SUMS_FIELDS)
    arrow = to_arrow_schema(schema)
    rows = _spread(blocks)
    if before is not None:
        rows = rows.unionByName(_spread(before.select(
            *PAIR, "tile_row", "low", "high", F.col("top").alias("sums_top"), "reach")), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (ts, seq, tile_row), group in tiles.groups_of(batches, *PAIR, "tile_row"):
            given = list(group)
            costs = [r for r in given if r["cost"] is not None]
            own = next((r for r in costs if r["own"]), None)
            if own is None:
                continue
            top, bottom = (tile_row - 1) * size, (tile_row + 2) * size
            edge = (own["left"] // size + step) * size
            first, last = max(own["left"], edge), min(own["right"], edge + size - 1)
            sums = None if step == 0 else _sums([r for r in given if r["cost"] is None], top, bottom)
            reach, origin = forward(_canvas(costs, top, bottom, first, last), sums)
            core = slice(size, 2 * size)
            done, origin = reach[core, -1], origin[core] + top
            end = None
            if last == own["right"] and np.isfinite(done).any():
                row = int(done.argmin())
                end = {"reach": float(done[row]), "row": tile_row * size + row}
            yield {
                "ts": ts, "seq": seq, "step": step, "tile_row": tile_row, "low": own["low"], "high": own["high"], "top": tile_row * size,
                "reach": np.ascontiguousarray(done).tobytes(), "origin": origin.astype(np.int32).tobytes(), "end": end}

    return tiles.in_order(rows, *PAIR, "tile_row").mapInArrow(lambda batches: tiles.packed(run(batches), arrow), schema)


def _step_back(ends: DataFrame, sums: DataFrame, size: int) -> DataFrame:
    """Where paths leave the step before, from where they leave this one."""
    at = ends.withColumn("tile_row", F.expr(f"int(floor(row / {size}))"))
    schema = _schema(ends, *_fields("row"))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _table([{
                "ts": r["ts"], "seq": r["seq"], "row": int(np.frombuffer(r["origin"], np.int32)[r["row"] - r["top"]])}
                for r in batch.to_pylist()], arrow).to_batches()

    return at.join(sums.select(*PAIR, "tile_row", "top", "origin"), [*PAIR, "tile_row"]).select(
        *PAIR, "row", "top", "origin").mapInArrow(run, schema)


def _trace(blocks: DataFrame, sums: DataFrame | None, ends: DataFrame, size: int) -> DataFrame:
    """Path cells (ts, seq, mosaic_row, mosaic_col) inside the blocks around each end."""
    schema = _schema(blocks, *_fields("mosaic_row", "mosaic_col"))
    arrow = to_arrow_schema(schema)
    at = ends.withColumn("_home", F.expr(f"int(floor(row / {size}))"))
    near = F.abs(F.col("tile_row") - F.col("_home")) <= 1
    rows = blocks.join(at, [*PAIR, "step"]).where(near).drop("_home")
    if sums is not None:
        before = sums.select(*PAIR, (F.col("step") + 1).alias("step"), "tile_row", F.col("top").alias("sums_top"), "reach")
        rows = rows.unionByName(before.join(at, [*PAIR, "step"]).where(near).drop("_home"), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (ts, seq, step), group in tiles.groups_of(batches, *PAIR, "step"):
            given = list(group)
            costs = [r for r in given if r["cost"] is not None]
            end, left, right = given[0]["row"], costs[0]["left"], costs[0]["right"]
            top, bottom = end - size, end + size + 1
            edge = (left // size + step) * size
            first, last = max(left, edge), min(right, edge + size - 1)
            sums = None if step == 0 else _sums([r for r in given if r["cost"] is None], top, bottom)
            reach, _ = forward(_canvas(costs, top, bottom, first, last), sums)
            row = end - top
            yield {"ts": ts, "seq": seq, "mosaic_row": end, "mosaic_col": last}
            for c in range(last - first - 1, -1, -1):
                row = row - 1 + int(reach[row - 1:row + 2, c].argmin())
                yield {"ts": ts, "seq": seq, "mosaic_row": row + top, "mosaic_col": first + c}

    return tiles.in_order(rows, *PAIR, "step").mapInArrow(lambda batches: tiles.packed(run(batches), arrow), schema)


def _first_rows(blocks: DataFrame) -> DataFrame:
    """Rows (ts, seq, mosaic_row) of the overlap's first column."""
    schema = _schema(blocks, *_fields("mosaic_row"))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p in batch.to_pylist():
                block = np.frombuffer(p["cost"]).reshape(p["height"], p["width"])
                found = np.flatnonzero(np.isfinite(block[:, p["left"] - p["first_col"]])) + p["top"]
                rows += [{"ts": p["ts"], "seq": p["seq"], "mosaic_row": r} for r in found.tolist()]
            yield from _table(rows, arrow).to_batches()

    return blocks.where("left >= first_col AND left < first_col + width").mapInArrow(run, schema)


def lines_of_blocks(blocks: DataFrame, regions: DataFrame, folder: str, size: int) -> DataFrame:
    """Rows (ts, seq, mosaic_row, seam_col) from cost blocks stored by step.

    regions: (ts, seq, row_start, col_start, region_height, left, right, low, high) of every
    image with an overlap. A row of the overlap's first column that the path misses is cut at the start
    of the image; a row without that column keeps the mosaic; without a path the cut is at
    the middle column. One job per column of tiles of the widest overlap, and one back.
    """
    spark = blocks.sparkSession
    widest = regions.agg(F.max(F.expr(f"right div {size} - left div {size}"))).first()[0]
    steps = 0 if widest is None else int(widest) + 1
    sums_schema = _schema(blocks, *_SUMS_FIELDS)
    before = None
    for step in range(steps):
        own = blocks.where(F.col("step") == step)
        before = _stored(_forward_step(own, before, step, size), f"{folder}/sums/part={step}")
    sums = spark.read.schema(sums_schema).parquet(f"{folder}/sums") if steps else spark.createDataFrame([], sums_schema)

    last = sums.where("end IS NOT NULL").groupBy(*PAIR).agg(F.min("end").alias("end"), F.max("step").alias("step"))
    last = last.select(*PAIR, "step", F.col("end.row").alias("row"))
    ends = last
    if steps > 1:  # from block to block; the tables hold one row per image
        last = _stored(last, f"{folder}/last")
        at = last.where(F.col("step") == steps - 1).select(*PAIR, "row")
        found = [at.withColumn("step", F.lit(steps - 1))]
        for step in range(steps - 1, 0, -1):
            back = _step_back(at, sums.where(F.col("step") == step), size)
            at = _stored(back.unionByName(last.where(F.col("step") == step - 1).select(*PAIR, "row")), f"{folder}/ends/{step - 1}")
            found.append(at.withColumn("step", F.lit(step - 1)))
        ends = found[0]
        for f in found[1:]:
            ends = ends.unionByName(f)
    path = _trace(blocks, sums if steps > 1 else None, ends, size)
    rows = path.select(*PAIR, "mosaic_row", F.col("mosaic_col").alias("_cut"), F.lit(False).alias("_first")).unionByName(
        _first_rows(blocks.where("step = 0")).select(*PAIR, "mosaic_row", F.lit(None).cast("int").alias("_cut"), F.lit(True).alias("_first")))
    rows = rows.groupBy(*PAIR, "mosaic_row").agg(F.min("_cut").alias("_cut"), F.max("_first").alias("_first")).where("_first")
    known = regions.join(last.select(*PAIR, F.lit(True).alias("_path")), PAIR, "left")
    cut = with_metadata(rows, known.where("_path").select(*PAIR, "col_start"), PAIR).select(
        *PAIR, "mosaic_row", F.coalesce("_cut", "col_start").alias("seam_col"))
    middle = known.where("_path IS NULL").select(
        *PAIR, F.explode(F.expr("sequence(row_start, row_start + region_height - 1)")).alias("mosaic_row"),
        F.expr("int((left + right) div 2)").alias("seam_col"))
    return cut.unionByName(middle)


def seam_lines(costs: DataFrame, size: int = tiles.TILE) -> DataFrame:
    """Rows (ts, mosaic_row, seam_col): from seam_col on, the new image is used.

    ``costs`` holds the overlap of one image per ts as rows (ts, mosaic_row, mosaic_col,
    cost, row_start, col_start, region_height); a group is one tile of it.
    """
    folder = work_dir(costs.sparkSession, "seam-lines")
    # read three times: cells are not found anew for each
    cells = _stored(costs.withColumn("seq", F.lit(0)), f"{folder}/cells")
    regions = _stored(cells.groupBy(*PAIR).agg(
        F.min("mosaic_col").alias("left"), F.max("mosaic_col").alias("right"),
        F.expr(f"int(min(mosaic_row) div {size})").alias("low"), F.expr(f"int(max(mosaic_row) div {size})").alias("high"),
        *[F.first(c).alias(c) for c in ("row_start", "col_start", "region_height")]), f"{folder}/regions")
    schema = _schema(cells, *_BLOCK_FIELDS)
    arrow = to_arrow_schema(schema)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for group in tiles.tables_of(batches, *PAIR, "tile_row", "tile_col"):
            own = {n: group[n][0].as_py() for n in (*PAIR, "tile_row", "tile_col", *_EXTENT)}
            rows, cols = group["mosaic_row"].to_numpy(), group["mosaic_col"].to_numpy()
            top, first = int(rows.min()), int(cols.min())
            block = np.full((int(rows.max()) - top + 1, int(cols.max()) - first + 1), np.inf)
            block[rows - top, cols - first] = group["cost"].to_numpy()
            yield {
                **own, "step": own["tile_col"] - own["left"] // size, "top": top, "first_col": first,
                "height": block.shape[0], "width": block.shape[1], "cost": block.tobytes()}

    tiled = with_metadata(cells.select(*PAIR, "mosaic_row", "mosaic_col", "cost"), regions.select(*PAIR, *_EXTENT), PAIR).withColumns({
        "tile_row": F.expr(f"int(mosaic_row div {size})"), "tile_col": F.expr(f"int(mosaic_col div {size})")})
    tiled = tiles.in_order(tiled, *PAIR, "tile_row", "tile_col")
    blocks = _stored(tiled.mapInArrow(lambda batches: tiles.packed(build(batches), arrow), schema), f"{folder}/blocks", "step")
    return lines_of_blocks(blocks, regions, folder, size).drop("seq")


# --- cost of images against what lies below ------------------------------------------------

_PIECE = ("tile_row", "tile_col", "from_seq", "top", "first_col", "height", "width", *REGION)


def _cuts(first: int, last: int, low: int, high: int, size: int, rim: int) -> Iterator[tuple[int, int, int]]:
    """(tile, begin, end): what tiles of the mosaic need, with their rim, of the pixels
    first..last-1 inside a region low..high-1."""
    first, last = max(first, low), min(last, high)
    if first >= last:
        return
    for tile in range(max(low, first - rim) // size, min(high - 1, last - 1 + rim) // size + 1):
        begin, end = max(first, tile * size - rim), min(last, (tile + 1) * size + rim)
        if begin < end:
            yield tile, begin, end


def _region_pieces(ortho: DataFrame, targets: DataFrame, rim: int, size: int) -> DataFrame:
    """Ortho tiles cut along the mosaic's tiles, with rims, for every image (ts, seq) whose
    region they touch. targets: (ts, camera, from_seq, from_row, from_col, seq, region)."""
    joined = tiles.dealt(with_metadata(ortho, targets, ["ts", "camera"]), size, "ts", "camera", "tile_row", "tile_col", "seq")
    schema = _schema(joined, *_fields(*_PIECE), T.StructField("data", _BIN), T.StructField("cuts", _BIN))
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for t in batch.to_pylist():
                block = np.frombuffer(t["data"], np.uint8).reshape(t["height"], t["width"], 3)
                # first pixel of the tile in the mosaic
                top, left = t["tile_row"] * size + t["from_row"], t["tile_col"] * size + t["from_col"]
                line = None
                if t["cuts"] is not None:
                    line = np.full(size, NO_CUT, np.int32)
                    for cut_at in t["cuts"]:
                        line[cut_at["row"]] = cut_at["seam_col"]
                bottom, right = t["row_start"] + t["region_height"], t["col_start"] + t["region_width"]
                for r, r0, r1 in _cuts(top, top + t["height"], t["row_start"], bottom, size, rim):
                    for c, c0, c1 in _cuts(left, left + t["width"], t["col_start"], right, size, rim):
                        part = block[r0 - top:r1 - top, c0 - left:c1 - left]
                        if t["from_seq"] != t["seq"] and not part.any():
                            continue
                        rows.append({
                            "ts": t["ts"], "seq": t["seq"], "tile_row": r, "tile_col": c, "from_seq": t["from_seq"], "top": r0,
                            "first_col": c0, "height": r1 - r0, "width": c1 - c0, **{n: t[n] for n in REGION}, "data": part.tobytes(),
                            "cuts": None if line is None else line[r0 - top:r1 - top].tobytes()})
                        held += part.size
                if held >= tiles.OUT_BYTES:
                    yield from _table(rows, arrow).to_batches()
                    rows, held = [], 0
        if rows:
            yield from _table(rows, arrow).to_batches()

    return joined.mapInArrow(cut, schema)


#: Column behind which no pixel lies: a row without a seam.
NO_CUT = np.iinfo(np.int32).max


class Layers:
    """A block of the mosaic onto which pieces of images are laid in any order. The last
    image whose seam lies at or left of a cell wins, else the first image there."""

    def __init__(self, top: int, left: int, height: int, width: int):
        self.top, self.left = top, left
        self.pixels = np.zeros((height, width, 3), np.uint8)
        self.rank = np.full((height, width), np.iinfo(np.int64).min)
        self.seq = np.zeros((height, width), np.int32)

    def lay(self, piece: dict) -> None:
        data = np.frombuffer(piece["data"], np.uint8).reshape(piece["height"], piece["width"], 3)
        cuts = np.full(piece["height"], NO_CUT) if piece["cuts"] is None else np.frombuffer(piece["cuts"], np.int32)
        cols = np.arange(piece["first_col"], piece["first_col"] + piece["width"])
        rank = np.where(cols[None, :] >= cuts[:, None], piece["from_seq"], -(1 << 32) - piece["from_seq"])
        r, c = piece["top"] - self.top, piece["first_col"] - self.left
        at = (slice(r, r + piece["height"]), slice(c, c + piece["width"]))
        better = data.any(axis=2) & (rank > self.rank[at])
        self.rank[at][better] = rank[better]
        self.pixels[at][better] = data[better]
        self.seq[at][better] = piece["from_seq"]


def _raw_costs(pieces: DataFrame, method: str, size: int) -> DataFrame:
    """Measures of the new image and of the mosaic below it where both have data, per tile,
    with the largest values of the tile."""
    names, rim = tile_costs.measures_of(method), tile_costs.rim_of(method)
    sides = [f"{side}_{n}" for side in ("new", "old") for n in names]
    schema = _schema(
        pieces, *_fields("tile_row", "tile_col", *REGION, "top", "first_col", "height", "width", "left", "right"),
        *[T.StructField(f"max_{s}", _DOUBLE) for s in sides], *[T.StructField(s, _BIN) for s in sides], T.StructField("shared", _BIN))
    arrow = to_arrow_schema(schema)

    def measured(held: list[tuple[dict, tuple | None, list[np.ndarray]]]) -> Iterator[dict]:
        """The rows with the measures of both sides; blocks of one size together."""
        by_shape: dict[tuple, list] = {}
        for one in held:
            by_shape.setdefault(one[2][0].shape, []).append(one)
        for some in by_shape.values():
            gray = tile_costs.gray_of(np.stack([block for _, _, sides in some for block in sides]))
            for n, values in tile_costs.measure(gray, rim, names).items():
                tops = values.max(axis=(-2, -1)).tolist()
                for i, (row, part, _) in enumerate(some):
                    for k, side in enumerate(("new", "old")):
                        row[f"max_{side}_{n}"] = tops[2 * i + k]
                        if part:
                            row[f"{side}_{n}"] = values[2 * i + k][part].tobytes()
            yield from (row for row, _, _ in some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, size_held = [], 0
        for (ts, seq, tile_row, tile_col), group in tiles.groups_of(batches, *PAIR, "tile_row", "tile_col"):
            layers = None
            for p in group:
                if layers is None:
                    region = {n: p[n] for n in REGION}
                    (y, x, h, w) = region.values()
                    core = (max(y, tile_row * size), max(x, tile_col * size), min(y + h, (tile_row + 1) * size), min(x + w, (tile_col + 1) * size))
                    box = (max(y, core[0] - rim), max(x, core[1] - rim), min(y + h, core[2] + rim), min(x + w, core[3] + rim))
                    layers = [Layers(box[0], box[1], box[2] - box[0], box[3] - box[1]) for _ in range(2)]
                layers[0 if p["from_seq"] == seq else 1].lay(p)
            inner = (slice(core[0] - box[0], core[2] - box[0]), slice(core[1] - box[1], core[3] - box[1]))
            shared = layers[0].pixels[inner].any(axis=2) & layers[1].pixels[inner].any(axis=2)
            row = {"ts": ts, "seq": seq, "tile_row": tile_row, "tile_col": tile_col, **region}
            rows, cols = np.nonzero(shared)
            some = len(rows) > 0
            if some:
                part = (slice(rows.min(), rows.max() + 1), slice(cols.min(), cols.max() + 1))
                row |= {"top": core[0] + int(rows.min()), "first_col": core[1] + int(cols.min()), "height": int(np.ptp(rows)) + 1,
                        "width": int(np.ptp(cols)) + 1, "left": core[1] + int(cols.min()), "right": core[1] + int(cols.max()),
                        "shared": np.packbits(shared[part]).tobytes()}
            local = (core[0] - y, core[1] - x, core[2] - y, core[3] - x)
            sides = [tile_costs.padded(layer.pixels, (box[0] - y, box[1] - x), local, (h, w), rim) for layer in layers]
            held.append((row, part if some else None, sides))
            size_held += sides[0].size
            if size_held >= tiles.PIXELS_AT_ONCE:
                yield from measured(held)
                held, size_held = [], 0
        yield from measured(held)

    ordered = tiles.in_order(pieces, *PAIR, "tile_row", "tile_col")
    return ordered.mapInArrow(lambda batches: tiles.packed(run(batches), arrow), schema)


def _blocks_of(raw: DataFrame, regions: DataFrame, method: str, size: int) -> DataFrame:
    """Cost blocks: the mean of both costs, each over the largest values of its region."""
    names = tile_costs.measures_of(method)
    largest = [f"max_{side}_{n}" for side in ("new", "old") for n in names]
    schema = _schema(raw, *_BLOCK_FIELDS)
    arrow = to_arrow_schema(schema)
    rows = with_metadata(raw.where("shared IS NOT NULL").drop("left", "right", *REGION, *largest),
                         regions.select(*PAIR, *_EXTENT, *largest), PAIR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.to_pylist():
                shape = (t["height"], t["width"])
                both = [tile_costs.weighted_cost(
                    {n: np.frombuffer(t[f"{side}_{n}"]).reshape(shape) for n in names}, {n: t[f"max_{side}_{n}"] for n in names})
                    for side in ("new", "old")]
                shared = np.unpackbits(np.frombuffer(t["shared"], np.uint8), count=shape[0] * shape[1]).astype(bool).reshape(shape)
                cost = np.where(shared, (both[0] + both[1]) / 2, np.inf)
                out.append({
                    **{n: t[n] for n in (*PAIR, "tile_row", "tile_col", *_EXTENT, "top", "first_col", "height", "width")},
                    "step": t["tile_col"] - t["left"] // size, "cost": cost.tobytes()})
            yield from _table(out, arrow).to_batches()

    return rows.mapInArrow(run, schema)


# --- the seams of all images ---------------------------------------------------------------

def _line_blocks(lines: DataFrame, placed: DataFrame, size: int) -> DataFrame:
    """(ts, camera, tile_row, cuts): the seam columns of the rows of an image's tile, `size`
    at most."""
    own = with_metadata(lines, placed.select(*PAIR, "camera", "row_start", "src_row"), PAIR)
    own = own.withColumn("_row", F.col("mosaic_row") - F.col("row_start") + F.col("src_row"))
    return own.groupBy("ts", "camera", F.expr(f"int(_row div {size})").alias("tile_row")).agg(
        F.collect_list(F.struct((F.col("_row") % size).alias("row"), "seam_col")).alias("cuts"))


class Seams:
    """The seams of all images of all timestamps, found once: the mosaic and the seam map
    are both read from them. placed, lines and the pieces are tables in the shared folder."""

    def __init__(self, ortho: DataFrame, images: DataFrame, method: str = "gradient",
                 resolution: float | None = None, strict: bool = True, size: int = tiles.TILE):
        names = tile_costs.measures_of(method)
        self.size, self.ortho = size, ortho
        spark = ortho.sparkSession
        folder = work_dir(spark, "seam")
        self.placed = _stored(seam_waves(mosaic.left_to_right(mosaic.place_images(images, resolution, strict))), f"{folder}/placed")
        line_schema = _schema(self.placed, *_fields("mosaic_row", "seam_col"))
        self.lines = spark.createDataFrame([], line_schema)
        first = [(F.col("row_start") - F.col("src_row")).alias("from_row"), (F.col("col_start") - F.col("src_col")).alias("from_col")]
        own = self.placed.select("ts", "camera", F.col("seq").alias("from_seq"), *first)
        for wave in range(1, (self.placed.agg(F.max("wave")).first()[0] or 0) + 1):
            new = self.placed.where(F.col("wave") == wave)
            touched = new.select(*PAIR, *REGION, F.explode(F.concat("olds", F.array("seq"))).alias("from_seq"))
            targets = touched.join(own, ["ts", "from_seq"])
            pieces = _region_pieces(self._with_cuts(wave > 1), targets, tile_costs.rim_of(method), size)
            raw = _stored(_raw_costs(pieces, method, size), f"{folder}/raw/{wave}")
            largest = [f"max_{side}_{n}" for side in ("new", "old") for n in names]
            shared_row = F.when(F.col("left").isNotNull(), F.col("tile_row"))
            regions = _stored(raw.groupBy(*PAIR).agg(
                F.min("left").alias("left"), F.max("right").alias("right"), F.min(shared_row).alias("low"), F.max(shared_row).alias("high"),
                *[F.first(c).alias(c) for c in REGION],
                *[F.max(c).alias(c) for c in largest]).where("left IS NOT NULL"), f"{folder}/regions/{wave}")
            blocks = _stored(_blocks_of(raw, regions, method, size), f"{folder}/blocks/{wave}", "step")
            found = lines_of_blocks(blocks, regions, f"{folder}/paths/{wave}", size)
            found.select(line_schema.fieldNames()).write.parquet(f"{folder}/lines/wave={wave}")
            self.lines = spark.read.schema(line_schema).parquet(f"{folder}/lines")

    def _with_cuts(self, known: bool) -> DataFrame:
        """Ortho tiles with the seam columns of their rows, as far as seams are known."""
        if not known:
            return self.ortho.withColumn("cuts", F.lit(None).cast("array<struct<row: int, seam_col: int>>"))
        return self.ortho.join(_line_blocks(self.lines, self.placed, self.size), ["ts", "camera", "tile_row"], "left")

    def mosaic_tiles(self) -> DataFrame:
        """Mosaic tiles (ts, tile_row, tile_col, height, width, data, positions); the pieces of
        a tile stream through one block of fixed size."""
        size = self.size
        targets = self.placed.select(
            "ts", "camera", (-F.col("position")).alias("seq"), F.col("seq").alias("from_seq"),
            (F.col("row_start") - F.col("src_row")).alias("from_row"), (F.col("col_start") - F.col("src_col")).alias("from_col"), *REGION)
        pieces = _region_pieces(self._with_cuts(True), targets, 0, size)
        schema = T.StructType([
            T.StructField("ts", self.placed.schema["ts"].dataType), *_fields("tile_row", "tile_col", "height", "width"),
            T.StructField("data", _BIN), T.StructField("positions", _BIN)])
        arrow = to_arrow_schema(schema)

        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for (ts, tile_row, tile_col), group in tiles.groups_of(batches, "ts", "tile_row", "tile_col"):
                layers = Layers(tile_row * size, tile_col * size, size, size)
                positions = {}
                for p in group:
                    layers.lay(p)
                    positions[p["from_seq"]] = -p["seq"]
                known = np.zeros(max(positions) + 1, np.int32)
                known[list(positions)] = list(positions.values())
                yield {
                    "ts": ts, "tile_row": tile_row, "tile_col": tile_col, "height": size, "width": size,
                    "data": layers.pixels.tobytes(), "positions": known[layers.seq].tobytes()}

        ordered = tiles.in_order(pieces, "ts", "tile_row", "tile_col")
        return ordered.mapInArrow(lambda batches: tiles.packed(fold(batches), arrow), schema)

    def mosaic_rows(self) -> DataFrame:
        """Mosaic pixels (ts, mosaic_row, mosaic_col, b, g, r, camera)."""
        rows = tiles.mosaic_tile_pixels(self.mosaic_tiles(), self.size)
        return with_metadata(rows, self.placed.select("ts", "position", "camera"), ["ts", "position"]).drop("position")

    def seam_map(self) -> DataFrame:
        """Cells (ts, mosaic_row, mosaic_col) that touch a seam from the left."""
        return seam_map(self.lines, self.placed)


def seam_map(lines: DataFrame, placed: DataFrame) -> DataFrame:
    """Cells (ts, mosaic_row, mosaic_col) that touch the seam from the left.

    Lines carry seq. A row's cut lies at seam_col, so its boundary runs from one
    cell before the smallest cut of the three rows around it up to its own cut.
    """
    regions = placed.select("ts", "seq", *REGION)
    near = lines.withColumn(
        "mosaic_row", F.explode(F.array(*[F.col("mosaic_row") + d for d in (-1, 0, 1)])))
    smallest = near.groupBy("ts", "seq", "mosaic_row").agg(F.min("seam_col").alias("_near"))
    own = lines.select("ts", "seq", "mosaic_row", F.col("seam_col").alias("_own"))
    row_end = F.col("row_start") + F.col("region_height")
    col_end = F.col("col_start") + F.col("region_width")
    return (
        smallest.join(own, ["ts", "seq", "mosaic_row"], "left")
        .join(regions, ["ts", "seq"])
        .where((F.col("mosaic_row") >= F.col("row_start")) & (F.col("mosaic_row") < row_end))
        .withColumns({
            "_from": F.greatest(F.col("_near") - 1, F.col("col_start")),
            "_to": F.coalesce("_own", col_end) - 1,
        })
        .where("_from <= _to")
        .select("ts", "mosaic_row", F.explode(F.sequence("_from", "_to")).alias("mosaic_col"))
        .distinct()
    )


def mosaic_seam(pixel_rows: DataFrame, images: DataFrame, method: str = "gradient",
                resolution: float | None = None, strict: bool = True, seams: bool = False,
                size: int = tiles.TILE) -> DataFrame:
    """Seam mosaic of pixel rows (ts, mosaic_row, mosaic_col, b, g, r, camera), or its seam map."""
    ortho = _stored(tiles.to_tiles(pixel_rows, size), work_dir(pixel_rows.sparkSession, "seam-tiles"))
    found = Seams(ortho, images, method, resolution, strict, size)
    return found.seam_map() if seams else found.mosaic_rows()
