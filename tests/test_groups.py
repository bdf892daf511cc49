"""Groups of rows that a task reads as one stream."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_raster import IMAGE, pixel_frame, random_scene

from orthoweave.operators import seam, tile_costs, tiles

ROWS = [(1, "a", 0), (1, "a", 1), (1, "b", 2), (2, None, 3), (2, None, 4), (2, "b", 5), (None, "b", 6)]


def batches(cuts):
    table = pa.table({"ts": pa.array([r[0] for r in ROWS], pa.int64()), "camera": [r[1] for r in ROWS], "n": [r[2] for r in ROWS]})
    return [b for x, y in zip(cuts, cuts[1:]) for b in table.slice(x, y - x).combine_chunks().to_batches()]


@pytest.mark.parametrize("cuts", [[0, 7], [0, 1, 2, 3, 4, 5, 6, 7], [0, 4, 7], [0, 2, 6, 7]])
def test_groups_cross_batches(cuts):
    want = [[0, 1], [2], [3, 4], [5], [6]]
    assert [[r["n"] for r in rows] for _, rows in tiles.groups_of(batches(cuts), "ts", "camera")] == want
    assert [t["n"].to_pylist() for t in tiles.tables_of(batches(cuts), "ts", "camera")] == want


def test_rows_go_out_together(monkeypatch):
    schema = pa.schema([("n", pa.int32()), ("data", pa.binary())])
    rows = [{"n": i, "data": bytes(10) if i % 2 else None} for i in range(100)]
    assert [b.num_rows for b in tiles.packed(rows, schema)] == [100]
    monkeypatch.setattr(tiles, "OUT_BYTES", 100)
    found = list(tiles.packed(rows, schema))
    assert [b.num_rows for b in found] == [20] * 5
    assert [r for b in found for r in b.to_pylist()] == rows
    assert list(tiles.packed([], schema)) == []


def test_small_tiles_have_no_group_of_their_own(spark):
    """Costs, mosaics and seam steps hand Python a stream of tiles, not a group per tile."""
    arrays, rows = random_scene(5, 2)
    px, images = pixel_frame(spark, arrays), spark.createDataFrame(rows, IMAGE)
    cut = tiles.to_tiles(px, 3)
    cells = px.select("ts", F.lit(0).alias("seq"), *[F.lit(0).alias(n) for n in seam._PLACE], F.lit(b"").alias("cost"))
    placed = seam.mosaic.left_to_right(seam.mosaic.place_images(images))
    for df in (tile_costs.cost_tiles(cut, ["ts", "camera"], 3, "combined"), tiles.mosaic_tiles(cut, images, size=3),
               seam._forward_step(cells, None, 0, 3), seam.seam_waves(placed)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "GroupsInArrow" not in plan


def test_blocks_together_as_one_by_one():
    gray = np.random.default_rng(4).integers(0, 256, (3, 18, 19)).astype(np.uint8)
    both = tile_costs.measure(gray, tile_costs.VARIANCE_RIM, tile_costs.MEASURES)
    for i, one in enumerate(gray):
        for n, values in tile_costs.measure(one, tile_costs.VARIANCE_RIM, tile_costs.MEASURES).items():
            assert (both[n][i] == values).all()


def test_small_tiles_are_cut_by_all_tasks(spark):
    """Their bytes would be one task's; tiles of full size are not shuffled for it."""
    wide = spark.range(4).select("id", F.lit(1).alias("tile_row"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tiles.dealt(wide.coalesce(1), 3, "id").rdd.getNumPartitions() == n
    assert tiles.dealt(wide.coalesce(1), tiles.TILE, "id").rdd.getNumPartitions() == 1


def test_lookup_tiles_have_no_group_of_their_own(spark):
    """A map's tiles are read as a stream, whole even where batches cut them."""
    rows = [(c, r, k, float(r), float(k), 9, 9) for c in range(2) for r in range(7) for k in range(5) if (r + k) % 4]
    lookup = spark.createDataFrame(rows, "camera int, row int, col int, src_x float, src_y float, image_width int, image_height int")
    cut = tiles.map_tiles(lookup, 3, listed=True)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "GroupsInArrow" not in plan
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)
    try:
        found = cut.collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(found) == 2 * 3 * 2 == len({(t.camera, t.tile_row, t.tile_col) for t in found})
    back = set()
    for t in found:
        x, y = (np.frombuffer(v, np.float32).reshape(t.height, t.width) for v in (t.src_x, t.src_y))
        listed = np.unpackbits(np.frombuffer(t.listed, np.uint8))[:t.height * t.width].reshape(t.height, t.width)
        back |= {(t.camera, t.tile_row * 3 + i, t.tile_col * 3 + j, float(x[i, j]), float(y[i, j]), 9, 9) for i, j in np.argwhere(listed).tolist()}
    assert back == set(rows)
