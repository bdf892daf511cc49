"""Neighbourhood operators on tiles against the pixel form, and what they shuffle."""

import re
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_raster import pixel_frame

from orthoweave.functions import pixels
from orthoweave.operators import neighbourhood, tile_costs, tiles

KEYS = ["ts", "camera"]


@pytest.fixture(scope="module")
def scene(spark):
    """Images of uneven sizes, one narrower than the variance window and one a single row."""
    rng = np.random.default_rng(8)
    shapes = {(1, "a"): (23, 31), (1, "b"): (5, 40), (2, "a"): (1, 9), (2, "c"): (17, 16)}
    return pixel_frame(spark, {k: rng.integers(0, 256, (*s, 3)) for k, s in shapes.items()})


def gray(px):
    sizes = px.groupBy(*KEYS).agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))
    return px.join(sizes, KEYS).select(*KEYS, "row", "col", pixels.bgr_to_gray().alias("gray"), "height", "width")


def values(df, *names):
    return {(r.ts, r.camera, r.row, r.col): tuple(round(r[n], 6) for n in names) for r in df.collect()}


@pytest.mark.parametrize("size", [4, 16, 256])
def test_equal_to_the_pixel_form(spark, scene, size):
    cut = tiles.to_tiles(scene, size)
    double = T.DoubleType()
    found = tile_costs.to_rows(tile_costs.sobel_tiles(cut, KEYS, size), KEYS, {
        "gx": T.IntegerType(), "gy": T.IntegerType(), "gradient": double}, size)
    assert values(found, "gx", "gy", "gradient") == values(neighbourhood.sobel_gradient(gray(scene), KEYS), "gx", "gy", "gradient")
    found = tile_costs.to_rows(tile_costs.variance_tiles(cut, KEYS, size), KEYS, {"variance": double}, size)
    assert values(found, "variance") == values(neighbourhood.local_variance(gray(scene), KEYS), "variance")
    for method in neighbourhood.COST_METHODS:
        found = tile_costs.to_rows(tile_costs.cost_tiles(cut, KEYS, size, method), KEYS, {"cost": double}, size)
        assert values(found, "cost") == values(neighbourhood.quality_cost(gray(scene), KEYS, method), "cost")


def test_unknown_method():
    with pytest.raises(ValueError):
        tile_costs.measures_of("entropy")


def test_only_rims_are_shuffled(spark, scene, tmp_path):
    """Tiles stored in buckets of their key stay where they are: one exchange, of the strips."""
    name = f"tiles_{uuid.uuid4().hex}"
    place = [*KEYS, "tile_row", "tile_col"]
    sized = tile_costs.with_raster_size(tiles.to_tiles(scene, 8), KEYS, 8)
    sized.write.option("path", str(tmp_path / "tiles")).bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), *place).saveAsTable(name)
    try:
        found = tile_costs.variance_tiles(spark.table(name), KEYS, 8)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
        assert values(tile_costs.to_rows(found, KEYS, {"variance": T.DoubleType()}, 8), "variance") == values(
            neighbourhood.local_variance(gray(scene), KEYS), "variance")
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_strips_hold_rims_only(spark, scene):
    sized = tile_costs.with_raster_size(tiles.to_tiles(scene, 8), KEYS, 8)
    sent = tile_costs.send_rims(sized, KEYS, 1, 8).agg(F.sum(F.octet_length("strip"))).first()[0]
    assert 0 < sent < scene.count()
