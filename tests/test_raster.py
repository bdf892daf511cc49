import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from orthoweave.functions import pixels
from orthoweave.operators import dem as dem_ops
from orthoweave.operators import mosaic, neighbourhood, remap, tiles
from orthoweave.plans import mosaics
from orthoweave.suite import views

PX = "ts long, camera string, row int, col int, b int, g int, r int"
MAP = "camera string, row int, col int, src_x float, src_y float, image_width int, image_height int"
IMAGE = ("ts long, camera string, file string, width int, height int, x_min double, y_max double, "
         "pixel_width double, pixel_height double")


def pixel_frame(spark, images):
    """Pixel rows of {(ts, camera): array}; 2-D arrays become three equal channels."""
    rows = []
    for (ts, camera), a in images.items():
        a = np.asarray(a)
        a = np.repeat(a[:, :, None], 3, axis=2) if a.ndim == 2 else a
        rows += [(ts, camera, r, c, *map(int, a[r, c])) for r in range(a.shape[0]) for c in range(a.shape[1])]
    return spark.createDataFrame(rows, PX)


def lookup(spark, camera, xs, ys, width, height):
    rows = [(camera, r, c, float(xs[r, c]), float(ys[r, c]), width, height)
            for r in range(xs.shape[0]) for c in range(xs.shape[1])]
    return spark.createDataFrame(rows, MAP)


def gathered(df, shape):
    out = np.full(shape, -1)
    for r in df.collect():
        out[r.row, r.col] = r.b
    return out


def both_forms(spark, px, table, size=2):
    yield remap.remap_bilinear(px, table)
    built = tiles.remap_tiles(tiles.to_tiles(px, size), tiles.map_tiles(table, size), size=size)
    yield tiles.to_pixels(built, size)


IMG = np.arange(16).reshape(4, 4) * 10


def test_identity_map(spark):
    ys, xs = np.indices((4, 4))
    for df in both_forms(spark, pixel_frame(spark, {(1, "c"): IMG}), lookup(spark, "c", xs, ys, 4, 4)):
        assert (gathered(df, (4, 4)) == IMG).all()


def test_listed_pixels_of_small_tiles(spark):
    """Pixels the map does not list are left out without a join of the output; the tiles of a
    square travel together."""
    rng = np.random.default_rng(5)
    frames = pixel_frame(spark, {(t, "c"): rng.integers(0, 256, (5, 7)) for t in range(3)})
    table = lookup(spark, "c", rng.uniform(-1, 8, (9, 11)), rng.uniform(-1, 6, (9, 11)), 7, 5).where(
        "(row * 11 + col) % 3 <> 0 and not (row between 2 and 3 and col between 4 and 5)")
    ortho = tiles.remap_tiles(tiles.to_tiles(frames, 2), tiles.map_tiles(table, 2, listed=True), size=2)
    got = tiles.to_pixels(ortho, 2)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, remap.remap_bilinear(frames, table).select(*got.columns).collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and "square_tile_row" in plan


def test_half_pixel_shift_and_black_outside(spark):
    ys, xs = np.indices((4, 4))
    padded = np.pad(IMG, ((0, 1), (0, 1)))
    want = (padded[:4, :4] + padded[:4, 1:] + padded[1:, :4] + padded[1:, 1:] + 2) // 4
    for df in both_forms(spark, pixel_frame(spark, {(1, "c"): IMG}), lookup(spark, "c", xs + .5, ys + .5, 4, 4)):
        assert (gathered(df, (4, 4)) == want).all()


def test_unusable_positions_stay_in_the_result(spark):
    xs = np.array([[np.nan, -100.0], [1e9, 1.0]])
    ys = np.array([[0.0, 0.0], [0.0, 2.0]])
    for df in both_forms(spark, pixel_frame(spark, {(1, "c"): IMG, (2, "c"): IMG}),
                         lookup(spark, "c", xs, ys, 4, 4)):
        rows = df.collect()
        assert len(rows) == 8
        assert {(r.ts, r.row, r.col): r.b for r in rows}[(2, 1, 1)] == IMG[2, 1]
        assert sum(r.b for r in rows) == 2 * IMG[2, 1]


def test_random_gather_forms_agree(spark):
    rng = np.random.default_rng(5)
    frames = {(t, "c"): rng.integers(0, 256, (7, 9, 3)) for t in range(20)}
    xs, ys = rng.uniform(-3, 12, (6, 5)), rng.uniform(-3, 10, (6, 5))
    a, b = both_forms(spark, pixel_frame(spark, frames), lookup(spark, "c", xs, ys, 9, 7), size=4)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))


def raster(spark, a):
    h, w = a.shape
    return spark.createDataFrame(
        [(1, r, c, int(a[r, c]), h, w) for r in range(h) for c in range(w)],
        "ts long, row int, col int, gray int, height int, width int")


def as_array(df, name, shape):
    out = np.zeros(shape)
    for r in df.collect():
        out[r.row, r.col] = r[name]
    return out


def sobel(a):
    p = np.pad(a.astype(float), 1, mode="reflect")
    dx = p[:, 2:] - p[:, :-2]
    gx = dx[:-2] + 2 * dx[1:-1] + dx[2:]
    s = p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
    return np.hypot(gx, s[2:] - s[:-2])


@pytest.mark.parametrize("a", [
    np.full((5, 6), 77), np.repeat([[0, 0, 0, 9, 9, 9, 9, 9]], 8, axis=0),
    np.random.default_rng(1).integers(0, 256, (9, 11)), np.random.default_rng(2).integers(0, 256, (3, 20))])
def test_sobel_and_variance(spark, a):
    df = neighbourhood.sobel_gradient(raster(spark, a), ["ts"])
    assert np.allclose(as_array(df, "gradient", a.shape), sobel(a))
    df = neighbourhood.local_variance(raster(spark, a), ["ts"])
    p = a[np.ix_(*[[n - 1 - abs((n - 1) - (i % (2 * n - 2))) if n > 1 else 0 for i in range(-7, n + 7)]
                   for n in a.shape])].astype(float)
    want = np.array([[p[r:r + 15, c:c + 15].var() for c in range(a.shape[1])] for r in range(a.shape[0])])
    assert np.allclose(as_array(df, "variance", a.shape), want)


def test_constant_image_costs_nothing(spark):
    df = neighbourhood.quality_cost(raster(spark, np.full((6, 6), 40)), ["ts"], "combined")
    assert as_array(df, "cost", (6, 6)).max() == 0
    with pytest.raises(ValueError):
        neighbourhood.quality_cost(raster(spark, np.zeros((2, 2))), ["ts"], "beauty")


def image_row(ts, camera, col, row, width, height):
    """An image whose origin is at mosaic cell (row, col) below y = 100."""
    return (ts, camera, f"{camera}_ortho.tif", width, height, col * 0.25, 100 - row * 0.25, 0.25, -0.25)


def test_single_image_keeps_all_but_its_corner(spark):
    a = np.random.default_rng(3).integers(1, 256, (5, 7))
    images = spark.createDataFrame([image_row(1, "a", 0, 0, 7, 5)], IMAGE)
    rows = mosaic.mosaic_priority(pixel_frame(spark, {(1, "a"): a}), images).collect()
    assert {(r.mosaic_row, r.mosaic_col): r.b for r in rows} == {
        (r, c): a[r, c] for r in range(5) for c in range(7) if (r, c) != (0, 0)}


def test_only_corner_valid_is_never_written(spark):
    a = np.zeros((4, 4), int)
    a[0, 0] = 9
    images = spark.createDataFrame([image_row(1, "a", 0, 0, 4, 4)], IMAGE)
    px = pixel_frame(spark, {(1, "a"): a})
    assert mosaic.mosaic_priority(px, images).count() == 0
    assert mosaic.mosaic_priority(px, images, "order").count() == 1


def random_scene(seed, n=5):
    rng = np.random.default_rng(seed)
    arrays, rows = {}, []
    for ts in (1, 2):
        col = 0
        for i in range(n):
            h, w = rng.integers(5, 10, 2)
            a = rng.integers(0, 256, (h, w, 3))
            a[rng.random((h, w)) < 0.15] = 0
            name = f"cam{i}"
            arrays[(ts, name)] = a
            rows.append(image_row(ts, name, int(col), int(rng.integers(0, 3)), int(w), int(h)))
            col += rng.integers(1, w)
    return arrays, rows


def layout(rows, ts):
    """[(camera, file, first row, first column, height, width)] in the mosaic of a ts."""
    own = [r for r in rows if r[0] == ts]
    left, top = min(r[5] for r in own), max(r[6] for r in own)
    return [(r[1], r[2], int((top - r[6]) / .25), int((r[5] - left) / .25), r[4], r[3]) for r in own]


@pytest.mark.parametrize("method", ["center", "order"])
def test_priority_mosaic_against_direct_search(spark, method):
    arrays, rows = random_scene(11)
    want = {}
    for ts in (1, 2):
        best = {}
        for k, (camera, _, r0, c0, h, w) in enumerate(sorted(layout(rows, ts), key=lambda x: x[1]), 1):
            for r in range(h):
                for c in range(w):
                    if not arrays[(ts, camera)][r, c].any():
                        continue
                    p = float(k) if method == "order" else (
                        1 - np.sqrt((c - w / 2) ** 2 + (r - h / 2) ** 2) / np.sqrt((w / 2) ** 2 + (h / 2) ** 2))
                    if p > best.get((r + r0, c + c0), (0, None))[0]:
                        best[(r + r0, c + c0)] = (p, (camera, *arrays[(ts, camera)][r, c]))
        want |= {(ts, *cell): v[1] for cell, v in best.items()}
    px, images = pixel_frame(spark, arrays), spark.createDataFrame(rows, IMAGE)
    rows_found = mosaics.build_mosaics(px, images, method).collect()
    assert {(r.ts, r.mosaic_row, r.mosaic_col): (r.camera, r.b, r.g, r.r) for r in rows_found} == want
    built = tiles.mosaic_tiles(tiles.to_tiles(px, 4), images, method, size=4)
    tiled = tiles.mosaic_tile_pixels(built, 4).collect()
    assert {(r.ts, r.mosaic_row, r.mosaic_col): (r.b, r.g, r.r) for r in tiled} == {
        k: v[1:] for k, v in want.items()}


def test_other_resolution_is_refused(spark):
    images = spark.createDataFrame([image_row(1, "a", 0, 0, 4, 4)], IMAGE)
    with pytest.raises(ValueError):
        mosaic.place_images(images, 0.5)
    grid = mosaic.mosaic_grid(images, 0.5).first()
    assert (grid.width, grid.height) == (2, 2)
    assert mosaic.place_images(images, 0.5, strict=False).count() == 1


def test_mosaic_aggregates_before_the_shuffle(spark):
    arrays, rows = random_scene(1, 2)
    df = mosaic.mosaic_priority(pixel_frame(spark, arrays), spark.createDataFrame(rows, IMAGE))
    plan = df._jdf.queryExecution().toString()
    assert re.search(r"HashAggregate\(keys=\[ts#\d+L, mosaic_row#\d+, mosaic_col#\d+\], functions=\[partial_max_by", plan)
    assert not re.search(r"SortAggregate\(key=\[ts#\d+L, mosaic_row", plan)


def test_more_images_than_the_fast_rank_holds(spark):
    """Equal priorities go to the first file, a better one wins, on both sides of the limit."""
    rows = [(1, p, 0, 0, 1, 1, 3, 3, p % 255 + 1, 0, 0) for p in range(1020, 1501)]
    columns = ("ts long, position int, mosaic_row int, mosaic_col int, region_row int, region_col int, "
               "region_height int, region_width int, b int, g int, r int")
    tied = spark.createDataFrame(rows, columns)
    assert mosaic.priority_argmax(tied).first().position == 1020
    late = tied.where("position > 1024")
    assert mosaic.priority_argmax(late).first().position == 1025
    # position 1 is off the centre, so the late image at the centre is chosen
    off = tied.where("position = 1020").withColumn("region_col", F.lit(0))
    assert mosaic.priority_argmax(off.unionByName(late)).first().position == 1025
    assert mosaic.priority_argmax(tied, "order").first().position == 1500


def test_priority_rank_loses_nothing(spark):
    values = np.random.default_rng(0).random(2000)
    p = 1.0 - values
    assert ((p * 2.0**53).astype(np.int64).astype(float) / 2.0**53 == p).all()


def test_gray_of_gray_is_itself(spark):
    df = spark.range(256).select(F.col("id").cast("int").alias("v"))
    same = df.where(pixels.bgr_to_gray("v", "v", "v") == F.col("v"))
    assert same.count() == 256
    b, g, r = pixels.unpack_bgr(pixels.pack_bgr(F.lit(1), F.lit(200), F.lit(255)))
    assert tuple(spark.range(1).select(b, g, r).first()) == (1, 200, 255)


def test_dem_sampling(spark):
    z = np.array([[0.0, 10.0, 20.0], [30.0, np.nan, 50.0]])
    dem = spark.createDataFrame(
        [(r, c, None if np.isnan(z[r, c]) else float(z[r, c])) for r in range(2) for c in range(3)],
        "row int, col int, z double")
    transform = dem_ops.DemTransform(0.0, 2.0, 1.0, 2, 3)
    grid = spark.createDataFrame(
        [("c", r, c, 0.0, 2.0, 0.5, -0.5) for r in range(4) for c in range(8)],
        "camera string, row int, col int, x_min double, y_max double, pixel_width double, pixel_height double")

    def at(df):
        return {(r.row, r.col): r.z for r in df.collect()}

    found = at(dem_ops.dem_bilinear(grid, dem, transform, fill=None))
    assert found[(0, 1)] == pytest.approx(2.5)        # between the centres of the first two cells
    assert found[(0, 0)] == pytest.approx(0.0)        # at the border only the border cell counts
    # next to the empty cell its weight goes to the others
    assert found[(1, 1)] == pytest.approx((0.5625 * 0 + 0.1875 * 10 + 0.1875 * 30) / 0.9375)
    assert found[(0, 6)] is None and found[(0, 7)] is None   # outside
    filled = at(dem_ops.dem_bilinear(grid, dem, transform))
    valid = [v for v in found.values() if v is not None]
    assert filled[(0, 7)] == pytest.approx(np.mean(valid), abs=1e-5)
    assert at(dem_ops.dem_bilinear(grid, dem, transform, fill=-1.0))[(0, 7)] == -1.0
    nearest = at(dem_ops.dem_nearest(grid, dem, transform, fill=None))
    assert nearest[(0, 3)] == 10.0 and nearest[(3, 4)] == 50.0 and nearest[(2, 2)] is None


def test_far_source_pixels_and_missing_sources(spark):
    """A wide image is read beyond any fixed limit, and blind outputs need no source."""
    px = spark.createDataFrame(
        [(1, "c", 0, 35000, 9, 8, 7), (1, "c", 0, 35001, 1, 1, 1)],
        "ts long, camera string, row int, col int, b int, g int, r int")
    table = spark.createDataFrame(
        [("c", 0, 0, 35000.0, 0.0, 40000, 1), ("c", 0, 1, float("nan"), 0.0, 40000, 1),
         ("c", 0, 2, -5.0, 0.0, 40000, 1), ("c", 0, 3, 1e30, 0.0, 40000, 1), ("c", 0, 4, None, 0.0, 40000, 1)],
        "camera string, row int, col int, src_x float, src_y float, image_width int, image_height int")
    want = [(0, 9, 8, 7), *[(c, 0, 0, 0) for c in (1, 2, 3, 4)]]
    rows = remap.remap_bilinear(px, table).orderBy("col").collect()
    assert [(r.col, r.b, r.g, r.r) for r in rows] == want
    # the frame lacks the first source tile, which a black output tile must not need
    size = 4
    late = px.withColumn("col", px["col"] - 34990)
    small = table.withColumn("src_x", table["src_x"] - 34990).withColumn("row", table["row"] + 8)
    made = tiles.to_pixels(tiles.remap_tiles(tiles.to_tiles(late, size), tiles.map_tiles(small, size), size=size), size)
    found = {(r.row, r.col): (r.b, r.g, r.r) for r in made.collect()}
    assert found[8, 0] == (9, 8, 7) and all(found[8, c] == (0, 0, 0) for c in (1, 2, 3, 4))


def test_gather_of_sparse_frames_over_block_borders(spark):
    """Sums by hand, wide values included; the output is not shuffled."""
    rng = np.random.default_rng(8)
    side = remap.BLOCK + 5
    frame = {(r, c): tuple(map(int, rng.integers(0, 70000, 3))) for r in range(side) for c in range(side)
             if rng.random() < 0.4 or remap.BLOCK - 2 < r < remap.BLOCK + 2}
    px = spark.createDataFrame([(t, "c", *k, *v) for t in range(2) for k, v in frame.items()], PX)
    at = rng.integers(-48, side * 32 + 16, (400, 2))
    table = spark.createDataFrame([("c", 0, i, x / 32, y / 32, side, side) for i, (y, x) in enumerate(at.tolist())], MAP)
    want = {}
    for i, (y, x) in enumerate(at.tolist()):
        usable = -32 < y < side * 32 and -32 < x < side * 32
        taps = {((y >> 5) + a, (x >> 5) + b): ((y & 31) if a else 32 - (y & 31)) * ((x & 31) if b else 32 - (x & 31))
                for a in (0, 1) for b in (0, 1)}
        taps = {k: w for k, w in taps.items() if usable and w and 0 <= k[0] < side and 0 <= k[1] < side}
        met = [(w, frame[k]) for k, w in taps.items() if k in frame]
        if met or not taps:
            want[i] = tuple((sum(w * v[n] for w, v in met) + 512) >> 10 for n in range(3))
    found = remap.remap_bilinear(px, table)
    rows = {t: {r.col: (r.b, r.g, r.r) for r in found.where(f"ts = {t}").collect()} for t in range(2)}
    assert rows == {0: want, 1: want}
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [i for i, line in enumerate(plan.splitlines()) if "Join" in line]
    assert joins and not any("Exchange" in line for line in plan.splitlines()[:joins[0]]), plan


def test_neighbours_stop_at_a_hole(spark):
    cells = [(1, 0, c, v) for c, v in ((0, 10), (1, 20), (3, 100))]
    raster = spark.createDataFrame(cells, "ts int, row int, col int, gray int")
    found = {r.col: r.gx for r in neighbourhood.sobel_gradient(raster, ["ts"]).collect()}
    assert found == {0: 0, 1: 0, 3: 0}  # no value comes from the other side of column 2


def test_gather_of_many_full_tiles(spark):
    """Tiles of the default size, a map that turns and enlarges, and one that jumps about."""
    rng = np.random.default_rng(6)
    frames = {(t, "c"): rng.integers(0, 256, (300, 290, 3)) for t in range(2)}
    ys, xs = np.indices((270, 300))
    turned = lookup(spark, "c", 0.9 * xs + 0.2 * ys - 8, 0.9 * ys - 0.1 * xs + 3, 290, 300)
    scattered = lookup(spark, "c", rng.uniform(-5, 300, (40, 30)), rng.uniform(-5, 310, (40, 30)), 290, 300)
    for table in (turned, scattered):
        a, b = both_forms(spark, pixel_frame(spark, frames), table, size=tiles.TILE)
        assert a.exceptAll(b.select(*a.columns)).count() == 0 and a.count() == b.count()


def test_tiles_of_sparse_pixels(spark):
    """Against NumPy; tiles are built without a Python call per tile."""
    rng = np.random.default_rng(3)
    cells = {(int(r), int(c)): tuple(map(int, rng.integers(0, 256, 3))) for r, c in rng.integers(0, 23, (90, 2))}
    px = spark.createDataFrame([(t, "c", *k, *v) for t in range(2) for k, v in cells.items()], PX)
    for size in (1, 4, 9, 256):
        made = tiles.to_tiles(px, size)
        assert made.columns == ["ts", "camera", "tile_row", "tile_col", "height", "width", "data"]
        want = {}
        for key in {(r // size, c // size) for r, c in cells}:
            own = {(r % size, c % size): v for (r, c), v in cells.items() if (r // size, c // size) == key}
            block = np.zeros((max(r for r, _ in own) + 1, max(c for _, c in own) + 1, 3), np.uint8)
            for at, v in own.items():
                block[at] = v
            want[key] = (*block.shape[:2], block.tobytes())
        for t in range(2):
            rows = made.where(f"ts = {t}").collect()
            assert {(r.tile_row, r.tile_col): (r.height, r.width, bytes(r.data)) for r in rows} == want and len(rows) == len(want)
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Arrow" not in plan and plan.count("Exchange") == 1, plan


def test_tile_faults(spark):
    rows = [(0, 0, 2, 2, b"x" * 12), (0, 0, 2, 2, b"x" * 11), (0, 1, 0, 2, b""), (1, 0, 2, 2, None), (-1, 0, 1, 1, b"abc"), (0, 0, 5, 2, b"")]
    df = spark.createDataFrame(rows, "tile_row int, tile_col int, height int, width int, data binary")
    found = [r.fault for r in df.select(tiles.tile_fault(4).alias("fault")).collect()]
    assert found == [None, "tile (0, 0): 11 bytes for 2 x 2", "tile (0, 1): size 0 x 2", "tile (1, 0): no data",
                     "tile (-1, 0): no such place", "tile (0, 0): size 5 x 2"]


TABLES = "/root/testdata/sf0.001"


def test_gather_in_parts_of_the_map(spark, monkeypatch):
    """A map's rows are cut into parts and not repeated for a camera with few timestamps."""
    lookup = views.lookup_map(spark, TABLES)
    pixels = views.pixels(spark, TABLES)
    whole = remap.remap_bilinear(pixels, lookup)
    assert "sequence(0, 15" not in whole._jdf.queryExecution().toString()
    expected = sorted(map(tuple, whole.collect()))
    monkeypatch.setattr(remap, "PART_ROWS", 3)
    monkeypatch.setattr(remap, "PART_TIMES", 2)
    assert sorted(map(tuple, remap.remap_bilinear(pixels, lookup).collect())) == expected
    n_images, n_rows = views.images(spark, TABLES).groupBy("camera").count(), lookup.groupBy("camera").count()
    assert len(expected) == n_images.toDF("camera", "n").join(n_rows.toDF("camera", "m"), "camera").selectExpr("sum(n * m)").first()[0]


def test_sight_from_places_and_from_taps(spark):
    """Output pixels see something exactly where they have a tap, at the borders of the image too."""
    at = [-2.0, -1.0, -0.999, -0.99, -0.5, 0.0, 0.5, 6.99, 7.0, 7.01, 7.5, 7.99, 8.0, float("nan"), None]
    rows = [("c", i, j, x, y, 8, 8) for i, x in enumerate(at) for j, y in enumerate(at)]
    lookup = spark.createDataFrame(rows, "camera string, row int, col int, src_x float, src_y float, image_width int, image_height int")
    taps = {(r.out_row, r.out_col) for r in remap.bilinear_taps(lookup).collect()}
    blind = {(r.out_row, r.out_col) for r in remap.blind_pixels(lookup).collect()}
    assert not taps & blind and len(taps | blind) == len(rows)
    assert {(r.row, r.col) for r in remap._block_taps(lookup).collect()} == taps
