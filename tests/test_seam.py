import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_raster import IMAGE, image_row, layout, pixel_frame, random_scene, sobel

from orthoweave.operators import mosaic, seam, tiles
from orthoweave.plans import mosaics


def gray(a):
    return (3735 * a[..., 0] + 19235 * a[..., 1] + 9798 * a[..., 2] + 16384) >> 15


def all_paths(cells, left, right):
    """Every left-to-right path through a set of cells, by exhaustion."""
    for first in sorted(r for r, c in cells if c == left):
        for steps in itertools.product((-1, 0, 1), repeat=right - left):
            path = [first]
            for s in steps:
                path.append(path[-1] + s)
            if all((r, left + i) in cells for i, r in enumerate(path)):
                yield path


def direct_cut(cost):
    """{row: first new column}, or the middle column, from {(row, col): cost}."""
    left, right = min(c for _, c in cost), max(c for _, c in cost)
    best = min(((sum(cost[(r, left + i)] for i, r in enumerate(p)), p[::-1]) for p in
                all_paths(cost, left, right)), default=None)
    if best is None:
        return (left + right) // 2
    path = best[1][::-1]
    rows = {r for r, c in cost if c == left}
    return {r: next((left + i for i, q in enumerate(path) if q == r), None) for r in rows}


COST = "ts long, mosaic_row int, mosaic_col int, cost double, row_start int, col_start int, region_height int"


def lines(spark, cost, first_row=0, first_col=0, height=6, size=256):
    df = spark.createDataFrame(
        [(1, r, c, float(v), first_row, first_col, height) for (r, c), v in cost.items()], COST)
    return {r.mosaic_row: r.seam_col for r in seam.seam_lines(df, size).collect()}


def block(values, row=0, col=3):
    return {(row + r, col + c): v for r, line in enumerate(values) for c, v in enumerate(line)}


def test_unique_path(spark):
    cost = block([[9, 9, 1], [9, 1, 9], [1, 9, 9], [9, 9, 9]])
    # the path climbs from row 2 to row 0; row 3 is not on it and is cut at the image start
    assert lines(spark, cost) == {2: 3, 1: 4, 0: 5, 3: 0}


def test_ties_go_to_the_upper_row(spark):
    assert lines(spark, block([[1, 1, 1], [1, 1, 1], [1, 1, 1]])) == {0: 3, 1: 0, 2: 0}


def test_blocked_path_splits_in_the_middle(spark):
    cost = block([[1, 1, 1], [1, 1, 1]])
    del cost[(0, 4)], cost[(1, 4)]
    assert lines(spark, cost) == {r: 4 for r in range(6)}


def test_rows_without_first_column_have_no_line(spark):
    cost = block([[5, 1], [1, 1]])
    del cost[(0, 3)]
    assert set(lines(spark, cost)) == {1}


@pytest.mark.parametrize("seed", range(4))
def test_random_paths_against_exhaustion(spark, seed):
    rng = np.random.default_rng(seed)
    cost = {k: float(v) for k, v in block(rng.random((5, 4))).items() if rng.random() < 0.85}
    want = direct_cut(cost)
    if isinstance(want, int):
        want = {r: want for r in range(6)}
    assert lines(spark, cost) == {r: 0 if c is None else c for r, c in want.items()}


def whole_cut(cost):
    """The same cut by plain dynamic programming, for overlaps too wide to exhaust."""
    left, right = min(c for _, c in cost), max(c for _, c in cost)
    rows = range(min(r for r, _ in cost) - 1, max(r for r, _ in cost) + 2)
    reach = {(r, left): cost[(r, left)] for r in rows if (r, left) in cost}
    for c in range(left + 1, right + 1):
        for r in rows:
            near = [reach[(q, c - 1)] for q in (r - 1, r, r + 1) if (q, c - 1) in reach]
            if (r, c) in cost and near:
                reach[(r, c)] = min(near) + cost[(r, c)]
    at = min(((reach[(r, right)], r) for r in rows if (r, right) in reach), default=(None, None))[1]
    if at is None:
        return (left + right) // 2
    cut = {at: right}
    for c in range(right - 1, left - 1, -1):
        at = min((reach[(q, c)], q) for q in (at - 1, at, at + 1) if (q, c) in reach)[1]
        cut[at] = c
    return {r: cut.get(r) for r in rows if (r, left) in cost}


@pytest.mark.parametrize("seed", range(6))
def test_blocked_paths_against_whole_ones(spark, seed):
    """Overlaps of many blocks in both directions, ties and holes included."""
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 4, (23, 19)) if seed % 2 else rng.random((23, 19))
    share = 0.97 if seed < 4 else 0.55
    cost = {k: float(v) for k, v in block(values, row=5, col=7).items() if rng.random() < share}
    want = whole_cut(cost)
    if isinstance(want, int):
        want = {r: want for r in range(3, 33)}
    for size in (2, 7) if seed < 2 else (5,):
        assert lines(spark, cost, 3, 2, 30, size) == {r: 2 if c is None else c for r, c in want.items()}


def test_waves(spark):
    """Pairwise overlaps are one wave; an image waits only where three images meet."""
    rows = [image_row(1, f"c{i}", col, 0, 8, 8) for i, col in enumerate((0, 5, 10, 15))]
    rows += [image_row(2, f"c{i}", col, 0, 8, 8) for i, col in enumerate((0, 3, 6, 9))]
    rows += [image_row(3, f"c{i}", col, 0, 4, 4) for i, col in enumerate((0, 4, 9))]
    placed = seam.seam_waves(mosaic.left_to_right(mosaic.place_images(spark.createDataFrame(rows, IMAGE))))
    found = {(r.ts, r.camera): (r.wave, r.olds) for r in placed.collect()}
    assert [found[1, f"c{i}"] for i in range(4)] == [(0, []), (1, [1]), (1, [2]), (1, [3])]
    assert [found[2, f"c{i}"] for i in range(4)] == [(0, []), (1, [1]), (2, [1, 2]), (3, [2, 3])]
    assert all(found[3, f"c{i}"] == (0, []) for i in range(3))


def test_no_task_holds_a_timestamp(spark):
    """No shuffle of the cost and path steps has ts, or ts and image, as its whole key."""
    cost = spark.createDataFrame([(1, 0, 0, 1.0, 0, 0, 1)], COST).withColumn("seq", F.lit(0))
    blocks = cost.select("ts", "seq", *[F.lit(0).alias(n) for n in seam._PLACE], F.lit(b"").alias("cost"))
    plan = seam._forward_step(blocks, None, 0, 4)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"hashpartitioning\(([^)]*?), \d+\)", plan)
    assert keys and all("tile_row" in k for k in keys)


def direct_mosaic(arrays, rows, ts):
    """Seam mosaic and seam map of one ts, image by image on plain arrays."""
    own = layout(rows, ts)
    height, width = max(r0 + h for *_, r0, _, h, _ in own), max(c0 + w for *_, c0, _, w in own)
    out, marks = np.zeros((height, width, 3), int), set()
    x_of = {r[1]: r[5] for r in rows if r[0] == ts}
    for camera, _, r0, c0, h, w in sorted(own, key=lambda x: (x_of[x[0]], x[1])):
        new, old = arrays[(ts, camera)], out[r0:r0 + h, c0:c0 + w]
        new_ok, old_ok = new.any(axis=2), old.any(axis=2)
        use = new_ok & ~old_ok
        shared = new_ok & old_ok
        if shared.any():
            costs = [g / (g.max() + 1e-10) for g in (sobel(gray(new)), sobel(gray(old)))]
            mean = (costs[0] + costs[1]) / 2
            cut = whole_cut({(r, c): mean[r, c] for r, c in zip(*np.nonzero(shared))})
            mask = np.zeros((h, w), bool)
            for r in range(h):
                if isinstance(cut, int):
                    mask[r, cut:] = True
                elif r in cut:
                    mask[r, cut[r] or 0:] = True
            use |= shared & mask
            padded = np.pad(mask, 1)
            near = np.any([padded[a:a + h, b:b + w] for a in range(3) for b in range(3)], axis=0)
            marks |= {(r + r0, c + c0) for r, c in zip(*np.nonzero(near & ~mask))}
        out[r0:r0 + h, c0:c0 + w] = np.where(use[..., None], new, old)
    return out, marks


@pytest.mark.parametrize("seed, size", [(21, 256), (22, 3)])
def test_seam_mosaic_against_direct_evaluation(spark, seed, size):
    arrays, rows = random_scene(seed, 5)
    px, images = pixel_frame(spark, arrays), spark.createDataFrame(rows, IMAGE)
    seams = seam.Seams(tiles.to_tiles(px, size), images, size=size)
    assert seams.placed.agg(F.max("wave")).first()[0] > 1
    found = seams.mosaic_rows().collect()
    marks = {tuple(r) for r in seams.seam_map().collect()}
    assert sorted(map(tuple, mosaics.build_mosaics(px, images, "seam").collect())) == sorted(map(tuple, found))
    for ts in (1, 2):
        want, want_marks = direct_mosaic(arrays, rows, ts)
        got = np.zeros_like(want)
        for r in found:
            if r.ts == ts:
                got[r.mosaic_row, r.mosaic_col] = (r.b, r.g, r.r)
        assert (got == want).all()
        assert {(r, c) for t, r, c in marks if t == ts} == want_marks


@pytest.mark.parametrize("method", ["variance", "combined"])
def test_other_costs_keep_every_cell(spark, method):
    arrays, rows = random_scene(31, 3)
    px, images = pixel_frame(spark, arrays), spark.createDataFrame(rows, IMAGE)
    cells = {(r.ts, r.mosaic_row, r.mosaic_col): (r.b, r.g, r.r)
             for r in seam.mosaic_seam(px, images, method).collect()}
    placed = mosaic.placed_pixels(px, mosaic.place_images(images)).where("greatest(b, g, r) > 0")
    sources = {}
    for r in placed.collect():
        sources.setdefault((r.ts, r.mosaic_row, r.mosaic_col), set()).add((r.b, r.g, r.r))
    assert cells.keys() == sources.keys()
    assert all(v in sources[k] for k, v in cells.items())
