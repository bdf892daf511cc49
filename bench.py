"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma separated names, default the list below).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F

from orthoweave.operators import tiles
from orthoweave.session import get_session, work_dir
from orthoweave.suite import QUERIES

HEADLINE = (
    "P1_parse_video_name", "J1_match_frames", "C1_plan_frames", "A9_requests_per_video",
    "A5_reprojection_rms", "J8_close_pairs", "C7_recalibration_qc", "J2_match_calibration",
    "J6_dem_bilinear", "S6_build_ortho_map", "J5_remap_bilinear", "C5_orthorectify",
    "A12_mosaic_center", "A12_mosaic_order", "W2_sobel_gradient", "W3_local_variance",
    "W4_combined_cost", "A14_band_stats", "S2_mosaic_seam", "J5_remap_tiles",
    "A12_mosaic_center_tiles",
)

# Large images for the tile operators: one per group of ORDERS_PER_IMAGE orders.
IMAGE_SIDE, TILE, CAMERAS, ORDERS_PER_IMAGE = 1024, 256, 8, 1500


def large_frames(spark, sf_dir):
    """Frame tiles (ts, camera, ...) of SIDE x SIDE images, made from lineitem inside Spark:
    a tile's bytes are the hashes of its image's prices, repeated over the tile."""
    image = F.floor(F.col("l_orderkey") / ORDERS_PER_IMAGE)
    images = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy(image.alias("image")).agg(
        F.sha2(F.sum("l_extendedprice").cast("string").cast("binary"), 512).alias("seed"))
    blocks = IMAGE_SIDE // TILE
    cells = F.explode(F.sequence(F.lit(0), F.lit(blocks * blocks - 1))).alias("cell")
    text = F.concat(F.col("seed"), F.col("cell").cast("string"))
    size = TILE * TILE * 3
    return images.select("image", "seed", cells).select(
        F.floor(F.col("image") / CAMERAS).alias("ts"), (F.col("image") % CAMERAS).cast("int").alias("camera"),
        F.floor(F.col("cell") / blocks).cast("int").alias("tile_row"), (F.col("cell") % blocks).cast("int").alias("tile_col"),
        F.lit(TILE).alias("height"), F.lit(TILE).alias("width"),
        F.substring(F.repeat(text, size // 128 + 1).cast("binary"), 1, size).alias("data"))


def large_map(spark):
    """A rotated, enlarging lookup map of every camera, as rows."""
    cell = spark.range(CAMERAS * IMAGE_SIDE * IMAGE_SIDE)
    row, col = (F.expr(f"cast(id div {IMAGE_SIDE} % {IMAGE_SIDE} as int)"), (F.col("id") % IMAGE_SIDE).cast("int"))
    return cell.select(
        F.expr(f"cast(id div {IMAGE_SIDE * IMAGE_SIDE} as int)").alias("camera"), row.alias("row"), col.alias("col"),
        (0.9 * col + 0.2 * row).cast("float").alias("src_x"), (0.9 * row - 0.1 * col).cast("float").alias("src_y"),
        F.lit(IMAGE_SIDE).alias("image_width"), F.lit(IMAGE_SIDE).alias("image_height"))


def large_rasters(spark, sf_dir, cpus):
    """Seconds, and output megapixels per core second, of gather and mosaic on large images."""
    folder = work_dir(spark, "bench")
    tiles.map_tiles(large_map(spark), TILE).write.parquet(f"{folder}/map")
    large_frames(spark, sf_dir).write.parquet(f"{folder}/frames")
    lookup, frames = spark.read.parquet(f"{folder}/map"), spark.read.parquet(f"{folder}/frames")
    started = time.perf_counter()
    tiles.remap_tiles(frames, lookup, size=TILE).write.parquet(f"{folder}/orthos")
    gather = time.perf_counter() - started
    orthos = spark.read.parquet(f"{folder}/orthos")
    n = orthos.count() * TILE * TILE
    x = F.col("camera") * (IMAGE_SIDE * 0.75)
    images = orthos.select("ts", "camera").distinct().select(
        "ts", "camera", F.format_string("%02d.tif", "camera").alias("file"), F.lit(IMAGE_SIDE).alias("width"),
        F.lit(IMAGE_SIDE).alias("height"), x.cast("double").alias("x_min"), F.lit(0.0).alias("y_max"),
        F.lit(1.0).alias("pixel_width"), F.lit(-1.0).alias("pixel_height"))
    started = time.perf_counter()
    built = tiles.mosaic_tiles(orthos, images, "center", size=TILE)
    made = built.agg(F.count("*")).first()[0] * TILE * TILE
    mosaic = time.perf_counter() - started
    rate = lambda pixels, seconds: round(pixels / 1e6 / seconds / int(cpus), 3)
    return {"large_gather_tiles": round(gather, 3), "large_mosaic_tiles": round(mosaic, 3)}, {
        "gather_mpx_per_core_s": rate(n, gather), "mosaic_mpx_per_core_s": rate(made, mosaic),
        "gather_mpx": round(n / 1e6, 1), "mosaic_mpx": round(made / 1e6, 1)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = get_session(
        "orthoweave-bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["A4_gcp_counts"](spark, sf_dir).collect()  # starts the session's machinery
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    large, rates = large_rasters(spark, sf_dir, cpus) if not chosen else ({}, {})
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds | large, "rates": rates, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
