import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orthoweave.operators import catalog
from orthoweave.plans import run as runs
from orthoweave.sources import files, images, tables


def png(a):
    """A PNG file of an H x W (gray) or H x W x 3 (R, G, B) array."""
    h, w = a.shape[:2]
    kind = 0 if a.ndim == 2 else 2
    raw = b"".join(b"\0" + row.tobytes() for row in a.astype(np.uint8))

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def tiff(a):
    """An uncompressed TIFF file of an H x W x 3 (R, G, B) array."""
    h, w = a.shape[:2]
    data = a.astype(np.uint8).tobytes()
    entries = [(256, 4, 1, w), (257, 4, 1, h), (258, 3, 3, 8 + len(data)), (259, 3, 1, 1), (262, 3, 1, 2),
               (273, 4, 1, 8), (277, 3, 1, 3), (278, 4, 1, h), (279, 4, 1, len(data))]
    directory = struct.pack("<H", len(entries))
    for tag, kind, count, value in entries:
        directory += struct.pack("<HHI", tag, kind, count)
        directory += struct.pack("<HH", value, 0) if kind == 3 and count == 1 else struct.pack("<I", value)
    return (struct.pack("<2sHI", b"II", 42, 8 + len(data) + 6) + data + struct.pack("<HHH", 8, 8, 8)
            + directory + struct.pack("<I", 0))


def test_scan_videos(spark, tmp_path):
    for name in ("b.dav", "a.MP4", "c.Mp4", "d.txt", "sub/e.dav", "sub one/f.mkv"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * 10)
    base = str(tmp_path)
    flat = [r.path for r in files.scan_video_files(spark, base).collect()]
    assert flat == [f"{base}/a.MP4", f"{base}/b.dav"]
    deep = [r.path for r in files.scan_video_files(spark, base, recursive=True).collect()]
    assert deep == [f"{base}/a.MP4", f"{base}/b.dav", f"{base}/sub one/f.mkv", f"{base}/sub/e.dav"]


def test_scan_images(spark, tmp_path):
    rng = np.random.default_rng(0)
    color, gray = rng.integers(0, 256, (5, 7, 3)), rng.integers(0, 256, (4, 3))
    (tmp_path / "a.tif").write_bytes(tiff(color))
    (tmp_path / "b.tiff").write_bytes(b"not an image")
    (tmp_path / "c.png").write_bytes(png(gray))
    scanned = files.scan_images(spark, str(tmp_path))
    assert [r.path for r in scanned.collect()] == [f"{tmp_path}/a.tif"]
    got = np.zeros((5, 7, 3), int)
    for r in files.image_pixels(scanned).collect():
        got[r.row, r.col] = (r.r, r.g, r.b)
    assert (got == color).all()
    pixels = files.image_pixels(files.scan_images(spark, str(tmp_path), "*.png")).collect()
    assert {(r.row, r.col): (r.b, r.g, r.r) for r in pixels} == {
        (r, c): (gray[r, c],) * 3 for r in range(4) for c in range(3)}


def test_written_tiffs(spark, tmp_path):
    """Own files, of odd sizes too, come back with the same pixels through the image reader."""
    rng = np.random.default_rng(1)
    blocks = {f"s/{h}x{w}.tif": rng.integers(0, 256, (h, w, 3), np.uint8) for h, w in ((1, 1), (3, 5), (40, 7), (8, 8))}
    rows = spark.createDataFrame([(p, *b.shape[:2], b.tobytes()) for p, b in blocks.items()],
                                 "path string, height int, width int, data binary")
    written = images.write_files(images.as_tiff(rows), f"file:{tmp_path}").collect()
    assert {r.path for r in written} == set(blocks) and all(r.bytes == (tmp_path / r.path).stat().st_size for r in written)
    for r in files.scan_images(spark, f"{tmp_path}/s").collect():
        block = blocks["s/" + r.path.rsplit("/", 1)[1]]
        assert (r.height, r.width, r.n_channels) == block.shape and bytes(r.data) == block.tobytes()


def test_world_files(spark, tmp_path):
    (tmp_path / "x_ortho.tfw").write_text("0.0025\n0\n0\n-0.0025\n-12.5\n40.25\n")
    row = files.scan_world_files(spark, str(tmp_path)).first()
    assert (row.stem, row.pixel_width, row.pixel_height, row.x_min, row.y_max) == (
        "x_ortho", 0.0025, -0.0025, -12.5, 40.25)
    text = files.scan_world_files(spark, str(tmp_path)).select(tables.world_file_text()).first()[0]
    assert text == "0.0025\n0\n0\n-0.0025\n-12.5\n40.25"


def test_gcp_and_channel_csv(spark, tmp_path):
    (tmp_path / "g.csv").write_text("camera_name,X,Y,Z,col_sample,row_sample\nc1,-2.5,1.5,-8,1543.25,2099\n")
    assert tuple(files.scan_gcp_csv(spark, str(tmp_path / "g.csv")).first()) == (
        "c1", -2.5, 1.5, -8.0, 1543.25, 2099.0)
    (tmp_path / "m.csv").write_text("channel,camera name\n1,NVR1_a\n2,NVR1_b\n")
    assert [tuple(r) for r in files.scan_channel_map(spark, str(tmp_path / "m.csv")).collect()] == [
        (1, "NVR1_a"), (2, "NVR1_b")]


def test_one_version_is_replaced(spark, tmp_path):
    store = spark.createDataFrame([("20250101", "01", 1.0), ("original", "01", 2.0)],
                                  "version string, camera string, rms double")
    path = str(tmp_path / "store")
    tables.write_calibrations(store, path)
    tables.write_calibrations(store.where("version = '20250101'").withColumn("rms", F.lit(9.0)), path)
    assert {(r.version, r.camera, r.rms) for r in tables.read_calibrations(spark, path).collect()} == {
        ("20250101", "01", 9.0), ("original", "01", 2.0)}
    assert tables.read_calibrations(spark, path, "original").count() == 1


def inputs(spark, with_frames=True):
    paths = spark.createDataFrame(
        [("/v/r1/cam_20240101000000_20240101020000.dav",), ("/v/r2/cam_20240101000000_20240101010000.dav",)],
        "path string")
    grid = catalog.make_grid(spark, "2024-01-01 00:00:00", "2024-01-01 02:00:00", "1h")
    px = [(f"2024-01-01 0{h}:00:00", cam, r, c, 10 * h + c + 1, 5, 5)
          for h in (0, 1) for cam in ("r1_cam", "r2_cam") for r in range(4) for c in range(4)]
    frames = spark.createDataFrame(px if with_frames else [], "t string, camera string, row int, col int, b int, g int, r int")
    frames = frames.withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t")
    cells = [("r1_cam", r, c, float(c), float(r), 4, 4) for r in range(4) for c in range(4)]
    lookup = spark.createDataFrame(
        cells, "camera string, row int, col int, src_x float, src_y float, image_width int, image_height int")
    grids = spark.createDataFrame(
        [("r1_cam", 4, 4, 0.0, 1.0, 0.25, -0.25)],
        "camera string, width int, height int, x_min double, y_max double, pixel_width double, pixel_height double")
    return runs.RunInputs(paths, grid, frames, lookup, grids, base="/v", fps=F.lit(25.0))


def counts(status):
    return {r.stage: (r.succeeded, r.total) for r in runs.summary(status).collect()}


def test_run_and_partial_runs(spark, tmp_path):
    folder = str(tmp_path / "run")
    # r1 covers three times, r2 two; frames exist for two times; only r1 is calibrated
    assert counts(runs.run(spark, inputs(spark), folder)) == {"extract": (4, 5), "ortho": (2, 4), "mosaic": (2, 2)}
    again = runs.run(spark, inputs(spark), folder, ("mosaic",), method="order")
    assert counts(again) == {"mosaic": (2, 2)}
    stored = tables.read_stage(spark, f"{folder}/mosaics/pixels").where("ts_folder = '20240101_010000'")
    assert {(r.mosaic_row, r.mosaic_col): r.b for r in stored.collect()} == {
        (r, c): 11 + c for r in range(4) for c in range(4)}
    with pytest.raises(ValueError):
        runs.run(spark, inputs(spark), folder, ("paint",))


def test_run_stops_without_frames(spark, tmp_path):
    status = runs.run(spark, inputs(spark, with_frames=False), str(tmp_path / "run"))
    assert counts(status) == {"extract": (0, 5)}
    assert {r.error for r in status.collect()} == {"no frame"}


def test_stage_files_follow_bands_not_images_or_tasks(spark, tmp_path):
    """A time has a file per band, however many cameras and tasks; the work is dealt out."""
    times = spark.range(40).select(
        F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"))
    images = times.crossJoin(spark.range(6).select(F.format_string("%02d", "id").alias("camera")))
    rows = images.crossJoin(spark.range(3).select(F.col("id").cast("int").alias("row"))).repartition(8).select(
        "ts", "camera", "row", F.lit(0).alias("col"), *[F.lit(1).alias(c) for c in "bgr"])
    tables.write_frames(rows, f"{tmp_path}/frames")
    tables.write_list(images.repartition(8), f"{tmp_path}/list")
    tables.write_world_files(times.select(
        F.format_string("m%s", F.date_format("ts", "ddHH")).alias("name"),
        *[F.lit(1.0).alias(c) for c in ("pixel_width", "rotation_x", "rotation_y", "pixel_height", "x_min", "y_max")]),
        f"{tmp_path}/world")
    files = {name: list((tmp_path / name).rglob("part-*")) for name in ("frames", "list", "world")}
    assert {name: len(found) for name, found in files.items()} == {"frames": 40, "list": 40, "world": 40}
    for found in files.values():
        assert len({path.name[:10] for path in found}) > 1  # written by several tasks
    back = tables.read_stage(spark, f"{tmp_path}/frames")
    assert back.count() == 720 and back.schema["camera"].dataType.simpleString() == "string"
    tiled = images.crossJoin(spark.range(5).select(F.col("id").cast("int").alias("tile_row"))).withColumn("data", F.lit(b"x"))
    tables.write_frames(tiled, f"{tmp_path}/tiles", size=4)
    assert len(list((tmp_path / "tiles").rglob("part-*"))) == 40


def strips_tiff(block, order=">", extra=()):
    """The image in strips of two rows, in another byte order, with more tags (tag, kind, value)."""
    height, width = block.shape[:2]
    strips = [block[top:top + 2, :, ::-1].tobytes() for top in range(0, height, 2)]
    data, places = b"".join(strips), np.cumsum([8, *map(len, strips[:-1])]).tolist()
    data += bytes(len(data) % 2)
    tags = [(256, 3, [width]), (257, 3, [height]), (258, 3, [8, 8, 8]), (259, 3, [1]), (262, 3, [2]), (273, 4, places),
            (277, 3, [3]), (278, 3, [2]), (279, 4, list(map(len, strips))), *[(t, k, [v]) for t, k, v in extra]]
    after, entries = b"", b""
    at = 8 + len(data) + 2 + 12 * len(tags) + 4
    for tag, kind, values in sorted(tags):
        packed = struct.pack(f"{order}{len(values)}{'H' if kind == 3 else 'I'}", *values)
        place = packed.ljust(4, b"\0") if len(packed) <= 4 else struct.pack(f"{order}I", at + len(after))
        after += packed if len(packed) > 4 else b""
        entries += struct.pack(f"{order}HHI", tag, kind, len(values)) + place
    head = (b"MM\0*" if order == ">" else b"II*\0") + struct.pack(f"{order}I", 8 + len(data))
    return head + data + struct.pack(f"{order}H", len(tags)) + entries + bytes(4) + after


def test_plain_images_are_read_as_they_are(spark, tmp_path):
    """Folders of plain files do not go through the image reader, and give what it gives."""
    rng = np.random.default_rng(6)
    (tmp_path / "a b").mkdir()
    blocks = {f"a b/{n}.tif": rng.integers(0, 256, (5, 3 + n, 3)).astype(np.uint8) for n in range(4)}
    for n, (name, block) in enumerate(blocks.items()):
        made = (images.tiff_bytes(block), strips_tiff(block), strips_tiff(block, "<"), strips_tiff(block, "<", [(284, 3, 1), (296, 3, 2)]))[n]
        (tmp_path / name).write_bytes(made)
        assert (images.plain_tiff(made) == block).all()
    plain = files.scan_images(spark, str(tmp_path), recursive=True)
    assert "FileScan image" not in plain._jdf.queryExecution().executedPlan().toString()
    whole = strips_tiff(blocks["a b/0.tif"])
    for other in (whole[:20], whole[:-30], b"", strips_tiff(blocks["a b/0.tif"], extra=[(274, 3, 6)]), strips_tiff(blocks["a b/0.tif"], extra=[(284, 3, 2)])):
        assert images.plain_tiff(other) is None
    (tmp_path / "bad.tif").write_bytes(b"no image")
    decoded = files.scan_images(spark, str(tmp_path), recursive=True)
    assert "FileScan image" in decoded._jdf.queryExecution().executedPlan().toString()
    found = [sorted(map(tuple, df.collect())) for df in (plain, decoded)]
    assert found[0] == found[1]
    assert [r[0].rsplit("/", 2)[-1] for r in found[0]] == [f"{n}.tif" for n in range(4)]
