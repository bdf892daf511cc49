"""Readers of the files that a site delivers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orthoweave.functions import names
from orthoweave.operators.tiles import packed
from orthoweave.sources import images as images_source

GCP_SCHEMA = ("camera_name string, X double, Y double, Z double, "
              "col_sample double, row_sample double")
CHANNEL_SCHEMA = "channel int, camera_name string"
PIXEL_SCHEMA = "path string, row int, col int, b int, g int, r int"


def _plain_path(path: str) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def scan_video_files(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame:
    """Sorted distinct paths of the videos in a folder. Reads no file content."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(directory)
        .select(_plain_path("path").alias("path"))
    )
    return listed.where(names.has_video_extension("path")).distinct().orderBy("path")


IMAGE_SCHEMA = "path string, height int, width int, n_channels int, data binary"


def scan_images(spark: SparkSession, directory: str, glob: str = "*.tif*", recursive: bool = False) -> DataFrame:
    """Decodable images of a folder: path, height, width, n_channels, data (B, G, R bytes).

    The files are looked at once before: if all are plain TIFF images, tasks take the bytes
    as they are; if any is not, Spark's image reader decodes all, several milliseconds each.
    """
    def read(kind: str) -> DataFrame:
        return spark.read.format(kind).option("recursiveFileLookup", recursive).option(
            "pathGlobFilter", glob).option("dropInvalid", True).load(directory)

    def is_other(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [images_source.plain_tiff(memoryview(data.as_buffer())) is None for data in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([True] * sum(found), pa.bool_())], ["other"])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for path, data in zip(batch.column(0), batch.column(1), strict=True):
                block = images_source.plain_tiff(memoryview(data.as_buffer()))
                if block is None:
                    raise ValueError(f"no plain image any more: {path.as_py()}")
                yield {"path": path.as_py(), "height": block.shape[0], "width": block.shape[1],
                       "n_channels": 3, "data": block.tobytes()}

    # Spark deals few files to a task, as if each had megabytes
    files = read("binaryFile").select(_plain_path("_metadata.file_path").alias("path"), "content").coalesce(
        int(spark.conf.get("spark.sql.shuffle.partitions")))
    if files.select("content").mapInArrow(is_other, "other boolean").limit(1).count() == 0:
        schema = pa.schema([("path", pa.string()), ("height", pa.int32()), ("width", pa.int32()),
                            ("n_channels", pa.int32()), ("data", pa.binary())])
        return files.mapInArrow(
            lambda batches: packed(decode(batches), schema), IMAGE_SCHEMA)
    return read("image").select(
        _plain_path("image.origin").alias("path"),
        F.col("image.height").alias("height"), F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("n_channels"), F.col("image.data").alias("data"))


def decode_bgr(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Height x width x 3 array; gray images repeat their channel, alpha is dropped."""
    array = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(array, 3, axis=2) if channels == 1 else array[:, :, :3]


def _pixel_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for image in batch.to_pylist():
            array = decode_bgr(image["data"], image["height"], image["width"], image["n_channels"])
            # one batch per band of rows keeps the memory of a large image bounded
            band = max(1, 65536 // max(1, image["width"]))
            for top in range(0, image["height"], band):
                part = array[top:top + band].astype(np.int32)
                rows, cols = np.indices(part.shape[:2], dtype=np.int32)
                values = part.reshape(-1, 3)
                yield pa.RecordBatch.from_pydict({
                    "path": pa.array([image["path"]] * len(values), pa.string()),
                    "row": rows.ravel() + np.int32(top), "col": cols.ravel(),
                    "b": values[:, 0], "g": values[:, 1], "r": values[:, 2]})


def image_pixels(images: DataFrame) -> DataFrame:
    """Pixel rows (path, row, col, b, g, r) of scanned images."""
    wanted = images.select("path", "height", "width", "n_channels", "data")
    return wanted.mapInArrow(_pixel_batches, PIXEL_SCHEMA)


TILE_SCHEMA = ("path string, tile_row int, tile_col int, height int, width int, "
               "image_height int, image_width int, data binary")


def image_tiles(images: DataFrame, size: int = 256) -> DataFrame:
    """Tiles (path, tile_row, tile_col, height, width, image_height, image_width, data) of
    scanned images, cut inside the task that holds the image: no pixel rows, no shuffle."""
    schema = pa.schema([("path", pa.string()), *[(n, pa.int32()) for n in (
        "tile_row", "tile_col", "height", "width", "image_height", "image_width")], ("data", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for image in batch.to_pylist():
                array = decode_bgr(image["data"], image["height"], image["width"], image["n_channels"])
                for top in range(0, image["height"], size):
                    for left in range(0, image["width"], size):
                        part = array[top:top + size, left:left + size]
                        yield {
                            "path": image["path"], "tile_row": top // size, "tile_col": left // size,
                            "height": part.shape[0], "width": part.shape[1],
                            "image_height": image["height"], "image_width": image["width"], "data": part.tobytes()}

    return images.select("path", "height", "width", "n_channels", "data").mapInArrow(
        lambda batches: packed(cut(batches), schema), TILE_SCHEMA)


def scan_world_files(spark: SparkSession, directory: str, glob: str = "*.tfw") -> DataFrame:
    """Geotransforms (path, stem, pixel_width, rotation_x, rotation_y, pixel_height, x_min, y_max)."""
    texts = (
        spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
        .text(directory, wholetext=True)
        .select(_plain_path("_metadata.file_path").alias("path"), "value")
    )
    return parse_world_text(texts.withColumn("stem", names.stem("path")))


def parse_world_text(texts: DataFrame, text: str = "value") -> DataFrame:
    """Six numbers, one per line, in place of the text column."""
    lines = F.split(F.col(text), "\n")
    fields = ("pixel_width", "rotation_x", "rotation_y", "pixel_height", "x_min", "y_max")
    return texts.withColumns({
        name: F.trim(F.get(lines, F.lit(i))).cast("double") for i, name in enumerate(fields)
    }).drop(text)


def scan_gcp_csv(spark: SparkSession, path: str) -> DataFrame:
    """Control points of one or many CSV files."""
    return spark.read.schema(GCP_SCHEMA).option("recursiveFileLookup", True).csv(path, header=True)


def scan_channel_map(spark: SparkSession, path: str) -> DataFrame:
    """Channel numbers and camera names."""
    return spark.read.schema(CHANNEL_SCHEMA).csv(path, header=True, enforceSchema=True)
