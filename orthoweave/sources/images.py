"""Images as files: uncompressed TIFF, one file per image, written by the tasks."""

from __future__ import annotations

import posixpath
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark.sql import DataFrame

# TIFF field types, and tags of a baseline RGB image in ascending order.
SHORT, LONG = 3, 4
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSET, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES = 273, 277, 278, 279
NO_COMPRESSION, RGB = 1, 2
# Tags that do not change the pixels of such an image: file type and planes (with the value
# they must have), resolution and its unit.
SUBFILE, PLANES, NEUTRAL = 254, 284, (282, 283, 296)


def tiff_bytes(block: np.ndarray) -> bytes:
    """A little-endian TIFF of a height x width x 3 block of B, G, R bytes, in one strip."""
    height, width = block.shape[:2]
    data = block[:, :, ::-1].tobytes()
    bits_at = 8
    data_at = bits_at + 6
    fields = [
        (WIDTH, LONG, 1, width), (HEIGHT, LONG, 1, height), (BITS, SHORT, 3, bits_at), (COMPRESSION, SHORT, 1, NO_COMPRESSION),
        (PHOTOMETRIC, SHORT, 1, RGB), (STRIP_OFFSET, LONG, 1, data_at), (SAMPLES, SHORT, 1, 3), (ROWS_PER_STRIP, LONG, 1, height),
        (STRIP_BYTES, LONG, 1, len(data))]
    padding = len(data) % 2
    head = struct.pack("<2sHI", b"II", 42, data_at + len(data) + padding) + struct.pack("<3H", 8, 8, 8)
    # a single short value lies in the first half of its field, as little-endian does anyway
    directory = struct.pack("<H", len(fields)) + b"".join(struct.pack("<HHII", *f) for f in fields) + bytes(4)
    return head + data + bytes(padding) + directory


def plain_tiff(data: bytes | memoryview) -> np.ndarray | None:
    """Height x width x 3 block of B, G, R bytes of a file with one uncompressed image of
    three 8-bit channels and no tags but those of tiff_bytes() and neutral ones. None for all
    other files, damaged ones too."""
    order = {b"II*\x00": "<", b"MM\x00*": ">"}.get(bytes(data[:4]))
    if order is None or len(data) < 8:
        return None
    kinds = {SHORT: f"{order}u2", LONG: f"{order}u4"}
    at = int(np.frombuffer(data, f"{order}u4", 1, 4)[0])
    if at + 2 > len(data):
        return None
    count = int(np.frombuffer(data, f"{order}u2", 1, at)[0])
    end = at + 2 + 12 * count
    if end + 4 > len(data) or np.frombuffer(data, f"{order}u4", 1, end)[0]:
        return None
    tags: dict[int, list[int]] = {}
    for k in range(at + 2, end, 12):
        tag, kind, n, place = struct.unpack_from(f"{order}HHII", data, k)
        if tag in NEUTRAL:
            continue
        if kind not in kinds or tag in tags:
            return None
        place = k + 8 if n * np.dtype(kinds[kind]).itemsize <= 4 else place
        if place + n * np.dtype(kinds[kind]).itemsize > len(data):
            return None
        tags[tag] = np.frombuffer(data, kinds[kind], n, place).tolist()
    fixed = {BITS: [8, 8, 8], COMPRESSION: [NO_COMPRESSION], PHOTOMETRIC: [RGB], SAMPLES: [3]}
    if tags.pop(SUBFILE, [0]) != [0] or tags.pop(PLANES, [1]) != [1] or any(tags.pop(t, None) != v for t, v in fixed.items()):
        return None
    if tags.keys() != {WIDTH, HEIGHT, STRIP_OFFSET, ROWS_PER_STRIP, STRIP_BYTES} or not all(
            len(tags[t]) == 1 for t in (WIDTH, HEIGHT, ROWS_PER_STRIP)):
        return None
    (width,), (height,), (rows,) = tags[WIDTH], tags[HEIGHT], tags[ROWS_PER_STRIP]
    if not (width and height and rows):
        return None
    sizes = [min(rows, height - top) * width * 3 for top in range(0, height, rows)]
    strips = list(zip(tags[STRIP_OFFSET], tags[STRIP_BYTES], strict=False))
    if sizes != tags[STRIP_BYTES] or len(tags[STRIP_OFFSET]) != len(sizes) or any(a + n > len(data) for a, n in strips):
        return None
    block = np.frombuffer(b"".join(data[a:a + n] for a, n in strips), np.uint8).reshape(height, width, 3)
    return block[:, :, ::-1]


def open_store(folder: str) -> tuple[pa_fs.FileSystem, str]:
    """File system and path of a folder that all tasks reach."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return pa_fs.FileSystem.from_uri(folder)


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Writes rows (path, content) as files below a folder; gives (path, bytes) when run. A
    repeated task writes the same file again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_store(folder)
        for batch in batches:
            names, sizes = batch.column(0).to_pylist(), []
            for name, content in zip(names, batch.column(1).to_pylist(), strict=True):
                target = f"{base}/{name}"
                system.create_dir(posixpath.dirname(target), recursive=True)
                with system.open_output_stream(target) as out:
                    out.write(content)
                sizes.append(len(content))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["path", "bytes"])

    return files.select("path", "content").mapInArrow(run, "path string, bytes long")


def as_tiff(images: DataFrame) -> DataFrame:
    """Rows (path, content) of whole images (path, height, width, data), ready to be written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [tiff_bytes(np.frombuffer(i["data"], np.uint8).reshape(i["height"], i["width"], 3)) for i in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(done, pa.binary())], ["path", "content"])

    return images.select("path", "height", "width", "data").mapInArrow(run, "path string, content binary")
