"""Joins between images, cameras, control points and names."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as pa_ds
import pyarrow.fs as pa_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orthoweave.functions import names
from orthoweave.functions.util import as_column
from orthoweave.session import work_dir

# Copies of the small side of a join whose key may be dominated by one camera.
SALTS = 16
# Identifiers looked for at once, and blocks of them that a task keeps.
NAME_BLOCK, KEPT_BLOCKS = 50_000, 4


def salted_join(big: DataFrame, small: DataFrame, on: list[str], spread_by: list[str],
                how: str = "inner", salts: int = SALTS, grows: bool = False) -> DataFrame:
    """Equi-join that splits every key of ``big`` into ``salts`` parts.

    The small side (cameras, lookup maps) is repeated per part, so a camera that
    holds a third of ``big`` is still worked on by many tasks. Spark's estimate of its size
    leaves the repeats out: a small side that ``grows`` with the data is never broadcast, and
    both sides go to as many tasks as the session has shuffle partitions, since the rows made
    do not show in the bytes that Spark would merge partitions by.
    """
    part = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = big.withColumn("_salt", part)
    if grows:
        n = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salted = salted.repartition(n, *on, "_salt")
        repeated = repeated.repartition(n, *on, "_salt").hint("merge")
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def with_metadata(data: DataFrame, metadata: DataFrame, on: list[str]) -> DataFrame:
    """Pixels or tiles joined with rows about their image; Spark broadcasts the metadata
    if its bytes are within its own limit."""
    return data.join(metadata, on)


class _Names:
    """Blocks of identifiers in a stored table, each with its Aho-Corasick automaton. A few
    blocks are kept, more are built again for each batch of texts."""

    def __init__(self, folder: str, column: str):
        path = "/" + folder.removeprefix("file:").lstrip("/") if folder.startswith("file:") else folder
        system, path = pa_fs.FileSystem.from_uri(path)
        self.data, self.column = pa_ds.dataset(path, format="parquet", filesystem=system), column
        self.kept = [] if self.data.count_rows() <= KEPT_BLOCKS * NAME_BLOCK else None

    def blocks(self) -> Iterator[tuple]:
        """(automaton, rows) of every block."""
        import ahocorasick
        if self.kept:
            yield from self.kept
            return
        for batch in self.data.to_batches(batch_size=NAME_BLOCK):
            automaton = ahocorasick.Automaton()
            rows: dict[str, list[int]] = {}
            for i, name in enumerate(batch.column(self.column).to_pylist()):
                rows.setdefault(name, []).append(i)
            for name, found in rows.items():
                automaton.add_word(name, found)
            if rows:
                automaton.make_automaton()
                if self.kept is not None:
                    self.kept.append((automaton, batch))
                yield automaton, batch


def contains_join(texts: DataFrame, text: str, ids: DataFrame, id_column: str) -> DataFrame:
    """All pairs where ``text`` contains the identifier, in one pass over each text.

    The identifiers are written to the shared folder and read by the tasks in blocks of
    NAME_BLOCK; an automaton finds all of a block's identifiers in a text at once. Texts
    are not shuffled, and there is no row per place or per identifier tried. Empty and
    NULL identifiers are in no text; a pair is given once, however often it occurs.
    """
    folder = work_dir(texts.sparkSession, "names")
    ids.where(F.length(id_column) > 0).write.parquet(folder)
    schema = T.StructType([*texts.schema.fields, *ids.schema.fields])
    arrow, place = to_arrow_schema(schema), texts.columns.index(text)

    ids_columns = ids.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _Names(folder, id_column)
        for batch in batches:
            values = batch.column(place).to_pylist()
            for automaton, block in names.blocks():
                rows, found = [], []
                for i, value in enumerate(values):
                    if value:
                        hits = sorted({k for _, ks in automaton.iter(value) for k in ks})
                        rows += [i] * len(hits)
                        found += hits
                at, to = pa.array(rows, pa.int64()), pa.array(found, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [c.take(at).cast(f.type) for c, f in zip(batch.columns, arrow, strict=False)]
                    + [block.column(n).take(to).cast(arrow.field(batch.num_columns + k).type) for k, n in enumerate(ids_columns)],
                    schema=arrow)

    return texts.mapInArrow(run, schema)


def match_calibration(images: DataFrame, cameras: DataFrame, path: str = "path") -> DataFrame:
    """Each image path with the first camera, in ``cal_order``, named anywhere in it."""
    pairs = contains_join(images.select(path).distinct(), path, cameras, "camera")
    return pairs.groupBy(path).agg(F.min_by("camera", "cal_order").alias("camera"))


def image_for_camera(cameras: DataFrame, images: DataFrame, path: str = "path") -> DataFrame:
    """Each camera with the first path whose file name contains it."""
    named = images.select(path, names.base_name(path).alias("_name"))
    pairs = contains_join(named, "_name", cameras.select("camera"), "camera")
    return pairs.groupBy("camera").agg(F.min(path).alias(path))


def gcp_for_camera(gcps: DataFrame, cameras: DataFrame, match: str = "equals") -> DataFrame:
    """Control points of each camera, by equal or by contained camera name."""
    ids = cameras.select("camera").distinct()
    if match == "equals":
        return gcps.join(ids, gcps["camera_name"] == ids["camera"])
    if match == "contains":
        return contains_join(gcps, "camera_name", ids, "camera")
    raise ValueError(f"unknown match: {match!r}")


def has_world_file(rasters: DataFrame, world_files: DataFrame) -> DataFrame:
    """Rasters with a world file of the same stem."""
    return rasters.join(world_files.select("stem").distinct(), "stem", "left_semi")


def frames_without_calibration(images: DataFrame, matched: DataFrame, path: str = "path") -> DataFrame:
    """Images that no camera of the calibration matches."""
    return images.join(matched.select(path), path, "left_anti")


def cameras_without_image(cameras: DataFrame, matched: DataFrame) -> DataFrame:
    """Cameras that no image belongs to."""
    return cameras.join(matched.select("camera"), "camera", "left_anti")


def apply_channel_map(frames: DataFrame, channel_map: DataFrame, channel="channel") -> DataFrame:
    """Frames with the camera name of their channel."""
    names_by_channel = channel_map.select(F.col("channel").alias("_channel"), "camera_name")
    return frames.join(names_by_channel, as_column(channel) == F.col("_channel")).drop("_channel")


def rename_camera(records: DataFrame, short: str, full: str) -> DataFrame:
    """Re-key one camera of a calibration table."""
    renamed = F.when(F.col("camera") == short, F.lit(full)).otherwise(F.col("camera"))
    return records.withColumn("camera", renamed)
