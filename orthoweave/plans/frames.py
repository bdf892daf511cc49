"""Which frame of which video shows each camera at each requested time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orthoweave.functions import names
from orthoweave.operators import catalog
from orthoweave.operators.catalog import ClockGrid


def _with_frames(matches: DataFrame, fps: Column) -> DataFrame:
    return matches.select(
        "camera", "path", "ts", "start_time", "end_time",
        names.ts_folder("ts").alias("ts_folder"),
        names.frame_number("ts", "start_time", fps).alias("frame_number"))


def plan_frames(paths: DataFrame, grid: ClockGrid, base: str | None = None,
                fps: Column | None = None) -> DataFrame:
    """Frame requests (camera, path, ts, frame_number, ts_folder) on a regular grid.

    ``base`` is the scanned folder when subfolders name the recorder; ``fps`` is a
    constant, or None when the paths carry fps and frame_count.
    """
    return _plan(paths, lambda s, extra: catalog.match_grid(s, grid, extra), base, fps)


def plan_clock_times(paths: DataFrame, times: DataFrame, base: str | None = None,
                     fps: Column | None = None) -> DataFrame:
    """Frame requests for any set of clock times (ts)."""
    return _plan(paths, lambda s, extra: catalog.match_frames(s, times, extra), base, fps)


def _plan(paths, match, base, fps) -> DataFrame:
    segments = catalog.catalog_segments(paths, base)
    if fps is not None:
        return _with_frames(match(segments, ()), fps)
    clips = paths.select("path", "fps", "frame_count")
    requests = match(segments.join(clips, "path"), ("fps", "frame_count"))
    inside = catalog.in_duration(
        requests.withColumn("offset_seconds", names.elapsed_seconds("start_time", "ts")))
    return _with_frames(inside, F.col("fps"))


def plan_offsets(clips: DataFrame, offsets: list[str], base: str | None = None) -> DataFrame:
    """Frame requests at the same offsets into every clip.

    The offsets are a short list given by the caller; each clip lists them itself.
    Offsets that cannot be parsed or lie behind the clip's end give no row.
    """
    name = names.stem("path")
    if base is not None:
        name = names.qualified_camera(name, "path", base)
    listed = clips.withColumn("offset", F.explode(F.array(*[F.lit(o) for o in offsets]))).withColumn(
        "offset_seconds", names.relative_seconds("offset"))
    return catalog.in_duration(listed, clock=False).select(
        "path", name.alias("name"), "offset", names.offset_folder("offset").alias("offset_folder"),
        (F.col("offset_seconds") * F.col("fps")).cast("bigint").alias("frame_number"))
