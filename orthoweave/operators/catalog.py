"""Video catalog, clock grids and the match of clock times to video segments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orthoweave.functions import names
from orthoweave.functions.util import as_column

# Shortest interval class of the interval join, and the number of classes. Each
# class doubles the width, so 34 of them cover ten thousand years.
BUCKET_SECONDS = 60
BUCKET_LEVELS = 34

# Grid positions that a row of a segment lists at most.
GRID_CHUNK = 65_536


# --- catalog -------------------------------------------------------------------------------

def video_files(paths: DataFrame, path: str = "path") -> DataFrame:
    """Distinct paths with a video extension in one letter case."""
    return paths.where(names.has_video_extension(path)).select(path).distinct()


def union_listings(listings: list[DataFrame], path: str = "path") -> DataFrame:
    """Distinct paths of several listings."""
    merged = listings[0].select(path)
    for listing in listings[1:]:
        merged = merged.unionByName(listing.select(path))
    return merged.distinct()


def _dated_paths(paths: DataFrame, path: str) -> DataFrame:
    """Distinct paths with the times in their names.

    The listing has to be made distinct anyway. The times are found in that
    aggregation, so that later filters on them do not match the name again.
    """
    start, end = names.fields_times("_f")
    return (
        paths.select(F.col(path).alias("path"), names.video_fields(path).alias("_f"))
        .groupBy("path").agg(
            F.max(start).alias("start_time"), F.max(end).alias("end_time"), F.max("_f").alias("_f"))
    )


def catalog_segments(paths: DataFrame, base: str | None = None, path: str = "path") -> DataFrame:
    """Segments (path, camera, start_time, end_time) of the names that can be parsed.

    With ``base`` the folders below it become part of the camera name.
    """
    camera = names.fields_camera("_f")
    if base is not None:
        camera = names.qualified_camera(camera, "path", base)
    return (
        _dated_paths(paths, path).where("start_time IS NOT NULL AND end_time IS NOT NULL")
        .select("path", camera.alias("camera"), "start_time", "end_time")
    )


def unparsed_videos(paths: DataFrame, path: str = "path") -> DataFrame:
    """Paths that give no segment."""
    return _dated_paths(paths, path).where("start_time IS NULL OR end_time IS NULL").select("path")


def ordered_segments(segments: DataFrame) -> DataFrame:
    """Segments sorted by start within each camera; a range shuffle, not one task per camera."""
    return segments.orderBy("camera", "start_time", "path")


# --- clock grids ---------------------------------------------------------------------------

@dataclass(frozen=True)
class ClockGrid:
    """A regular grid of clock times: first time, step and number of times."""

    start: str
    step_micros: int
    count: int

    def start_column(self) -> Column:
        return F.lit(self.start).cast("timestamp_ntz")

    def time_at(self, k) -> Column:
        return F.timestamp_add(
            "MICROSECOND", as_column(k).cast("bigint") * F.lit(self.step_micros), self.start_column())


def make_grid(spark: SparkSession, start: str, end: str, interval: str) -> ClockGrid:
    """Grid from ``start`` to ``end``, both included. Raises ValueError on bad limits."""
    row = spark.range(1).select(
        names.parse_clock_time(F.lit(start)).cast("string").alias("start"),
        F.timestamp_diff("MICROSECOND", names.parse_clock_time(F.lit(start)),
                         names.parse_clock_time(F.lit(end))).alias("span"),
        names.interval_seconds(F.lit(interval)).alias("step"),
    ).first()
    if row.span is None:
        raise ValueError(f"not a clock time: {start!r} or {end!r}")
    if row.span <= 0:
        raise ValueError("the start must be before the end")
    step = None if row.step is None else round(row.step * 1_000_000)
    if not step or step <= 0:
        raise ValueError(f"not a positive interval: {interval!r}")
    return ClockGrid(row.start, step, row.span // step + 1)


def clock_grid(spark: SparkSession, grid: ClockGrid) -> DataFrame:
    """One row (ts) per clock time, generated in parallel."""
    return spark.range(grid.count).select(grid.time_at("id").alias("ts"))


def times_within(segments: DataFrame, step_seconds: float) -> DataFrame:
    """A row per segment and clock time ts from its start to its end, in steps from its start;
    segments that do not start before their end have none. A segment is cut into chunks of
    GRID_CHUNK times first, so no row holds more, however long it claims to be."""
    step = round(step_seconds * 1_000_000)
    last = F.expr(f"timestampdiff(MICROSECOND, start_time, end_time) div {step}L")
    chunks = segments.where("start_time < end_time").withColumn("_last", last).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.expr(f"_last div {GRID_CHUNK}"))))
    chunks = chunks.repartition("start_time", "_chunk").withColumn("_k", F.explode(F.sequence(
        F.col("_chunk") * GRID_CHUNK, F.least("_last", F.col("_chunk") * GRID_CHUNK + (GRID_CHUNK - 1)))))
    return chunks.withColumn("ts", F.timestamp_add("MICROSECOND", F.col("_k") * step, F.col("start_time"))).drop("_last", "_chunk", "_k")


def clock_times(spark: SparkSession, texts: list[str]) -> DataFrame:
    """Rows (ts) of explicitly listed clock times. Raises ValueError if one cannot be parsed."""
    parsed = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", names.parse_clock_time("text").alias("ts"))
    bad = parsed.where("ts IS NULL").first()
    if bad is not None:
        raise ValueError(f"not a clock time: {bad.text!r}")
    return parsed.select("ts").distinct()


# --- matching ------------------------------------------------------------------------------

def first_segment(matches: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Per (camera, ts) the segment that starts first, then the first path.

    A minimum instead of a ranking window: it combines on the map side, so a
    camera or time with very many overlapping segments does not fill one task.
    """
    best = F.min(F.struct("start_time", "path", "end_time", *extra)).alias("_s")
    return matches.groupBy("camera", "ts").agg(best).select("camera", "ts", "_s.*")


def _bucket_micros(level: Column) -> Column:
    return F.lit(BUCKET_SECONDS * 1_000_000) * F.pow(F.lit(2.0), level).cast("bigint")


def _micros(ts) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, as_column(ts))


def containing_segments(segments: DataFrame, targets: DataFrame) -> DataFrame:
    """All pairs start_time <= ts <= end_time, planned as an equi-join.

    A segment goes into the class of widths just above its length and touches at
    most two buckets of that class; a time is put into one bucket per class. The
    candidates of a segment then stay within a small factor of its real matches,
    however long or wrong its end time is. Times are repeated per class only; a bucket
    that many segments share is left to Spark's skew handling, and segments are read once.
    """
    length = _micros("end_time") - _micros("start_time")
    level = F.ceil(F.log2(F.greatest(length / F.lit(BUCKET_SECONDS * 1e6), F.lit(1.0))))
    width = _bucket_micros(F.col("_level"))
    placed = (
        segments.where(F.col("start_time") <= F.col("end_time"))
        .withColumn("_level", level.cast("int"))
        .withColumn("_bucket", F.explode(F.array_distinct(F.array(
            F.floor(_micros("start_time") / width), F.floor(_micros("end_time") / width)))))
    )
    times = (
        targets.select("ts")
        .withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(BUCKET_LEVELS - 1))))
        .withColumn("_bucket", F.floor(_micros("ts") / _bucket_micros(F.col("_level"))))
    )
    return (
        placed.join(times, ["_level", "_bucket"])
        .where(F.col("ts").between(F.col("start_time"), F.col("end_time")))
        .drop("_level", "_bucket")
    )


def match_frames(segments: DataFrame, targets: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(camera, ts) with the first segment that contains ts, for any set of clock times."""
    return first_segment(containing_segments(segments, targets), extra)


def match_grid(segments: DataFrame, grid: ClockGrid, extra: tuple[str, ...] = ()) -> DataFrame:
    """As :func:`match_frames` for a regular grid, without a join.

    The grid positions inside a segment follow from its limits, so each segment
    lists its own clock times; segments outside the grid list none. A segment is
    first cut into chunks of GRID_CHUNK positions, which other tasks may work on, so
    no row holds more than a chunk of them, however long the segment claims to be.
    """
    def steps(ts: str) -> Column:
        return F.timestamp_diff("MICROSECOND", grid.start_column(), F.col(ts)) / F.lit(
            float(grid.step_micros))

    first = F.greatest(F.ceil(steps("start_time")), F.lit(0))
    last = F.least(F.floor(steps("end_time")), F.lit(grid.count - 1))
    hits = (
        segments.withColumn("_first", first).withColumn("_last", last)
        .where("_first <= _last")
        .withColumn("_chunk", F.explode(F.sequence(
            F.floor(F.col("_first") / GRID_CHUNK), F.floor(F.col("_last") / GRID_CHUNK))))
        .repartition("path", "_chunk")
        .withColumn("_k", F.explode(F.sequence(
            F.greatest("_first", F.col("_chunk") * GRID_CHUNK),
            F.least("_last", F.col("_chunk") * GRID_CHUNK + (GRID_CHUNK - 1)))))
        .withColumn("ts", grid.time_at("_k"))
        .drop("_first", "_last", "_k", "_chunk")
    )
    return first_segment(hits, extra)


# --- frame requests ------------------------------------------------------------------------

def clip_duration(fps="fps", frames="frame_count") -> Column:
    """Length of a clip in seconds; 0 when the frame rate is not positive."""
    fps, frames = as_column(fps), as_column(frames)
    return F.when(fps > 0, frames / fps).otherwise(F.lit(0.0))


def in_duration(requests: DataFrame, offset: str = "offset_seconds", clock: bool = True) -> DataFrame:
    """Requests inside their clip. Clock mode also drops negative offsets."""
    inside = F.col(offset) <= clip_duration()
    return requests.where(inside & (F.col(offset) >= 0) if clock else inside)


def requests_per_video(requests: DataFrame, block: str = "HOUR") -> DataFrame:
    """Sorted frame requests of each video, so a reader opens a file once per block.

    A block is one ``block`` of clock time. It bounds the list a task holds, also
    for a file that spans a long time; nearly every file is one or two blocks.
    """
    return (
        requests.withColumn("block_start", F.date_trunc(block, "ts").cast("timestamp_ntz"))
        .groupBy("camera", "path", "block_start")
        .agg(
            F.count(F.lit(1)).alias("n_requests"),
            F.sort_array(F.collect_list(F.struct("ts", "frame_number"))).alias("requests"),
        )
    )
