"""Run status and raster statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BANDS = ("b", "g", "r")


def stage_summary(status: DataFrame) -> DataFrame:
    """Succeeded and total items per stage."""
    return status.groupBy("stage").agg(
        F.count_if("success").alias("succeeded"), F.count(F.lit(1)).alias("total"))


def frames_per_camera(status: DataFrame, stage: str = "extract") -> DataFrame:
    """Extracted frames per camera, cameras without any left out."""
    done = status.where((F.col("stage") == stage) & F.col("success"))
    return done.groupBy("camera").agg(F.count(F.lit(1)).alias("frames"))


def failures(status: DataFrame) -> DataFrame:
    """Failed items with their message."""
    return status.where(~F.col("success")).select("stage", "ts", "camera", "error")


def band_stats(pixel_rows: DataFrame, keys: list[str], no_data: int | None = None) -> DataFrame:
    """Minimum, maximum, mean, deviation and share of present values per band.

    NULLs, and values equal to ``no_data`` if one is given, are missing: they count in
    the share only. One pass over the pixels; the bands become rows after the aggregation.
    """
    totals = []
    for band in BANDS:
        value = F.col(band) if no_data is None else F.nullif(F.col(band), F.lit(no_data))
        totals += [
            F.min(value).alias(f"{band}_min"), F.max(value).alias(f"{band}_max"),
            F.avg(value).alias(f"{band}_mean"), F.stddev_pop(value).alias(f"{band}_stddev"),
            (F.count(value) * 100.0 / F.count(F.lit(1))).alias(f"{band}_valid"),
        ]
    wide = pixel_rows.groupBy(*keys).agg(*totals)
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(i + 1).alias("band"), F.col(f"{b}_min").alias("minimum"),
            F.col(f"{b}_max").alias("maximum"), F.col(f"{b}_mean").alias("mean"),
            F.col(f"{b}_stddev").alias("stddev"), F.col(f"{b}_valid").alias("valid_percent"))
        for i, b in enumerate(BANDS)]))
    return wide.select(*keys, rows.alias("s")).select(*keys, "s.*")
