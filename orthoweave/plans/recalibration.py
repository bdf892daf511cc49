"""Checks on picked points and the promotion of new calibrations into the store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orthoweave.functions import quality
from orthoweave.operators import calibration


def recalibration_qc(picks: DataFrame, calibrations: DataFrame,
                     min_gcps: int = calibration.MIN_GCPS) -> DataFrame:
    """One row per camera with all point and error checks and a verdict.

    ``reject``: too few points. ``confirm``: a check wants a decision. ``accept``.
    """
    checks = (
        calibration.gcp_counts(picks)
        .join(calibration.close_pair_counts(picks), "camera", "left")
        .join(calibration.point_spread(picks), "camera", "left")
        .join(calibration.reprojection_rms(picks, calibrations).select("camera", "rms"),
              "camera", "left")
        .withColumn("rms_warning", quality.rms_flag("rms"))
    )
    doubtful = (F.col("n_close_pairs") > 0) | F.col("clustered") | F.col("rms_warning")
    verdict = (
        F.when(F.col("n_gcps") < min_gcps, "reject")
        .when(F.coalesce(doubtful, F.lit(True)), "confirm")
        .otherwise("accept"))
    return checks.withColumn("verdict", verdict)


def promote_calibration(store: DataFrame, records: DataFrame, date: str,
                        full_names: dict[str, str] | None = None) -> DataFrame:
    """Rows to write into the store: the new version ``date`` and the saved old records.

    The new version holds all cameras of the version that applies to ``date``,
    with ``records`` replacing theirs. Replaced records are kept in a backup
    version per camera. ``full_names`` re-keys records afterwards.
    """
    spark = store.sparkSession
    request = spark.range(1).select(F.lit(date).alias("date"))
    source = calibration.resolve_calibration(request, store, mode="latest").first().version
    label = F.concat(F.lit("backup_"), F.col("camera").cast("string"), F.lit(f"_{date}"))
    replaced = (
        store.where(F.col("version") == source)
        .join(records.select("camera"), "camera", "left_semi")
        .withColumn("version", label)
    )
    stamped = records.withColumns({
        "recalibrated": F.lit(True), "recalibration_date": F.lit(date)})
    new = calibration.upsert_camera(store, source, date, stamped)
    for short, full in (full_names or {}).items():
        new = new.withColumn(
            "camera", F.when(F.col("camera") == short, F.lit(full)).otherwise(F.col("camera")))
    return new.unionByName(replaced, allowMissingColumns=True)
