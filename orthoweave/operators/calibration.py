"""Quality of control points and calibrations, and the versioned calibration store.

A store is rows (version, camera, ...). Dated versions are ``yyyyMMdd``; the first
calibration is ``original``; saved copies are ``backup_...``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orthoweave.functions import geometry, quality
from orthoweave.operators.matching import SALTS, salted_join
from orthoweave.operators.remap import MODEL_COLUMNS

# Distance in pixels below which two picks count as the same, number
# of close pairs that is reported, fewest points to calibrate from.
CLOSE_PIXELS = 30.0
# Side of a square in which any two picks are close.
PATCH = math.floor(CLOSE_PIXELS / math.sqrt(2))
REPORTED_PAIRS = 5
MIN_GCPS = 6
ORIGINAL = "original"


# --- points --------------------------------------------------------------------------------

def gcp_counts(gcps: DataFrame) -> DataFrame:
    """Number of control points per camera."""
    return gcps.groupBy("camera").agg(F.count(F.lit(1)).alias("n_gcps"))


def distinct_cameras(gcps: DataFrame) -> DataFrame:
    """Camera names, sorted."""
    return gcps.select("camera").distinct().orderBy("camera")


def enough_gcps(picks: DataFrame, min_gcps: int = MIN_GCPS) -> DataFrame:
    """Cameras with at least ``min_gcps`` picked points."""
    return gcp_counts(picks).where(F.col("n_gcps") >= min_gcps)


def point_spread(picks: DataFrame) -> DataFrame:
    """Column and row span of the picked points per camera, with their coverage class."""
    spans = picks.groupBy("camera").agg(
        (F.max("col_sample") - F.min("col_sample")).alias("col_span"),
        (F.max("row_sample") - F.min("row_sample")).alias("row_span"),
    )
    return spans.withColumns({
        "coverage": quality.coverage_class("col_span", "row_span"),
        "clustered": quality.too_clustered("col_span", "row_span"),
    })


def _in_cells(points: DataFrame) -> DataFrame:
    cell = F.lit(CLOSE_PIXELS)
    return points.withColumns({
        "_cc": F.floor(F.col("col_sample") / cell), "_cr": F.floor(F.col("row_sample") / cell)})


def _neighbour_join(points: DataFrame, columns: list[str], before: Column) -> DataFrame:
    """Pairs of points in the same or adjacent cells, closer than the limit.

    The left side visits its own cell and the four that follow it, so every pair
    of cells meets once; ``before`` orders the points of one cell. A crowded cell is
    split over the salts of its left points.
    """
    steps = F.array(*[
        F.struct(F.lit(dc).alias("dc"), F.lit(dr).alias("dr"))
        for dc, dr in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    placed = _in_cells(points)
    left = placed.select(
        "camera", *[F.col(c).alias(f"a_{c}") for c in columns], "_cc", "_cr",
        F.explode(steps).alias("_s"),
    ).select(
        "camera", *[f"a_{c}" for c in columns],
        (F.col("_cc") + F.col("_s.dc")).alias("_cc"), (F.col("_cr") + F.col("_s.dr")).alias("_cr"),
        ((F.col("_s.dc") == 0) & (F.col("_s.dr") == 0)).alias("_own"),
    )
    right = placed.select("camera", *[F.col(c).alias(f"b_{c}") for c in columns], "_cc", "_cr")
    dx = F.col("a_col_sample") - F.col("b_col_sample")
    dy = F.col("a_row_sample") - F.col("b_row_sample")
    return (
        salted_join(left, right, ["camera", "_cc", "_cr"], [f"a_{c}" for c in columns], grows=True)
        .where(~F.col("_own") | before)
        .withColumn("distance", F.sqrt(dx * dx + dy * dy))
        .where(F.col("distance") < CLOSE_PIXELS)
        .drop("_cc", "_cr", "_own")
    )


def close_pairs(picks: DataFrame) -> DataFrame:
    """Every pair of picks (camera, i, j, distance), i < j, that is closer than the limit.

    The rows are the result itself. Where only their number or the first few
    matter, use :func:`close_pair_counts` or :func:`top_close_pairs`.
    """
    pairs = _neighbour_join(
        picks, ["pid", "col_sample", "row_sample"], F.col("a_pid") < F.col("b_pid"))
    return pairs.select(
        "camera", F.least("a_pid", "b_pid").alias("i"), F.greatest("a_pid", "b_pid").alias("j"),
        "distance")


def close_pair_counts(picks: DataFrame) -> DataFrame:
    """Number of close pairs per camera, without forming the pairs of equal positions.

    Copies of one position are counted first; a position with n copies adds
    n (n - 1) / 2 pairs and joins its neighbours as one row.
    """
    spots = picks.groupBy("camera", "col_sample", "row_sample").agg(
        F.count(F.lit(1)).alias("copies"))
    before = F.struct("a_col_sample", "a_row_sample") < F.struct("b_col_sample", "b_row_sample")
    across = _neighbour_join(spots, ["col_sample", "row_sample", "copies"], before).select(
        "camera", (F.col("a_copies") * F.col("b_copies")).alias("n"))
    within = spots.select(
        "camera", F.expr("copies * (copies - 1) div 2").alias("n"))
    return across.unionByName(within).groupBy("camera").agg(F.sum("n").alias("n_close_pairs"))


def _last_first(points: DataFrame, n: int) -> DataFrame:
    """Per camera a pick that is not before the first pick of its ``n``-th close pair, where
    the patches alone already hold n pairs. All picks of a patch are close to each other."""
    patch = W.partitionBy("camera", "_pc", "_pr").orderBy("pid")
    inside = points.where((F.abs("col_sample") < 1e9) & (F.abs("row_sample") < 1e9)).select(
        "camera", F.row_number().over(patch).alias("_k"), F.first("pid").over(patch).alias("_first"))
    order = W.partitionBy("camera").orderBy("_first")
    pairs = inside.where(F.col("_k").between(2, n + 1)).select(
        "camera", "_first", F.row_number().over(order).alias("_r"))
    return pairs.where(F.col("_r") <= n).groupBy("camera").agg(
        F.max("_first").alias("_last"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") == n).drop("_n")


def top_close_pairs(picks: DataFrame, n: int = REPORTED_PAIRS) -> DataFrame:
    """First ``n`` close pairs per camera in (i, j) order.

    A pick beyond the first n + 1 at its position cannot be in them: pairs with
    those earlier picks come first. Nor can a pick i after the first picks of n pairs that
    are close for certain. At most n picks i of a patch are left, so the pairs formed grow
    with the picks, however crowded a place is.
    """
    spot = W.partitionBy("camera", "col_sample", "row_sample").orderBy("pid")
    early = picks.withColumn("_k", F.row_number().over(spot)).where(F.col("_k") <= n + 1)
    points = early.select(
        "camera", "pid", "col_sample", "row_sample",
        F.floor(F.col("col_sample") / PATCH).alias("_pc"), F.floor(F.col("row_sample") / PATCH).alias("_pr"))
    # a camera without such a limit has hardly two picks in a patch: nothing to split
    salts = F.when(F.col("_last").isNull(), 1).otherwise(SALTS)
    limited = points.join(_last_first(points, n), "camera", "left").withColumn("_salts", salts)

    def near(place: str) -> Column:
        return F.explode(F.sequence(F.col(place) - 2, F.col(place) + 2))

    left = limited.where("_last IS NULL OR pid <= _last").select(
        "camera", F.col("pid").alias("i"), F.col("col_sample").alias("_ac"), F.col("row_sample").alias("_ar"),
        "_pc", "_pr", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"),
    ).withColumn("_pc", near("_pc")).withColumn("_pr", near("_pr"))
    right = limited.select(
        "camera", F.col("pid").alias("j"), F.col("col_sample").alias("_bc"), F.col("row_sample").alias("_br"),
        "_pc", "_pr", F.pmod(F.xxhash64("pid"), F.col("_salts")).cast("int").alias("_salt"))
    dx, dy = F.col("_ac") - F.col("_bc"), F.col("_ar") - F.col("_br")
    # the estimate of the repeated side leaves its repeats out: no broadcast
    pairs = right.join(left.hint("merge"), ["camera", "_pc", "_pr", "_salt"]).where("i < j").select(
        "camera", "i", "j", F.sqrt(dx * dx + dy * dy).alias("distance")).where(F.col("distance") < CLOSE_PIXELS)
    order = W.partitionBy("camera").orderBy("i", "j")
    return pairs.withColumn("pair_rank", F.row_number().over(order)).where(F.col("pair_rank") <= n)


# --- reprojection --------------------------------------------------------------------------

def reprojection_errors(gcps: DataFrame, cameras: DataFrame, keys: list[str]) -> DataFrame:
    """Squared image distance of each control point, per camera record named by ``keys``."""
    model = geometry.CameraModel.of_record()
    records = cameras.select(*keys, *MODEL_COLUMNS, geometry.rotation_array(model.rvec).alias("R"))
    joined = salted_join(gcps, records, ["camera"], ["X", "Y", "Z", "col_sample", "row_sample"])
    point = geometry.world_to_camera("X", "Y", "Z", geometry.rotation_of("R"), model.tvec)
    placed = joined.withColumn("p", F.struct(*[c.alias(n) for c, n in zip(point, "xyz")]))
    u, v = geometry.fisheye_project((F.col("p.x"), F.col("p.y"), F.col("p.z")), model)
    dx, dy = u - F.col("col_sample"), v - F.col("row_sample")
    return placed.select(*keys, (dx * dx + dy * dy).alias("squared"))


def reprojection_rms(gcps: DataFrame, cameras: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Root mean square reprojection error and number of points per camera record."""
    keys = keys or ["camera"]
    return reprojection_errors(gcps, cameras, keys).groupBy(*keys).agg(
        F.sqrt(F.avg("squared")).alias("rms"), F.count(F.lit(1)).alias("n_gcps"))


def best_calibration(gcps: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidate with the lowest reprojection error per camera, ties to the smallest id.

    Candidates of equal parameters have equal errors: each model is scored once, under its
    smallest id, the only one of them that can be the result.
    """
    models = candidates.groupBy("camera", *MODEL_COLUMNS).agg(F.min("candidate").alias("candidate"))
    scores = reprojection_rms(gcps, models, ["camera", "candidate"])
    best = F.min(F.struct("rms", "candidate", "n_gcps")).alias("s")
    return scores.groupBy("camera").agg(best).select("camera", "s.*")


# --- store ---------------------------------------------------------------------------------

def resolve_calibration(requests: DataFrame, store: DataFrame, date: str = "date",
                        mode: str = "latest") -> DataFrame:
    """Requests with the version to load for their date.

    ``latest``: the exact date, else the last dated version, also when it is later
    than the date. ``asof``: the last one not after the date. Else ``original``.
    """
    # One array of distinct dates: at most one entry per calendar day. It is searched once
    # per distinct date of the requests, not once per request.
    versions = store.where(F.col("version").rlike("^[0-9]{8}$")).agg(
        F.collect_set("version").alias("v")).scalar()
    dates = requests.select(F.col(date).alias("_date")).distinct().withColumn("_v", versions)
    wanted = F.col("_date")
    if mode == "latest":
        found = F.when(F.array_contains("_v", wanted), wanted).otherwise(F.array_max("_v"))
    elif mode == "asof":
        found = F.array_max(F.filter("_v", lambda v: v <= wanted))
    else:
        raise ValueError(f"unknown mode: {mode!r}")
    resolved = dates.select("_date", F.coalesce(found, F.lit(ORIGINAL)).alias("_version"))
    return requests.join(resolved, F.col(date).eqNullSafe(F.col("_date")), "left").withColumn(
        "version", F.col("_version")).drop("_date", "_version")


def _require(store: DataFrame, version: str, camera: str) -> DataFrame:
    record = store.where((F.col("version") == version) & (F.col("camera") == camera))
    if record.isEmpty():
        raise KeyError(f"camera {camera!r} is not in version {version!r}")
    return record


def upsert_camera(store: DataFrame, source_version: str, new_version: str,
                  records: DataFrame) -> DataFrame:
    """The new version: all cameras of the source version, with ``records`` replacing theirs."""
    carried = store.where(F.col("version") == source_version).join(
        records.select("camera"), "camera", "left_anti")
    stamped = F.lit(new_version)
    return carried.withColumn("version", stamped).unionByName(
        records.withColumn("version", stamped), allowMissingColumns=True)


def copy_camera(store: DataFrame, source_version: str, target_version: str, camera: str) -> DataFrame:
    """The target version with the camera's record taken from the source version."""
    record = _require(store, source_version, camera)
    rest = store.where((F.col("version") == target_version) & (F.col("camera") != camera))
    return rest.unionByName(record.withColumn("version", F.lit(target_version)))


def restore_camera(store: DataFrame, backup_version: str, target_version: str,
                   camera: str) -> DataFrame:
    """The target version with the camera's record taken from a backup."""
    return copy_camera(store, backup_version, target_version, camera)


def delete_camera(store: DataFrame, version: str, camera: str) -> DataFrame:
    """The version without the camera. Raises KeyError for an unknown camera."""
    _require(store, version, camera)
    return store.where((F.col("version") == version) & (F.col("camera") != camera))


def backup_label(camera: str, date: str) -> str:
    """Version name of the saved record of one camera."""
    return f"backup_{camera}_{date}"


def backup(store: DataFrame, version: str, label: str, camera: str | None = None) -> DataFrame:
    """Copy of a version, or of one camera in it, under ``label``."""
    kept = store.where(F.col("version") == version)
    if camera is not None:
        kept = kept.where(F.col("camera") == camera)
    return kept.withColumn("version", F.lit(label))


def with_version(store: DataFrame, version: str, rows: DataFrame) -> DataFrame:
    """The store with one version replaced by ``rows``."""
    return store.where(F.col("version") != version).unionByName(rows)


def calibration_summary(records: DataFrame, grids: DataFrame, z_ranges: DataFrame) -> DataFrame:
    """Per camera record: error, points, output size, resolution, elevation range and date."""
    return (
        records.select("version", "camera", "rms", "n_gcps", "recalibration_date")
        .join(grids.select("camera", "width", "height", "pixel_width"), "camera", "left")
        .join(z_ranges, "camera", "left")
        .select(
            "version", "camera", "rms", "n_gcps", "width", "height",
            (F.col("pixel_width") * 1000).alias("mm_per_pixel"), "min_z", "max_z",
            F.coalesce("recalibration_date", F.lit(ORIGINAL)).alias("date"),
            quality.rms_flag("rms").alias("rms_warning"),
        )
    )
