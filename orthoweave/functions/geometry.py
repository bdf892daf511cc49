"""Geotransforms and the fisheye camera model as Column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from orthoweave.functions.util import as_column, truncated

# Fixed values of the fisheye model: smallest radius that is divided by,
# number of refinements when the distortion is inverted.
SMALL_RADIUS = 1e-8
INVERSE_STEPS = 10


def image_bounds(width="width", height="height", x_min="x_min", y_max="y_max",
                 pixel_width="pixel_width", pixel_height="pixel_height") -> dict[str, Column]:
    """World bounds of a raster; ``pixel_height`` is negative."""
    return {
        "x_max": as_column(x_min) + as_column(width) * as_column(pixel_width),
        "y_min": as_column(y_max) + as_column(height) * as_column(pixel_height),
    }


def ortho_grid(x_min, x_max, y_min, y_max, resolution: float) -> Column:
    """Output size and geotransform covering the bounds."""
    res = F.lit(float(resolution))
    x_min, x_max, y_min, y_max = map(as_column, (x_min, x_max, y_min, y_max))
    return F.struct(
        truncated((x_max - x_min) / res).alias("width"),
        truncated((y_max - y_min) / res).alias("height"),
        x_min.alias("x_min"),
        y_max.alias("y_max"),
        res.alias("pixel_width"),
        (-res).alias("pixel_height"),
        F.lit(0.0).alias("rotation_x"),
        F.lit(0.0).alias("rotation_y"),
    )


def pixel_to_world(row="row", col="col", x_min="x_min", y_max="y_max",
                   pixel_width="pixel_width", pixel_height="pixel_height",
                   centre: bool = False) -> tuple[Column, Column]:
    """World position of a pixel corner, or of its centre."""
    shift = 0.5 if centre else 0.0
    x = as_column(x_min) + (as_column(col) + shift) * as_column(pixel_width)
    y = as_column(y_max) + (as_column(row) + shift) * as_column(pixel_height)
    return x, y


@dataclass(frozen=True)
class CameraModel:
    """Columns of one camera: focal lengths, centre, distortion, pose."""

    fx: Column
    fy: Column
    cx: Column
    cy: Column
    k: tuple[Column, Column, Column, Column]
    rvec: tuple[Column, Column, Column]
    tvec: tuple[Column, Column, Column]

    @classmethod
    def of_record(cls, prefix: str = "") -> "CameraModel":
        """The model held in the columns K, D, rvec, tvec of a calibration record."""
        def item(name: str, i: int) -> Column:
            return F.get(F.col(prefix + name), F.lit(i))

        def k_item(i: int, j: int) -> Column:
            return F.get(F.get(F.col(prefix + "K"), F.lit(i)), F.lit(j))

        return cls(
            fx=k_item(0, 0), fy=k_item(1, 1), cx=k_item(0, 2), cy=k_item(1, 2),
            k=tuple(item("D", i) for i in range(4)),
            rvec=tuple(item("rvec", i) for i in range(3)),
            tvec=tuple(item("tvec", i) for i in range(3)),
        )


def rotation_matrix(rvec) -> list[list[Column]]:
    """3 x 3 rotation of an axis-angle vector: cos I + (1 - cos) k k' + sin [k]."""
    rx, ry, rz = rvec
    theta = F.sqrt(rx * rx + ry * ry + rz * rz)
    safe = F.when(theta > 0, theta).otherwise(F.lit(1.0))
    kx, ky, kz = rx / safe, ry / safe, rz / safe
    c, s = F.cos(theta), F.sin(theta)
    v = F.lit(1.0) - c
    return [
        [c + v * kx * kx, v * kx * ky - s * kz, v * kx * kz + s * ky],
        [v * kx * ky + s * kz, c + v * ky * ky, v * ky * kz - s * kx],
        [v * kx * kz - s * ky, v * ky * kz + s * kx, c + v * kz * kz],
    ]


def world_to_camera(x, y, z, rotation, tvec) -> list[Column]:
    """Camera coordinates R p + t. ``rotation`` is three rows of Columns."""
    point = [as_column(v) for v in (x, y, z)]
    return [
        row[0] * point[0] + row[1] * point[1] + row[2] * point[2] + shift
        for row, shift in zip(rotation, tvec)
    ]


def rotation_of(column: str) -> list[list[Column]]:
    """Nine entries of an ARRAY<DOUBLE> rotation column in row order."""
    return [[F.get(F.col(column), F.lit(3 * i + j)) for j in range(3)] for i in range(3)]


def rotation_array(rvec) -> Column:
    """The rotation as ARRAY<DOUBLE> of nine, so it is computed once per camera."""
    return F.array(*[cell for row in rotation_matrix(rvec) for cell in row])


def distort_angle(theta: Column, k) -> Column:
    """Distorted angle of the fisheye polynomial."""
    t2 = theta * theta
    t4 = t2 * t2
    return theta * (F.lit(1.0) + k[0] * t2 + k[1] * t4 + k[2] * t4 * t2 + k[3] * t4 * t4)


def _project_normalised(a: Column, b: Column, model: CameraModel) -> tuple[Column, Column]:
    r = F.sqrt(a * a + b * b)
    scale = F.when(r > SMALL_RADIUS, distort_angle(F.atan(r), model.k) / r).otherwise(F.lit(1.0))
    return a * scale * model.fx + model.cx, b * scale * model.fy + model.cy


def fisheye_project(point, model: CameraModel) -> tuple[Column, Column]:
    """Image position (col, row) of camera coordinates; NULL on the plane z = 0."""
    x, y, z = point
    depth = F.when(z != 0, z)
    return _project_normalised(x / depth, y / depth, model)


def undistort_angle(theta_d: Column, k) -> Column:
    """Angle whose distortion is ``theta_d``, by a fixed number of Newton steps."""
    start = theta_d

    def step(theta: Column, _: Column) -> Column:
        t2 = theta * theta
        t4 = t2 * t2
        slope = (F.lit(1.0) + 3 * k[0] * t2 + 5 * k[1] * t4
                 + 7 * k[2] * t4 * t2 + 9 * k[3] * t4 * t4)
        return theta - (distort_angle(theta, k) - start) / slope

    return F.aggregate(F.sequence(F.lit(1), F.lit(INVERSE_STEPS)), start, step)


def undistort_point(u: Column, v: Column, model: CameraModel) -> Column:
    """Struct (x, y): the normalised direction of an image position."""
    a, b = (u - model.cx) / model.fx, (v - model.cy) / model.fy
    theta_d = F.least(F.sqrt(a * a + b * b), F.lit(3.141592653589793 / 2))
    scale = F.when(theta_d > SMALL_RADIUS, F.tan(undistort_angle(theta_d, model.k)) / theta_d)
    scale = F.coalesce(scale, F.lit(1.0))
    return F.struct((a * scale).alias("x"), (b * scale).alias("y"))


def edge_midpoints(width, height, model: CameraModel) -> Column:
    """Array of the undistorted midpoints of the four image edges."""
    w, h = as_column(width).cast("double"), as_column(height).cast("double")
    return F.array(*[
        undistort_point(u, v, model)
        for u, v in ((w / 2, F.lit(0.0)), (w, h / 2), (w / 2, h), (F.lit(0.0), h / 2))])


def fitting_view(edges: str, width, height, model: CameraModel, balance: float = 0.0) -> Column:
    """Struct (fx, fy, cx, cy) of the view that shows an undistorted frame.

    ``edges`` names a column of :func:`edge_midpoints`. The focal length lets the
    widest (``balance`` 1) or the narrowest (0) of them reach its image edge.
    """
    w, h = as_column(width).cast("double"), as_column(height).cast("double")
    aspect = model.fx / model.fy
    xs = F.transform(edges, lambda e: e["x"])
    ys = F.transform(edges, lambda e: e["y"] * aspect)

    def mean(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda total, v: total + v) / 4

    reach = F.array(
        w * 0.5 / (mean(xs) - F.array_min(xs)),
        w * 0.5 / (F.array_max(xs) - mean(xs)),
        h * 0.5 * aspect / (mean(ys) - F.array_min(ys)),
        h * 0.5 * aspect / (F.array_max(ys) - mean(ys)),
    )
    focal = F.lit(float(balance)) * F.array_min(reach) + F.lit(1.0 - balance) * F.array_max(reach)
    return F.struct(
        focal.alias("fx"),
        (focal / aspect).alias("fy"),
        (-mean(xs) * focal + w * 0.5).alias("cx"),
        ((-mean(ys) * focal + h * aspect * 0.5) / aspect).alias("cy"),
    )


def undistorted_source(row, col, view: str, model: CameraModel) -> tuple[Column, Column]:
    """Source position of an output pixel of the undistorted view held in struct ``view``."""
    a = (as_column(col) - F.col(f"{view}.cx")) / F.col(f"{view}.fx")
    b = (as_column(row) - F.col(f"{view}.cy")) / F.col(f"{view}.fy")
    return _project_normalised(a, b, model)


def centre_priority(row, col, height, width) -> Column:
    """1 at the centre of a region, 0 at its corner."""
    row, col = as_column(row).cast("double"), as_column(col).cast("double")
    cy, cx = as_column(height) / F.lit(2.0), as_column(width) / F.lit(2.0)
    distance = F.sqrt((col - cx) * (col - cx) + (row - cy) * (row - cy))
    return F.lit(1.0) - distance / F.sqrt(cx * cx + cy * cy)


def mosaic_offset(x_min, y_max, bounds_x_min, bounds_y_max, resolution) -> tuple[Column, Column]:
    """Row and column of a raster's origin in the mosaic grid."""
    res = as_column(resolution)
    row = truncated((as_column(bounds_y_max) - as_column(y_max)) / F.abs(res))
    col = truncated((as_column(x_min) - as_column(bounds_x_min)) / res)
    return row, col
