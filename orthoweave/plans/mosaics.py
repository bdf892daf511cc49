"""Mosaics of all timestamps by one of the three methods."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orthoweave.operators import mosaic, seam, tiles

METHODS = (*mosaic.METHODS, "seam")


def build_mosaics(pixel_rows: DataFrame, images: DataFrame, method: str = "seam",
                  seam_quality: str = "gradient", resolution: float | None = None,
                  strict: bool = True, size: int = tiles.TILE) -> DataFrame:
    """Mosaic pixels (ts, mosaic_row, mosaic_col, b, g, r, camera); from ortho tiles mosaic
    tiles (ts, tile_row, tile_col, height, width, data, positions).
    """
    if method not in METHODS:
        raise ValueError(f"unknown method: {method!r}")
    in_tiles = "tile_row" in pixel_rows.columns
    if method == "seam" and in_tiles:
        return seam.Seams(pixel_rows, images, seam_quality, resolution, strict, size).mosaic_tiles()
    if method == "seam":
        return seam.mosaic_seam(pixel_rows, images, seam_quality, resolution, strict, size=size)
    if in_tiles:
        return tiles.mosaic_tiles(pixel_rows, images, method, resolution, strict, size)
    return mosaic.mosaic_priority(pixel_rows, images, method, resolution, strict)
