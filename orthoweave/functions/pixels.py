"""Pixel value expressions. Channels are unsigned bytes held as INT, in B, G, R order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orthoweave.functions.util import as_column

# Luminance weights of blue, green and red in units of 1/32768.
GRAY_WEIGHTS = (3735, 19235, 9798)


def bgr_to_gray(b="b", g="g", r="r") -> Column:
    """Luminance of a pixel, rounded to an integer."""
    wb, wg, wr = GRAY_WEIGHTS
    weighted = wb * as_column(b) + wg * as_column(g) + wr * as_column(r)
    return F.shiftright(weighted + 16384, 15)


def valid_pixel(b="b", g="g", r="r") -> Column:
    """Black means no data."""
    return F.greatest(as_column(b), as_column(g), as_column(r)) > 0


def pack_bgr(b="b", g="g", r="r") -> Column:
    """Three channels in one INT."""
    return as_column(b) * 65536 + as_column(g) * 256 + as_column(r)


def unpack_bgr(packed) -> list[Column]:
    """Columns b, g, r of a packed pixel."""
    c = as_column(packed)
    return [
        (F.shiftright(c, shift) % 256).cast("int").alias(name)
        for name, shift in (("b", 16), ("g", 8), ("r", 0))
    ]
