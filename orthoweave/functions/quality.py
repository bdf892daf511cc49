"""Quality rules for picked points and calibrations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orthoweave.functions.util import as_column

# Spans in pixels and the reprojection error limit.
GOOD_COL_SPAN, GOOD_ROW_SPAN = 1500, 1000
MIN_COL_SPAN, MIN_ROW_SPAN = 1000, 800
MAX_RMS = 5.0


def coverage_class(col_span, row_span) -> Column:
    """GOOD when the points span enough of the image, else MARGINAL."""
    good = (as_column(col_span) > GOOD_COL_SPAN) & (as_column(row_span) > GOOD_ROW_SPAN)
    return F.when(good, "GOOD").otherwise("MARGINAL")


def too_clustered(col_span, row_span) -> Column:
    """True when the points are too close together to calibrate from."""
    return (as_column(col_span) < MIN_COL_SPAN) | (as_column(row_span) < MIN_ROW_SPAN)


def rms_flag(rms) -> Column:
    """True when the reprojection error needs a warning."""
    return as_column(rms) > MAX_RMS
