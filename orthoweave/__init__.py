"""Multi-camera raster analytics as Spark jobs.

Video catalog, clock-time matching, camera calibrations, ortho lookup maps and
mosaics, all expressed as DataFrame transformations.
"""

__version__ = "0.1.0"
