"""Relational operators on video catalogs, rasters and calibrations."""
