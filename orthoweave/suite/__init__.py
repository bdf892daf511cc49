"""Registered queries on the given tables and the SQL that checks them."""

from orthoweave.suite.registry import ORACLES, QUERIES
from orthoweave.suite import cameras, jobs, raster, video  # noqa: F401  (they register their queries)

__all__ = ["ORACLES", "QUERIES"]
