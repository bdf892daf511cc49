"""Small helpers shared by the expression modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value) -> Column:
    """A Column from a name or a Column; wrap constants in ``F.lit`` first."""
    return value if isinstance(value, Column) else F.col(value)


def truncated(value: Column, dtype: str = "int") -> Column:
    """Integer part toward zero."""
    return value.cast(dtype)
