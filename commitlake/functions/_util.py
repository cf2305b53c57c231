from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value) -> Column:
    """A column from a name or a column."""
    return F.col(value) if isinstance(value, str) else value
