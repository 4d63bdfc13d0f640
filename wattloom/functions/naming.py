"""Small helpers for column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(column: str) -> Column:
    """A column by its literal name, also if the name is no identifier (``25-perc``)."""
    return F.col("`" + column.replace("`", "``") + "`")
