"""Ranking that does not depend on the order in which Spark added up doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratiolens.functions.scalar import settled


def largest_first(value: str) -> Column:
    """Descending order, NULLs last; values equal but for rounding noise tie."""
    return F.desc_nulls_last(F.expr(settled(value)))
