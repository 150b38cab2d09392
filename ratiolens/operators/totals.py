"""Totals brought to the rows they add up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_totals(df: DataFrame, keys: tuple[str, ...], totals: dict[str, str]) -> DataFrame:
    """``df`` with SQL aggregates ``totals`` over all rows of its ``keys``.

    An aggregate, which combines before the shuffle, and a join with its one row
    per key: no task ever holds all rows of a key, as it would under a window.
    Null keys match each other.
    """
    sums = df.groupBy(*[F.col(k).alias(f"of_{k}") for k in keys]).agg(
        *[F.expr(f"{sql} AS {name}") for name, sql in totals.items()]
    )
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys))
    return df.join(sums, same).drop(*[f"of_{k}" for k in keys])
