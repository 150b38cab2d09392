"""Mergeable moments: count, mean and squared deviations of samples.

Parts of a history keep their moments; intervals come from merging these, without the
samples. Merging is exact up to rounding and as steady as a pass over the samples: no
difference of large squares is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ratiolens.operators.daily import aggregates

MOMENTS = ("n", "mean", "squares")


def moments(samples: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Per key the count of non-null values, their mean, and their squared deviations from it."""
    found = {
        "n": f"count({value})",
        "mean": f"avg({value})",
        "squares": f"var_pop({value}) * count({value})",
    }
    return samples.groupBy(*keys).agg(*aggregates(found)).where("n > 0")


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Moments of all parts of a key together.

    A key has one row per part of its history, some hundred at most; they are merged in
    the order of their means, so that a repeated run gives the same digits.
    """
    start = "named_struct('n', 0D, 'mean', 0D, 'squares', 0D)"
    step = (
        "named_struct('n', s.n + x.n, "
        "'mean', s.mean + (x.mean - s.mean) * x.n / (s.n + x.n), "
        "'squares', s.squares + x.squares "
        "+ (x.mean - s.mean) * (x.mean - s.mean) * s.n * x.n / (s.n + x.n))"
    )
    ordered = "array_sort(collect_list(struct(mean, n, squares)))"
    total = f"aggregate({ordered}, {start}, (s, x) -> {step})"
    return (
        parts.groupBy(*keys)
        .agg(*aggregates({"total": total}))
        .selectExpr(*keys, "cast(total.n AS bigint) AS n", "total.mean", "total.squares")
    )


def interval(threshold: float = 2.0) -> dict[str, str]:
    """Mean minus and plus ``threshold`` population deviations, to 4 decimals half-even."""
    spread = f"{threshold!r}D * sqrt(squares / n)"
    return {"bottom": f"bround(mean - {spread}, 4)", "top": f"bround(mean + {spread}, 4)"}


def intervals(parts: DataFrame, keys: list[str], threshold: float = 2.0) -> DataFrame:
    """The interval per key, from the moments of its parts."""
    edges = [f"{sql} AS {name}" for name, sql in interval(threshold).items()]
    return merged(parts, keys).selectExpr(*keys, *edges)
