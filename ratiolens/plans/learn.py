"""Run 1: learn the normal interval of each rate metric."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ratiolens.codes import Codes
from ratiolens.operators.bounds import all_samples, bounds_table
from ratiolens.operators.daily import daily, kpi_measures
from ratiolens.sources.fact import paired_windows

LOOKBACK = 295
# The day horizon pairs the years' dates from the oldest on, the others from the newest back.
DEFAULT_PAIRS = {"day": "oldest", "week": "newest", "month": "newest"}


def learn_bounds(
    fact: DataFrame,
    day: str,
    codes: Codes,
    back: int = LOOKBACK,
    threshold: float = 2.0,
    pair: dict[str, str] | str = DEFAULT_PAIRS,
    month_bound: str = "qoq",
    date_column: str = "d",
    held: DataFrame | None = None,
) -> DataFrame:
    """The bounds table of ``day``: one fact scan for all sources, metrics and horizons.

    ``date_column='label_period'`` ranges over the business date where late rows
    sit in other partitions; the scan then prunes only with ``held`` (see ``paired_windows``).
    """
    tagged = paired_windows(fact, day, back, codes, date_column, held)
    kpi = daily(tagged, (), kpi_measures(codes))
    return bounds_table(all_samples(kpi, pair, month_bound), day, threshold)
