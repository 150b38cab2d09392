"""Run 2: detection series of the run day and their anomaly flags."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ratiolens.codes import Codes
from ratiolens.operators.daily import daily, kpi_measures
from ratiolens.operators.detect import detection_series, flag_anomalies
from ratiolens.sources.fact import paired_windows
from ratiolens.sources.results import latest_bounds

LOOKBACK = 299


def detect(
    fact: DataFrame, bounds: DataFrame, day: str, codes: Codes, back: int = LOOKBACK
) -> DataFrame:
    """The detection table of ``day``, judged by the newest ``bounds`` saved up to it."""
    kpi = daily(paired_windows(fact, day, back, codes), (), kpi_measures(codes))
    series = detection_series(kpi, latest_bounds(bounds, day), codes)
    return flag_anomalies(series, day)
