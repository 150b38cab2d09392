"""Normal intervals of the rate metrics, learned from year-on-year adjusted history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratiolens.functions.scalar import quoted, ratio
from ratiolens.operators.daily import aggregates
from ratiolens.operators.pairing import year_pairs

# Metric name to its numerator; the denominator is always the net amount.
METRICS = {"self_rt": "self_amt", "highRate_rt": "highRate_amt"}
HORIZONS = ("day", "week", "month")


def metric_series(kpi: DataFrame) -> DataFrame:
    """One row per metric, side, source and date, arranged by source.

    A source has at most a few hundred days on each side; one exchange on the
    source serves every window, pairing and aggregate that follows.
    """
    rows = ", ".join(f"struct({quoted(m)} AS metric, {n} AS num)" for m, n in METRICS.items())
    return (
        kpi.repartition("usersource")
        .selectExpr("side", "usersource", "label_period", "amt", f"inline(array({rows}))")
        .selectExpr("*", f"{ratio('num', 'amt')} AS rt")
    )


def day_samples(series: DataFrame, pair: str = "newest") -> DataFrame:
    """Rate over its 7-row trailing mean, this year's divided by last year's.

    Only whole windows without a missing rate count, and only they are paired
    with each other. Dates without one keep a row with a NULL value, so that a
    source without any sample still reaches the bounds table.
    """
    week = W.partitionBy("usersource", "metric", "side").orderBy("label_period").rowsBetween(-6, 0)
    smooth = (
        series.withColumn("n", F.count("rt").over(week))
        .withColumn("mean", F.avg("rt").over(week))
        .selectExpr(
            "side",
            "usersource",
            "metric",
            "label_period",
            "n = 7 AS whole",
            f"{ratio('rt', 'mean')} AS t",
        )
    )
    pairs = year_pairs(smooth, ["usersource", "metric", "whole"], ["t"], pair)
    return _samples(pairs, "day", f"CASE WHEN whole THEN {ratio('cur_t', 'prev_t')} END")


def _rolled(series: DataFrame, rows: int, pair: str) -> DataFrame:
    """Trailing ``rows``-row rates of both years, whole windows only, and their predecessors.

    A window counts if all four sums have all their rows; the predecessor is
    ``rows`` places back among the windows that count.
    """
    keys = ["usersource", "metric"]
    pairs = year_pairs(series, keys, ["num", "amt"], pair)
    columns = ("cur_num", "cur_amt", "prev_num", "prev_amt")
    by_date = W.partitionBy(*keys).orderBy("label_period")
    frame = by_date.rowsBetween(1 - rows, 0)
    complete = F.when(F.expr(" AND ".join(f"{c} IS NOT NULL" for c in columns)), 1)
    rolled = pairs.withColumn("n", F.count(complete).over(frame))
    for c in columns:
        rolled = rolled.withColumn(f"sum_{c}", F.sum(c).over(frame))
    rates = rolled.where(f"n = {rows}").selectExpr(
        *keys,
        "label_period",
        f"{ratio('sum_cur_num', 'sum_cur_amt')} AS cur_rt",
        f"{ratio('sum_prev_num', 'sum_prev_amt')} AS prev_rt",
    )
    return rates.withColumn("cur_before", F.lag("cur_rt", rows).over(by_date)).withColumn(
        "prev_before", F.lag("prev_rt", rows).over(by_date)
    )


def week_samples(series: DataFrame, pair: str = "newest") -> DataFrame:
    """Week-on-week change of the 7-row rate, this year's divided by last year's."""
    change = ratio(ratio("cur_rt", "cur_before"), ratio("prev_rt", "prev_before"))
    return _samples(_rolled(series, 7, pair), "week", change)


def month_samples(series: DataFrame, pair: str = "newest", month_bound: str = "qoq") -> DataFrame:
    """Change of the 30-row rate against 30 rows before.

    ``month_bound='qoq'`` samples this year's change alone, although detection
    compares a year-on-year quotient with the bounds; ``'double_ratio'`` samples
    that quotient.
    """
    change = ratio("cur_rt", "cur_before")
    if month_bound == "double_ratio":
        change = ratio(change, ratio("prev_rt", "prev_before"))
    elif month_bound != "qoq":
        raise ValueError("month_bound must be 'qoq' or 'double_ratio'")
    return _samples(_rolled(series, 30, pair), "month", change)


def _samples(df: DataFrame, horizon: str, value: str) -> DataFrame:
    return df.selectExpr(
        "usersource", "metric", f"'{horizon}' AS horizon", "label_period", f"{value} AS value"
    )


def zscore_interval(value: str, threshold: float) -> dict[str, str]:
    """Mean minus and plus ``threshold`` population deviations, to 4 decimals half-even."""
    spread = f"{threshold!r}D * stddev_pop({value})"
    return {
        "bottom": f"bround(avg({value}) - {spread}, 4)",
        "top": f"bround(avg({value}) + {spread}, 4)",
    }


def zscore_bounds(samples: DataFrame, keys: list[str], threshold: float = 2.0) -> DataFrame:
    """The interval of the ``value`` column per key."""
    return samples.groupBy(*keys).agg(*aggregates(zscore_interval("value", threshold)))


def all_samples(
    kpi: DataFrame, pair: dict[str, str] | str = "newest", month_bound: str = "qoq"
) -> DataFrame:
    """The samples of every metric and horizon; ``pair`` for all of them, or by horizon."""
    series = metric_series(kpi)
    by = pair if isinstance(pair, dict) else dict.fromkeys(HORIZONS, pair)
    return (
        day_samples(series, by["day"])
        .unionByName(week_samples(series, by["week"]))
        .unionByName(month_samples(series, by["month"], month_bound))
    )


def bounds_table(samples: DataFrame, day: str, threshold: float = 2.0) -> DataFrame:
    """One row per source with this year's rows: 12 bounds; NULL where no sample exists."""
    intervals = {}
    for metric in METRICS:
        for horizon in HORIZONS:
            inside = f"metric = {quoted(metric)} AND horizon = '{horizon}'"
            value = f"CASE WHEN {inside} THEN value END"
            for edge, sql in zscore_interval(value, threshold).items():
                intervals[f"{metric}_{horizon}_{edge}"] = sql
    return (
        samples.groupBy("usersource")
        .agg(*aggregates(intervals))
        .selectExpr(
            f"{quoted(day)} AS Date",
            "usersource AS Usersource",
            *intervals,
            f"{quoted(day)} AS d",
        )
    )
