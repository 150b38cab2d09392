"""Daily, weekly and monthly detection series and their anomaly flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratiolens.codes import Codes
from ratiolens.functions.scalar import quoted, ratio
from ratiolens.operators.bounds import METRICS
from ratiolens.operators.pairing import year_pairs

# Rows of history a date needs before it is reported, by horizon.
MIN_AGE = {"day": 7, "week": 14, "month": 60}
# Rows back to the compared predecessor, by horizon.
STEP = {"day": 1, "week": 7, "month": 30}
VALUES = ("amt", *METRICS.values())


def paired_kpi(kpi: DataFrame) -> DataFrame:
    """Both years' daily amounts by recency rank, with the date's age rank."""
    pairs = year_pairs(kpi.repartition("usersource"), ["usersource"], list(VALUES))
    everything = W.partitionBy("usersource")
    return pairs.withColumn("age", F.count(F.lit(1)).over(everything) - F.col("rk") + 1)


def rolling_sums(pairs: DataFrame) -> DataFrame:
    """7- and 30-row sums of both years' amounts, newest row first."""
    newest_first = W.partitionBy("usersource").orderBy(F.desc("label_period"))
    sums = {
        f"{side}_{value}_{rows}": F.sum(f"{side}_{value}").over(
            newest_first.rowsBetween(0, rows - 1)
        )
        for rows in (7, 30)
        for side in ("cur", "prev")
        for value in VALUES
    }
    return pairs.withColumns(sums)


def horizon_rates(rolled: DataFrame) -> DataFrame:
    """Rates of both years per horizon, with their predecessors and 7-row means.

    Rows younger than the horizon's minimum age hold NULL, so frames and
    predecessors see only reported rows.
    """
    suffix = {"day": "", "week": "_7", "month": "_30"}
    rates = {}
    for metric, num in METRICS.items():
        for horizon, tail in suffix.items():
            for side in ("cur", "prev"):
                value = ratio(f"{side}_{num}{tail}", f"{side}_amt{tail}")
                rates[f"{metric}_{horizon}_{side}"] = (
                    f"CASE WHEN age >= {MIN_AGE[horizon]} THEN {value} END"
                )
    table = rolled.selectExpr(
        "usersource", "label_period", "age", *[f"{sql} AS {name}" for name, sql in rates.items()]
    )
    newest_first = W.partitionBy("usersource").orderBy(F.desc("label_period"))
    week = newest_first.rowsBetween(0, 6)
    more = {}
    for metric in METRICS:
        for horizon, step in STEP.items():
            for side in ("cur", "prev"):
                name = f"{metric}_{horizon}_{side}"
                more[f"{name}_before"] = F.lead(name, step).over(newest_first)
                if horizon == "day":
                    more[f"{name}_sum"] = F.sum(name).over(week)
                    more[f"{name}_mean"] = F.avg(name).over(week)
    return table.withColumns(more)


def _metric_columns(metric: str, horizon: str) -> dict[str, str]:
    cur, prev = f"{metric}_{horizon}_cur", f"{metric}_{horizon}_prev"
    if horizon == "day":
        value = ratio(f"{cur} * {prev}_sum", f"{cur}_sum * {prev}")
        own, other = ratio(cur, f"{cur}_mean"), ratio(prev, f"{prev}_mean")
    else:
        value = ratio(f"{cur} * {prev}_before", f"{cur}_before * {prev}")
        own, other = ratio(cur, f"{cur}_before"), ratio(prev, f"{prev}_before")
    return {
        f"this_year_{metric}": cur,
        f"{metric}_qoq": ratio(cur, f"{cur}_before"),
        f"{metric}_yoy": ratio(cur, prev),
        f"{metric}_qy_value": value,
        f"{metric}_top": f"{metric}_{horizon}_top",
        f"{metric}_bottom": f"{metric}_{horizon}_bottom",
        f"{metric}_qy_value_numerator": own,
        f"{metric}_qy_value_denominator": other,
    }


def detection_series(kpi: DataFrame, bounds: DataFrame, codes: Codes) -> DataFrame:
    """All horizons of every reported date, one unpivot over a single window pass.

    ``bounds`` holds one row per source (see ``latest_bounds``).
    """
    rates = horizon_rates(rolling_sums(paired_kpi(kpi)))
    limits = bounds.drop("Date", "d").withColumnRenamed("Usersource", "usersource")
    joined = rates.join(limits, "usersource", "left")
    rows = []
    for horizon, period in zip(MIN_AGE, codes.periods):
        fields = [f"{quoted(period)} AS period", f"{MIN_AGE[horizon]} AS min_age"]
        for metric in METRICS:
            fields += [f"{sql} AS {n}" for n, sql in _metric_columns(metric, horizon).items()]
        rows.append(f"struct({', '.join(fields)})")
    return (
        joined.selectExpr("label_period", "usersource", "age", f"inline(array({', '.join(rows)}))")
        .where("age >= min_age")
        .drop("age", "min_age")
    )


def flag(metric: str) -> str:
    """0 inside the bounds, 1 outside; a missing value or bound counts as outside."""
    inside = f"{metric}_qy_value BETWEEN {metric}_bottom AND {metric}_top"
    return f"CASE WHEN {inside} THEN 0 ELSE 1 END AS {metric}_flag"


def flag_anomalies(series: DataFrame, day: str) -> DataFrame:
    """The run day's rows with their flags and the partition column."""
    return series.where(f"label_period = DATE'{day}'").selectExpr(
        "*", *[flag(metric) for metric in METRICS], "label_period AS d"
    )
