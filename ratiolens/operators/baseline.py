"""Seasonal baseline: actual and expected value of every measure of a daily series.

Expected = last year's value at the same position, scaled by how this year's
leading part of the period compares with last year's. Positions count existing
rows of the series, not calendar days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratiolens.codes import Codes
from ratiolens.functions.scalar import quoted, ratio
from ratiolens.operators.daily import PAIR_KEYS, aggregates
from ratiolens.sources.fact import CURRENT, with_doubles

TOTAL_LEVEL = "total"


def lookbacks(codes: Codes) -> dict[str, int]:
    """Days before the run day that each period reads (7, 14 and 60 days in all)."""
    return {codes.day: 6, codes.week: 13, codes.month: 59}


def level_name(dims: tuple[str, ...]) -> str:
    return "*".join(dims) or TOTAL_LEVEL


def finest_dims(levels: list[tuple[str, ...]]) -> tuple[str, ...]:
    return tuple(dict.fromkeys(d for dims in levels for d in dims))


def level_series(
    tagged: DataFrame,
    day: str,
    codes: Codes,
    levels: list[tuple[str, ...]],
    measures: dict[str, str],
    periods: tuple[str, ...] | None = None,
) -> DataFrame:
    """Daily series at several dimension levels and for several periods at once.

    Fact rows are aggregated once, at the finest grain; periods and levels are
    fanned out over that small result only. A level drops rows whose own
    dimension is NULL, coarser levels keep them.
    """
    spans = lookbacks(codes)
    periods = periods or codes.periods
    finest = finest_dims(levels)
    grain = with_doubles(
        tagged.groupBy(*PAIR_KEYS, "d", "label_period", *finest).agg(*aggregates(measures))
    )
    age = (
        f"datediff(CASE WHEN side = '{CURRENT}' THEN DATE'{day}' "
        f"ELSE add_months(DATE'{day}', -12) END, d)"
    )
    inside = ", ".join(f"CASE WHEN {age} <= {spans[p]} THEN {quoted(p)} END" for p in periods)
    fanned = grain.selectExpr("*", f"explode(array_compact(array({inside}))) AS period")
    keys = ["period", *PAIR_KEYS, "label_period"]
    rolled = fanned.groupingSets([keys + list(dims) for dims in levels], *keys, *finest).agg(
        *[F.expr(f"sum({name}) AS {name}") for name in measures],
        *[F.expr(f"grouping({dim}) AS without_{dim}") for dim in finest],
    )
    names = []
    for dims in levels:
        here = [f"without_{d} = {0 if d in dims else 1}" for d in finest]
        names.append(f"WHEN {' AND '.join(here) or 'true'} THEN '{level_name(dims)}'")
    known = [f"(without_{d} = 1 OR {d} IS NOT NULL)" for d in finest]
    return rolled.where(" AND ".join(known) or "true").selectExpr(
        *keys, *finest, *measures, f"CASE {' '.join(names)} END AS level"
    )


def baseline(series: DataFrame, keys: list[str], measures: list[str], codes: Codes) -> DataFrame:
    """``a_*`` (actual) and ``p_*`` (expected) per key and measure, one aggregate for both years.

    | period | leading rows | measured rows |
    | day    | all but last | last          |
    | week   | first 7      | mean of last 7  |
    | month  | first 30     | mean of last 30 |

    ``n_cur`` and ``n_prev`` count the series' dates; a series without this
    year's rows has no actual, one without either year's rows has no expectation.

    A series holds a few dozen rows, and one exchange on its key serves the
    positions, the sizes and the final aggregate.
    """
    per_side = W.partitionBy(*keys, "side")
    ranked = (
        series.repartition(*keys)
        .withColumn("position", F.row_number().over(per_side.orderBy("label_period")))
        .withColumn("size", F.count(F.lit(1)).over(per_side))
    )
    k = f"CASE period WHEN {quoted(codes.week)} THEN 7 WHEN {quoted(codes.month)} THEN 30 END"
    flagged = ranked.selectExpr(
        *keys,
        *measures,
        f"side = '{CURRENT}' AS cur",
        f"position <= coalesce({k}, size - 1) AS leading",
        f"position > size - coalesce({k}, 1) AS measured",
    )
    sums = {
        "n_cur": "count(CASE WHEN cur THEN 1 END)",
        "n_prev": "count(CASE WHEN NOT cur THEN 1 END)",
    }
    for name in measures:
        for side, when in (("cur", "cur"), ("prev", "NOT cur")):
            sums[f"{side}_tail_{name}"] = f"avg(CASE WHEN {when} AND measured THEN {name} END)"
            sums[f"{side}_head_{name}"] = (
                f"cast(coalesce(sum(CASE WHEN {when} AND leading THEN {name} END), 0) AS double)"
            )
    expected = {
        name: ratio(f"prev_tail_{name} * cur_head_{name}", f"prev_head_{name}") for name in measures
    }
    return (
        flagged.groupBy(*keys)
        .agg(*aggregates(sums))
        .selectExpr(
            *keys,
            "n_cur",
            "n_prev",
            *[f"cur_tail_{name} AS a_{name}" for name in measures],
            *[f"CASE WHEN n_cur > 0 THEN {sql} END AS p_{name}" for name, sql in expected.items()],
        )
    )


def level_baseline(
    tagged: DataFrame,
    day: str,
    codes: Codes,
    levels: list[tuple[str, ...]],
    measures: dict[str, str],
    periods: tuple[str, ...] | None = None,
) -> DataFrame:
    """:func:`baseline` of :func:`level_series`."""
    series = level_series(tagged, day, codes, levels, measures, periods)
    keys = ["period", "usersource", "level", *finest_dims(levels)]
    return baseline(series, keys, list(measures), codes)


def indicator(base: DataFrame, numerator: str = "self_amt") -> DataFrame:
    """Actual and expected overall rate per source and period."""
    return base.where(f"level = '{TOTAL_LEVEL}'").selectExpr(
        "period",
        "usersource",
        f"{ratio(f'a_{numerator}', 'a_amt')} AS actual",
        f"{ratio(f'p_{numerator}', 'p_amt')} AS pred",
    )
