"""Two-factor split of the overall rate gap over business lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ratiolens.functions.scalar import gap, quoted, ratio
from ratiolens.operators.baseline import TOTAL_LEVEL
from ratiolens.operators.totals import with_totals

LEVELS = [(), ("bu",)]

# The two indicators of a split.
STRUCTURE, PERMEABILITY = "结构占比", "渗透率"


def bu_split(base: DataFrame, numerator: str = "self_amt") -> DataFrame:
    """Business lines with this year's rows, their shares, rates and contributions.

    ``base`` has the LEVELS; its measure columns are kept for the deeper splits.
    The overall rate and the totals are one small aggregate per source, joined
    back to its lines. The rate change is weighted by the predicted share, hence
    the contributions leave out the interaction of the two changes.
    """
    is_total = f"level = '{TOTAL_LEVEL}'"
    bring = {
        f"all_{tag}_{name}": f"max(CASE WHEN {is_total} THEN {tag}_{name} END)"
        for tag in ("a", "p")
        for name in ("amt", numerator)
    }
    sums = {
        f"sum_{tag}_amt": f"sum(CASE WHEN NOT {is_total} THEN {tag}_amt END)"
        for tag in ("a", "p")
    }
    # sum over lines of (predicted share * predicted rate), times the predicted total amount
    weighted = f"CASE WHEN NOT {is_total} AND p_amt <> 0 THEN p_{numerator} END"
    totals = bring | sums | {"sum_p_weighted": f"sum({weighted})"}
    zoomed = with_totals(base, ("period", "usersource"), totals).where(f"NOT {is_total} AND n_cur > 0")
    overall_a = ratio(f"all_a_{numerator}", "all_a_amt")
    overall_p = ratio(f"all_p_{numerator}", "all_p_amt")
    zoom = ratio(overall_p, ratio("sum_p_weighted", "sum_p_amt"))
    rates = zoomed.selectExpr(
        *base.columns,
        f"{gap(overall_a, overall_p)} AS total_gap",
        f"{ratio('a_amt', 'sum_a_amt')} AS a_share",
        f"{ratio('p_amt', 'sum_p_amt')} AS p_share",
        f"{ratio(f'a_{numerator}', 'a_amt')} AS a_rate",
        f"{ratio(f'p_{numerator}', 'p_amt')} * {zoom} AS p_rate",
    )
    return rates.selectExpr(
        "*",
        "(a_share - p_share) * p_rate AS g_share",
        "(a_rate - p_rate) * p_share AS g_rate",
    )


def bu_rows(split: DataFrame) -> DataFrame:
    """Two rows per business line: structure share and permeability."""
    rows = ", ".join(
        f"struct({quoted(label)} AS indicator, {i} AS idx, a_{x} AS actual, p_{x} AS pred, "
        f"g_{x} AS cts)"
        for i, (label, x) in enumerate(((STRUCTURE, "share"), (PERMEABILITY, "rate")))
    )
    return split.selectExpr("period", "usersource", "bu", "total_gap", f"inline(array({rows}))")
