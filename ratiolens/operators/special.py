"""Special scenes: refunds, listed pay channels and listed platforms."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ratiolens.codes import Codes
from ratiolens.functions.scalar import gap, quoted, ratio
from ratiolens.operators.baseline import TOTAL_LEVEL
from ratiolens.operators.daily import aggregates

LEVELS = [(), ("paycategory",), ("platform",)]

# Indicator and element names of the report.
REFUND, PAY_CHANNEL, PAY_PLATFORM = "Refund", "PayChannel", "PayPlatform"
REFUND_ELEMENT = "退款"
ALL = "all"


def special_scenes(base: DataFrame, codes: Codes) -> DataFrame:
    """Actual, calibrated prediction and gap of every scene element, plus each scene's total.

    ``base`` has the LEVELS with the special measures. Everything of a source is
    one conditional aggregate: totals, shares and the listed elements, which
    thereby exist (as 0) even where the data lacks them. Predictions are scaled
    so that each scene adds up to the overall prediction.
    """
    groups = {
        PAY_CHANNEL: ("paycategory", codes.channels),
        PAY_PLATFORM: ("platform", codes.platforms),
    }
    at_total = f"CASE WHEN level = '{TOTAL_LEVEL}' THEN {{}} END"
    found = {
        f"{tag}_{name}": f"max({at_total.format(f'{tag}_{name}')})"
        for tag in ("a", "p")
        for name in ("amt", "self_amt", "self_amt_payonly", "self_amt_refund")
    }
    for dim, elements in groups.values():
        for tag in ("a", "p"):
            for name in ("amt", "self_amt"):
                found[f"{tag}_{dim}_{name}"] = (
                    f"sum(CASE WHEN level = '{dim}' THEN {tag}_{name} END)"
                )
        for i, element in enumerate(elements):
            here = f"level = '{dim}' AND {dim} = {quoted(element)}"
            found[f"n_{dim}_{i}"] = f"count(CASE WHEN {here} THEN 1 END)"
            found[f"cur_{dim}_{i}"] = f"count(CASE WHEN {here} AND n_cur > 0 THEN 1 END)"
            for tag in ("a", "p"):
                found[f"{tag}_{dim}_{i}"] = f"max(CASE WHEN {here} THEN {tag}_self_amt END)"
    totals = base.groupBy("period", "usersource").agg(*aggregates(found))

    overall = ratio("p_self_amt", "p_amt")
    paid, refund = ratio("a_self_amt_payonly", "a_amt"), ratio("a_self_amt_refund", "a_amt")
    paid_p, refund_p = ratio("p_self_amt_payonly", "p_amt"), ratio("p_self_amt_refund", "p_amt")
    zoom = ratio(overall, f"{paid_p} + {refund_p}")
    rows = [
        _row(REFUND, ALL, 0, f"{paid} + {refund}", overall),
        _row(REFUND, REFUND_ELEMENT, 1, refund, f"{refund_p} * {zoom}"),
    ]
    for indicator, (dim, elements) in groups.items():
        # Shares of the total amount sum to (sum of own amounts) / (total amount).
        share = ratio(f"a_{dim}_self_amt", f"a_{dim}_amt")
        zoom = ratio(overall, ratio(f"p_{dim}_self_amt", f"p_{dim}_amt"))
        rows.append(_row(indicator, ALL, len(rows), share, overall))
        for i, _ in enumerate(elements):
            actual = ratio(f"a_{dim}_{i}", f"a_{dim}_amt")
            pred = f"{ratio(f'p_{dim}_{i}', f'p_{dim}_amt')} * {zoom}"
            rows.append(
                _row(
                    indicator,
                    elements[i],
                    len(rows),
                    f"CASE WHEN cur_{dim}_{i} = 0 THEN 0D ELSE {actual} END",
                    f"CASE WHEN n_{dim}_{i} = 0 THEN 0D ELSE {pred} END",
                )
            )
    listed = totals.selectExpr("period", "usersource", f"inline(array({', '.join(rows)}))")
    with_gap = listed.selectExpr("*", f"{gap('actual', 'pred')} AS gap")
    scene_gap = (
        f"max(CASE WHEN element = '{ALL}' THEN gap END) "
        "OVER (PARTITION BY period, usersource, indicator)"
    )
    return with_gap.selectExpr("*", f"{ratio('gap', scene_gap)} AS ratio")


def _row(indicator: str, element: str, idx: int, actual: str, pred: str) -> str:
    return (
        f"struct({quoted(indicator)} AS indicator, {quoted(element)} AS element, {idx} AS idx, "
        f"{actual} AS actual, {pred} AS pred)"
    )
