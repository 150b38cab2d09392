"""Daily aggregates of the fact table at every grain the analysis uses.

Measures are dictionaries of result name to SQL aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratiolens.codes import Codes
from ratiolens.functions.scalar import quoted, quoted_list
from ratiolens.sources.fact import with_doubles

PAIR_KEYS = ("side", "usersource")


def aggregates(measures: dict[str, str]):
    return [F.expr(f"{sql} AS {name}") for name, sql in measures.items()]


def kpi_measures(codes: Codes) -> dict[str, str]:
    """Net amount, own-instrument amount, and the high-rate card part (NULL on days without)."""
    card = quoted(codes.high_rate_card)
    return {
        "amt": "sum(amt)",
        "self_amt": "sum(self_amt)",
        "highRate_amt": f"sum(CASE WHEN paycategory = {card} THEN self_amt END)",
    }


def special_measures() -> dict[str, str]:
    names = ("amt", "self_amt", "self_amt_payonly", "self_amt_refund")
    return {n: f"coalesce(sum({n}), 0D)" for n in names}


def _sum_if(condition: str, value: str) -> str:
    return f"sum(CASE WHEN {condition} THEN {value} ELSE 0 END)"


def _counters(codes: Codes) -> dict[str, str]:
    return {
        "prepay": f"new_post_flag = {quoted(codes.prepay)}",
        "quick": f"new_post_flag = {quoted(codes.quick)}",
        "postpay": f"new_post_flag = {quoted(codes.postpay)}",
    }


def counter_measures(codes: Codes) -> dict[str, str]:
    """Amount and own amount at each checkout counter (6 sums)."""
    return {
        f"{counter}_{value}": _sum_if(at, value)
        for counter, at in _counters(codes).items()
        for value in ("amt", "self_amt")
    }


def second_measures(codes: Codes) -> dict[str, str]:
    """Order counts and amounts behind each counter's own-payment rate (27 sums)."""
    groups = {
        "prepay": {
            "card": f"paytype = {quoted(codes.card)}",
            "credit": f"paytype = {quoted(codes.credit_line)}",
            "other": f"paytype = {quoted(codes.other_own)}",
        },
        "quick": {
            "new": f"label_a = {quoted(codes.quick_new)}",
            "old": f"label_a = {quoted(codes.quick_old)}",
        },
        "postpay": {
            "new": f"label_a = {quoted(codes.post_new)}",
            "old": f"label_a = {quoted(codes.post_old)}",
        },
    }
    by_ticket = {"cnt": "cnt_payonly", "paid": "amt_payonly"}
    by_own = {"cnt": "cnt_payonly", "own_cnt": "self_cnt_payonly", "own_paid": "self_amt_payonly"}
    values = {"prepay": by_ticket, "quick": by_own, "postpay": by_own}
    out: dict[str, str] = {}
    for counter, at in _counters(codes).items():
        out[f"{counter}_amt"] = _sum_if(at, "amt")
        out[f"{counter}_refund"] = f"{_sum_if(at, 'self_amt_payonly')} - {_sum_if(at, 'self_amt')}"
        out[f"{counter}_cnt"] = _sum_if(at, "cnt_payonly")
        for group, inside in groups[counter].items():
            for suffix, value in values[counter].items():
                out[f"{counter}_{group}_{suffix}"] = _sum_if(f"{at} AND {inside}", value)
    return out


def third_measures(codes: Codes) -> dict[str, str]:
    """Page entries and submitted orders behind the three splittable rates (17 sums)."""
    at = _counters(codes)
    card = f"{at['prepay']} AND paytype = {quoted(codes.card)}"
    credit = f"{at['prepay']} AND paytype = {quoted(codes.credit_line)}"
    quick_new = f"{at['quick']} AND label_a = {quoted(codes.quick_new)}"
    without = quoted_list([codes.nocard_bind, codes.nocard_nobind])
    having = quoted_list(
        [codes.havecard_bind, codes.havecard_default, codes.havecard_change, codes.havecard_other]
    )
    inactive = quoted_list([codes.noact_new, codes.noact_other])
    out = {
        "nocard_entry": _sum_if(f"{card} AND label_a IN ({without})", "card_cnt"),
        "havecard_entry": _sum_if(f"{card} AND label_a IN ({having})", "card_cnt"),
    }
    steps = {
        "nocard_bind": codes.nocard_bind,
        "havecard_default": codes.havecard_default,
        "havecard_change": codes.havecard_change,
        "havecard_bind": codes.havecard_bind,
    }
    for step, value in steps.items():
        inside = f"{card} AND label_a = {quoted(value)}"
        out[f"{step}_entry"] = _sum_if(inside, "card_cnt")
        out[f"{step}_submit"] = _sum_if(inside, "cnt_payonly")
    activating = f"{credit} AND label_a = {quoted(codes.noact_new)}"
    active = f"{credit} AND label_a = {quoted(codes.activated)}"
    out["inactive_entry"] = _sum_if(f"{credit} AND label_a IN ({inactive})", "nqh_cnt")
    out["inactive_submit"] = _sum_if(activating, "cnt_payonly")
    out["active_entry"] = _sum_if(active, "nqh_cnt")
    out["active_submit"] = _sum_if(active, "cnt_payonly")
    out["quicknew_cnt"] = _sum_if(quick_new, "cnt_payonly")
    out["quicknew_haveown_cnt"] = _sum_if(quick_new, "quickpay_haveself_cnt_payonly")
    out["quicknew_own_cnt"] = _sum_if(quick_new, "self_cnt_payonly")
    return out


def funnel_measures(codes: Codes) -> dict[str, str]:
    """Everything the business-line and permeability splits need, per date and line."""
    return (
        kpi_measures(codes)
        | counter_measures(codes)
        | second_measures(codes)
        | third_measures(codes)
    )


FUNNEL_DIMS = ("bu", "paycategory", "new_post_flag", "paytype", "label_a")


def daily(tagged: DataFrame, dims: tuple[str, ...], measures: dict[str, str]) -> DataFrame:
    """One row per year side, source, dimension values and date."""
    sums = tagged.groupBy(*PAIR_KEYS, *dims, "label_period").agg(*aggregates(measures))
    return with_doubles(sums)
