"""Conversion splits below a business line: counters, payment factors, page steps.

Each split keeps one row per parent and works on that row's columns: raw
factors of both sides, a calibration that makes the predicted factors reproduce
the parent's prediction, then LMDI over chains of factors. Since every parent's
columns travel along, no level joins back to the level above it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ratiolens.codes import Codes
from ratiolens.functions.lmdi import chain_means, chain_products, factor_parts
from ratiolens.functions.scalar import cap, gap, or_zero, positive_pow, quoted, ratio
from ratiolens.operators.business import PERMEABILITY, STRUCTURE

COUNTERS = ("prepay", "quick", "postpay")
KEYS = ("period", "usersource", "bu")
# Columns of a business line that every level passes on where they exist.
CARRIED = ("total_gap", "bu_rank")
# What a split reads of its parent: prediction, gap, contribution to the overall gap.
PARENT = ("parent_pred", "parent_cta", "parent_ctb")


# ---------------------------------------------------------------- first level


def counter_split(split: DataFrame) -> DataFrame:
    """Share and rate of every counter within a business line (``bu_split`` rows).

    Only the predicted rates are calibrated; missing values count as 0.
    """
    scaled = split.selectExpr(
        "*",
        *[
            f"{' + '.join(or_zero(f'{tag}_{c}_{name}') for c in COUNTERS)} AS {tag}_sum_{name}"
            for tag in ("a", "p")
            for name in ("amt", "self_amt")
        ],
    )
    zoom = ratio("p_rate", ratio("p_sum_self_amt", "p_sum_amt"))
    factors = {}
    for c in COUNTERS:
        for tag in ("a", "p"):
            rate = ratio(f"{tag}_{c}_self_amt", f"{tag}_{c}_amt")
            share = ratio(f"{tag}_{c}_amt", f"{tag}_sum_amt")
            factors[f"{tag}_{c}_share"] = or_zero(share)
            factors[f"{tag}_{c}_rate"] = or_zero(rate if tag == "a" else f"{rate} * {zoom}")
    with_factors = scaled.selectExpr("*", *[f"{sql} AS {name}" for name, sql in factors.items()])
    chains = [[f"{c}_share", f"{c}_rate"] for c in COUNTERS]
    return lmdi_split(with_factors, chains, skip_first_on_zero=True)


def lmdi_split(df: DataFrame, chains: list[list[str]], skip_first_on_zero: bool) -> DataFrame:
    """Add a ``g_`` column with the LMDI contribution of every factor of the chains."""

    def named(columns: dict[str, str]) -> list[str]:
        return [f"{sql} AS {name}" for name, sql in columns.items()]

    parts = factor_parts(chains, skip_first_on_zero)
    return (
        df.selectExpr("*", *named(chain_products(chains)))
        .selectExpr("*", *named(chain_means(chains)))
        .selectExpr("*", *[f"{sql} AS g_{x}" for x, sql in parts.items()])
    )


def _carried(df: DataFrame) -> list[str]:
    return [c for c in CARRIED if c in df.columns]


def counter_rows(counters: DataFrame, codes: Codes) -> DataFrame:
    """Six rows per business line, in report order: shares first, last counter first."""
    rows = []
    for label, x in ((STRUCTURE, "share"), (PERMEABILITY, "rate")):
        for c in reversed(COUNTERS):
            element = quoted(getattr(codes, c))
            rows.append(_factor_struct(quoted(label), element, f"{c}_{x}", len(rows)))
    return counters.selectExpr(
        *KEYS,
        *_carried(counters),
        f"{gap('a_rate', 'p_rate')} AS parent_cta",
        "g_rate AS parent_ctb",
        f"inline(array({', '.join(rows)}))",
    )


def _factor_struct(indicator: str, element: str, name: str, idx: int) -> str:
    return (
        f"struct({indicator} AS indicator, {element} AS element, '{name}' AS factor, "
        f"{idx} AS idx, a_{name} AS actual, p_{name} AS pred, g_{name} AS cts)"
    )


# ------------------------------------------------------------- deeper levels


@dataclass(frozen=True)
class FactorModel:
    """A rate written as a sum of products of factors.

    ``factors``: name to (numerator, denominator) measures; a lone measure name
    stands for itself, a leading ``1/`` or ``-`` for its inverse or negative.
    ``total``: the rate as SQL over raw factors or measures, ``{x}`` prefixed.
    ``exponents``: power of the calibration ratio each factor gets.
    """

    factors: dict[str, tuple[str, str] | str]
    chains: list[list[str]]
    total: str
    exponents: dict[str, float]
    total_of_measures: bool = False
    limit: float | None = None
    skip_first_on_zero: bool = True

    def measures(self) -> set[str]:
        """Names of the fact measures that the factors are made of."""
        found: set[str] = set()
        for formula in self.factors.values():
            for part in formula if isinstance(formula, tuple) else (formula,):
                found.update(m.removeprefix("1/").removeprefix("-") for m in part.split(" + "))
        return found


def second_model(counter: str) -> FactorModel:
    """Own-payment rate of a counter: orders x 1/amount x (group factors), and refunds."""
    c = counter
    factors: dict[str, tuple[str, str] | str] = {}
    groups = []
    for g in ("card", "credit", "other") if c == "prepay" else ("new", "old"):
        steps = [(f"{c}_{g}_rt", f"{c}_{g}_cnt", f"{c}_cnt")]
        if c == "prepay":
            steps.append((f"{c}_{g}_p", f"{c}_{g}_paid", f"{c}_{g}_cnt"))
        else:
            steps.append((f"{c}_{g}_self_rt", f"{c}_{g}_own_cnt", f"{c}_{g}_cnt"))
            steps.append((f"{c}_{g}_self_p", f"{c}_{g}_own_paid", f"{c}_{g}_own_cnt"))
        factors |= {name: (num, den) for name, num, den in steps}
        groups.append([name for name, _, _ in steps])
    orders, inverse, refund = f"{c}_orders", f"{c}_inverse_amt", f"{c}_refunds"
    factors |= {orders: f"{c}_cnt", inverse: f"1/{c}_amt", refund: f"-{c}_refund"}
    products = " + ".join(" * ".join("{x}" + name for name in g) for g in groups)
    depth = len(groups[0]) + 2
    exponents = {name: 1 / depth for name in factors} | {refund: (depth - 1) / depth}
    return FactorModel(
        factors=factors,
        chains=[[orders, inverse, *g] for g in groups] + [[inverse, refund]],
        total="{x}%s * {x}%s * (%s) + {x}%s * {x}%s" % (orders, inverse, products, refund, inverse),
        exponents=exponents,
    )


def _entry_rates(pairs: dict[str, tuple[str, str]], exponent: float) -> dict:
    return {
        "factors": pairs,
        "exponents": {name: exponent for name in pairs},
        "total_of_measures": True,
        "limit": 1.0,
        "skip_first_on_zero": False,
    }


def third_models() -> dict[str, FactorModel]:
    """The three second-level rates that can be split again, by factor name."""
    entries = "({x}nocard_entry + {x}havecard_entry)"
    card = {
        "nocard_rt": ("nocard_entry", "nocard_entry + havecard_entry"),
        "havecard_rt": ("havecard_entry", "nocard_entry + havecard_entry"),
    }
    steps = ("nocard_bind", "havecard_default", "havecard_change", "havecard_bind")
    for step in steps:
        card[f"{step}_rt"] = (f"{step}_entry", f"{step.split('_')[0]}_entry")
        card[f"{step}_sub_rt"] = (f"{step}_submit", f"{step}_entry")
    submits = " + ".join("{x}" + f"{s}_submit" for s in steps)
    credit = {
        "inactive_rt": ("inactive_entry", "inactive_entry + active_entry"),
        "active_rt": ("active_entry", "inactive_entry + active_entry"),
        "inactive_sub_rt": ("inactive_submit", "inactive_entry"),
        "active_sub_rt": ("active_submit", "active_entry"),
    }
    quick = {
        "quicknew_haveown_rt": ("quicknew_haveown_cnt", "quicknew_cnt"),
        "quicknew_own_sub_rt": ("quicknew_own_cnt", "quicknew_haveown_cnt"),
    }
    return {
        "prepay_card_rt": FactorModel(
            chains=[[f"{s.split('_')[0]}_rt", f"{s}_rt", f"{s}_sub_rt"] for s in steps],
            total=ratio(submits, entries),
            **_entry_rates(card, 1 / 3),
        ),
        "prepay_credit_rt": FactorModel(
            chains=[["active_rt", "active_sub_rt"], ["inactive_rt", "inactive_sub_rt"]],
            total=ratio(
                "{x}inactive_submit + {x}active_submit", "{x}inactive_entry + {x}active_entry"
            ),
            **_entry_rates(credit, 1 / 2),
        ),
        "quick_new_self_rt": FactorModel(
            chains=[list(quick)],
            total=ratio("{x}quicknew_own_cnt", "{x}quicknew_cnt"),
            **_entry_rates(quick, 1 / 2),
        ),
    }


THIRD_COUNTER = {
    "prepay_card_rt": "prepay",
    "prepay_credit_rt": "prepay",
    "quick_new_self_rt": "quick",
}


def _measure(formula: tuple[str, str] | str, tag: str) -> str:
    def prefixed(sum_of: str) -> str:
        return " + ".join(f"{tag}_{m}" for m in sum_of.split(" + "))

    if isinstance(formula, tuple):
        return ratio(f"({prefixed(formula[0])})", f"({prefixed(formula[1])})")
    if formula.startswith("1/"):
        return ratio("1D", f"{tag}_{formula[2:]}")
    if formula.startswith("-"):
        return f"-{tag}_{formula[1:]}"
    return f"{tag}_{formula}"


def factor_split(parents: DataFrame, model: FactorModel, mode: str = "chain") -> DataFrame:
    """``a_``, ``p_`` and ``g_`` (LMDI) columns of the model's factors on every parent row.

    ``mode='delta'`` gives each factor its plain change instead of LMDI parts.
    """
    names = list(model.factors)
    raw = parents.selectExpr(
        "*",
        *[f"{or_zero(_measure(f, 'a'))} AS a_{n}" for n, f in model.factors.items()],
        *[f"{or_zero(_measure(f, 'p'))} AS raw_{n}" for n, f in model.factors.items()],
    )
    total = model.total.replace("{x}", "p_" if model.total_of_measures else "raw_")
    zoomed = raw.selectExpr("*", f"{ratio('parent_pred', f'({total})')} AS zoom")

    def calibrated(name: str) -> str:
        value = f"raw_{name} * ({positive_pow('zoom', model.exponents[name])})"
        return or_zero(value if model.limit is None else cap(f"({value})", model.limit))

    predicted = zoomed.selectExpr("*", *[f"{calibrated(n)} AS p_{n}" for n in names])
    if mode == "chain":
        return lmdi_split(predicted, model.chains, model.skip_first_on_zero)
    if mode == "delta":
        return predicted.selectExpr("*", *[f"a_{n} - p_{n} AS g_{n}" for n in names])
    raise ValueError("mode must be 'chain' or 'delta'")


def _below(df: DataFrame, name: str, models: list[FactorModel]) -> DataFrame:
    """Factor ``name`` of a split as the parent of the next level.

    Only what the given models read is carried on.
    """
    measures = sorted({m for model in models for m in model.measures()})
    return df.selectExpr(
        *KEYS,
        *_carried(df),
        f"p_{name} AS parent_pred",
        f"{gap(f'a_{name}', f'p_{name}')} AS parent_cta",
        f"{ratio(f'g_{name}', 'parent_cta')} * parent_ctb AS parent_ctb",
        *[f"{tag}_{m}" for tag in ("a", "p") for m in measures],
    )


def second_level(counters: DataFrame, counter: str, with_deeper: bool = True) -> DataFrame:
    """Factor columns of one counter's own-payment rate.

    ``with_deeper`` carries what the third level reads.
    """
    model = second_model(counter)
    deeper = [third_models()[c] for c, at in THIRD_COUNTER.items() if with_deeper and at == counter]
    line_gap = gap("a_rate", "p_rate")
    parents = counters.selectExpr("*", f"{line_gap} AS parent_cta", "g_rate AS parent_ctb")
    return factor_split(_below(parents, f"{counter}_rate", [model, *deeper]), model)


def third_level(second: DataFrame, code: str, quick_new_mode: str = "delta") -> DataFrame:
    """Factor columns of one splittable second-level rate.

    The quick-new pair is split by plain differences unless
    ``quick_new_mode='chain'`` asks for the two-factor LMDI.
    """
    model = third_models()[code]
    mode = quick_new_mode if code == "quick_new_self_rt" else "chain"
    return factor_split(_below(second, code, [model]), model, mode)


def factor_rows(
    split: DataFrame, model: FactorModel, counter: str, code: str | None, labels: dict[str, str]
) -> DataFrame:
    """One row per factor, with the counter (and the parent code) it belongs to."""
    rows = [
        _factor_struct("NULL", quoted(labels[name]), name, i)
        for i, name in enumerate(model.factors)
    ]
    return split.selectExpr(
        *KEYS,
        *_carried(split),
        "parent_cta",
        "parent_ctb",
        f"{quoted(counter)} AS counter",
        f"{quoted(code) if code else 'cast(NULL AS string)'} AS code",
        f"inline(array({', '.join(rows)}))",
    )


def with_contributions(rows: DataFrame) -> DataFrame:
    """Gap, contribution to the overall gap, and its share, from the LMDI part ``cts``."""
    scaled = f"{ratio('cts', 'parent_cta')} * parent_ctb"
    return rows.selectExpr(
        *[c for c in rows.columns if c not in ("parent_cta", "parent_ctb")],
        "actual - pred AS cta",
        f"{scaled} AS ctb",
        f"{ratio(scaled, 'total_gap')} AS ratio",
    )
