"""Adtributor measures of one dimension element."""

from __future__ import annotations

from ratiolens.functions.scalar import gap, ratio


def _x_ln(x: str, y: str) -> str:
    """x ln y with its limit 0 at x = 0."""
    return f"CASE WHEN {x} = 0 THEN 0D WHEN {y} > 0 THEN {x} * ln({y}) END"


def surprise(p: str, q: str) -> str:
    """Unweighted Jensen-Shannon term of actual share p and predicted share q."""
    both = f"({p} + {q})"
    return f"({_x_ln(p, p)}) + ({_x_ln(q, q)}) - ({_x_ln(both, f'({both} / 2)')})"


def explanatory_power(a: str, f: str, total_a: str, total_f: str) -> str:
    """Share of the total gap explained by the element, for an additive measure."""
    return ratio(f"{a} - {f}", gap(total_a, total_f))


def explanatory_power_ratio(a: str, f: str, total_a: str, total_f: str) -> str:
    """Explanatory power of the element when a, f and the totals are rates."""
    return ratio(
        f"({a} - {f}) * {total_f} - ({total_a} - {total_f}) * {f}", f"{total_f} * {total_a}"
    )
