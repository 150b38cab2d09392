"""Logarithmic mean Divisia index: split a change of a product over its factors.

Written as three column steps, so that products and means are computed once per
chain instead of once per factor. Factor ``x`` is read from columns ``a_x``
(actual) and ``p_x`` (predicted).
"""

from __future__ import annotations

from ratiolens.functions.scalar import gap, log_ratio, ratio


def chain_products(chains: list[list[str]]) -> dict[str, str]:
    """Step 1: actual and predicted product of every chain."""
    return {
        f"{tag}_product_{i}": " * ".join(f"{tag}_{x}" for x in chain)
        for i, chain in enumerate(chains)
        for tag in ("a", "p")
    }


def chain_means(chains: list[list[str]]) -> dict[str, str]:
    """Step 2: change of every chain and the logarithmic mean of its two products.

    The mean of two equal products is their common value. With a zero product
    there is no logarithm, and the mean is NULL.
    """
    out = {}
    for i, _ in enumerate(chains):
        after, before = f"a_product_{i}", f"p_product_{i}"
        change = gap(after, before)
        out[f"change_{i}"] = change
        out[f"mean_{i}"] = (
            f"CASE WHEN {after} = 0 OR {before} = 0 THEN NULL WHEN {change} = 0 THEN {after} "
            f"ELSE {ratio(f'({after} - {before})', f'({log_ratio(after, before)})')} END"
        )
        out[f"zero_{i}"] = f"{after} = 0 OR {before} = 0"
    return out


def factor_parts(chains: list[list[str]], skip_first_on_zero: bool) -> dict[str, str]:
    """Step 3: every factor's contribution to prod(actual) - prod(predicted).

    It is ln(actual / predicted) times the mean; a factor shared by chains gets
    the sum of its parts. On a zero product every factor gets the whole change,
    and with ``skip_first_on_zero`` the chain's first (the shared base) none.
    """
    parts: dict[str, list[str]] = {}
    for i, chain in enumerate(chains):
        for position, x in enumerate(chain):
            on_zero = "0D" if position == 0 and skip_first_on_zero else f"change_{i}"
            parts.setdefault(x, []).append(
                f"CASE WHEN zero_{i} THEN {on_zero} "
                f"ELSE ({log_ratio(f'a_{x}', f'p_{x}')}) * mean_{i} END"
            )
    return {x: " + ".join(found) for x, found in parts.items()}
