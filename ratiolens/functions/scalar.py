"""Null-safe arithmetic and number-to-text expressions."""

from __future__ import annotations

import re


def quoted(value: str) -> str:
    """A string literal."""
    escaped = (
        value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\t", "\\t")
    )
    return f"'{escaped}'"


def quoted_list(values: tuple[str, ...] | list[str]) -> str:
    return ", ".join(quoted(v) for v in values)


def ratio(num: str, den: str) -> str:
    """num / den; NULL instead of an error or infinity when den is 0."""
    return f"try_divide({num}, {den})"


def or_zero(value: str) -> str:
    return f"coalesce({value}, 0D)"


def positive_pow(base: str, exponent: float) -> str:
    """base ** exponent for a positive base, NULL otherwise."""
    return f"CASE WHEN {base} > 0 THEN power({base}, {exponent!r}D) END"


def log_ratio(num: str, den: str) -> str:
    """ln(num / den), NULL unless the ratio is positive."""
    quotient = ratio(num, den)
    return f"CASE WHEN {quotient} > 0 THEN ln({quotient}) END"


def cap(value: str, limit: float) -> str:
    """min(value, limit) that keeps NULL (``least`` alone would skip it)."""
    return f"CASE WHEN {value} IS NOT NULL THEN least({value}, {limit!r}D) END"


def gap(actual: str, pred: str) -> str:
    """actual - pred, exactly 0 if they differ by rounding noise only.

    Used where the gap becomes a divisor: a ratio to a noise-sized gap means nothing.
    """
    noise = f"1e-12D * (abs({actual}) + abs({pred}))"
    return (
        f"CASE WHEN abs({actual} - {pred}) <= {noise} THEN 0D ELSE {actual} - {pred} END"
    )


def settled(value: str) -> str:
    """Rounded to 10 decimals: sums of doubles differ by run in their last bits."""
    return f"round({value}, 10)"


def positive(value: str) -> str:
    return f"{settled(value)} > 0"


def filled(template: str, **values: str) -> str:
    """Text from a template whose {names} stand for the given SQL expressions."""
    pieces = re.split(r"\{(\w+)\}", template)
    parts = [values[p] if i % 2 else quoted(p) for i, p in enumerate(pieces) if i % 2 or p]
    return f"concat({', '.join(parts)})"


def percent_text(value: str) -> str:
    """Share as text with two decimals and a percent sign; NULL reads 'nan%'.

    The size is rounded half-even first, so the formatter never meets a tie.
    """
    return (
        f"CASE WHEN {value} IS NULL THEN 'nan%' ELSE concat("
        f"CASE WHEN {settled(value)} < 0 THEN '-' ELSE '' END, "
        f"format_string('%.2f%%', bround(abs({value}), 4) * 100)) END"
    )
