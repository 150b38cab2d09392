"""Adtributor: rank the dimension elements behind a line's change of structure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratiolens.functions.attribution import (
    explanatory_power,
    explanatory_power_ratio,
    surprise,
)
from ratiolens.functions.scalar import gap, ratio, settled
from ratiolens.operators.ranking import largest_first

DIMS = ("platform", "paycategory", "new_post_flag")
LEAF = [("bu", *DIMS)]
PARENT = ("period", "usersource", "bu")
EP_THRESHOLD = 0.1
TOP_K = 3


AMOUNTS = ("a_amt", "p_amt", "a_self_amt", "p_self_amt")


def dimension_sums(
    leaves: DataFrame, dims: tuple[str, ...] = DIMS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Actual and predicted amounts per element of each single dimension, and their line's.

    Leaves without this year's rows are out, a missing prediction adds nothing. A line's
    leaves are put together first and counted once per dimension and once for the line, so
    one exchange serves the sums, the totals (``total_`` columns, spread from the line's own
    row) and any ranking within the line. ``carry`` are columns that every leaf of a
    business line shares.
    """
    keys = [*PARENT, *carry]
    places = [f"struct('{d}' AS dim, {DIMS.index(d)} AS dim_idx, {d} AS element)" for d in dims]
    places.append("struct(NULL AS dim, NULL AS dim_idx, NULL AS element)")
    counted = (
        leaves.where("n_cur > 0")
        .repartition(*PARENT)
        .selectExpr(*keys, *AMOUNTS, f"inline(array({', '.join(places)}))")
    )
    sums = counted.groupBy(*keys, "dim", "dim_idx", "element").agg(
        *[F.expr(f"coalesce(sum({n}), 0D) AS {n}") for n in AMOUNTS]
    )
    line = ", ".join(PARENT)
    totals = [
        f"max(CASE WHEN dim IS NULL THEN {n} END) OVER (PARTITION BY {line}) AS total_{n}"
        for n in AMOUNTS
    ]
    return sums.selectExpr("*", *totals).where("dim IS NOT NULL")


def explain_additive(leaves: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Explanatory power and surprise of every element for the net amount."""
    shares = dimension_sums(leaves, carry=carry).selectExpr(
        "*", f"{ratio('a_amt', 'total_a_amt')} AS p", f"{ratio('p_amt', 'total_p_amt')} AS q"
    )
    return shares.selectExpr(
        *PARENT,
        *carry,
        "dim",
        "dim_idx",
        "element",
        "a_amt AS actual",
        "p_amt AS pred",
        f"{gap('total_a_amt', 'total_p_amt')} AS dim_gap",
        f"{explanatory_power('a_amt', 'p_amt', 'total_a_amt', 'total_p_amt')} AS ep",
        f"{surprise('p', 'q')} AS surprise",
    )


def explain_ratio(leaves: DataFrame) -> DataFrame:
    """The same for the own-instrument rate, over the last dimension only."""
    rates = dimension_sums(leaves, DIMS[-1:]).selectExpr(
        "*",
        f"{ratio('a_self_amt', 'a_amt')} AS actual",
        f"{ratio('p_self_amt', 'p_amt')} AS pred",
        f"{ratio('total_a_self_amt', 'total_a_amt')} AS total_actual",
        f"{ratio('total_p_self_amt', 'total_p_amt')} AS total_pred",
        *[f"{ratio(n, f'total_{n}')} AS share_{n}" for n in AMOUNTS],
    )
    ep = explanatory_power_ratio("actual", "pred", "total_actual", "total_pred")
    numerators = surprise("share_a_self_amt", "share_p_self_amt")
    denominators = surprise("share_a_amt", "share_p_amt")
    return rates.selectExpr(
        *PARENT,
        "dim",
        "dim_idx",
        "element",
        "actual",
        "pred",
        f"{ep} AS ep",
        f"({numerators}) + ({denominators}) AS surprise",
    )


def reaches(value: str, threshold: float) -> str:
    return f"{settled(value)} >= {threshold!r}D"


def top_elements(
    explained: DataFrame, threshold: float | None = EP_THRESHOLD, top_k: int = TOP_K
) -> DataFrame:
    """The ``top_k`` elements per business line by explanatory power, dimensions pooled.

    ``threshold=None`` ranks all elements, as the rate metric does. The filter
    runs before the ranking, and Spark keeps only the top rows per partition.
    """
    ranked = W.partitionBy(*PARENT).orderBy(largest_first("ep"), "dim_idx", "element")
    kept = explained if threshold is None else explained.where(reaches("ep", threshold))
    return kept.withColumn("rank", F.row_number().over(ranked)).where(f"rank <= {top_k}")


def contributions(explained: DataFrame, parents: DataFrame) -> DataFrame:
    """Each element's part of its line's share gap and of the line's structure contribution.

    ``parents`` are structure rows of ``business.bu_rows``; other columns of
    theirs are dropped. Both sides are aggregates of at most one row per line
    and element.
    """
    above = parents.selectExpr(
        *PARENT, "total_gap", "actual - pred AS parent_gap", "cts AS parent_ctb"
    )
    part = ratio("(actual - pred)", "dim_gap")
    return explained.join(above, list(PARENT)).selectExpr(
        *explained.columns,
        "parent_gap",
        "actual - pred AS cta",
        f"{part} * parent_gap AS cts",
        f"{part} * parent_ctb AS ctb",
        f"{ratio(f'{part} * parent_ctb', 'total_gap')} AS ratio",
    )
