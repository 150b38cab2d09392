"""Run 3: root cause of the overall gap, from business lines down to page steps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratiolens.codes import Codes
from ratiolens.functions.scalar import (
    filled,
    gap,
    percent_text,
    positive,
    quoted,
    quoted_list,
    ratio,
)
from ratiolens.operators import adtributor, business, permeability, special
from ratiolens.operators.baseline import (
    TOTAL_LEVEL,
    finest_dims,
    level_baseline,
    level_name,
    lookbacks,
)
from ratiolens.operators.daily import funnel_measures, kpi_measures, special_measures
from ratiolens.operators.ranking import largest_first
from ratiolens.plans import labels as L
from ratiolens.plans.report import conclusion_rows, report_rows
from ratiolens.sources.fact import DIMENSIONS, compact, paired_windows
from ratiolens.sources.staging import stage

TOP = 3
#: Prefix of the scenes' measures beside those of the lines.
SCENE = "scene_"

# One long frame carries every layer's rows. Besides the reported values it has
# the row's place in the drill-down (line, counter, code), its rank among its
# siblings, the ranks of its chosen ancestors, and its pieces of conclusion text.
DETAIL_COLUMNS = (
    "period",
    "usersource",
    "layer",
    "indicator",
    "element",
    "actual",
    "pred",
    "cta",
    "cts",
    "ctb",
    "ratio",
    "line",
    "counter",
    "code",
    "bu_rank",
    "counter_rank",
    "code_rank",
    "rank",
    "piece",
    "next_piece",
)


def analyse(
    fact: DataFrame,
    day: str,
    codes: Codes,
    periods: tuple[str, ...] | None = None,
    target: str = "self_rt",
    bu_text: str = "ratio",
) -> DataFrame:
    """The analysis table of ``day`` for all sources and the given periods.

    The fact table is read once, into a staged table of daily sums per dimension
    combination. Lines are compared and picked on two measures first; only rows of
    picked lines are read again for what lies below them. ``bu_text`` picks the number shown in the business-line text:
    the contribution ``ratio``, or the element's ``pred``.
    """
    if target not in L.TARGETS:
        raise ValueError(f"target must be one of {', '.join(L.TARGETS)}")
    detail = stage(drill_down(fact, day, codes, periods, bu_text), "detail")
    rows = report_rows(detail).unionByName(conclusion_rows(detail, day, target))
    return rows.selectExpr(
        f"{quoted(day)} AS Date",
        "period AS Period",
        f"{quoted(target)} AS Target",
        "usersource AS Usersource",
        "layer AS Layer",
        "indicator AS Indicator",
        "element AS Element",
        "actual AS Actual",
        "pred AS Pred",
        "cta AS CTA",
        "cts AS CTS",
        "ctb AS CTB",
        "ratio AS CTBRatio",
        "conclusion AS Conclusion",
        f"{quoted(day)} AS d",
    )


def drill_down(
    fact: DataFrame,
    day: str,
    codes: Codes,
    periods: tuple[str, ...] | None = None,
    bu_text: str = "ratio",
) -> DataFrame:
    """The detail rows of every layer, limited to the branches the drill-down chooses."""
    periods = periods or codes.periods
    back = max(lookbacks(codes)[p] for p in periods)
    base = stage(compact(paired_windows(fact, day, back, codes), DIMENSIONS), "base")

    # One pass gives the baselines of totals, lines and scenes; a second one those of the
    # picked lines, which are three per source at most: only their rows of the base are
    # read again, for the funnel that the tree starts from and for the leaves.
    kpi = kpi_measures(codes)
    upper = stage(
        level_baseline(
            base,
            day,
            codes,
            [*business.LEVELS, *special.LEVELS[1:]],
            kpi | {f"{SCENE}{n}": sql for n, sql in special_measures().items()},
            periods,
        ),
        "upper",
    )
    lines = _of_levels(upper, business.LEVELS, kpi)
    scenes = special.special_scenes(
        _of_levels(upper, special.LEVELS, special_measures(), SCENE), codes
    )
    split = stage(business.bu_split(lines), "split")
    picks = stage(top_lines(split), "picks")
    deep = level_baseline(
        below(base, picks.where(positive("ratio"))),
        day,
        codes,
        [*business.LEVELS[1:], *adtributor.LEAF],
        funnel_measures(codes),
        periods,
    )
    deep = stage(deep, "deep")
    funnel = _of_levels(deep, business.LEVELS[1:], funnel_measures(codes))
    leaves = _of_levels(deep, adtributor.LEAF, kpi)
    chosen = stage(chosen_lines(split, picks, funnel), "chosen")
    parts = [
        total_detail(lines),
        special_detail(scenes),
        bu_detail(split, picks, bu_text),
        permeability_detail(chosen, codes),
        structure_detail(leaves, picks),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select(
        *DETAIL_COLUMNS
    )


def _of_levels(
    base: DataFrame, levels: list[tuple[str, ...]], measures: dict[str, str], prefix: str = ""
) -> DataFrame:
    """The rows of ``base`` at the given levels, with those measures, under their own names."""
    names = quoted_list([level_name(dims) for dims in levels])
    columns = ["period", "usersource", "level", *finest_dims(levels), "n_cur", "n_prev"]
    return base.where(f"level IN ({names})").selectExpr(
        *columns, *[f"{tag}_{prefix}{n} AS {tag}_{n}" for n in measures for tag in ("a", "p")]
    )


def total_detail(lines: DataFrame) -> DataFrame:
    actual, pred = ratio("a_self_amt", "a_amt"), ratio("p_self_amt", "p_amt")
    total_gap = gap(actual, pred)
    return lines.where(f"level = '{TOTAL_LEVEL}'").selectExpr(
        "period",
        "usersource",
        f"{quoted(L.LAYER_TOTAL)} AS layer",
        f"{quoted(L.LAYER_TOTAL)} AS indicator",
        f"{quoted(L.LAYER_TOTAL)} AS element",
        f"{actual} AS actual",
        f"{pred} AS pred",
        f"{total_gap} AS cta",
        f"{total_gap} AS cts",
        f"{total_gap} AS ctb",
        "1D AS ratio",
    )


def special_detail(scenes: DataFrame) -> DataFrame:
    by_share = W.partitionBy("period", "usersource").orderBy(largest_first("ratio"), "idx")
    return (
        scenes.where(f"element <> '{special.ALL}'")
        .withColumn("rank", F.row_number().over(by_share))
        .selectExpr(
            "period",
            "usersource",
            f"{quoted(L.LAYER_SPECIAL)} AS layer",
            "indicator",
            "element",
            "actual",
            "pred",
            "gap AS cta",
            "gap AS cts",
            "gap AS ctb",
            "ratio",
            "rank",
            "element AS piece",
        )
    )


def top_lines(split: DataFrame) -> DataFrame:
    """The top 3 of all lines and both indicators of a source, with their ``bu_rank``.

    Spark cuts each partition to its own top 3 before the ranking shuffle, so a
    source with very many lines sends few rows.
    """
    by_ratio = W.partitionBy("period", "usersource").orderBy(largest_first("ratio"), "idx", "bu")
    return (
        business.bu_rows(split)
        .selectExpr("*", f"{ratio('cts', 'total_gap')} AS ratio")
        .withColumn("bu_rank", F.row_number().over(by_ratio))
        .where(f"bu_rank <= {TOP}")
    )


def picked(picks: DataFrame, indicator: str) -> DataFrame:
    """The positive ones of the top lines that owe their place to ``indicator``."""
    return picks.where(f"{positive('ratio')} AND indicator = {quoted(indicator)}")


def below(base: DataFrame, picks: DataFrame) -> DataFrame:
    """The rows of ``base`` that belong to picked lines, of whichever period."""
    return base.join(picks.select("usersource", "bu"), ["usersource", "bu"], "left_semi")


def chosen_lines(split: DataFrame, picks: DataFrame, funnel: DataFrame) -> DataFrame:
    """Lines to drill into for their permeability: split, rank and funnel measures."""
    parent = list(permeability.KEYS)
    ranks = picked(picks, business.PERMEABILITY).select(*parent, "bu_rank")
    new = [c for c in funnel.columns if c not in split.columns]
    return split.join(ranks, parent).join(funnel.select(*parent, *new), parent)


def bu_detail(split: DataFrame, picks: DataFrame, bu_text: str = "ratio") -> DataFrame:
    """Both indicators of every line; the top 3 carry a rank and a piece of text."""
    if bu_text not in ("ratio", "pred"):
        raise ValueError("bu_text must be 'ratio' or 'pred'")
    keys = [*permeability.KEYS, "indicator"]
    ranks = picks.selectExpr(*keys, "bu_rank AS rank")
    shown = percent_text("pred" if bu_text == "pred" else f"({ratio('cts', 'total_gap')})")
    return business.bu_rows(split).join(ranks, keys, "left").selectExpr(
        "period",
        "usersource",
        f"{quoted(L.LAYER_BU)} AS layer",
        "indicator",
        "bu AS element",
        "actual",
        "pred",
        "actual - pred AS cta",
        "cts",
        "cts AS ctb",
        f"{ratio('cts', 'total_gap')} AS ratio",
        "bu AS line",
        "rank",
        f"{filled(L.PIECE_INDICATOR, element='bu', indicator='indicator', value=shown)} AS piece",
    )


def permeability_nodes(lines: DataFrame, codes: Codes) -> DataFrame:
    """Rows of the three permeability levels of the given lines, all branches.

    A line is one row whatever its size in the fact table, so its whole tree is
    computed column-wise; choosing branches is left to the ranks.
    """
    counters = permeability.counter_split(lines)
    second = {c: permeability.second_level(counters, c) for c in permeability.COUNTERS}
    first = permeability.with_contributions(permeability.counter_rows(counters, codes))
    parts = [_level(first.withColumn("counter", F.col("element")), L.LAYER_FIRST)]
    for counter, frame in second.items():
        rows = _factor_rows(
            frame,
            permeability.second_model(counter),
            getattr(codes, counter),
            None,
            L.SECOND_LABELS,
        )
        parts.append(_level(rows, L.LAYER_SECOND))
    for code, model in permeability.third_models().items():
        counter = permeability.THIRD_COUNTER[code]
        frame = permeability.third_level(second[counter], code)
        rows = _factor_rows(frame, model, getattr(codes, counter), code, L.THIRD_LABELS)
        parts.append(_level(rows, L.LAYER_THIRD))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _factor_rows(*args) -> DataFrame:
    return permeability.with_contributions(permeability.factor_rows(*args))


def _level(rows: DataFrame, layer: str) -> DataFrame:
    return rows.selectExpr(
        "period",
        "usersource",
        f"{quoted(layer)} AS layer",
        "bu AS line",
        "bu_rank",
        *[c for c in ("counter", "code") if c in rows.columns],
        *["indicator", "element", "factor", "idx"],
        *["actual", "pred", "cta", "cts", "ctb", "ratio"],
    )


def choose_branches(nodes: DataFrame) -> DataFrame:
    """Rank siblings and keep the branches below chosen parents.

    Chosen are the permeability ones of a line's top 3 counter factors, and the
    splittable ones of a counter's top 3 factors. Every window's partition
    contains the line, so one exchange serves ranking and choosing.
    """
    line = ["period", "usersource", "line"]
    below = f"CASE WHEN layer <> {quoted(L.LAYER_FIRST)} THEN counter END"
    siblings = W.partitionBy(*line, "layer", F.expr(below), "code")
    ranked = nodes.repartition(*line).withColumn(
        "rank", F.row_number().over(siblings.orderBy(largest_first("ratio"), "idx"))
    )
    permeable = f"indicator = {quoted(business.PERMEABILITY)} AND rank <= {TOP}"
    splittable = quoted_list(list(permeability.third_models()))
    chosen = {
        "counter_rank": (
            f"CASE WHEN layer = {quoted(L.LAYER_FIRST)} AND {permeable} THEN rank END",
            "counter",
        ),
        "code_rank": (
            f"CASE WHEN layer = {quoted(L.LAYER_SECOND)} AND rank <= {TOP} "
            f"AND factor IN ({splittable}) THEN rank END",
            "counter, coalesce(code, factor)",
        ),
    }
    placed = ranked.selectExpr(
        "*",
        *[
            f"max({pick}) OVER (PARTITION BY {', '.join(line)}, {by}) AS {n}"
            for n, (pick, by) in chosen.items()
        ],
    )
    return placed.where(
        f"""CASE layer WHEN {quoted(L.LAYER_FIRST)} THEN true
        WHEN {quoted(L.LAYER_SECOND)} THEN counter_rank IS NOT NULL
        ELSE counter_rank IS NOT NULL AND code_rank IS NOT NULL END"""
    )


def permeability_detail(chosen: DataFrame, codes: Codes) -> DataFrame:
    """The chosen branches with their report names and text pieces."""
    nodes = choose_branches(permeability_nodes(chosen, codes))
    names = " ".join(
        f"WHEN {quoted(c)} THEN {quoted(L.SECOND_LABELS[c])}" for c in permeability.third_models()
    )
    labelled = f"CASE code {names} END"
    first, second, third = (
        quoted(layer) for layer in (L.LAYER_FIRST, L.LAYER_SECOND, L.LAYER_THIRD)
    )
    splittable = quoted_list(list(permeability.third_models()))
    value = percent_text("ratio")
    indicator_piece = filled(
        L.PIECE_INDICATOR, element="element", indicator="indicator", value=value
    )
    factor_piece = filled(L.PIECE_FACTOR, element="element", value=value)
    return nodes.selectExpr(
        "period",
        "usersource",
        "layer",
        f"""CASE layer WHEN {first} THEN concat(line, '-', indicator)
        WHEN {second} THEN concat(line, '-', counter)
        ELSE concat(line, '-', counter, '-', {labelled}) END AS indicator""",
        "element",
        *["actual", "pred", "cta", "cts", "ctb", "ratio", "line", "counter"],
        f"{labelled} AS code",
        "bu_rank",
        f"CASE WHEN layer <> {first} THEN counter_rank END AS counter_rank",
        f"CASE WHEN layer = {third} THEN code_rank END AS code_rank",
        "rank",
        f"CASE WHEN layer = {first} THEN {indicator_piece} ELSE {factor_piece} END AS piece",
        f"""CASE WHEN layer = {first} AND indicator = {quoted(business.PERMEABILITY)}
        THEN {filled(L.NEXT_FIRST, line='line', element='element', indicator='indicator')}
        WHEN layer = {second} AND factor IN ({splittable})
        THEN {filled(L.NEXT_SECOND, line='line', counter='counter', element='element')}
        END AS next_piece""",
    )


def structure_detail(leaves: DataFrame, picks: DataFrame) -> DataFrame:
    """Dimension elements of the chosen lines, ranked by explanatory power.

    ``leaves`` are those of the picked lines; the join leaves the periods in which
    a line was picked.
    """
    parent = list(adtributor.PARENT)
    shares = picked(picks, business.STRUCTURE)
    chosen = leaves.join(shares.select(*parent, "bu_rank"), parent)
    explained = adtributor.explain_additive(chosen, carry=("bu_rank",))
    rows = adtributor.contributions(explained, shares)
    eligible = adtributor.reaches("ep", adtributor.EP_THRESHOLD)
    by_ep = W.partitionBy(*adtributor.PARENT, F.expr(eligible)).orderBy(
        largest_first("ep"), "dim_idx", "element"
    )
    dim = "CASE dim " + " ".join(
        f"WHEN {quoted(d)} THEN {quoted(label)}" for d, label in L.DIM_LABELS.items()
    ) + " END"
    piece = filled(L.PIECE_STRUCTURE, element="element", dim=dim, value=percent_text("ep"))
    return rows.withColumn("position", F.row_number().over(by_ep)).selectExpr(
        "period",
        "usersource",
        f"{quoted(L.LAYER_STRUCTURE)} AS layer",
        "concat(bu, '-', dim) AS indicator",
        "element",
        "actual",
        "pred",
        *["cta", "cts", "ctb", "ratio"],
        "bu AS line",
        "bu_rank",
        f"CASE WHEN {eligible} THEN position END AS rank",
        f"{piece} AS piece",
        f"CASE WHEN parent_gap < 0 THEN {quoted(L.TREND_DOWN)} ELSE {quoted(L.TREND_UP)} END "
        "AS next_piece",
    )
