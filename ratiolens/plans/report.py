"""Report rows and plain-text conclusions from the drill-down's detail rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ratiolens.functions.scalar import filled, percent_text, positive, quoted
from ratiolens.operators.daily import aggregates
from ratiolens.plans import labels as L

TOP = 3
NUMBERS = ("actual", "pred", "cta", "cts", "ctb", "ratio")
LAYERS_BELOW = (L.LAYER_FIRST, L.LAYER_SECOND, L.LAYER_THIRD)


def report_rows(detail: DataFrame) -> DataFrame:
    return detail.selectExpr(
        "period",
        "usersource",
        "layer",
        "indicator",
        "element",
        *NUMBERS,
        "cast(NULL AS string) AS conclusion",
    )


def joined_text(order: str, text: str, condition: str, separator: str) -> str:
    """Aggregate: texts of the rows meeting ``condition``, in ``order``, with a separator."""
    collected = (
        f"collect_list(CASE WHEN {condition} AND {text} IS NOT NULL "
        f"THEN struct({order}, {text} AS text) END)"
    )
    texts = f"transform(array_sort({collected}), x -> x.text)"
    return f"array_join({texts}, {quoted(separator)})"


def group_texts(detail: DataFrame, target: str) -> DataFrame:
    """One conclusion text per group of siblings (per line in the structure layer).

    Only ranked rows are collected: at most three per group, and the short list
    of special scenes.
    """
    layer = {name: quoted(getattr(L, f"LAYER_{name}")) for name in (
        "TOTAL", "SPECIAL", "BU", "STRUCTURE", "FIRST", "SECOND", "THIRD"
    )}
    counter_group = f"CASE WHEN layer IN ({layer['SECOND']}, {layer['THIRD']}) THEN counter END"
    groups = detail.selectExpr(
        "*",
        f"CASE WHEN layer <> {layer['BU']} THEN line END AS line_group",
        f"{counter_group} AS counter_group",
        f"CASE WHEN layer <> {layer['BU']} THEN bu_rank END AS order_1",
        "counter_rank AS order_2",
        "code_rank AS order_3",
    ).groupBy(
        "period",
        "usersource",
        "layer",
        "line_group",
        "counter_group",
        "code",
        "order_1",
        "order_2",
        "order_3",
    )
    is_special = f"layer = {layer['SPECIAL']}"
    found = groups.agg(
        *aggregates(
            {
                "top": joined_text("rank", "piece", f"rank <= {TOP}", L.BETWEEN_PIECES),
                "next": joined_text(
                    "rank",
                    "next_piece",
                    f"rank <= {TOP} AND layer <> {layer['STRUCTURE']}",
                    L.BETWEEN_PIECES,
                ),
                "trend": f"max(CASE WHEN layer = {layer['STRUCTURE']} THEN next_piece END)",
                "positive": joined_text(
                    "rank", "piece", f"{is_special} AND {positive('ratio')}", L.BETWEEN_PIECES
                ),
                "positive_sum": f"coalesce(sum(CASE WHEN {positive('ratio')} THEN ratio END), 0D)",
                "best": "max(CASE WHEN rank = 1 THEN element END)",
                "best_ratio": "max(CASE WHEN rank = 1 THEN ratio END)",
                "total_actual": f"max(CASE WHEN layer = {layer['TOTAL']} THEN actual END)",
                "total_pred": f"max(CASE WHEN layer = {layer['TOTAL']} THEN pred END)",
            }
        )
    )
    explained = (
        f"CASE WHEN positive_sum < 0.5D THEN {quoted(L.TEXT_SPECIAL_WEAK)} ELSE "
        + filled(L.TEXT_SPECIAL_STRONG, elements="positive", sum=percent_text("positive_sum"))
        + " END"
    )
    group = {"line": "line_group", "counter": "counter_group", "layer": "layer"}
    group |= {"code": "code", "trend": "trend", "top": "top", "next": "next"}
    by_layer = {
        "TOTAL": filled(
            L.TEXT_TOTAL,
            target=quoted(L.TARGETS[target]),
            pred=percent_text("total_pred"),
            actual=percent_text("total_actual"),
            gap=percent_text("(total_actual - total_pred)"),
        ),
        "SPECIAL": filled(
            L.TEXT_SPECIAL,
            best="best",
            best_ratio=percent_text("best_ratio"),
            explained=explained,
        ),
        "BU": filled(L.TEXT_BU, **group),
        "STRUCTURE": filled(L.TEXT_STRUCTURE, **group),
        "FIRST": filled(L.TEXT_FIRST, **group),
        "SECOND": filled(L.TEXT_SECOND, **group),
        "THIRD": filled(L.TEXT_THIRD, **group),
    }
    cases = " ".join(f"WHEN {layer[name]} THEN {sql}" for name, sql in by_layer.items())
    text = f"CASE layer {cases} END AS text"
    return found.selectExpr(
        "period",
        "usersource",
        "layer",
        "line_group",
        "counter_group",
        "code",
        "coalesce(order_1, 0) AS order_1",
        "coalesce(order_2, 0) AS order_2",
        "coalesce(order_3, 0) AS order_3",
        text,
    )


def conclusion_rows(detail: DataFrame, day: str, target: str) -> DataFrame:
    """Text rows: one per layer of a source, per group in the levels below, and the summary."""
    texts = group_texts(detail, target)
    end, mark = quoted(L.CONCLUSION), quoted(L.PERMEABILITY_MARK)
    none = ["cast(NULL AS double) AS " + n for n in NUMBERS]
    below = texts.where(f"layer IN ({', '.join(quoted(x) for x in LAYERS_BELOW)})").selectExpr(
        "period",
        "usersource",
        "layer",
        f"""concat_ws('-', line_group, counter_group, code,
        CASE WHEN layer <> {quoted(L.LAYER_FIRST)} THEN {mark} END, {end}) AS indicator""",
        f"{end} AS element",
        *none,
        "text AS conclusion",
    )
    order = "order_1, order_2, order_3"
    per_source = texts.groupBy("period", "usersource").agg(
        *aggregates(
            {
                "total": joined_text(order, "text", f"layer = {quoted(L.LAYER_TOTAL)}", ""),
                "special": joined_text(order, "text", f"layer = {quoted(L.LAYER_SPECIAL)}", ""),
                "bu": joined_text(order, "text", f"layer = {quoted(L.LAYER_BU)}", ""),
                "structure": joined_text(
                    order, "text", f"layer = {quoted(L.LAYER_STRUCTURE)}", L.BETWEEN_LINES
                ),
                "first": _indented(order, L.LAYER_FIRST),
                "second": _indented(order, L.LAYER_SECOND),
                "third": _indented(order, L.LAYER_THIRD),
            }
        )
    )
    paragraphs = [
        filled(L.SUMMARY_HEAD, day=quoted(day), period="period", target=quoted(target)),
        "total",
        filled(L.SUMMARY_SPECIAL, text="special"),
        filled(L.SUMMARY_BU, text="bu"),
        filled(L.SUMMARY_STRUCTURE, text="structure"),
        filled(L.SUMMARY_FIRST, text="first"),
        filled(L.SUMMARY_SECOND, text="second"),
        filled(L.SUMMARY_THIRD, text="third"),
    ]
    summary = f"concat_ws({quoted(L.BETWEEN_PARAGRAPHS)}, {', '.join(paragraphs)})"
    rows = ", ".join(
        f"struct({quoted(layer)} AS layer, {text} AS conclusion)"
        for layer, text in (
            (L.LAYER_TOTAL, "total"),
            (L.LAYER_SPECIAL, "special"),
            (L.LAYER_BU, "bu"),
            (L.LAYER_STRUCTURE, "structure"),
            (L.CONCLUSION, summary),
        )
    )
    upper = per_source.selectExpr("period", "usersource", f"inline(array({rows}))").selectExpr(
        "period",
        "usersource",
        "layer",
        f"{end} AS indicator",
        f"{end} AS element",
        *none,
        "conclusion",
    )
    return below.unionByName(upper)


def _indented(order: str, layer: str) -> str:
    return joined_text(order, f"concat({quoted(L.INDENT)}, text)", f"layer = {quoted(layer)}", "\n")
