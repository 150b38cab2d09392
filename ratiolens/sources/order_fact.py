"""A KPI fact table derived from order tables: one fact row per line item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratiolens.codes import ORDER_CODES
from ratiolens.functions.scalar import quoted, quoted_list
from ratiolens.sources.fact import check_lookback

# The columns read, with their types: naming them spares a footer-reading job per table.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double, "
        "l_discount double, l_returnflag string, l_linestatus string"
    ),
}
OWN_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE")


def order_fact(
    spark: SparkSession, folder: str, windows: list[tuple[str, int]] | None = None
) -> DataFrame:
    """Fact rows of the order tables in ``folder``.

    ``windows`` are the (day, lookback) pairs a later step reads; they are also
    put on the raw order timestamp, where the parquet reader can skip row groups
    (a predicate on the derived date would not reach it). Orders are cut to
    those dates and widened with their small dimensions before they meet the
    line items, so the one large join shuffles narrow rows. No side is hinted:
    the optimizer broadcasts by measured size, and splits skewed keys otherwise.
    """
    read = lambda name: spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")
    orders = read("orders")
    if windows:
        orders = orders.where(" OR ".join(_raw_range(*w) for w in windows))
    places = read("nation").join(read("region"), F.expr("n_regionkey = r_regionkey"))
    buyers = read("customer").join(places, F.expr("c_nationkey = n_nationkey"))
    orders = orders.join(buyers, F.expr("o_custkey = c_custkey"))
    lines = read("lineitem").join(orders, F.expr("l_orderkey = o_orderkey"))
    return lines.selectExpr(
        "*",
        f"c_mktsegment IN ({quoted_list(OWN_SEGMENTS)}) AS own",
        "l_extendedprice * (1 - l_discount) AS net",
    ).selectExpr(*[f"{sql} AS {name}" for name, sql in _fact_columns().items()])


def _raw_range(day: str, back: int) -> str:
    """Both year windows as a predicate on the stored timestamp."""
    check_lookback(back)
    ends = (f"DATE'{day}'", f"add_months(DATE'{day}', -12)")
    return " OR ".join(
        f"(o_orderdate >= cast(date_sub({end}, {back}) AS timestamp_ntz)"
        f" AND o_orderdate < cast(date_add({end}, 1) AS timestamp_ntz))"
        for end in ends
    )


def _fact_columns() -> dict[str, str]:
    c = ORDER_CODES
    q = quoted
    card_label = (
        f"CASE l_linenumber WHEN 1 THEN {q(c.nocard_bind)} WHEN 2 THEN {q(c.nocard_nobind)} "
        f"WHEN 3 THEN {q(c.havecard_bind)} WHEN 4 THEN {q(c.havecard_default)} "
        f"WHEN 5 THEN {q(c.havecard_change)} ELSE {q(c.havecard_other)} END"
    )
    credit_label = (
        f"CASE l_linenumber % 3 WHEN 0 THEN {q(c.noact_new)} WHEN 1 THEN {q(c.noact_other)} "
        f"ELSE {q(c.activated)} END"
    )
    by_parity = "CASE WHEN l_linenumber % 2 = 1 THEN {} ELSE {} END".format
    entries = "1 + l_partkey % 2"
    return {
        "label_period": "cast(o_orderdate AS date)",
        "d": "cast(o_orderdate AS date)",
        "period": q(c.day),
        "usersource": "CASE WHEN l_linestatus = 'O' THEN 'SRC_A' ELSE 'SRC_B' END",
        "bu": "r_name",
        "platform": "o_orderpriority",
        "paycategory": (
            f"CASE WHEN l_returnflag IN ('A', 'R') THEN {q(c.high_rate_card)} "
            f"ELSE {by_parity(q(c.channels[0]), q(c.channels[1]))} END"
        ),
        "new_post_flag": (
            f"CASE o_orderstatus WHEN 'P' THEN {q(c.prepay)} WHEN 'F' THEN {q(c.quick)} "
            f"WHEN 'O' THEN {q(c.postpay)} END"
        ),
        "paytype": (
            f"CASE c_mktsegment WHEN 'AUTOMOBILE' THEN {q(c.card)} "
            f"WHEN 'BUILDING' THEN {q(c.credit_line)} WHEN 'FURNITURE' THEN {q(c.other_own)} "
            f"ELSE 'not_own' END"
        ),
        "label_a": (
            f"CASE WHEN o_orderstatus = 'F' THEN {by_parity(q(c.quick_new), q(c.quick_old))} "
            f"WHEN o_orderstatus = 'O' THEN {by_parity(q(c.post_new), q(c.post_old))} "
            f"WHEN c_mktsegment = 'AUTOMOBILE' THEN {card_label} "
            f"WHEN c_mktsegment = 'BUILDING' THEN {credit_label} ELSE 'other' END"
        ),
        "amt": "net",
        "self_amt": "CASE WHEN own THEN net ELSE 0D END",
        "self_amt_payonly": "CASE WHEN own THEN l_extendedprice ELSE 0D END",
        "self_amt_refund": "CASE WHEN own THEN net - l_extendedprice ELSE 0D END",
        "amt_payonly": "l_extendedprice",
        "cnt_payonly": "1L",
        "self_cnt_payonly": "CASE WHEN own THEN 1L ELSE 0L END",
        "card_cnt": entries,
        "nqh_cnt": entries,
        "quickpay_haveself_cnt_payonly": (
            "CASE WHEN own OR l_partkey % 3 = 0 THEN 1L ELSE 0L END"
        ),
    }
