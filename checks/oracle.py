"""DuckDB SQL for the registered queries, written independently of the Spark operators.

Every statement starts from the raw order tables. Shared parts are plain CTE
texts; ``with_`` strings them together.
"""

from __future__ import annotations

DAY = "2000-06-13"
LAST = f"DATE '{DAY}'"
LAST_PREV = "DATE '1999-06-13'"

ORACLES: dict[str, str] = {}


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def r6(x: str) -> str:
    """Six places; the nudge keeps means and quotients off exact rounding ties."""
    return f"(round({x} + 0.0000000317, 6) + 0.0)"


def fine(x: str) -> str:
    """Twelve places near zero."""
    return (
        f"(CASE WHEN abs({x}) < 1e-4 THEN round(({x}) * 1000000 + 0.0000000317, 6) / 1000000 "
        f"ELSE {r6(x)} END + 0.0)"
    )


def r4(x: str) -> str:
    """Four places, nudged likewise."""
    return f"(round({x} + 0.00000317, 4) + 0.0)"


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif(({b}), 0))"


def gap(a: str, b: str) -> str:
    """a - b; 0 where they differ by rounding noise only."""
    return f"(CASE WHEN abs({a} - {b}) <= 1e-12 * (abs({a}) + abs({b})) THEN 0.0 ELSE {a} - {b} END)"


def z0(x: str) -> str:
    return f"coalesce({x}, 0.0)"


def names(columns: list[str], fn) -> str:
    return ", ".join(f"{fn(c)} AS {c}" for c in columns)


def r6s(columns: list[str]) -> str:
    return names(columns, r6)


def r4s(columns: list[str]) -> str:
    return names(columns, r4)


def ints(columns: list[str]) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)


FACT = """raw AS (
  SELECT l.*, o.*, c.c_mktsegment, r.r_name,
    c.c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') AS own,
    l.l_extendedprice * (1 - l.l_discount) AS net
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
), fact AS (
  SELECT CAST(o_orderdate AS DATE) AS label_period, CAST(o_orderdate AS DATE) AS d, 'D' AS period,
    CASE l_linestatus WHEN 'O' THEN 'SRC_A' ELSE 'SRC_B' END AS usersource,
    r_name AS bu, o_orderpriority AS platform,
    CASE WHEN l_returnflag <> 'N' THEN 'high_rate_card'
         WHEN l_linenumber % 2 = 1 THEN 'chan_1' ELSE 'chan_2' END AS paycategory,
    CASE o_orderstatus WHEN 'P' THEN 'prepay' WHEN 'F' THEN 'quick'
         WHEN 'O' THEN 'postpay' END AS new_post_flag,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'card' WHEN 'BUILDING' THEN 'credit_line'
         WHEN 'FURNITURE' THEN 'other_own' ELSE 'not_own' END AS paytype,
    CASE WHEN o_orderstatus = 'F' AND l_linenumber % 2 = 1 THEN 'quick_new'
         WHEN o_orderstatus = 'F' THEN 'quick_old'
         WHEN o_orderstatus = 'O' AND l_linenumber % 2 = 1 THEN 'post_new'
         WHEN o_orderstatus = 'O' THEN 'post_old'
         WHEN c_mktsegment = 'AUTOMOBILE' THEN CASE l_linenumber WHEN 1 THEN 'nocard_bind'
           WHEN 2 THEN 'nocard_nobind' WHEN 3 THEN 'havecard_bind' WHEN 4 THEN 'havecard_default'
           WHEN 5 THEN 'havecard_change' ELSE 'havecard_other' END
         WHEN c_mktsegment = 'BUILDING' THEN CASE l_linenumber % 3 WHEN 0 THEN 'noact_new'
           WHEN 1 THEN 'noact_other' ELSE 'activated' END
         ELSE 'other' END AS label_a,
    net AS amt, CASE WHEN own THEN net ELSE 0.0 END AS self_amt,
    CASE WHEN own THEN l_extendedprice ELSE 0.0 END AS self_amt_payonly,
    CASE WHEN own THEN net - l_extendedprice ELSE 0.0 END AS self_amt_refund,
    l_extendedprice AS amt_payonly, 1 AS cnt_payonly,
    CASE WHEN own THEN 1 ELSE 0 END AS self_cnt_payonly,
    1 + l_partkey % 2 AS card_cnt, 1 + l_partkey % 2 AS nqh_cnt,
    CASE WHEN own OR l_partkey % 3 = 0 THEN 1 ELSE 0 END AS quickpay_haveself_cnt_payonly
  FROM raw
)"""


def windows(back: int, last: str = LAST, last_prev: str = LAST_PREV, name: str = "win") -> str:
    return f"""{name} AS (
  SELECT *, 'cur' AS side FROM fact WHERE d BETWEEN {last} - {back} AND {last}
  UNION ALL
  SELECT *, 'prev' AS side FROM fact WHERE d BETWEEN {last_prev} - {back} AND {last_prev}
)"""


KPI = {
    "amt": "sum(amt)",
    "self_amt": "sum(self_amt)",
    "highRate_amt": "sum(self_amt) FILTER (WHERE paycategory = 'high_rate_card')",
}
SPECIAL = {
    n: f"coalesce(sum({n}), 0)"
    for n in ("amt", "self_amt", "self_amt_payonly", "self_amt_refund")
}


def when(condition: str, value: str) -> str:
    return f"sum(CASE WHEN {condition} THEN {value} ELSE 0 END)"


COUNTER = {}
SECOND = {}
for c in ("prepay", "quick", "postpay"):
    at = f"new_post_flag = '{c}'"
    COUNTER[f"{c}_amt"] = when(at, "amt")
    COUNTER[f"{c}_self_amt"] = when(at, "self_amt")
    SECOND[f"{c}_amt"] = when(at, "amt")
    SECOND[f"{c}_refund"] = when(at, "self_amt_payonly - self_amt")
    SECOND[f"{c}_cnt"] = when(at, "cnt_payonly")
for g, p in (("card", "card"), ("credit", "credit_line"), ("other", "other_own")):
    here = f"new_post_flag = 'prepay' AND paytype = '{p}'"
    SECOND[f"prepay_{g}_cnt"] = when(here, "cnt_payonly")
    SECOND[f"prepay_{g}_paid"] = when(here, "amt_payonly")
for c, short in (("quick", "quick"), ("postpay", "post")):
    for g in ("new", "old"):
        here = f"new_post_flag = '{c}' AND label_a = '{short}_{g}'"
        SECOND[f"{c}_{g}_cnt"] = when(here, "cnt_payonly")
        SECOND[f"{c}_{g}_own_cnt"] = when(here, "self_cnt_payonly")
        SECOND[f"{c}_{g}_own_paid"] = when(here, "self_amt_payonly")
_CARD = "new_post_flag = 'prepay' AND paytype = 'card'"
_CREDIT = "new_post_flag = 'prepay' AND paytype = 'credit_line'"
_NEW = "new_post_flag = 'quick' AND label_a = 'quick_new'"
THIRD = {
    "nocard_entry": when(_CARD + " AND label_a LIKE 'nocard%'", "card_cnt"),
    "havecard_entry": when(_CARD + " AND label_a LIKE 'havecard%'", "card_cnt"),
}
for s in ("nocard_bind", "havecard_default", "havecard_change", "havecard_bind"):
    THIRD[f"{s}_entry"] = when(f"{_CARD} AND label_a = '{s}'", "card_cnt")
    THIRD[f"{s}_submit"] = when(f"{_CARD} AND label_a = '{s}'", "cnt_payonly")
THIRD |= {
    "inactive_entry": when(_CREDIT + " AND label_a LIKE 'noact%'", "nqh_cnt"),
    "inactive_submit": when(_CREDIT + " AND label_a = 'noact_new'", "cnt_payonly"),
    "active_entry": when(_CREDIT + " AND label_a = 'activated'", "nqh_cnt"),
    "active_submit": when(_CREDIT + " AND label_a = 'activated'", "cnt_payonly"),
    "quicknew_cnt": when(_NEW, "cnt_payonly"),
    "quicknew_haveown_cnt": when(_NEW, "quickpay_haveself_cnt_payonly"),
    "quicknew_own_cnt": when(_NEW, "self_cnt_payonly"),
}


def sums(measures: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {n}" for n, sql in measures.items())


def daily(dims: list[str], measures: dict[str, str], name: str = "daily", src: str = "win") -> str:
    keys = ", ".join(["side", "usersource", *dims, "label_period"])
    return f"{name} AS (SELECT {keys}, {sums(measures)} FROM {src} GROUP BY {keys})"


def _daily_oracle(dims: list[str], measures: dict, back: int, counts: list[str] = ()) -> str:
    amounts = [m for m in measures if m not in counts]
    shown = ", ".join(["side", "usersource", "CAST(label_period AS VARCHAR) AS label_period", *dims])
    values = ", ".join(x for x in (r4s(amounts), ints(list(counts))) if x)
    return with_(
        FACT, windows(back), daily(dims, measures), select=f"SELECT {shown}, {values} FROM daily"
    )


LEAF_DIMS = ["bu", "platform", "paycategory", "new_post_flag"]
ORACLES["daily_kpi"] = _daily_oracle([], KPI, 295)
ORACLES["special_daily"] = _daily_oracle(["paycategory", "platform"], SPECIAL, 59)
ORACLES["bu_daily"] = _daily_oracle(["bu"], KPI, 59)
ORACLES["structure_daily"] = _daily_oracle(LEAF_DIMS, KPI, 59)
ORACLES["counter_daily"] = _daily_oracle(["bu"], COUNTER, 59)
ORACLES["sec_daily"] = _daily_oracle(
    ["bu"], SECOND, 59, [m for m in SECOND if m.endswith("_cnt")]
)
ORACLES["thd_daily"] = _daily_oracle(["bu"], THIRD, 59, list(THIRD))

_ALL_DIMS = "bu, platform, paycategory, new_post_flag, paytype, label_a"
_AMOUNTS = ["amt", "self_amt", "self_amt_payonly", "self_amt_refund", "amt_payonly"]
_COUNTS = [
    "cnt_payonly", "self_cnt_payonly", "card_cnt", "nqh_cnt", "quickpay_haveself_cnt_payonly",
]
ORACLES["base_rollup"] = with_(
    FACT,
    windows(59),
    select=f"""SELECT period, side, usersource, CAST(label_period AS VARCHAR) AS label_period,
  CAST(d AS VARCHAR) AS d, {_ALL_DIMS},
  {", ".join(f"{r4(f'sum({m})')} AS {m}" for m in _AMOUNTS)},
  {", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in _COUNTS)}
FROM win GROUP BY ALL""",
)

# ----------------------------------------------------------- bounds, detection

METRIC_NUM = {"self_rt": "self_amt", "highRate_rt": "highRate_amt"}

PAIRS = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY side, usersource ORDER BY label_period DESC) AS rk
  FROM daily
), pairs AS (
  SELECT a.usersource, a.label_period, b.label_period AS prev_label_period, a.rk,
    row_number() OVER (PARTITION BY a.usersource ORDER BY a.label_period) AS age,
    a.amt AS cur_amt, a.self_amt AS cur_self_amt, a.highRate_amt AS cur_highRate_amt,
    b.amt AS prev_amt, b.self_amt AS prev_self_amt, b.highRate_amt AS prev_highRate_amt
  FROM (SELECT * FROM ranked WHERE side = 'cur') a
  LEFT JOIN (SELECT * FROM ranked WHERE side = 'prev') b
    ON a.usersource = b.usersource AND a.rk = b.rk
)"""
_PAIR_AMOUNTS = [f"{s}_{n}" for s in ("cur", "prev") for n in KPI]
ORACLES["year_pair"] = with_(
    FACT,
    windows(299),
    daily([], KPI),
    PAIRS,
    select=f"""SELECT usersource, CAST(label_period AS VARCHAR) AS label_period,
  CAST(prev_label_period AS VARCHAR) AS prev_label_period,
  {r4s(_PAIR_AMOUNTS)}, {ints(['rk', 'age'])} FROM pairs""",
)

_ROLLED = [f"{n}_{k}" for k in (7, 30) for n in _PAIR_AMOUNTS]
ROLLED = (
    "rolled AS (SELECT *, "
    + ", ".join(
        f"sum({n}) OVER (PARTITION BY usersource ORDER BY label_period DESC "
        f"ROWS BETWEEN CURRENT ROW AND {k - 1} FOLLOWING) AS {n}_{k}"
        for k in (7, 30)
        for n in _PAIR_AMOUNTS
    )
    + " FROM pairs)"
)
ORACLES["rolling_7_30"] = with_(
    FACT,
    windows(299),
    daily([], KPI),
    PAIRS,
    ROLLED,
    select="SELECT usersource, CAST(label_period AS VARCHAR) AS label_period, "
    + r4s(_ROLLED)
    + " FROM rolled",
)

_HORIZON = {"day": ("", 7, 1, "D"), "week": ("_7", 14, 7, "W"), "month": ("_30", 60, 30, "M")}


def horizon_cte(horizon: str) -> str:
    """The reported rows of one horizon: old rows are gone before windows look back."""
    tail, age, step, _ = _HORIZON[horizon]
    w = "PARTITION BY usersource ORDER BY label_period DESC"
    f = w + " ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING"
    rates, more = [], []
    for m, num in METRIC_NUM.items():
        for s in ("cur", "prev"):
            rates.append(f"{div(f'{s}_{num}{tail}', f'{s}_amt{tail}')} AS {m}_{s}")
            more.append(f"lead({m}_{s}, {step}) OVER ({w}) AS {m}_{s}_before")
            more.append(f"sum({m}_{s}) OVER ({f}) AS {m}_{s}_sum")
            more.append(f"avg({m}_{s}) OVER ({f}) AS {m}_{s}_mean")
    return f"""{horizon}_rates AS (
  SELECT usersource, label_period, {', '.join(rates)} FROM rolled WHERE age >= {age}
), {horizon}_rows AS (
  SELECT *, {', '.join(more)} FROM {horizon}_rates
)"""


def _lead_columns() -> str:
    out = []
    for m in METRIC_NUM:
        for h in _HORIZON:
            for s in ("cur", "prev"):
                out.append(f"{r6(f'{h}_rows.{m}_{s}')} AS {m}_{h}_{s}")
                out.append(f"{r6(f'{h}_rows.{m}_{s}_before')} AS {m}_{h}_{s}_before")
    return ", ".join(out)


ORACLES["qoq_leads"] = with_(
    FACT,
    windows(299),
    daily([], KPI),
    PAIRS,
    ROLLED,
    *[horizon_cte(h) for h in _HORIZON],
    select=f"""SELECT rolled.usersource, CAST(rolled.label_period AS VARCHAR) AS label_period,
  {_lead_columns()}
FROM rolled LEFT JOIN day_rows USING (usersource, label_period)
LEFT JOIN week_rows USING (usersource, label_period)
LEFT JOIN month_rows USING (usersource, label_period)""",
)


def sample_ctes(
    prefix: str = "", src: str = "daily", oldest: bool = False, learned: bool = False
) -> str:
    """Day, week and month samples per source and metric; ``learned``: days from the oldest on."""
    p = prefix
    direction = "" if oldest else "DESC"
    day_direction = "" if oldest or learned else "DESC"
    trailing = "PARTITION BY usersource, metric ORDER BY label_period ROWS BETWEEN {} PRECEDING AND CURRENT ROW"
    four = ("cur_num", "cur_amt", "prev_num", "prev_amt")

    def rolled(k: int, name: str) -> str:
        f = trailing.format(k - 1)
        w = "PARTITION BY usersource, metric ORDER BY label_period"
        totals = ", ".join(f"sum({c}) OVER ({f}) AS s_{c}" for c in four)
        whole = " AND ".join(f"count({c}) OVER ({f}) = {k}" for c in four)
        return f"""{p}{name}_sums AS (
  SELECT usersource, metric, label_period, {totals}, {whole} AS whole FROM {p}lpairs
), {p}{name}_rates AS (
  SELECT usersource, metric, label_period, {div('s_cur_num', 's_cur_amt')} AS c,
    {div('s_prev_num', 's_prev_amt')} AS q FROM {p}{name}_sums WHERE whole
), {p}{name}_changes AS (
  SELECT usersource, metric, label_period,
    {div('c', f'lag(c, {k}) OVER ({w})')} AS c_change, {div('q', f'lag(q, {k}) OVER ({w})')} AS q_change
  FROM {p}{name}_rates
)"""

    return f"""{p}long AS (
  SELECT side, usersource, label_period, 'self_rt' AS metric, self_amt AS num, amt FROM {src}
  UNION ALL
  SELECT side, usersource, label_period, 'highRate_rt', highRate_amt, amt FROM {src}
), {p}smooth AS (
  SELECT *, num / nullif(amt, 0) AS rt,
    avg(num / nullif(amt, 0)) OVER (PARTITION BY side, usersource, metric ORDER BY label_period
      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS mean7,
    count(num / nullif(amt, 0)) OVER (PARTITION BY side, usersource, metric ORDER BY label_period
      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS n7
  FROM {p}long
), {p}whole AS (
  SELECT *, rt / nullif(mean7, 0) AS t,
    row_number() OVER (PARTITION BY side, usersource, metric ORDER BY label_period {day_direction}) AS rk
  FROM {p}smooth WHERE n7 = 7
), {p}day_samples AS (
  SELECT a.usersource, a.metric, 'day' AS horizon, a.label_period, {div('a.t', 'b.t')} AS value
  FROM {p}whole a JOIN {p}whole b ON a.side = 'cur' AND b.side = 'prev'
    AND a.usersource = b.usersource AND a.metric = b.metric AND a.rk = b.rk
), {p}lranked AS (
  SELECT *, row_number() OVER (PARTITION BY side, usersource, metric
    ORDER BY label_period {direction}) AS rk FROM {p}long
), {p}lpairs AS (
  SELECT a.usersource, a.metric, a.label_period, a.num AS cur_num, a.amt AS cur_amt,
    b.num AS prev_num, b.amt AS prev_amt
  FROM (SELECT * FROM {p}lranked WHERE side = 'cur') a
  LEFT JOIN (SELECT * FROM {p}lranked WHERE side = 'prev') b
    ON a.usersource = b.usersource AND a.metric = b.metric AND a.rk = b.rk
), {rolled(7, 'week')}, {p}week_samples AS (
  SELECT usersource, metric, 'week' AS horizon, label_period, {div('c_change', 'q_change')} AS value
  FROM {p}week_changes
), {rolled(30, 'month')}, {p}month_samples AS (
  SELECT usersource, metric, 'month' AS horizon, label_period, c_change AS value
  FROM {p}month_changes
), {p}samples AS (
  SELECT * FROM {p}day_samples UNION ALL SELECT * FROM {p}week_samples
  UNION ALL SELECT * FROM {p}month_samples
)"""


def _sample_oracle(select_from: str, oldest: bool = False) -> str:
    return with_(
        FACT,
        windows(295),
        daily([], KPI),
        sample_ctes(oldest=oldest),
        select=f"""SELECT usersource, metric, horizon, CAST(label_period AS VARCHAR) AS label_period,
  {r6('value')} AS value FROM {select_from} WHERE value IS NOT NULL""",
    )


ORACLES["bounds_day"] = _sample_oracle("day_samples")
ORACLES["bounds_week"] = _sample_oracle("week_samples")
ORACLES["bounds_month"] = _sample_oracle("month_samples")
ORACLES["bounds_day_oldest"] = _sample_oracle("day_samples", oldest=True)
ORACLES["bounds_week_oldest"] = _sample_oracle("week_samples", oldest=True)
ORACLES["bounds_month_double"] = _sample_oracle(
    "(SELECT usersource, metric, 'month' AS horizon, label_period, "
    f"{div('c_change', 'q_change')} AS value FROM month_changes)"
)


def edges(value: str) -> tuple[str, str]:
    return (
        f"(round_even(avg({value}) - 2 * stddev_pop({value}), 4) + 0.0)",
        f"(round_even(avg({value}) + 2 * stddev_pop({value}), 4) + 0.0)",
    )


_B, _T = edges("value")
ORACLES["zscore_bounds"] = with_(
    FACT,
    windows(295),
    daily([], KPI),
    sample_ctes(),
    select=f"""SELECT usersource, metric, horizon, {_B} AS bottom, {_T} AS top
FROM samples WHERE value IS NOT NULL GROUP BY ALL""",
)


def bounds_cte(name: str, day: str, prefix: str = "", src: str = "daily") -> str:
    columns = []
    for m in METRIC_NUM:
        for h in _HORIZON:
            value = f"CASE WHEN s.metric = '{m}' AND s.horizon = '{h}' THEN s.value END"
            bottom, top = edges(value)
            columns += [f"{bottom} AS {m}_{h}_bottom", f"{top} AS {m}_{h}_top"]
    return f"""{name} AS (
  SELECT '{day}' AS "Date", u.usersource AS "Usersource", {', '.join(columns)}, '{day}' AS d
  FROM (SELECT DISTINCT usersource FROM {src} WHERE side = 'cur') u
  LEFT JOIN {prefix}samples s ON u.usersource = s.usersource GROUP BY u.usersource
)"""


ORACLES["bounds_table"] = with_(
    FACT,
    windows(295),
    daily([], KPI),
    sample_ctes(learned=True),
    bounds_cte("bounds", DAY),
    select="SELECT * FROM bounds",
)


def _earlier(day: str, name: str) -> list[str]:
    prev = "1999" + day[4:]
    return [
        windows(295, f"DATE '{day}'", f"DATE '{prev}'", f"{name}_win"),
        daily([], KPI, f"{name}_daily", f"{name}_win"),
        sample_ctes(f"{name}_", f"{name}_daily", learned=True),
        bounds_cte(f"{name}_bounds", day, f"{name}_", f"{name}_daily"),
    ]


ORACLES["latest_bounds"] = with_(
    FACT,
    *_earlier("2000-06-11", "newer"),
    *_earlier("2000-06-09", "older"),
    "saved AS (SELECT * FROM newer_bounds UNION ALL SELECT * FROM older_bounds)",
    select=f"""SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY "Usersource" ORDER BY d DESC) AS rk
  FROM saved WHERE d <= '{DAY}') WHERE rk = 1""",
)


def detect_cte(horizon: str) -> str:
    _, _, _, period = _HORIZON[horizon]
    out = []
    for m in METRIC_NUM:
        c, p = f"{m}_cur", f"{m}_prev"
        if horizon == "day":
            value = div(f"{c} * {p}_sum", f"{c}_sum * {p}")
            num, den = div(c, f"{c}_mean"), div(p, f"{p}_mean")
        else:
            value = div(f"{c} * {p}_before", f"{c}_before * {p}")
            num, den = div(c, f"{c}_before"), div(p, f"{p}_before")
        out += [
            f"{c} AS this_year_{m}",
            f"{div(c, f'{c}_before')} AS {m}_qoq",
            f"{div(c, p)} AS {m}_yoy",
            f"{value} AS {m}_qy_value",
            f"{m}_{horizon}_top AS {m}_top",
            f"{m}_{horizon}_bottom AS {m}_bottom",
            f"{num} AS {m}_qy_value_numerator",
            f"{den} AS {m}_qy_value_denominator",
        ]
    return f"""{horizon}_detect AS (
  SELECT label_period, usersource, '{period}' AS period, {', '.join(out)}
  FROM {horizon}_rows LEFT JOIN (SELECT * RENAME ("Usersource" AS source) FROM bounds)
    ON usersource = source
)"""


_DETECT = [
    x
    for m in METRIC_NUM
    for x in (
        f"this_year_{m}", f"{m}_qoq", f"{m}_yoy", f"{m}_qy_value", f"{m}_top", f"{m}_bottom",
        f"{m}_qy_value_numerator", f"{m}_qy_value_denominator",
    )
]
_DETECT_CTES = [
    FACT,
    windows(295, name="learn_win"),
    daily([], KPI, "learn_daily", "learn_win"),
    sample_ctes("learn_", "learn_daily", learned=True),
    bounds_cte("bounds", DAY, "learn_", "learn_daily"),
    windows(299),
    daily([], KPI),
    PAIRS,
    ROLLED,
]
for _h in _HORIZON:
    ORACLES[f"detect_{_h}"] = with_(
        *_DETECT_CTES,
        horizon_cte(_h),
        detect_cte(_h),
        select=f"""SELECT CAST(label_period AS VARCHAR) AS label_period, usersource, period,
  {r6s(_DETECT)} FROM {_h}_detect""",
    )
_FLAGS = ", ".join(
    f"CAST(CASE WHEN {m}_qy_value BETWEEN {m}_bottom AND {m}_top THEN 0 ELSE 1 END AS BIGINT) "
    f"AS {m}_flag"
    for m in METRIC_NUM
)
ORACLES["detect_flags"] = with_(
    *_DETECT_CTES,
    *[x for h in _HORIZON for x in (horizon_cte(h), detect_cte(h))],
    """detected AS (SELECT * FROM day_detect UNION ALL SELECT * FROM week_detect
  UNION ALL SELECT * FROM month_detect)""",
    select=f"""SELECT CAST(label_period AS VARCHAR) AS label_period, usersource, period,
  CAST(label_period AS VARCHAR) AS d, {r6s(_DETECT)}, {_FLAGS}
FROM detected WHERE label_period = {LAST}""",
)

_JUDGED = "2000-06-11"
ORACLES["saved_flags"] = with_(
    FACT,
    *_earlier(_JUDGED, "newer"),
    "bounds AS (SELECT * FROM newer_bounds)",
    windows(299),
    daily([], KPI),
    PAIRS,
    ROLLED,
    *[x for h in _HORIZON for x in (horizon_cte(h), detect_cte(h))],
    """detected AS (SELECT * FROM day_detect UNION ALL SELECT * FROM week_detect
  UNION ALL SELECT * FROM month_detect)""",
    select=f"""SELECT CAST(label_period AS VARCHAR) AS label_period, usersource, period,
  CAST(label_period AS VARCHAR) AS d, {r6s(_DETECT)}, {_FLAGS}
FROM detected WHERE label_period = {LAST}""",
)
ORACLES["saved_bounds"] = with_(
    FACT, *_earlier(_JUDGED, "newer"), select="SELECT * FROM newer_bounds"
)
ORACLES["merged_bounds"] = ORACLES["zscore_bounds"]
ORACLES["maintained_kpi"] = ORACLES["late_rows_kpi"] = _daily_oracle([], KPI, 59)
ORACLES["daily_kpi_long"] = _daily_oracle([], KPI, 400)
ORACLES["stored_fact_kpi"] = with_(
    FACT,
    """exact AS (SELECT * REPLACE (CAST(amt AS DECIMAL(18, 4)) AS amt,
    CAST(self_amt AS DECIMAL(18, 4)) AS self_amt) FROM fact)""",
    windows(59).replace("FROM fact", "FROM exact"),
    daily([], KPI),
    select=f"""SELECT side, usersource, CAST(label_period AS VARCHAR) AS label_period,
  {r4s(list(KPI))} FROM (SELECT * REPLACE (CAST(amt AS DOUBLE) AS amt,
  CAST(self_amt AS DOUBLE) AS self_amt, CAST(highRate_amt AS DOUBLE) AS highRate_amt) FROM daily)""",
)

# -------------------------------------------------------------------- baseline


def base(name: str, dims: list[str], measures: dict[str, str], src: str = "win") -> str:
    """Actual and expected values of every series at one dimension level."""
    keys = ", ".join(["period", "usersource", *dims])
    known = " AND ".join(f"{d} IS NOT NULL" for d in dims) or "TRUE"
    values = []
    for m in measures:
        tails, heads = {}, {}
        for s in ("cur", "prev"):
            tails[s] = f"avg({m}) FILTER (side = '{s}' AND rn > n - tail)"
            heads[s] = f"coalesce(sum({m}) FILTER (side = '{s}' AND rn <= coalesce(head, n - 1)), 0)"
        values.append(f"{tails['cur']} AS a_{m}")
        expected = f"{tails['prev']} * CAST({heads['cur']} AS DOUBLE) / nullif(CAST({heads['prev']} AS DOUBLE), 0)"
        values.append(f"CASE WHEN count(*) FILTER (side = 'cur') > 0 THEN {expected} END AS p_{m}")
    return f"""{name}_days AS (
  SELECT f.period, f.head, f.tail, side, usersource, {''.join(d + ', ' for d in dims)}label_period,
    {sums(measures)}
  FROM (SELECT * EXCLUDE (period) FROM {src}) w
  JOIN (VALUES ('D', 6, NULL, 1), ('W', 13, 7, 7), ('M', 59, 30, 30)) f(period, span, head, tail)
    ON w.d >= (CASE side WHEN 'cur' THEN {LAST} ELSE {LAST_PREV} END) - f.span
  WHERE {known}
  GROUP BY f.period, f.head, f.tail, side, usersource, {''.join(d + ', ' for d in dims)}label_period
), {name}_pos AS (
  SELECT *, row_number() OVER (PARTITION BY {keys}, side ORDER BY label_period) AS rn,
    count(*) OVER (PARTITION BY {keys}, side) AS n FROM {name}_days
), {name} AS (
  SELECT {keys}, count(*) FILTER (side = 'cur') AS n_cur, count(*) FILTER (side = 'prev') AS n_prev,
    {', '.join(values)}
  FROM {name}_pos GROUP BY {keys}
)"""


_BASE_VALUES = [f"{t}_{n}" for t in ("a", "p") for n in KPI]
for _name, _p in (("day", "D"), ("week", "W"), ("month", "M")):
    ORACLES[f"baseline_{_name}"] = with_(
        FACT,
        windows(59),
        base("tot", [], KPI),
        base("line", ["bu"], KPI),
        select=f"""SELECT period, usersource, 'total' AS level, NULL AS bu, {r4s(_BASE_VALUES)},
  {ints(['n_cur', 'n_prev'])} FROM tot WHERE period = '{_p}'
UNION ALL SELECT period, usersource, 'bu', bu, {r4s(_BASE_VALUES)}, {ints(['n_cur', 'n_prev'])}
FROM line WHERE period = '{_p}'""",
    )

ORACLES["indicator"] = with_(
    FACT,
    windows(59),
    base("tot", [], KPI),
    select=f"""SELECT period, usersource, {r6(div('a_self_amt', 'a_amt'))} AS actual,
  {r6(div('p_self_amt', 'p_amt'))} AS pred FROM tot""",
)

_CHANNELS = ["chan_1", "chan_2", "chan_missing"]
_PLATFORMS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "platform_missing"]


def _scene_cte(name: str, indicator: str, level: str, dim: str, elements: list[str], idx: int) -> str:
    listed = ", ".join(f"('{e}', {idx + i})" for i, e in enumerate(elements, 1))
    return f"""{name}_total AS (
  SELECT period, usersource, sum(a_amt) AS a_amt, sum(p_amt) AS p_amt,
    sum(a_self_amt) AS a_self, sum(p_self_amt) AS p_self FROM {level} GROUP BY ALL
), {name}_listed AS (
  SELECT t.period, t.usersource, e.element, e.idx,
    CASE WHEN coalesce(l.n_cur, 0) = 0 THEN 0.0 ELSE l.a_self_amt / nullif(t.a_amt, 0) END AS actual,
    CASE WHEN l.usersource IS NULL THEN 0.0
      ELSE l.p_self_amt / nullif(t.p_amt, 0) * (s.overall / nullif(t.p_self / nullif(t.p_amt, 0), 0))
      END AS pred
  FROM {name}_total t CROSS JOIN (VALUES {listed}) e(element, idx)
  JOIN shares s USING (period, usersource)
  LEFT JOIN {level} l ON l.period = t.period AND l.usersource = t.usersource AND l.{dim} = e.element
), {name} AS (
  SELECT period, usersource, '{indicator}' AS indicator, 'all' AS element, {idx} AS idx,
    a_self / nullif(a_amt, 0) AS actual, overall AS pred
  FROM {name}_total JOIN shares USING (period, usersource)
  UNION ALL SELECT period, usersource, '{indicator}', element, idx, actual, pred FROM {name}_listed
)"""


SCENES = [
    base("stot", [], SPECIAL),
    base("chan", ["paycategory"], SPECIAL),
    base("plat", ["platform"], SPECIAL),
    f"""shares AS (
  SELECT period, usersource, {div('p_self_amt', 'p_amt')} AS overall,
    {div('a_self_amt_payonly', 'a_amt')} AS paid, {div('a_self_amt_refund', 'a_amt')} AS refund,
    {div('p_self_amt_payonly', 'p_amt')} AS paid_p, {div('p_self_amt_refund', 'p_amt')} AS refund_p
  FROM stot
), refunds AS (
  SELECT period, usersource, 'Refund' AS indicator, 'all' AS element, 0 AS idx,
    paid + refund AS actual, overall AS pred FROM shares
  UNION ALL SELECT period, usersource, 'Refund', '退款', 1, refund,
    refund_p * {div('overall', 'paid_p + refund_p')} FROM shares
)""",
    _scene_cte("channels", "PayChannel", "chan", "paycategory", _CHANNELS, 2),
    _scene_cte("platforms", "PayPlatform", "plat", "platform", _PLATFORMS, 6),
    f"""scene_rows AS (SELECT * FROM refunds UNION ALL SELECT * FROM channels
  UNION ALL SELECT * FROM platforms
), scenes AS (
  SELECT x.*, {gap('x.actual', 'x.pred')} AS gap,
    {div(gap('x.actual', 'x.pred'), gap('t.actual', 't.pred'))} AS ratio
  FROM scene_rows x JOIN scene_rows t USING (period, usersource, indicator) WHERE t.element = 'all'
)""",
]
for _name, _i in (("refund", "Refund"), ("channel", "PayChannel"), ("platform", "PayPlatform")):
    ORACLES[f"special_{_name}"] = with_(
        FACT,
        windows(59),
        *SCENES,
        select=f"""SELECT period, usersource, indicator, element,
  {r6s(['actual', 'pred', 'gap', 'ratio'])} FROM scenes WHERE indicator = '{_i}'""",
    )


def bu_ctes(numerator: str = "self_amt") -> str:
    """Business lines with shares, rates, contributions and the overall gap."""
    return f"""overall AS (
  SELECT period, usersource, {div(f'a_{numerator}', 'a_amt')} AS oa,
    {div(f'p_{numerator}', 'p_amt')} AS op FROM tot
), line_sums AS (
  SELECT period, usersource, sum(a_amt) AS sa, sum(p_amt) AS sp FROM line GROUP BY ALL
), line_rates AS (
  SELECT l.*, {gap("oa", "op")} AS total_gap, op, {div('l.a_amt', 'sa')} AS a_share,
    {div('l.p_amt', 'sp')} AS p_share, {div(f'l.a_{numerator}', 'l.a_amt')} AS a_rate,
    {div(f'l.p_{numerator}', 'l.p_amt')} AS raw_rate
  FROM line l JOIN line_sums USING (period, usersource) JOIN overall USING (period, usersource)
), line_zoom AS (
  SELECT *, raw_rate * (op / nullif(sum(p_share * raw_rate) OVER (PARTITION BY period, usersource), 0))
    AS p_rate FROM line_rates
), bus AS (
  SELECT *, (a_share - p_share) * p_rate AS g_share, (a_rate - p_rate) * p_share AS g_rate
  FROM line_zoom WHERE n_cur > 0
), bu_rows AS (
  SELECT period, usersource, bu, total_gap, '结构占比' AS indicator, 0 AS idx, a_share AS actual,
    p_share AS pred, g_share AS cts FROM bus
  UNION ALL SELECT period, usersource, bu, total_gap, '渗透率', 1, a_rate, p_rate, g_rate FROM bus
)"""


for _name, _num in (("bu_split", "self_amt"), ("bu_split_high_rate", "highRate_amt")):
    ORACLES[_name] = with_(
        FACT,
        windows(59),
        base("tot", [], KPI),
        base("line", ["bu"], KPI),
        bu_ctes(_num),
        select=f"""SELECT period, usersource, bu, indicator, {r6s(['actual', 'pred', 'cts'])},
  {r6(div('cts', 'total_gap'))} AS ratio FROM bu_rows""",
    )

# ------------------------------------------------------------------ Adtributor


def xln(x: str, y: str) -> str:
    return f"(CASE WHEN {x} = 0 THEN 0.0 WHEN {y} > 0 THEN {x} * ln({y}) END)"


def js(p: str, q: str) -> str:
    return f"({xln(p, p)} + {xln(q, q)} - {xln(f'({p} + {q})', f'(({p} + {q}) / 2)')})"


_DIMS = ("platform", "paycategory", "new_post_flag")
ELEMENTS = (
    "elements AS ("
    + " UNION ALL ".join(
        f"SELECT period, usersource, bu, '{d}' AS dim, {i} AS dim_idx, {d} AS element, "
        "coalesce(sum(a_amt), 0) AS a, coalesce(sum(p_amt), 0) AS f, "
        "coalesce(sum(a_self_amt), 0) AS a_self, coalesce(sum(p_self_amt), 0) AS f_self "
        "FROM leaf WHERE n_cur > 0 GROUP BY ALL"
        for i, d in enumerate(_DIMS)
    )
    + f"""), line_totals AS (
  SELECT period, usersource, bu, sum(a) AS ta, sum(f) AS tf, sum(a_self) AS tas, sum(f_self) AS tfs
  FROM elements WHERE dim = 'new_post_flag' GROUP BY ALL
), explained AS (
  SELECT period, usersource, bu, dim, dim_idx, element, a AS actual, f AS pred, {gap("ta", "tf")} AS dim_gap,
    {div('a - f', gap('ta', 'tf'))} AS ep, {js(div('a', 'ta'), div('f', 'tf'))} AS surprise
  FROM elements JOIN line_totals USING (period, usersource, bu)
), rate_elements AS (
  SELECT *, {div('a_self', 'a')} AS ra, {div('f_self', 'f')} AS rf, {div('tas', 'ta')} AS rta,
    {div('tfs', 'tf')} AS rtf
  FROM elements JOIN line_totals USING (period, usersource, bu) WHERE dim = 'new_post_flag'
), rate_explained AS (
  SELECT period, usersource, bu, dim, element, dim_idx, ra AS actual, rf AS pred,
    {div('(ra - rf) * rtf - (rta - rtf) * rf', 'rtf * rta')} AS ep,
    {js(div('a_self', 'tas'), div('f_self', 'tfs'))} + {js(div('a', 'ta'), div('f', 'tf'))} AS surprise
  FROM rate_elements
)"""
)
_LEAF_CTES = [FACT, windows(59), base("leaf", LEAF_DIMS, KPI), ELEMENTS]
_EKEYS = "period, usersource, bu, dim, element"
ORACLES["ep_additive"] = with_(
    *_LEAF_CTES,
    select=f"SELECT {_EKEYS}, {r6('ep')} AS ep, {r4s(['actual', 'pred'])} FROM explained",
)
ORACLES["surprise"] = with_(
    *_LEAF_CTES, select=f"SELECT {_EKEYS}, {r6('surprise')} AS surprise FROM explained"
)
ORACLES["ep_ratio"] = with_(
    *_LEAF_CTES,
    select=f"SELECT {_EKEYS}, {r6s(['actual', 'pred', 'ep', 'surprise'])} FROM rate_explained",
)
_RANK = (
    "row_number() OVER (PARTITION BY period, usersource, bu "
    "ORDER BY round(ep, 10) DESC NULLS LAST, dim_idx, element)"
)
ORACLES["adtributor_topk"] = with_(
    *_LEAF_CTES,
    select=f"""SELECT {_EKEYS}, {r6('ep')} AS ep, CAST(rank AS BIGINT) AS rank FROM (
  SELECT *, {_RANK} AS rank FROM explained WHERE round(ep, 10) >= 0.1) WHERE rank <= 3""",
)
ORACLES["adtributor_ratio_topk"] = with_(
    *_LEAF_CTES,
    select=f"""SELECT {_EKEYS}, {r6('ep')} AS ep, CAST(rank AS BIGINT) AS rank FROM (
  SELECT *, {_RANK} AS rank FROM rate_explained) WHERE rank <= 3""",
)
STRUCTURE = """structure AS (
  SELECT e.*, b.total_gap, b.actual - b.pred AS parent_gap, e.actual - e.pred AS cta,
    (e.actual - e.pred) / nullif(dim_gap, 0) * (b.actual - b.pred) AS cts,
    (e.actual - e.pred) / nullif(dim_gap, 0) * b.cts AS ctb
  FROM explained e JOIN bu_rows b USING (period, usersource, bu) WHERE b.indicator = '结构占比'
)"""
ORACLES["structure_split"] = with_(
    *_LEAF_CTES,
    base("tot", [], KPI),
    base("line", ["bu"], KPI),
    bu_ctes(),
    STRUCTURE,
    select=f"""SELECT {_EKEYS}, {r6s(['ep', 'cts', 'ctb'])}, {r6(div('ctb', 'total_gap'))} AS ratio,
  {r4s(['actual', 'pred', 'cta'])} FROM structure""",
)

# ---------------------------------------------------------------- permeability


def lnr(a: str, b: str) -> str:
    return f"(CASE WHEN {a} / nullif({b}, 0) > 0 THEN ln({a} / nullif({b}, 0)) END)"


def chains_sql(src: str, name: str, chains: list[list[str]], skip_first: bool) -> str:
    """Add the contribution g_x of every factor x of the chains (columns a_x and p_x)."""
    products, parts = [], {}
    for i, chain in enumerate(chains):
        products.append(f"{' * '.join('a_' + x for x in chain)} AS up_{i}")
        products.append(f"{' * '.join('p_' + x for x in chain)} AS down_{i}")
        for j, x in enumerate(chain):
            zero = "0.0" if skip_first and j == 0 else gap(f"up_{i}", f"down_{i}")
            parts.setdefault(x, []).append(
                f"(CASE WHEN up_{i} = 0 OR down_{i} = 0 THEN {zero} "
                f"WHEN {gap(f'up_{i}', f'down_{i}')} = 0 THEN {lnr(f'a_{x}', f'p_{x}')} * up_{i} "
                f"ELSE {lnr(f'a_{x}', f'p_{x}')} * ((up_{i} - down_{i}) / "
                f"nullif({lnr(f'up_{i}', f'down_{i}')}, 0)) END)"
            )
    gaps = ", ".join(f"{' + '.join(found)} AS g_{x}" for x, found in parts.items())
    drop = ", ".join(f"up_{i}, down_{i}" for i in range(len(chains)))
    return f"""{name}_products AS (SELECT *, {', '.join(products)} FROM {src}),
{name} AS (SELECT * EXCLUDE ({drop}), {gaps} FROM {name}_products)"""


_LMDI = [["orders", "ticket"]]
ORACLES["lmdi_chain"] = with_(
    FACT,
    windows(59),
    base("cat", ["paycategory"], {"amt": "sum(amt)", "cnt": "sum(cnt_payonly)"}),
    f"""two AS (SELECT period, usersource, paycategory, {z0('a_cnt')} AS a_orders,
  {z0('p_cnt')} AS p_orders, {z0(div('a_amt', 'a_cnt'))} AS a_ticket,
  {z0(div('p_amt', 'p_cnt'))} AS p_ticket FROM cat)""",
    chains_sql("two", "skipping", _LMDI, True),
    chains_sql("two", "full_change", _LMDI, False),
    select=f"""SELECT period, usersource, paycategory, {r4('s.g_orders')} AS skip_orders,
  {r4('s.g_ticket')} AS skip_ticket, {r4('f.g_orders')} AS g_orders, {r4('f.g_ticket')} AS g_ticket
FROM skipping s JOIN full_change f USING (period, usersource, paycategory)""",
)

_COUNTERS = ("prepay", "quick", "postpay")


def _counter_factors() -> str:
    out = []
    for t in ("a", "p"):
        amt = " + ".join(z0(f"{t}_{c}_amt") for c in _COUNTERS)
        own = " + ".join(z0(f"{t}_{c}_self_amt") for c in _COUNTERS)
        for c in _COUNTERS:
            rate = div(f"{t}_{c}_self_amt", f"{t}_{c}_amt")
            if t == "p":
                rate = f"{rate} * {div('p_rate', div(own, amt))}"
            out.append(f"{z0(div(f'{t}_{c}_amt', amt))} AS {t}_{c}_share")
            out.append(f"{z0(rate)} AS {t}_{c}_rate")
    return ", ".join(out)


def line_ctes(measures: dict[str, str]) -> list[str]:
    return [
        FACT,
        windows(59),
        base("tot", [], KPI),
        base("line", ["bu"], KPI | COUNTER | measures),
        bu_ctes(),
        f"counter_factors AS (SELECT *, {_counter_factors()} FROM bus)",
        chains_sql(
            "counter_factors", "counters", [[f"{c}_share", f"{c}_rate"] for c in _COUNTERS], True
        ),
        _counter_rows(),
    ]


def _counter_rows() -> str:
    rows = []
    for label, x in (("结构占比", "share"), ("渗透率", "rate")):
        for c in ("postpay", "quick", "prepay"):
            n = f"{c}_{x}"
            rows.append(
                f"SELECT period, usersource, bu, total_gap, '{label}' AS indicator, '{c}' AS element, "
                f"{len(rows)} AS idx, a_{n} AS actual, p_{n} AS pred, a_{n} - p_{n} AS cta, "
                f"g_{n} AS cts, {div(f'g_{n}', gap('a_rate', 'p_rate'))} * g_rate AS ctb FROM counters"
            )
    return f"""first_rows AS (SELECT *, ctb / nullif(total_gap, 0) AS ratio FROM (
  {' UNION ALL '.join(rows)}))"""


_VALUES = ["actual", "pred", "cta", "cts", "ctb", "ratio"]
ORACLES["counter_split"] = with_(
    *line_ctes({}),
    select=f"SELECT period, usersource, bu, indicator, element, {r6s(_VALUES)} FROM first_rows",
)

# Factor -> (formula with {t} for the side, label), in report order.
SECOND_FACTORS: dict[str, dict[str, tuple[str, str]]] = {
    "prepay": {
        "prepay_card_rt": (div("{t}_prepay_card_cnt", "{t}_prepay_cnt"), "卡支付比例"),
        "prepay_card_p": (div("{t}_prepay_card_paid", "{t}_prepay_card_cnt"), "卡支付笔单价"),
        "prepay_credit_rt": (div("{t}_prepay_credit_cnt", "{t}_prepay_cnt"), "拿去花支付比例"),
        "prepay_credit_p": (
            div("{t}_prepay_credit_paid", "{t}_prepay_credit_cnt"),
            "拿去花支付笔单价",
        ),
        "prepay_other_rt": (div("{t}_prepay_other_cnt", "{t}_prepay_cnt"), "其他自有支付比例"),
        "prepay_other_p": (
            div("{t}_prepay_other_paid", "{t}_prepay_other_cnt"),
            "其他自有支付笔单价",
        ),
    }
}
for c, new, old, new_p, old_p in (
    ("quick", "新开通标准极速比例", "已开通标准极速比例", "新开通标准极速且自有支付笔单价",
     "已开通标准极速且自有支付笔单价"),
    ("postpay", "新开通后付比例", "已开通后付比例", "新开通后付且自有支付笔单价",
     "已开通后付且自有支付笔单价"),
):
    SECOND_FACTORS[c] = {}
    for g, label, own_label, p_label in (
        ("new", new, "新开通且自有支付比例", new_p),
        ("old", old, "已开通且自有支付比例", old_p),
    ):
        n = "{t}_" + f"{c}_{g}"
        SECOND_FACTORS[c] |= {
            f"{c}_{g}_rt": (div(f"{n}_cnt", "{t}_" + f"{c}_cnt"), label),
            f"{c}_{g}_self_rt": (div(f"{n}_own_cnt", f"{n}_cnt"), own_label),
            f"{c}_{g}_self_p": (div(f"{n}_own_paid", f"{n}_own_cnt"), p_label),
        }
for c in _COUNTERS:
    SECOND_FACTORS[c] |= {
        f"{c}_orders": ("{t}_" + f"{c}_cnt", "支付成功订单数"),
        f"{c}_inverse_amt": (div("1.0", "{t}_" + f"{c}_amt"), "1/总体净额"),
        f"{c}_refunds": ("-{t}_" + f"{c}_refund", "自有退款"),
    }


def split_sql(
    name: str,
    src: str,
    factors: dict[str, tuple[str, str]],
    total: str,
    power,
    chains: list[list[str]] | None,
    skip_first: bool,
    capped: bool,
    own_total: bool,
) -> str:
    """Factors, calibration to pp (the parent's prediction), contributions, long rows."""
    actual = ", ".join(f"{z0(f.format(t='a'))} AS a_{n}" for n, (f, _) in factors.items())
    raw = ", ".join(f"{z0(f.format(t='p'))} AS r_{n}" for n, (f, _) in factors.items())
    pred = []
    for n in factors:
        value = f"r_{n} * (CASE WHEN zoom > 0 THEN pow(zoom, {power(n)!r}) END)"
        if capped:
            value = f"CASE WHEN {value} > 1 THEN 1.0 ELSE {value} END"
        pred.append(f"{z0(value)} AS p_{n}")
    rows = " UNION ALL ".join(
        f"SELECT period, usersource, bu, total_gap, pc, pb, '{n}' AS factor, '{label}' AS element, "
        f"{i} AS idx, a_{n} AS actual, p_{n} AS pred, g_{n} AS cts FROM {name}"
        for i, (n, (_, label)) in enumerate(factors.items())
    )
    if chains is None:
        gaps = ", ".join(f"a_{n} - p_{n} AS g_{n}" for n in factors)
        contributions = f"{name} AS (SELECT *, {gaps} FROM {name}_pred)"
    else:
        contributions = chains_sql(f"{name}_pred", name, chains, skip_first)
    total = total.format(t="p") if own_total else total
    return f"""{name}_raw AS (SELECT *, {actual}, {raw} FROM {src}),
{name}_zoom AS (SELECT *, {div('pp', total)} AS zoom FROM {name}_raw),
{name}_pred AS (SELECT * EXCLUDE (zoom), {', '.join(pred)} FROM {name}_zoom),
{contributions},
{name}_rows AS (SELECT *, actual - pred AS cta, cts / nullif(pc, 0) * pb AS ctb,
  cts / nullif(pc, 0) * pb / nullif(total_gap, 0) AS ratio FROM ({rows}))"""


def second_sql(c: str) -> str:
    factors = SECOND_FACTORS[c]
    groups = ("card", "credit", "other") if c == "prepay" else ("new", "old")
    steps = ("rt", "p") if c == "prepay" else ("rt", "self_rt", "self_p")
    each = [[f"{c}_{g}_{s}" for s in steps] for g in groups]
    total = (
        f"r_{c}_orders * r_{c}_inverse_amt * ("
        + " + ".join(" * ".join(f"r_{x}" for x in g) for g in each)
        + f") + r_{c}_refunds * r_{c}_inverse_amt"
    )
    k = 2 + len(steps)
    src = f"""second_{c}_src AS (SELECT * EXCLUDE (p_rate, a_rate), p_{c}_rate AS pp,
  {gap(f'a_{c}_rate', f'p_{c}_rate')} AS pc,
  {div(f'g_{c}_rate', gap('a_rate', 'p_rate'))} * g_rate AS pb FROM counters)"""
    return src + ",\n" + split_sql(
        f"second_{c}",
        f"second_{c}_src",
        factors,
        total,
        lambda n: (k - 1) / k if n.endswith("_refunds") else 1 / k,
        [[f"{c}_orders", f"{c}_inverse_amt", *g] for g in each]
        + [[f"{c}_inverse_amt", f"{c}_refunds"]],
        True,
        False,
        False,
    )


_SPLIT_KEYS = "period, usersource, bu, factor, element"
for _c in _COUNTERS:
    ORACLES[f"sec_{_c}"] = with_(
        *line_ctes(SECOND),
        second_sql(_c),
        select=f"SELECT {_SPLIT_KEYS}, {names(_VALUES[:3], fine)}, {r6s(_VALUES[3:])} "
        f"FROM second_{_c}_rows",
    )

_ENTRY = "{t}_nocard_entry + {t}_havecard_entry"
_ACT = "{t}_inactive_entry + {t}_active_entry"
THIRD_FACTORS = {
    "prepay_card_rt": {
        "nocard_rt": (div("{t}_nocard_entry", _ENTRY), "进入页无卡比例"),
        "havecard_rt": (div("{t}_havecard_entry", _ENTRY), "进入页有卡比例"),
        "nocard_bind_rt": (div("{t}_nocard_bind_entry", "{t}_nocard_entry"), "绑卡成功率"),
        "nocard_bind_sub_rt": (
            div("{t}_nocard_bind_submit", "{t}_nocard_bind_entry"),
            "绑卡后支付提交率",
        ),
        "havecard_default_rt": (
            div("{t}_havecard_default_entry", "{t}_havecard_entry"),
            "默勾卡率",
        ),
        "havecard_default_sub_rt": (
            div("{t}_havecard_default_submit", "{t}_havecard_default_entry"),
            "默勾后支付提交率",
        ),
        "havecard_change_rt": (div("{t}_havecard_change_entry", "{t}_havecard_entry"), "换勾卡率"),
        "havecard_change_sub_rt": (
            div("{t}_havecard_change_submit", "{t}_havecard_change_entry"),
            "换勾后支付提交率",
        ),
        "havecard_bind_rt": (div("{t}_havecard_bind_entry", "{t}_havecard_entry"), "新绑卡成功率"),
        "havecard_bind_sub_rt": (
            div("{t}_havecard_bind_submit", "{t}_havecard_bind_entry"),
            "新绑卡后支付提交率",
        ),
    },
    "prepay_credit_rt": {
        "inactive_rt": (div("{t}_inactive_entry", _ACT), "进入页拿去花未激活比例"),
        "active_rt": (div("{t}_active_entry", _ACT), "进入页拿去花已激活比例"),
        "inactive_sub_rt": (
            div("{t}_inactive_submit", "{t}_inactive_entry"),
            "拿去花未激活开通提交率",
        ),
        "active_sub_rt": (div("{t}_active_submit", "{t}_active_entry"), "拿去花已激活勾选提交率"),
    },
    "quick_new_self_rt": {
        "quicknew_haveown_rt": (
            div("{t}_quicknew_haveown_cnt", "{t}_quicknew_cnt"),
            "进入授权页有自有支付工具占比",
        ),
        "quicknew_own_sub_rt": (
            div("{t}_quicknew_own_cnt", "{t}_quicknew_haveown_cnt"),
            "自有支付工具提交率",
        ),
    },
}
THIRD_TOTAL = {
    "prepay_card_rt": div(
        "{t}_nocard_bind_submit + {t}_havecard_default_submit + {t}_havecard_change_submit"
        " + {t}_havecard_bind_submit",
        _ENTRY,
    ),
    "prepay_credit_rt": div("{t}_inactive_submit + {t}_active_submit", _ACT),
    "quick_new_self_rt": div("{t}_quicknew_own_cnt", "{t}_quicknew_cnt"),
}
THIRD_CHAINS = {
    "prepay_card_rt": [
        ["nocard_rt", "nocard_bind_rt", "nocard_bind_sub_rt"],
        ["havecard_rt", "havecard_default_rt", "havecard_default_sub_rt"],
        ["havecard_rt", "havecard_change_rt", "havecard_change_sub_rt"],
        ["havecard_rt", "havecard_bind_rt", "havecard_bind_sub_rt"],
    ],
    "prepay_credit_rt": [["active_rt", "active_sub_rt"], ["inactive_rt", "inactive_sub_rt"]],
    "quick_new_self_rt": [["quicknew_haveown_rt", "quicknew_own_sub_rt"]],
}
THIRD_AT = {"prepay_card_rt": "prepay", "prepay_credit_rt": "prepay", "quick_new_self_rt": "quick"}


def third_sql(code: str, chain_mode: bool = False) -> str:
    root = 3 if code == "prepay_card_rt" else 2
    chains = THIRD_CHAINS[code]
    if code == "quick_new_self_rt" and not chain_mode:
        chains = None
    src = f"""third_{code}_src AS (SELECT * EXCLUDE (pp, pc, pb), p_{code} AS pp,
  {gap(f'a_{code}', f'p_{code}')} AS pc, g_{code} / nullif(pc, 0) * pb AS pb FROM second_{THIRD_AT[code]})"""
    return src + ",\n" + split_sql(
        f"third_{code}",
        f"third_{code}_src",
        THIRD_FACTORS[code],
        THIRD_TOTAL[code],
        lambda n: 1 / root,
        chains,
        False,
        True,
        True,
    )


for _q, _code, _mode in (
    ("thd_card", "prepay_card_rt", False),
    ("thd_credit", "prepay_credit_rt", False),
    ("thd_quicknew", "quick_new_self_rt", False),
    ("thd_quicknew_chain", "quick_new_self_rt", True),
):
    ORACLES[_q] = with_(
        *line_ctes(SECOND | THIRD),
        second_sql(THIRD_AT[_code]),
        third_sql(_code, _mode),
        select=f"SELECT {_SPLIT_KEYS}, {r6s(_VALUES)} FROM third_{_code}_rows",
    )

# ------------------------------------------------------------- whole analysis

_N = "period, usersource"


def _siblings(src: str, name: str, keys: str, order: str = "idx, element") -> str:
    return f"""{name} AS (SELECT *, row_number() OVER (PARTITION BY {keys}
  ORDER BY round(ratio, 10) DESC NULLS LAST, {order}) AS rank FROM {src})"""


def _union(name: str, parts: list[str]) -> str:
    return f"{name} AS ({' UNION ALL '.join(parts)})"


TREE = [
    *line_ctes(SECOND | THIRD),
    *[second_sql(c) for c in _COUNTERS],
    *[third_sql(code) for code in THIRD_FACTORS],
    """bu_ratio AS (SELECT *, bu AS element, cts / nullif(total_gap, 0) AS ratio FROM bu_rows)""",
    _siblings("bu_ratio", "n0", _N),
    # chosen lines: top 3 of both indicators, positive
    "picks AS (SELECT * FROM n0 WHERE rank <= 3 AND round(ratio, 10) > 0)",
    "lines AS (SELECT period, usersource, bu, rank AS bu_rank FROM picks WHERE indicator = '渗透率')",
    _siblings("first_rows", "n1_all", f"{_N}, bu"),
    f"n1 AS (SELECT n1_all.*, bu_rank FROM n1_all JOIN lines USING ({_N}, bu))",
    f"""counters_chosen AS (SELECT {_N}, bu, element AS counter, bu_rank, rank AS counter_rank FROM n1
  WHERE rank <= 3 AND indicator = '渗透率')""",
    _union("second_all", [f"SELECT '{c}' AS counter, * FROM second_{c}_rows" for c in _COUNTERS]),
    _siblings("second_all", "n2_all", f"{_N}, bu, counter"),
    f"""n2 AS (SELECT n2_all.*, bu_rank, counter_rank FROM n2_all
  JOIN counters_chosen USING ({_N}, bu, counter))""",
    "codes_chosen AS (SELECT period, usersource, bu, counter, factor AS code, element AS code_label, "
    "bu_rank, counter_rank, rank AS code_rank FROM n2 WHERE rank <= 3 AND factor IN ("
    + ", ".join(f"'{c}'" for c in THIRD_FACTORS)
    + "))",
    _union(
        "third_all",
        [
            f"SELECT '{code}' AS code, '{THIRD_AT[code]}' AS counter, * FROM third_{code}_rows"
            for code in THIRD_FACTORS
        ],
    ),
    _siblings("third_all", "n3_all", f"{_N}, bu, counter, code"),
    f"""n3 AS (SELECT n3_all.*, code_label, bu_rank, counter_rank, code_rank FROM n3_all
  JOIN codes_chosen USING ({_N}, bu, counter, code))""",
]
_NODE = "CAST(rank AS BIGINT) AS rank, " + r6("ratio") + " AS ratio"
ORACLES["drill_top3"] = with_(
    *TREE,
    select=f"""SELECT {_N}, 'BU拆分' AS layer, bu AS line, NULL AS counter, NULL AS code,
  indicator, element, {_NODE} FROM n0 WHERE rank <= 3
UNION ALL SELECT {_N}, '渗透率一级指标', bu, element, NULL, indicator, element, {_NODE}
FROM n1 WHERE rank <= 3
UNION ALL SELECT {_N}, '渗透率二级指标', bu, counter, NULL, NULL, element, {_NODE}
FROM n2 WHERE rank <= 3
UNION ALL SELECT {_N}, '渗透率三级指标', bu, counter, code, NULL, element, {_NODE}
FROM n3 WHERE rank <= 3""",
)

FULL = [
    *TREE,
    *SCENES,
    base("leaf", LEAF_DIMS, KPI),
    ELEMENTS,
    STRUCTURE,
    f"""chosen_structure AS (SELECT s.*, s.ctb / nullif(s.total_gap, 0) AS ratio, p.rank AS bu_rank
  FROM structure s JOIN picks p USING ({_N}, bu) WHERE p.indicator = '结构占比')""",
    f"""scene_ranked AS (SELECT *, row_number() OVER (PARTITION BY {_N}
  ORDER BY round(ratio, 10) DESC NULLS LAST, idx) AS rank FROM scenes WHERE element <> 'all')""",
]
_DETAIL = [
    f"""SELECT {_N}, '大盘' AS layer, '大盘' AS indicator, '大盘' AS element, oa AS actual, op AS pred,
  total_gap AS cta, total_gap AS cts, total_gap AS ctb, 1.0 AS ratio
  FROM (SELECT *, {gap('oa', 'op')} AS total_gap FROM overall)""",
    f"""SELECT {_N}, '特殊场景', indicator, element, actual, pred, gap, gap, gap, ratio
  FROM scene_ranked""",
    f"""SELECT {_N}, 'BU拆分', indicator, bu, actual, pred, actual - pred, cts, cts, ratio FROM n0""",
    f"""SELECT {_N}, '结构分析', bu || '-' || dim, element, actual, pred, cta, cts, ctb, ratio
  FROM chosen_structure""",
    f"""SELECT {_N}, '渗透率一级指标', bu || '-' || indicator, element, actual, pred, cta, cts, ctb,
  ratio FROM n1""",
    f"""SELECT {_N}, '渗透率二级指标', bu || '-' || counter, element, actual, pred, cta, cts, ctb, ratio
  FROM n2""",
    f"""SELECT {_N}, '渗透率三级指标', bu || '-' || counter || '-' || code_label, element, actual, pred,
  cta, cts, ctb, ratio FROM n3""",
]
_HEAD = f"""'{DAY}' AS "Date", period AS "Period", 'self_rt' AS "Target", usersource AS "Usersource",
  layer AS "Layer", indicator AS "Indicator", element AS "Element\""""


def _either(x: str, name: str) -> str:
    return f"CASE WHEN layer = '结构分析' THEN {r4(x)} ELSE {fine(x)} END AS \"{name}\""


ORACLES["contributions"] = with_(
    *FULL,
    _union("detail", _DETAIL),
    select=f"""SELECT {_HEAD}, {_either('actual', 'Actual')}, {_either('pred', 'Pred')},
  {_either('cta', 'CTA')}, {r6('cts')} AS "CTS", {r6('ctb')} AS "CTB", {r6('ratio')} AS "CTBRatio"
FROM detail""",
)


def pct(x: str) -> str:
    return (
        f"(CASE WHEN {x} IS NULL THEN 'nan%' ELSE (CASE WHEN round({x}, 10) < 0 THEN '-' ELSE '' END)"
        f" || printf('%.2f%%', round_even(abs({x}), 4) * 100) END)"
    )


def agg(text: str, sep: str, order: str, condition: str = "TRUE") -> str:
    return f"coalesce(string_agg({text}, '{sep}' ORDER BY {order}) FILTER ({condition}), '')"


_NL = "chr(10)"
_TAB = "chr(9)"
TEXTS = [
    f"""t_total AS (SELECT {_N}, '自有支付占比的预测值为' || {pct('op')} || ', 实际值为' || {pct('oa')}
  || ', 差值为' || {pct('(oa - op)')} AS text FROM overall)""",
    f"""scene_text AS (SELECT {_N}, max(element) FILTER (rank = 1) AS best,
    max(ratio) FILTER (rank = 1) AS best_ratio,
    {agg('element', '、', 'rank', 'round(ratio, 10) > 0')} AS listed,
    coalesce(sum(ratio) FILTER (round(ratio, 10) > 0), 0) AS total FROM scene_ranked GROUP BY ALL
), t_special AS (SELECT {_N}, '特殊场景中，' || best || '对异动的贡献最大，为' || {pct('best_ratio')}
    || '。' || CASE WHEN total < 0.5 THEN '但还达不到50%的水平，显然解释力不足，需要继续分析'
    ELSE '特殊场景' || listed || '对异动的贡献达到' || {pct('total')} || '，具有较强的解释力' END
    || '。' AS text FROM scene_text)""",
    f"""t_bu AS (SELECT {_N}, '从结果看，贡献最大的Top3分别是: '
    || {agg("bu || '的' || indicator || '(' || " + pct('ratio') + " || ')'", '、', 'rank', 'rank <= 3')}
    || '。' AS text FROM n0 GROUP BY ALL)""",
    f"""structure_ranked AS (SELECT *, row_number() OVER (PARTITION BY {_N}, bu
    ORDER BY round(ep, 10) DESC NULLS LAST, dim_idx, element) AS rank
  FROM chosen_structure WHERE round(ep, 10) >= 0.1
), structure_lines AS (SELECT {_N}, bu, bu_rank, max(parent_gap) AS parent_gap
  FROM chosen_structure GROUP BY ALL
), structure_text AS (SELECT l.period, l.usersource, l.bu_rank, '造成' || l.bu || '业务占比'
    || CASE WHEN l.parent_gap < 0 THEN '下降' ELSE '上升' END || '的主要维度的元素为: '
    || {agg("r.element || ' 的 ' || CASE r.dim WHEN 'platform' THEN '支付平台' "
            "WHEN 'new_post_flag' THEN '收银台' ELSE '支付方式' END || '(' || " + pct('r.ep')
            + " || ')'", '、', 'r.rank', 'r.rank <= 3')} AS text
  FROM structure_lines l LEFT JOIN structure_ranked r USING ({_N}, bu)
  GROUP BY l.period, l.usersource, l.bu, l.bu_rank, l.parent_gap
), t_structure AS (SELECT o.period, o.usersource, {agg('s.text', '；', 's.bu_rank')} AS text
  FROM overall o LEFT JOIN structure_text s USING ({_N}) GROUP BY o.period, o.usersource)""",
    f"""t_first AS (SELECT {_N}, bu, bu_rank, '从' || bu || '业务线的渗透率归因来看，对大盘贡献的Top3为'
    || {agg("element || '的' || indicator || '(' || " + pct('ratio') + " || ')'", '、', 'rank', 'rank <= 3')}
    || '。接下来要分析'
    || {agg("bu || '业务' || element || '的' || indicator", '、', 'rank', "rank <= 3 AND indicator = '渗透率'")}
    || '。' AS text FROM n1 GROUP BY {_N}, bu, bu_rank)""",
    f"""t_second AS (SELECT {_N}, bu, counter, bu_rank, counter_rank, '从' || bu || '业务线的' || counter
    || '收银台渗透率二级指标归因来看，对大盘贡献的Top3为: '
    || {agg("element || '(' || " + pct('ratio') + " || ')'", '、', 'rank', 'rank <= 3')}
    || '。接下来要分析: ' || {agg("bu || '业务' || counter || '收银台的' || element", '、', 'rank',
        "rank <= 3 AND factor IN (" + ", ".join(f"'{c}'" for c in THIRD_FACTORS) + ")")}
    || '。' AS text FROM n2 GROUP BY {_N}, bu, counter, bu_rank, counter_rank)""",
    f"""t_third AS (SELECT {_N}, bu, counter, code_label, bu_rank, counter_rank, code_rank, '拆分' || bu
    || '业务线的' || counter || '收银台的' || code_label
    || '指标进行渗透率三级指标归因，发现对大盘贡献的Top3为: '
    || {agg("element || '(' || " + pct('ratio') + " || ')'", '、', 'rank', 'rank <= 3')} || '。' AS text
  FROM n3 GROUP BY {_N}, bu, counter, code_label, bu_rank, counter_rank, code_rank)""",
]


def _block(table: str, order: str) -> str:
    """Indented texts of one level per source and period."""
    return f"""{table}_block AS (SELECT o.period, o.usersource,
    coalesce(string_agg({_TAB} || {_TAB} || t.text, {_NL} ORDER BY {order}), '') AS text
  FROM overall o LEFT JOIN {table} t USING ({_N}) GROUP BY o.period, o.usersource)"""


_PARTS = [
    ("t_special", "·特殊场景: "),
    ("t_bu", "·业务线拆分: "),
    ("t_structure", "·结构变化归因: "),
    ("t_first_block", "·一级渗透率归因: \n"),
    ("t_second_block", "·二级渗透率归因: \n"),
    ("t_third_block", "·三级渗透率归因: \n"),
]
_SUMMARY = (
    f"'{DAY} ' || period || ' self_rt' || {_NL} || '异动总结: ' || {_NL} || {_NL} || t_total.text"
    + "".join(
        f" || {_NL} || {_NL} || {_TAB} || '{title.strip(chr(10))}'"
        + (f" || {_NL}" if title.endswith("\n") else "")
        + f" || {table}.text"
        for table, title in _PARTS
    )
)
ORACLES["conclusions"] = with_(
    *FULL,
    *TEXTS,
    _block("t_first", "t.bu_rank"),
    _block("t_second", "t.bu_rank, t.counter_rank"),
    _block("t_third", "t.bu_rank, t.counter_rank, t.code_rank"),
    _union(
        "conclusions",
        [
            f"SELECT {_N}, '{layer}' AS layer, '总结' AS indicator, text FROM {table}"
            for layer, table in (
                ("大盘", "t_total"),
                ("特殊场景", "t_special"),
                ("BU拆分", "t_bu"),
                ("结构分析", "t_structure"),
            )
        ]
        + [
            f"SELECT {_N}, '渗透率一级指标', bu || '-总结', text FROM t_first",
            f"SELECT {_N}, '渗透率二级指标', bu || '-' || counter || '-渗透率-总结', text FROM t_second",
            f"SELECT {_N}, '渗透率三级指标', bu || '-' || counter || '-' || code_label "
            "|| '-渗透率-总结', text FROM t_third",
            f"SELECT {_N}, '总结', '总结', {_SUMMARY} FROM t_total "
            + " ".join(f"JOIN {t} USING ({_N})" for t, _ in _PARTS),
        ],
    ),
    select=f"""SELECT {_HEAD.replace('element AS', "'总结' AS")}, text AS "Conclusion", '{DAY}' AS d
FROM conclusions""",
)

_BU_TEXT = next(t for t in TEXTS if t.startswith("t_bu AS"))
ORACLES["conclusions_pred"] = with_(
    *FULL,
    _BU_TEXT.replace(pct("ratio"), pct("pred")),
    select=f"""SELECT {_HEAD.replace('element AS', "'总结' AS")}, text AS "Conclusion", '{DAY}' AS d
FROM (SELECT {_N}, 'BU拆分' AS layer, '总结' AS indicator, text FROM t_bu)""",
)


def _on_day(name: str, day: str) -> str:
    """An oracle as of another day of the year."""
    return ORACLES[name].replace(DAY, day).replace("1999" + DAY[4:], "1999" + day[4:])


_REPORT = '"Date", "Period", "Target", "Usersource", "Layer", "Indicator", "Element"'
_VALUES = ("Actual", "Pred", "CTA", "CTS", "CTB", "CTBRatio")
ORACLES["saved_analysis"] = "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT {_REPORT}, {', '.join(f'"{v}"' for v in _VALUES)}, NULL AS "Conclusion", '{day}' AS d
  FROM ({_on_day("contributions", day)})
UNION ALL SELECT {_REPORT}, {', '.join(f'NULL AS "{v}"' for v in _VALUES)}, "Conclusion", d
  FROM ({_on_day("conclusions", day)})"""
    for day in ("2000-06-11", DAY)
) + """) WHERE "Period" IN ('D', 'W')"""
