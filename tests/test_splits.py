"""Special scenes, business lines, Adtributor and permeability on hand-made baselines."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest

from ratiolens.codes import ORDER_CODES as C
from ratiolens.operators import adtributor, business, permeability, special
from ratiolens.operators.daily import funnel_measures
from ratiolens.plans import labels as L
from tests.conftest import make_fact


def table(spark, rows, schema):
    names = [f.split()[0] for f in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


# ---------------------------------------------------------------- special

SPECIAL = (
    "period string, usersource string, level string, paycategory string, platform string, "
    "n_cur long, n_prev long, "
    + ", ".join(
        f"{t}_{n} double"
        for t in ("a", "p")
        for n in ("amt", "self_amt", "self_amt_payonly", "self_amt_refund")
    )
)


def special_row(level, a, p, **keys):
    row = {"period": "D", "usersource": "S", "level": level, "n_cur": 1, "n_prev": 1, **keys}
    for tag, values in (("a", a), ("p", p)):
        if values is None:
            row["n_cur" if tag == "a" else "n_prev"] = 0
            continue
        amt, own, paid, refund = values
        row |= {
            f"{tag}_amt": amt,
            f"{tag}_self_amt": own,
            f"{tag}_self_amt_payonly": paid,
            f"{tag}_self_amt_refund": refund,
        }
    return row


@pytest.fixture(scope="module")
def scenes(spark):
    rows = [
        special_row("total", (100.0, 50.0, 55.0, -5.0), (100.0, 40.0, 46.0, -6.0)),
        special_row("paycategory", (60.0, 30.0, 0.0, 0.0), (50.0, 20.0, 0.0, 0.0), paycategory="chan_1"),
        special_row("paycategory", (40.0, 20.0, 0.0, 0.0), (50.0, 30.0, 0.0, 0.0), paycategory="other"),
        special_row("platform", (100.0, 50.0, 0.0, 0.0), None, platform="1-URGENT"),
        special_row("platform", None, None, platform="2-HIGH"),
    ]
    got = special.special_scenes(table(spark, rows, SPECIAL), C).collect()
    return {(r["indicator"], r["element"]): r for r in got}


def test_refund_adds_up_to_the_overall_prediction(scenes):
    overall = scenes[("Refund", "all")]
    assert overall["pred"] == pytest.approx(0.4) and overall["actual"] == pytest.approx(0.5)
    refund = scenes[("Refund", "退款")]
    assert refund["pred"] == pytest.approx(-0.06 * (0.4 / 0.4))
    assert refund["ratio"] == pytest.approx((-0.05 + 0.06) / 0.1)


def test_listed_elements_are_scaled_or_zero(scenes):
    one = scenes[("PayChannel", "chan_1")]
    # predicted share 20/100, all channels predict 50/100, overall predicts 0.4
    assert one["pred"] == pytest.approx(0.2 * 0.4 / 0.5)
    assert one["actual"] == pytest.approx(0.3)
    missing = scenes[("PayChannel", "chan_missing")]
    assert (missing["actual"], missing["pred"]) == (0.0, 0.0)


def test_element_of_one_year_only(scenes):
    assert scenes[("PayPlatform", "1-URGENT")]["pred"] is None
    assert scenes[("PayPlatform", "2-HIGH")]["actual"] == 0.0
    assert scenes[("PayPlatform", "2-HIGH")]["pred"] is None


# ----------------------------------------------------------- business lines

LINES = (
    "period string, usersource string, level string, bu string, n_cur long, n_prev long, "
    "a_amt double, p_amt double, a_self_amt double, p_self_amt double"
)


def line(level, bu, a_amt, a_own, p_amt, p_own, n_cur=1):
    return {
        "period": "D", "usersource": "S", "level": level, "bu": bu, "n_cur": n_cur, "n_prev": 1,
        "a_amt": a_amt, "a_self_amt": a_own, "p_amt": p_amt, "p_self_amt": p_own,
    }


def test_bu_split_contributions(spark):
    rows = [
        line("total", None, 100.0, 50.0, 90.0, 30.0),
        line("bu", "x", 60.0, 40.0, 40.0, 16.0),
        line("bu", "y", 40.0, 10.0, 60.0, 12.0),
        line("bu", "gone", None, None, None, None, n_cur=0),
    ]
    got = {r["bu"]: r for r in business.bu_split(table(spark, rows, LINES)).collect()}
    assert set(got) == {"x", "y"}
    zoom = (30 / 90) / (0.4 * 0.4 + 0.6 * 0.2)
    assert got["x"]["p_rate"] == pytest.approx(0.4 * zoom)
    # the calibrated split predicts the overall rate
    assert sum(r["p_share"] * r["p_rate"] for r in got.values()) == pytest.approx(1 / 3)
    assert got["x"]["g_share"] == pytest.approx((0.6 - 0.4) * 0.4 * zoom)
    assert got["y"]["g_rate"] == pytest.approx((0.25 - 0.2 * zoom) * 0.6)
    assert got["x"]["total_gap"] == pytest.approx(0.5 - 1 / 3)


# --------------------------------------------------------------- Adtributor

LEAVES = (
    "period string, usersource string, bu string, platform string, paycategory string, "
    "new_post_flag string, n_cur long, a_amt double, p_amt double, a_self_amt double, "
    "p_self_amt double"
)


def leaf(platform, category, flag, a, p, a_own=0.0, p_own=0.0, n_cur=1):
    return {
        "period": "D", "usersource": "S", "bu": "B-1", "platform": platform,
        "paycategory": category, "new_post_flag": flag, "n_cur": n_cur, "a_amt": a, "p_amt": p,
        "a_self_amt": a_own, "p_self_amt": p_own,
    }


@pytest.fixture(scope="module")
def leaves(spark):
    return table(
        spark,
        [
            leaf("p1", "c1", "prepay", 20.0, 15.0, 10.0, 6.0),
            leaf("p2", "c1", "quick", 30.0, 29.0, 9.0, 9.0),
            leaf("p3", "c2", "quick", 4.0, None, 1.0, None),
            leaf("p4", "c2", "quick", None, 50.0, None, 1.0, n_cur=0),
        ],
        LEAVES,
    )


def test_additive_power_and_threshold(leaves):
    rows = adtributor.explain_additive(leaves)
    got = {(r["dim"], r["element"]): r for r in rows.collect()}
    # totals 54 and 44: the leaf without this year's rows is out, a missing prediction adds nothing
    assert got[("platform", "p2")]["ep"] == pytest.approx(0.1)
    assert got[("platform", "p3")]["ep"] == pytest.approx(0.4)
    assert ("platform", "p4") not in got
    for dim in adtributor.DIMS:
        assert sum(r["ep"] for k, r in got.items() if k[0] == dim) == pytest.approx(1)
    assert all(r["surprise"] >= -1e-12 for r in got.values())
    p3 = got[("platform", "p3")]
    assert p3["surprise"] == pytest.approx(4 / 54 * math.log(2))

    eligible = adtributor.top_elements(rows, top_k=100).collect()
    assert ("platform", "p2") in {(r["dim"], r["element"]) for r in eligible}  # exactly 0.1


def test_top_elements_break_ties_by_dimension_then_element(leaves):
    top = adtributor.top_elements(adtributor.explain_additive(leaves)).orderBy("rank").collect()
    assert [(r["dim"], r["element"]) for r in top] == [
        ("paycategory", "c1"),  # 0.6
        ("platform", "p1"),  # 0.5, before the other dimension's 0.5
        ("new_post_flag", "prepay"),
    ]


def test_ratio_power_ranks_the_last_dimension_only(leaves):
    rows = adtributor.explain_ratio(leaves)
    got = {r["element"]: r for r in rows.collect()}
    assert set(got) == {"prepay", "quick"}
    actual, pred, total, expected = 10 / 20, 6 / 15, 20 / 54, 15 / 44
    assert got["prepay"]["ep"] == pytest.approx(
        ((actual - pred) * expected - (total - expected) * pred) / (expected * total)
    )
    assert len(adtributor.top_elements(rows, threshold=None).collect()) == 2


# ------------------------------------------------------------- permeability

SECOND = [permeability.second_model(c) for c in permeability.COUNTERS]
THIRD = permeability.third_models()
MEASURES = sorted({m for model in [*SECOND, *THIRD.values()] for m in model.measures()})


def parents(spark, seed=5, count=20, **fixed):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        row = {"period": "D", "usersource": "S", "bu": f"B{i}", "total_gap": 0.1}
        row |= {"parent_pred": rng.uniform(0.2, 0.7), "parent_cta": 0.05, "parent_ctb": 0.02}
        for tag in ("a", "p"):
            for m in MEASURES:
                low_high = (0.1, 0.5) if m.endswith("_refund") else (10, 90)
                row[f"{tag}_{m}"] = rng.uniform(*low_high)
        rows.append(row | fixed)
    schema = ", ".join(
        f"{n} {'string' if n in ('period', 'usersource', 'bu') else 'double'}" for n in rows[0]
    )
    return rows, table(spark, rows, schema)


@pytest.mark.parametrize("counter", permeability.COUNTERS)
def test_second_level_reproduces_the_parent(spark, counter):
    """Calibrated factors multiply back to the parent's prediction; parts to the actual gap."""
    rows, frame = parents(spark)
    model = permeability.second_model(counter)
    got = {r["bu"]: r for r in permeability.factor_split(frame, model).collect()}
    groups = [c for c in model.chains if len(c) > 2]
    refund = model.chains[-1]
    for row in rows:
        r = got[row["bu"]]

        def rate(tag, r=r):
            return sum(math.prod(r[f"{tag}_{n}"] for n in c) for c in [*groups, refund])

        assert rate("p") == pytest.approx(row["parent_pred"])
        parts = sum(r[f"g_{n}"] for n in model.factors)
        assert parts == pytest.approx(rate("a") - rate("p"))


def test_non_positive_calibration_zeroes_the_prediction(spark):
    model = permeability.second_model("quick")
    for pred in (-0.2, 0.0):
        _, frame = parents(spark, count=1, parent_pred=pred)
        r = permeability.factor_split(frame, model).first()
        assert {r[f"p_{n}"] for n in model.factors} == {0.0}


def test_missing_measures_count_as_zero(spark):
    _, frame = parents(spark, count=1, a_prepay_cnt=0.0, p_prepay_card_cnt=None)
    r = permeability.factor_split(frame, permeability.second_model("prepay")).first()
    assert r["a_prepay_card_rt"] == 0.0 and r["p_prepay_card_rt"] == 0.0


@pytest.mark.parametrize("code, root", [("prepay_card_rt", 3), ("prepay_credit_rt", 2)])
def test_third_level_caps_and_whole_change_on_zero(spark, code, root):
    rows, frame = parents(spark)
    model = THIRD[code]
    for r in permeability.factor_split(frame, model).collect():
        assert all(0 <= r[f"p_{n}"] <= 1 for n in model.factors)
    chain = model.chains[0]
    broken = {f"a_{m}": 0.0 for m in (model.factors[chain[-1]][0],)}
    _, frame = parents(spark, count=1, **broken)
    r = permeability.factor_split(frame, model).first()
    change = -math.prod(r[f"p_{n}"] for n in chain)
    assert r[f"g_{chain[-1]}"] == pytest.approx(change)
    # at this level the chain's first factor gets the change as well
    if code == "prepay_card_rt":
        assert r[f"g_{chain[0]}"] == pytest.approx(change)


def test_quick_new_modes(spark):
    _, frame = parents(spark, count=1)
    model = THIRD["quick_new_self_rt"]
    delta = permeability.factor_split(frame, model, "delta").first()
    chain = permeability.factor_split(frame, model, "chain").first()
    first, second = model.factors
    assert delta[f"g_{first}"] == pytest.approx(delta[f"a_{first}"] - delta[f"p_{first}"])
    assert chain[f"g_{first}"] + chain[f"g_{second}"] == pytest.approx(
        chain[f"a_{first}"] * chain[f"a_{second}"] - chain[f"p_{first}"] * chain[f"p_{second}"]
    )
    with pytest.raises(ValueError):
        permeability.factor_split(frame, model, "other")


def test_counter_split_adds_up(spark):
    measures = [f"{c}_{x}" for c in permeability.COUNTERS for x in ("amt", "self_amt")]
    row = {"period": "D", "usersource": "S", "bu": "B", "total_gap": 0.1}
    row |= {"a_rate": 0.0, "p_rate": 0.45, "g_rate": 0.03}
    rng = random.Random(1)
    for m in measures:
        row[f"a_{m}"], row[f"p_{m}"] = rng.uniform(1, 9), rng.uniform(1, 9)
    row["a_rate"] = sum(row[f"a_{c}_self_amt"] for c in permeability.COUNTERS) / sum(
        row[f"a_{c}_amt"] for c in permeability.COUNTERS
    )
    schema = ", ".join(
        f"{n} {'string' if n in ('period', 'usersource', 'bu') else 'double'}" for n in row
    )
    split = permeability.counter_split(table(spark, [row], schema))
    r = split.first()
    assert sum(
        r[f"p_{c}_share"] * r[f"p_{c}_rate"] for c in permeability.COUNTERS
    ) == pytest.approx(0.45)
    rows = permeability.with_contributions(permeability.counter_rows(split, C)).collect()
    assert len(rows) == 6
    assert sum(x["cts"] for x in rows) == pytest.approx(row["a_rate"] - 0.45)
    # the parts of a line's permeability add up to the line's own contribution
    assert sum(x["ctb"] for x in rows) == pytest.approx(0.03)


def test_every_factor_has_a_label_and_a_measure():
    names = {n for model in SECOND for n in model.factors}
    assert names == set(L.SECOND_LABELS)
    assert {n for m in THIRD.values() for n in m.factors} == set(L.THIRD_LABELS)
    assert set(MEASURES) <= set(funnel_measures(C))


def test_funnel_measures_on_one_day(spark):
    date = dt.date(2023, 6, 30)
    rows = [
        {"label_period": date, "label_a": "nocard_bind", "card_cnt": 5, "cnt_payonly": 2},
        {"label_period": date, "label_a": "nocard_nobind", "card_cnt": 3},
        {"label_period": date, "label_a": "havecard_other", "card_cnt": 7},
        {"label_period": date, "label_a": "activated", "paytype": "credit_line", "nqh_cnt": 4},
        {"label_period": date, "new_post_flag": "quick", "label_a": "quick_new", "cnt_payonly": 9},
        {"label_period": date, "self_amt_payonly": 10.0, "self_amt": 8.0},
    ]
    from ratiolens.operators.daily import aggregates

    r = make_fact(spark, rows).groupBy("usersource").agg(*aggregates(funnel_measures(C))).first()
    assert (r["nocard_entry"], r["nocard_bind_entry"], r["nocard_bind_submit"]) == (8, 5, 2)
    assert (r["havecard_entry"], r["active_entry"], r["quicknew_cnt"]) == (7, 4, 9)
    assert r["prepay_refund"] == 2.0
