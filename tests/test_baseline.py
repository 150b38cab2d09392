"""Seasonal baseline against a pandas brute force, and its edge cases."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest

from ratiolens.codes import ORDER_CODES as C
from ratiolens.operators.baseline import indicator, level_baseline
from ratiolens.operators.daily import kpi_measures
from ratiolens.sources.fact import paired_windows
from tests.conftest import make_fact

DAY = dt.date(2024, 3, 10)
PREV = dt.date(2023, 3, 10)
SPAN = {"D": 6, "W": 13, "M": 59}


def brute(rows, key, period, measure):
    """(actual, expected) by positional slices of the two daily series."""
    frame = pd.DataFrame(rows)
    if key is not None:
        frame = frame[frame.bu == key]

    def series(end):
        inside = frame[
            (frame.label_period <= end)
            & (frame.label_period >= end - dt.timedelta(days=SPAN[period]))
        ]
        return inside.groupby("label_period")[measure].sum().sort_index().to_numpy()

    a, b = series(DAY), series(PREV)
    if period == "D":
        head_a, head_b, tail = a[:-1].sum(), b[:-1].sum(), 1
    else:
        k = 7 if period == "W" else 30
        head_a, head_b, tail = a[:k].sum(), b[:k].sum(), k
    actual = a[-tail:].mean() if len(a) else None
    if not len(a) or not len(b) or head_b == 0:
        return actual, None
    return actual, b[-tail:].mean() * head_a / head_b


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for end in (DAY, PREV):
        for back in range(60):
            for bu in ("B1", "B2", "B3", None):
                if rng.random() < 0.55:
                    amt = rng.uniform(1, 9)
                    rows.append(
                        {
                            "label_period": end - dt.timedelta(days=back),
                            "bu": bu,
                            "amt": amt,
                            "self_amt": amt * rng.random(),
                        }
                    )
    return rows


@pytest.fixture(scope="module")
def computed(spark):
    rows = random_rows(3)
    # a line of this year only, one of last year only, one with a single row last year
    rows += [{"label_period": DAY, "bu": "new", "amt": 2.0, "self_amt": 1.0}]
    rows += [{"label_period": PREV, "bu": "gone", "amt": 2.0, "self_amt": 1.0}]
    rows += [
        {"label_period": DAY, "bu": "thin", "amt": 4.0, "self_amt": 1.0},
        {"label_period": DAY - dt.timedelta(days=1), "bu": "thin", "amt": 4.0, "self_amt": 1.0},
        {"label_period": PREV, "bu": "thin", "amt": 5.0, "self_amt": 1.0},
    ]
    tagged = paired_windows(make_fact(spark, rows), str(DAY), 59, C)
    base = level_baseline(tagged, str(DAY), C, [(), ("bu",)], kpi_measures(C)).collect()
    return rows, {(r["period"], r["level"], r["bu"]): r for r in base}


@pytest.mark.parametrize("period", ["D", "W", "M"])
@pytest.mark.parametrize("key", [None, "B1", "B2", "B3", "new", "thin"])
def test_matches_brute_force(computed, period, key):
    rows, got = computed
    row = got[(period, "bu" if key else "total", key)]
    for measure in ("amt", "self_amt"):
        actual, pred = brute(rows, key, period, measure)
        assert row[f"a_{measure}"] == pytest.approx(actual)
        if pred is None:
            assert row[f"p_{measure}"] is None
        else:
            assert row[f"p_{measure}"] == pytest.approx(pred)


def test_groups_of_one_year(computed):
    _, got = computed
    assert got[("D", "bu", "gone")]["a_amt"] is None
    assert got[("D", "bu", "gone")]["p_amt"] is None
    assert got[("D", "bu", "gone")]["n_cur"] == 0
    assert got[("D", "bu", "new")]["p_amt"] is None


def test_null_key_counts_in_the_total_only(computed):
    _, got = computed
    assert ("D", "bu", None) not in got
    assert ("D", "total", None) in got


def test_leap_day_pairs_with_the_28th(spark):
    rows = [
        {"label_period": dt.date(2024, 2, 29), "amt": 10.0, "self_amt": 5.0},
        {"label_period": dt.date(2024, 2, 28), "amt": 10.0, "self_amt": 5.0},
        {"label_period": dt.date(2023, 2, 28), "amt": 8.0, "self_amt": 2.0},
        {"label_period": dt.date(2023, 2, 27), "amt": 8.0, "self_amt": 4.0},
        {"label_period": dt.date(2023, 3, 1), "amt": 99.0, "self_amt": 99.0},
    ]
    tagged = paired_windows(make_fact(spark, rows), "2024-02-29", 6, C)
    base = level_baseline(tagged, "2024-02-29", C, [()], kpi_measures(C), ("D",))
    row = indicator(base).first()
    assert row["actual"] == pytest.approx(0.5)
    # amount 8 * 10/8, own 2 * 5/4
    assert row["pred"] == pytest.approx(2.5 / 10)


def test_range_is_on_the_partition_date(spark):
    """A late row reports an old business date under a partition inside the range."""
    rows = [
        {"label_period": DAY, "amt": 1.0},
        {"label_period": DAY - dt.timedelta(days=90), "d": DAY, "amt": 7.0},
    ]
    tagged = paired_windows(make_fact(spark, rows), str(DAY), 6, C)
    row = level_baseline(tagged, str(DAY), C, [()], kpi_measures(C), ("D",)).first()
    assert row["n_cur"] == 2


def test_a_long_lookback_counts_days_on_both_sides(spark):
    rows = [{"label_period": DAY - dt.timedelta(days=k), "amt": 1.0} for k in (0, 390, 500)]
    tagged = paired_windows(make_fact(spark, rows), str(DAY), 400, C)
    sides = sorted((r.side, (DAY - r.label_period).days) for r in tagged.collect())
    assert sides == [("cur", 0), ("cur", 390), ("prev", 390), ("prev", 500)]
    with pytest.raises(ValueError):
        paired_windows(make_fact(spark, []), str(DAY), -1, C)
