"""Bounds and detection against pandas brute force, and their edge cases."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest

from ratiolens.codes import ORDER_CODES as C
from ratiolens.operators import bounds, detect
from ratiolens.operators.daily import daily, kpi_measures
from ratiolens.plans.learn import learn_bounds
from ratiolens.sources.fact import paired_windows
from tests.conftest import make_fact

DAY = dt.date(2023, 6, 30)
PREV = dt.date(2022, 6, 30)


def series_rows(end, days, seed, missing=(), no_card=()):
    """A daily series ending on ``end``: positions in ``missing`` have no row at all,
    those in ``no_card`` no high-rate card row."""
    rng = random.Random(seed)
    rows = []
    for back in range(days):
        if back in missing:
            continue
        date = end - dt.timedelta(days=back)
        amt = rng.uniform(5, 9)
        rows.append({"label_period": date, "amt": amt, "self_amt": amt * rng.uniform(0.3, 0.6)})
        if back not in no_card:
            rows.append(
                {
                    "label_period": date,
                    "amt": 1.0,
                    "self_amt": rng.uniform(0.2, 0.8),
                    "paycategory": C.high_rate_card,
                }
            )
    return rows


def frame(rows, end):
    data = pd.DataFrame(rows)
    if "paycategory" not in data:
        data["paycategory"] = "c1"
    data["high"] = data.self_amt.where(data.paycategory == C.high_rate_card)
    grouped = data.groupby("label_period")
    out = grouped[["amt", "self_amt"]].sum()
    out["highRate_amt"] = grouped["high"].sum(min_count=1)
    return out[(out.index <= end)].sort_index()


def rolled(a, b, num, k):
    """Both years' k-row rates on windows complete in all four columns (newest-first pairing)."""
    n = min(len(a), len(b))
    both = pd.DataFrame(
        {
            "an": a[num].to_numpy()[-n:],
            "aa": a["amt"].to_numpy()[-n:],
            "bn": b[num].to_numpy()[-n:],
            "ba": b["amt"].to_numpy()[-n:],
        }
    )
    sums = both.rolling(k).sum().dropna()
    return sums.an / sums.aa, sums.bn / sums.ba


def brute_bounds(a, b, num, day_from="oldest"):
    def z(x):
        x = np.asarray(pd.Series(x).dropna())
        return (x.mean() - 2 * x.std(), x.mean() + 2 * x.std()) if len(x) else (None, None)

    ts = []
    for side in (a, b):
        rate = side[num] / side["amt"]
        ts.append((rate / rate.rolling(7).mean()).dropna().to_numpy())
    n = min(map(len, ts))
    day = ts[0][:n] / ts[1][:n]
    if day_from == "newest":
        day = ts[0][len(ts[0]) - n :] / ts[1][len(ts[1]) - n :]
    ra, rb = rolled(a, b, num, 7)
    week = (ra / ra.shift(7)) / (rb / rb.shift(7))
    ra, _ = rolled(a, b, num, 30)
    return {"day": z(day), "week": z(week), "month": z(ra / ra.shift(30))}


def learn(spark, rows, **options):
    return learn_bounds(make_fact(spark, rows), str(DAY), C, **options).first()


@pytest.mark.parametrize(
    "cur, prev",
    [
        ({"days": 110}, {"days": 110}),
        ({"days": 110, "missing": {20, 50}}, {"days": 120}),
        ({"days": 120, "no_card": {15, 60}}, {"days": 110, "missing": {3}, "no_card": {70}}),
    ],
)
@pytest.mark.parametrize("options, day_from", [({}, "oldest"), ({"pair": "newest"}, "newest")])
def test_bounds_match_brute_force(spark, cur, prev, options, day_from):
    now, before = series_rows(DAY, seed=1, **cur), series_rows(PREV, seed=2, **prev)
    got = learn(spark, now + before, **options)
    for metric, num in bounds.METRICS.items():
        expected = brute_bounds(frame(now, DAY), frame(before, PREV), num, day_from)
        for horizon, (low, high) in expected.items():
            assert got[f"{metric}_{horizon}_bottom"] == pytest.approx(low, abs=6e-5)
            assert got[f"{metric}_{horizon}_top"] == pytest.approx(high, abs=6e-5)


def test_flat_series_has_a_point_interval(spark):
    rows = [
        {"label_period": end - dt.timedelta(days=i), "amt": 4.0, "self_amt": 1.0}
        for end in (DAY, PREV)
        for i in range(70)
    ]
    got = learn(spark, rows)
    for horizon in bounds.HORIZONS:
        assert got[f"self_rt_{horizon}_bottom"] == got[f"self_rt_{horizon}_top"] == 1.0
        assert got[f"highRate_rt_{horizon}_top"] is None


def test_source_without_samples_keeps_an_empty_row(spark):
    got = learn(spark, [{"label_period": DAY, "amt": 4.0, "self_amt": 1.0}])
    assert got["Usersource"] == "S" and got["self_rt_day_top"] is None


def test_pairing_from_the_oldest(spark):
    now, before = series_rows(DAY, 40, 1), series_rows(PREV, 45, 2)
    tagged = paired_windows(make_fact(spark, now + before), str(DAY), 295, C)
    series = bounds.metric_series(daily(tagged, (), kpi_measures(C)))
    got = {
        r["label_period"]: r["value"]
        for r in bounds.day_samples(series, "oldest").where("metric = 'self_rt'").collect()
        if r["value"] is not None
    }
    ts = []
    for f in (frame(now, DAY), frame(before, PREV)):
        rate = f.self_amt / f.amt
        ts.append((rate / rate.rolling(7).mean()).dropna())
    assert len(got) == 34
    for i, (date, t) in enumerate(ts[0].items()):
        assert got[date] == pytest.approx(t / ts[1].iloc[i])
    with pytest.raises(ValueError):
        bounds.day_samples(series, "middle")


NO_BOUNDS = (
    "Date string, Usersource string, "
    + ", ".join(
        f"{m}_{h}_{e} double"
        for m in bounds.METRICS
        for h in bounds.HORIZONS
        for e in ("bottom", "top")
    )
    + ", d string"
)


def detection(spark, rows, limits=()):
    tagged = paired_windows(make_fact(spark, rows), str(DAY), 299, C)
    saved = spark.createDataFrame(list(limits), NO_BOUNDS)
    series = detect.detection_series(daily(tagged, (), kpi_measures(C)), saved, C)
    return detect.flag_anomalies(series, str(DAY))


@pytest.mark.parametrize(
    "days, periods", [(6, ""), (7, "D"), (13, "D"), (14, "DW"), (59, "DW"), (60, "DWM")]
)
def test_periods_need_enough_history(spark, days, periods):
    rows = series_rows(DAY, days, 1) + series_rows(PREV, 90, 2)
    found = detection(spark, rows).collect()
    assert sorted(r["period"] for r in found) == sorted(periods)


@pytest.mark.parametrize("days, whole", [(21, True), (20, False)])
def test_week_predecessor_needs_21_rows(spark, days, whole):
    rows = series_rows(DAY, days, 1) + series_rows(PREV, 90, 2)
    week = detection(spark, rows).where("period = 'W'").first()
    assert (week["self_rt_qoq"] is not None) == whole


@pytest.mark.parametrize("days, whole", [(90, True), (89, False)])
def test_month_predecessor_needs_90_rows(spark, days, whole):
    rows = series_rows(DAY, days, 1) + series_rows(PREV, 120, 2)
    month = detection(spark, rows).where("period = 'M'").first()
    assert (month["self_rt_qoq"] is not None) == whole


def test_day_frame_leaves_out_young_rows(spark):
    """With 13 rows the newest date's frame is whole; with 12 the oldest kept rows cut it."""
    for days in (13, 12):
        now = series_rows(DAY, days, 1)
        got = detection(spark, now + series_rows(PREV, 90, 2)).where("period = 'D'").first()
        f = frame(now, DAY)
        rate = (f.self_amt / f.amt).to_numpy()[6:][-7:]
        assert len(rate) == days - 6
        assert got["self_rt_qy_value_numerator"] == pytest.approx(rate[-1] / rate.mean())


def test_week_values(spark):
    now, before = series_rows(DAY, 40, 1), series_rows(PREV, 40, 2)
    got = detection(spark, now + before).where("period = 'W'").first()
    ra, rb = rolled(frame(now, DAY), frame(before, PREV), "self_amt", 7)
    a, b = ra.to_numpy(), rb.to_numpy()
    assert got["this_year_self_rt"] == pytest.approx(a[-1])
    assert got["self_rt_yoy"] == pytest.approx(a[-1] / b[-1])
    assert got["self_rt_qy_value"] == pytest.approx((a[-1] / a[-8]) / (b[-1] / b[-8]))


def test_missing_bounds_flag_and_inside_does_not(spark):
    rows = series_rows(DAY, 100, 1) + series_rows(PREV, 100, 2)
    flags = {r["period"]: r["self_rt_flag"] for r in detection(spark, rows).collect()}
    assert flags == {"D": 1, "W": 1, "M": 1}
    wide = ("x", "S", *[v for _ in range(6) for v in (-100.0, 100.0)], "x")
    flags = {
        r["period"]: (r["self_rt_flag"], r["highRate_rt_flag"])
        for r in detection(spark, rows, [wide]).collect()
    }
    assert flags == {"D": (0, 0), "W": (0, 0), "M": (0, 0)}


def test_merged_moments_equal_one_pass(spark):
    """Parts of any size and order give mean and deviation of all samples, at 10 places."""
    import random

    from ratiolens.operators import moments

    rng = random.Random(12)
    rows = [(k, p, rng.gauss(1.0, s)) for k, s in (("wide", 0.2), ("narrow", 1e-4)) for p in range(40) for _ in range(rng.randint(0, 9))]
    rows += [("far", p, 1e8 + rng.random()) for p in range(30)] + [("one", 0, 0.7), ("gaps", 1, None), ("gaps", 2, 0.5)]
    samples = spark.createDataFrame(rows, "key string, part int, value double")
    parts = moments.moments(samples, ["key", "part"])
    found = {r.key: r for r in moments.merged(parts, ["key"]).collect()}
    for r in samples.groupBy("key").agg({"value": "count"}).collect():
        values = [v for k, _, v in rows if k == r.key and v is not None]
        mean = sum(values) / len(values)
        spread = (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5
        got = found[r.key]
        assert got.n == len(values)
        assert got.mean == pytest.approx(mean, rel=1e-12)
        assert (got.squares / got.n) ** 0.5 == pytest.approx(spread, abs=1e-10 if r.key != "far" else 1e-6)
    whole = {r.key: r for r in moments.intervals(moments.moments(samples, ["key"]), ["key"]).collect()}
    for r in moments.intervals(parts, ["key"]).collect():
        assert (r.bottom, r.top) == (whole[r.key].bottom, whole[r.key].top)
