"""The three runs end to end on small facts: drill-down rules, texts, saving."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from ratiolens.codes import ORDER_CODES, PRODUCTION_CODES
from ratiolens.plans import labels as L
from ratiolens.plans.analyse import analyse
from ratiolens.plans.detect import detect
from ratiolens.plans.learn import learn_bounds
from ratiolens.sources.fact import read_fact
from ratiolens.sources.results import (
    latest_bounds,
    read_bounds,
    save_partitions,
    save_partitions_to_path,
)
from tests.conftest import make_fact

DAY = dt.date(2023, 6, 30)
PREV = dt.date(2022, 6, 30)


def random_fact(spark, codes, lines=("east-1", "west"), seed=4, days=20):
    """Random orders with every counter, pay type and label, in the given spelling."""
    rng = random.Random(seed)
    c = codes
    rows = []
    for end in (DAY, PREV):
        for back in range(days):
            for _ in range(25):
                flag = rng.choice([c.prepay, c.quick, c.postpay])
                paytype = rng.choice([c.card, c.credit_line, c.other_own, "x"])
                label = {
                    c.quick: [c.quick_new, c.quick_old],
                    c.postpay: [c.post_new, c.post_old],
                }.get(
                    flag,
                    {
                        c.card: [
                            c.nocard_bind, c.nocard_nobind, c.havecard_bind,
                            c.havecard_default, c.havecard_change, c.havecard_other,
                        ],
                        c.credit_line: [c.noact_new, c.noact_other, c.activated],
                    }.get(paytype, ["other"]),
                )
                amt = rng.uniform(1, 9)
                own = int(paytype != "x")
                rows.append(
                    {
                        "label_period": end - dt.timedelta(days=back),
                        "period": c.day,
                        "usersource": rng.choice(["S1", "S2"]),
                        "bu": rng.choice(lines),
                        "platform": rng.choice([*c.platforms[:2], "p"]),
                        "paycategory": rng.choice([*c.channels[:2], c.high_rate_card]),
                        "new_post_flag": flag,
                        "paytype": paytype,
                        "label_a": rng.choice(label),
                        "amt": amt,
                        "self_amt": amt * own,
                        "self_amt_payonly": amt * own * 1.1,
                        "self_amt_refund": -amt * own * 0.1,
                        "amt_payonly": amt * 1.1,
                        "cnt_payonly": 1,
                        "self_cnt_payonly": own,
                        "card_cnt": rng.randint(1, 2),
                        "nqh_cnt": rng.randint(1, 2),
                        "quickpay_haveself_cnt_payonly": max(own, rng.randint(0, 1)),
                    }
                )
    return make_fact(spark, rows)


@pytest.fixture(scope="module")
def analysis(spark):
    table = analyse(random_fact(spark, ORDER_CODES), str(DAY), ORDER_CODES, ("D", "W"))
    return table.collect()


def test_every_source_and_period_has_every_upper_layer(analysis):
    for source in ("S1", "S2"):
        for period in ("D", "W"):
            rows = [r for r in analysis if (r["Usersource"], r["Period"]) == (source, period)]
            texts = [r for r in rows if r["Conclusion"] is not None]
            for layer in (L.LAYER_TOTAL, L.LAYER_SPECIAL, L.LAYER_BU, L.LAYER_STRUCTURE):
                assert sum(r["Layer"] == layer for r in texts) == 1
            assert sum(r["Layer"] == L.CONCLUSION for r in rows) == 1
            lines = [r for r in rows if r["Layer"] == L.LAYER_BU and r["Conclusion"] is None]
            assert len(lines) == 4


def test_drill_down_follows_the_top_three(analysis):
    """Each deeper layer appears exactly for the chosen parents; names may hold a dash."""
    for source in ("S1", "S2"):
        for period in ("D", "W"):
            rows = [
                r
                for r in analysis
                if (r["Usersource"], r["Period"]) == (source, period) and r["Conclusion"] is None
            ]

            def layer(name, rows=rows):
                return [r for r in rows if r["Layer"] == name]

            top = sorted(layer(L.LAYER_BU), key=lambda r: -r["CTBRatio"])[:3]
            lines = {r["Element"] for r in top if r["CTBRatio"] > 0 and r["Indicator"] == "渗透率"}
            shares = {r["Element"] for r in top if r["CTBRatio"] > 0 and r["Indicator"] != "渗透率"}
            first = layer(L.LAYER_FIRST)
            assert {r["Indicator"].rsplit("-", 1)[0] for r in first} == lines
            assert {r["Indicator"].rsplit("-", 1)[0] for r in layer(L.LAYER_STRUCTURE)} == shares
            expected = set()
            for line in lines:
                inside = [r for r in first if r["Indicator"].startswith(line + "-")]
                assert len(inside) == 6
                best = sorted(inside, key=lambda r: -r["CTBRatio"])[:3]
                expected |= {f"{line}-{r['Element']}" for r in best if "渗透率" in r["Indicator"]}
            assert {r["Indicator"] for r in layer(L.LAYER_SECOND)} == expected


def test_contributions_add_up_along_the_tree(analysis):
    rows = [r for r in analysis if r["Conclusion"] is None]
    for r in rows:
        if r["Layer"] != L.LAYER_BU or r["Indicator"] != "渗透率":
            continue
        below = [
            x
            for x in rows
            if x["Layer"] == L.LAYER_FIRST
            and (x["Usersource"], x["Period"]) == (r["Usersource"], r["Period"])
            and x["Indicator"].startswith(r["Element"] + "-")
        ]
        if below:
            assert sum(x["CTB"] for x in below) == pytest.approx(r["CTB"])


def test_summary_holds_the_other_texts(analysis):
    for r in analysis:
        if r["Layer"] == L.CONCLUSION:
            texts = [
                x["Conclusion"]
                for x in analysis
                if x["Conclusion"] and x["Layer"] != L.CONCLUSION
                and (x["Usersource"], x["Period"]) == (r["Usersource"], r["Period"])
            ]
            assert all(t in r["Conclusion"] for t in texts)
            assert r["Conclusion"].startswith(f"{DAY} {r['Period']} self_rt\n异动总结: \n\n自有支付占比的预测值为")


def test_production_spelling_gives_the_same_numbers(spark, analysis):
    """The profile changes names only."""
    table = analyse(random_fact(spark, PRODUCTION_CODES), str(DAY), PRODUCTION_CODES, ("日",))
    numbers = sorted(
        round(r["Actual"], 9)
        for r in table.collect()
        if r["Layer"] == L.LAYER_BU and r["Actual"] is not None
    )
    assert numbers == sorted(
        round(r["Actual"], 9)
        for r in analysis
        if r["Layer"] == L.LAYER_BU and r["Period"] == "D" and r["Actual"] is not None
    )


def test_no_gap_chooses_no_branch(spark):
    """Equal years: no ratio exists, nothing is drilled into, every text still comes out."""
    rows = []
    for end in (DAY, PREV):
        for back in range(7):
            for bu in ("x", "y"):
                rows.append(
                    {
                        "label_period": end - dt.timedelta(days=back), "bu": bu,
                        "amt": 4.0, "self_amt": 1.0, "self_amt_payonly": 1.0,
                    }
                )
    got = analyse(make_fact(spark, rows), str(DAY), ORDER_CODES, ("D",)).collect()
    assert {r["Layer"] for r in got} == {
        L.LAYER_TOTAL, L.LAYER_SPECIAL, L.LAYER_BU, L.LAYER_STRUCTURE, L.CONCLUSION,
    }
    assert all(r["CTBRatio"] is None for r in got if r["Layer"] == L.LAYER_BU)
    assert "nan%" in next(r["Conclusion"] for r in got if r["Layer"] == L.CONCLUSION)


def test_one_line_lists_fewer_than_three(spark):
    fact = random_fact(spark, ORDER_CODES, lines=("only",), days=8)
    got = analyse(fact, str(DAY), ORDER_CODES, ("D",), bu_text="pred").collect()
    text = next(r for r in got if r["Layer"] == L.LAYER_BU and r["Conclusion"])["Conclusion"]
    assert text.count("only的") == 2
    with pytest.raises(ValueError):
        analyse(fact, str(DAY), ORDER_CODES, ("D",), bu_text="other")


# ------------------------------------------------------------------- saving


def test_saving_a_day_keeps_the_others(spark, tmp_path):
    def day(d, value):
        return spark.createDataFrame([(value, d)], "v int, d string")

    for save, read in (
        (lambda df: save_partitions(df, "saved_days"), lambda: spark.table("saved_days")),
        (
            lambda df: save_partitions_to_path(df, str(tmp_path / "days")),
            lambda: spark.read.schema("v int, d string").parquet(str(tmp_path / "days")),
        ),
    ):
        save(day("2023-06-29", 1))
        save(day("2023-06-30", 2))
        save(day("2023-06-30", 3))
        assert sorted((r["d"], r["v"]) for r in read().collect()) == [
            ("2023-06-29", 1),
            ("2023-06-30", 3),
        ]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_sessions_save_days_side_by_side(spark, tmp_path, monkeypatch):
    """Writes of other days at once, from two sessions; nothing in a session is switched."""
    from concurrent.futures import ThreadPoolExecutor

    first = spark.createDataFrame([(0, "2023-06-01")], "v int, d string")
    save_partitions(first, "side_by_side", str(tmp_path / "side"))
    monkeypatch.setattr(type(spark.conf), "set", lambda *a: pytest.fail("a setting was changed"))

    def run(session, days):
        for n, day in enumerate(days):
            rows = session.range(500).selectExpr(f"cast({n} AS int) AS v", f"'2023-07-{day:02}' AS d")
            save_partitions(rows, "side_by_side")
        return session

    jobs = [(spark.newSession(), range(1, 7)), (spark.newSession(), range(7, 13))]
    with ThreadPoolExecutor(2) as pool:
        sessions = [f.result() for f in [pool.submit(run, *job) for job in jobs]]
    for session in (spark, *sessions):
        session.catalog.refreshTable("side_by_side")
        counts = {r.d: r["count"] for r in session.table("side_by_side").groupBy("d").count().collect()}
        assert counts == {"2023-06-01": 1} | {f"2023-07-{day:02}": 500 for day in range(1, 13)}


def test_saving_takes_the_table_types_and_names(spark):
    save_partitions(spark.createDataFrame([("a", 1.5, "2023-06-29")], "t string, v double, d string"), "typed")
    save_partitions(spark.createDataFrame([("2023-06-30", 7, "b")], "d string, v int, t string"), "typed")
    assert sorted(map(tuple, spark.table("typed").collect())) == [
        ("a", 1.5, "2023-06-29"), ("b", 7.0, "2023-06-30"),
    ]
    spark.sql("CREATE TABLE text_days (v string, d string) USING csv PARTITIONED BY (d)")
    with pytest.raises(ValueError, match="stored as csv"):
        save_partitions(spark.createDataFrame([("a", "2023-06-29")], "v string, d string"), "text_days")


def late_fact(spark, folder, codes=ORDER_CODES):
    """A stored fact, its late rows (arriving three days on), and all of it with true dates."""
    from pyspark.sql import functions as F

    fact = random_fact(spark, codes, days=40).withColumn("late", F.col("paycategory") == codes.channels[0])
    fact = fact.cache()
    fact.where("NOT late").drop("late").write.partitionBy("d").parquet(f"{folder}/fact")
    late = fact.where("late").drop("late").withColumn("d", F.date_add("d", 3))
    return late, fact.drop("late")


def kpi_rows(tagged):
    from ratiolens.operators.daily import daily, kpi_measures

    rows = daily(tagged, (), kpi_measures(ORDER_CODES)).collect()
    return {(r.side, r.usersource, r.label_period): (r.amt, r.self_amt, r.highRate_amt) for r in rows}


def test_series_is_kept_up_with_late_rows(spark, tmp_path):
    """Merged and full sums are equal; only partitions with new rows are summed again."""
    from ratiolens.sources import series
    from ratiolens.sources.fact import paired_windows

    folder = str(tmp_path)
    late, everything = late_fact(spark, folder)

    def read():
        return read_fact(spark, path=f"{folder}/fact")

    first = series.update(read(), f"{folder}/series")
    assert len(first) == 80 and series.update(read(), f"{folder}/series") == []
    late.where(f"label_period = DATE'{DAY}'").write.mode("append").partitionBy("d").parquet(f"{folder}/fact")
    assert series.update(read(), f"{folder}/series") == [DAY + dt.timedelta(days=3)]
    late.where(f"label_period <> DATE'{DAY}'").write.mode("append").partitionBy("d").parquet(f"{folder}/fact")
    again = series.update(read(), f"{folder}/series")
    assert 0 < len(again) <= 80
    kept = series.read_series(spark, f"{folder}/series", read())
    got = kpi_rows(paired_windows(kept, str(DAY), 30, ORDER_CODES, "label_period"))
    want = kpi_rows(paired_windows(everything, str(DAY), 30, ORDER_CODES, "label_period"))
    assert got.keys() == want.keys() and len(got) > 100
    for key, values in want.items():
        assert got[key] == pytest.approx(values)
    bounds = learn_bounds(kept, str(DAY), ORDER_CODES, date_column="label_period").collect()
    full = learn_bounds(everything, str(DAY), ORDER_CODES, date_column="label_period").collect()
    assert {r["Usersource"]: r["self_rt_day_top"] for r in bounds} == pytest.approx(
        {r["Usersource"]: r["self_rt_day_top"] for r in full}, abs=2e-4
    )
    series.refresh(read(), f"{folder}/series", [DAY])  # named by hand: the same sums again
    kept = series.read_series(spark, f"{folder}/series", read())
    again = kpi_rows(paired_windows(kept, str(DAY), 30, ORDER_CODES, "label_period"))
    assert again.keys() == got.keys() and all(again[k] == pytest.approx(got[k]) for k in got)


def test_business_dates_prune_with_a_map(spark, tmp_path):
    """The map's partitions reach the scan of the fact as a dynamic filter; results are the same."""
    from ratiolens.sources import series
    from ratiolens.sources.fact import paired_windows

    folder = str(tmp_path)
    late, everything = late_fact(spark, folder)
    late.write.mode("append").partitionBy("d").parquet(f"{folder}/fact")
    fact = read_fact(spark, path=f"{folder}/fact")
    series.update(fact, f"{folder}/series")
    held = series.read_series(spark, f"{folder}/series", fact)
    pruned = paired_windows(fact, str(DAY), 5, ORDER_CODES, "label_period", held)
    got = kpi_rows(pruned)
    want = kpi_rows(paired_windows(everything, str(DAY), 5, ORDER_CODES, "label_period"))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    counted = pruned.groupBy("side").count()
    counted.collect()
    plan = counted._jdf.queryExecution().executedPlan()
    scan = next(x for x in plan.toString().splitlines() if "FileScan" in x and "usersource" not in x.split("PartitionFilters")[0])
    assert "dynamicpruning" in scan.split("PartitionFilters")[1]
    rows = counted._jdf.queryExecution().executedPlan().toString()
    assert "SubqueryBroadcast" in rows or "SubqueryAdaptiveBroadcast" in rows


def test_learn_save_detect_analyse(spark):
    fact = random_fact(spark, ORDER_CODES, days=100)
    for run in (DAY - dt.timedelta(days=3), DAY - dt.timedelta(days=1)):
        save_partitions(learn_bounds(fact, str(run), ORDER_CODES), "kept_bounds")
    newest = read_bounds(spark, "kept_bounds", str(DAY)).collect()
    assert {r["d"] for r in newest} == {str(DAY - dt.timedelta(days=1))} and len(newest) == 2
    older = latest_bounds(spark.table("kept_bounds"), str(DAY - dt.timedelta(days=2)))
    assert {r["d"] for r in older.collect()} == {str(DAY - dt.timedelta(days=3))}

    flags = detect(fact, spark.table("kept_bounds"), str(DAY), ORDER_CODES)
    save_partitions(flags, "kept_flags")
    rows = spark.table("kept_flags").collect()
    assert len(rows) == 6
    for r in rows:
        inside = r["self_rt_bottom"] <= r["self_rt_qy_value"] <= r["self_rt_top"]
        assert r["self_rt_flag"] == (0 if inside else 1)
    save_partitions(analyse(fact, str(DAY), ORDER_CODES, ("W",)), "kept_analysis")
    assert spark.table("kept_analysis").where(f"d = '{DAY}'").count() > 0


def test_partitioned_fact_is_pruned(spark, tmp_path):
    """The date range reaches the scan as a partition filter; unused columns are not read."""
    random_fact(spark, ORDER_CODES).write.partitionBy("d").parquet(str(tmp_path / "fact"))
    fact = read_fact(spark, path=str(tmp_path / "fact"))
    plan = learn_bounds(fact, str(DAY), ORDER_CODES)._jdf.queryExecution().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    assert "PartitionFilters: [" in scan and "d#" in scan.split("PartitionFilters: [")[1]
    assert "nqh_cnt" not in scan and "platform" not in scan


def test_catalog_table_with_text_dates_and_decimals(spark):
    """Other types in the catalog give the same bounds, and text partitions still prune."""
    fact = random_fact(spark, ORDER_CODES, days=40)
    stored = fact.selectExpr(
        *[
            f"cast({c} AS string) AS {c}" if c in ("d", "label_period")
            else f"cast({c} AS decimal(38, 6)) AS {c}" if "amt" in c and "cnt" not in c
            else c
            for c in fact.columns
        ]
    )
    stored.write.partitionBy("d").format("parquet").saveAsTable("stored_fact")
    learned = learn_bounds(read_fact(spark, table="stored_fact"), str(DAY), ORDER_CODES)
    plan = learned._jdf.queryExecution().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    assert "d#" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    got = {r["Usersource"]: r for r in learned.collect()}
    for row in learn_bounds(fact, str(DAY), ORDER_CODES).collect():
        for name in ("self_rt_day_top", "self_rt_week_bottom", "highRate_rt_day_bottom"):
            assert got[row["Usersource"]][name] == pytest.approx(row[name], abs=2e-4)


def test_business_date_range(spark):
    """By business date a late row counts, by partition date it does not."""
    rows = [
        {"label_period": DAY - dt.timedelta(days=i), "d": DAY + dt.timedelta(days=9)}
        | {"amt": 4.0, "self_amt": 1.0}
        for i in range(20)
    ]
    fact = make_fact(spark, rows)
    by_date = learn_bounds(fact, str(DAY), ORDER_CODES, date_column="label_period")
    assert by_date.count() == 1
    assert learn_bounds(fact, str(DAY), ORDER_CODES).count() == 0


def test_staged_run_removes_its_folder(spark):
    from ratiolens.sources.staging import stage, staged_run

    with staged_run(spark) as folder:
        kept = stage(spark.range(5), "numbers")
        assert kept.inputFiles()[0].split("file:")[-1].lstrip("/").startswith(folder.lstrip("/"))
        assert kept.count() == 5
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    assert not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def test_lines_are_picked_before_their_leaves_are_read(spark):
    """A fact with a thousand lines: leaves and funnel aggregate below a semi-join with the picks."""
    from ratiolens.plans import analyse as A
    from ratiolens.sources import staging

    rows = [
        {
            "label_period": end - dt.timedelta(days=k),
            "period": ORDER_CODES.day,
            "bu": f"line{n}",
            "amt": 10.0 + n % 7,
            "self_amt": 4.0 + (n % 5) * (end.year % 2) + (n == 3 and k == 0 and end == DAY) * 900.0,
        }
        for n in range(1000)
        for end in (DAY, DAY.replace(year=DAY.year - 1))
        for k in range(2)
    ]
    plans = {}
    staging.watchers.append(
        lambda df: plans.update({len(plans): df._jdf.queryExecution().optimizedPlan().toString()})
    )
    try:
        detail = A.drill_down(make_fact(spark, rows), str(DAY), ORDER_CODES, (ORDER_CODES.day,))
    finally:
        staging.watchers.pop()
    # one staged plan serves both: baseline windows above, the semi-join with the picks below
    (deep,) = [plan for plan in plans.values() if "LeftSemi" in plan]
    assert deep.index("Window") < deep.index("LeftSemi")
    lines = {r.line for r in detail.where(f"layer = '{L.LAYER_STRUCTURE}'").collect()}
    assert len(lines) <= A.TOP
    found = {r.line for r in detail.where(f"layer = '{L.LAYER_FIRST}'").collect()}
    assert 0 < len(found) <= A.TOP
