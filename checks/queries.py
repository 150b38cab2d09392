"""The registered queries: every operator on the fact table derived from the order tables.

Ratios are rounded to 6 places and amounts to 4, so that results compare across
engines; dates come out as text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratiolens.codes import ORDER_CODES as C
from ratiolens.operators import (
    adtributor,
    bounds,
    business,
    detect,
    moments,
    permeability,
    special,
)
from ratiolens.operators import daily as D
from ratiolens.operators.baseline import indicator, level_baseline
from ratiolens.operators.permeability import lmdi_split, with_contributions
from ratiolens.plans import analyse as A
from ratiolens.plans import labels as L
from ratiolens.plans.detect import LOOKBACK as DETECT_BACK
from ratiolens.plans.detect import detect as run_detection
from ratiolens.plans.learn import LOOKBACK as LEARN_BACK
from ratiolens.plans.learn import learn_bounds
from ratiolens.sources import series
from ratiolens.sources.fact import (
    AMOUNTS,
    DIMENSIONS,
    MEASURES,
    compact,
    paired_windows,
    read_fact,
)
from ratiolens.sources.order_fact import order_fact
from ratiolens.sources.results import (
    latest_bounds,
    read_bounds,
    save_partitions,
    save_partitions_to_path,
)
from ratiolens.sources.staging import shared_folder, stage

DAY = "2000-06-13"
EARLIER_DAYS = ("2000-06-09", "2000-06-11")
BACK = 59


def r6(column: str) -> str:
    """Six places; the nudge keeps means and quotients off exact ties, where engines differ."""
    return f"round({column} + 0.0000000317D, 6)"


def r4(column: str) -> str:
    """Four places, nudged likewise."""
    return f"round({column} + 0.00000317D, 4)"


def fine(column: str) -> str:
    """Six places, and twelve for values near zero, such as the inverse of an amount."""
    return (
        f"CASE WHEN abs({column}) < 1e-4 THEN "
        f"round({column} * 1000000D + 0.0000000317D, 6) / 1000000D ELSE {r6(column)} END"
    )


Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def shaped(
    df: DataFrame,
    keys: list[str],
    ratios: list[str] = (),
    amounts: list[str] = (),
    counts: list[str] = (),
    fines: list[str] = (),
) -> DataFrame:
    dates = ("label_period", "prev_label_period", "d")
    return df.selectExpr(
        *[f"cast({k} AS string) AS {k}" if k in dates else k for k in keys],
        *[f"{r6(c)} AS {c}" for c in ratios],
        *[f"{fine(c)} AS {c}" for c in fines],
        *[f"{r4(c)} AS {c}" for c in amounts],
        *[f"cast({c} AS bigint) AS {c}" for c in counts],
    )


def tagged(spark: SparkSession, sf: str, back: int = BACK, day: str = DAY) -> DataFrame:
    return paired_windows(order_fact(spark, sf, [(day, back)]), day, back, C)


def kpi(spark: SparkSession, sf: str, back: int) -> DataFrame:
    return D.daily(tagged(spark, sf, back), (), D.kpi_measures(C))


# ------------------------------------------------------------ daily aggregates

KPI = ["amt", "self_amt", "highRate_amt"]
SERIES = ["side", "usersource", "label_period"]


@query
def daily_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return shaped(kpi(spark, sf, LEARN_BACK), SERIES, amounts=KPI)


@query
def base_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """The compacted fact: one row per date and dimension combination."""
    rows = compact(tagged(spark, sf), DIMENSIONS)
    keys = ["period", *SERIES, "d", *DIMENSIONS]
    return shaped(rows, keys, amounts=list(MEASURES[:5]), counts=list(MEASURES[5:]))


@query
def special_daily(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.daily(tagged(spark, sf), ("paycategory", "platform"), D.special_measures())
    return shaped(rows, [*SERIES, "paycategory", "platform"], amounts=list(D.special_measures()))


@query
def bu_daily(spark: SparkSession, sf: str) -> DataFrame:
    return shaped(
        D.daily(tagged(spark, sf), ("bu",), D.kpi_measures(C)), [*SERIES, "bu"], amounts=KPI
    )


@query
def structure_daily(spark: SparkSession, sf: str) -> DataFrame:
    dims = ("bu", *adtributor.DIMS)
    rows = D.daily(tagged(spark, sf), dims, D.kpi_measures(C))
    return shaped(rows, [*SERIES, *dims], amounts=KPI)


@query
def counter_daily(spark: SparkSession, sf: str) -> DataFrame:
    measures = D.counter_measures(C)
    rows = D.daily(tagged(spark, sf), ("bu",), measures)
    return shaped(rows, [*SERIES, "bu"], amounts=list(measures))


@query
def sec_daily(spark: SparkSession, sf: str) -> DataFrame:
    measures = D.second_measures(C)
    counts = [m for m in measures if m.endswith("_cnt")]
    amounts = [m for m in measures if m not in counts]
    rows = D.daily(tagged(spark, sf), ("bu",), measures)
    return shaped(rows, [*SERIES, "bu"], amounts=amounts, counts=counts)


@query
def thd_daily(spark: SparkSession, sf: str) -> DataFrame:
    measures = D.third_measures(C)
    rows = D.daily(tagged(spark, sf), ("bu",), measures)
    return shaped(rows, [*SERIES, "bu"], counts=list(measures))


# ----------------------------------------------------------- bounds, detection


@query
def year_pair(spark: SparkSession, sf: str) -> DataFrame:
    pairs = detect.paired_kpi(kpi(spark, sf, DETECT_BACK))
    return shaped(
        pairs,
        ["usersource", "label_period", "prev_label_period"],
        amounts=[f"{side}_{n}" for side in ("cur", "prev") for n in KPI],
        counts=["rk", "age"],
    )


@query
def rolling_7_30(spark: SparkSession, sf: str) -> DataFrame:
    rolled = detect.rolling_sums(detect.paired_kpi(kpi(spark, sf, DETECT_BACK)))
    sums = [f"{side}_{n}_{k}" for k in (7, 30) for side in ("cur", "prev") for n in KPI]
    return shaped(rolled, ["usersource", "label_period"], amounts=sums)


@query
def qoq_leads(spark: SparkSession, sf: str) -> DataFrame:
    pairs = detect.paired_kpi(kpi(spark, sf, DETECT_BACK))
    rates = detect.horizon_rates(detect.rolling_sums(pairs))
    names = [
        f"{metric}_{horizon}_{side}{part}"
        for metric in bounds.METRICS
        for horizon in bounds.HORIZONS
        for side in ("cur", "prev")
        for part in ("", "_before")
    ]
    return shaped(rates, ["usersource", "label_period"], ratios=names)


def _samples(make: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        samples = make(bounds.metric_series(kpi(spark, sf, LEARN_BACK)))
        return shaped(
            samples.where("value IS NOT NULL"),
            ["usersource", "metric", "horizon", "label_period"],
            ratios=["value"],
        )

    return run


REGISTRY["bounds_day"] = _samples(bounds.day_samples)
REGISTRY["bounds_week"] = _samples(bounds.week_samples)
REGISTRY["bounds_month"] = _samples(bounds.month_samples)
REGISTRY["bounds_day_oldest"] = _samples(lambda s: bounds.day_samples(s, pair="oldest"))
REGISTRY["bounds_week_oldest"] = _samples(lambda s: bounds.week_samples(s, pair="oldest"))
REGISTRY["bounds_month_double"] = _samples(
    lambda s: bounds.month_samples(s, month_bound="double_ratio")
)


@query
def zscore_bounds(spark: SparkSession, sf: str) -> DataFrame:
    samples = bounds.all_samples(kpi(spark, sf, LEARN_BACK)).where("value IS NOT NULL")
    return bounds.zscore_bounds(samples, ["usersource", "metric", "horizon"])


def _learned(spark: SparkSession, sf: str, day: str = DAY) -> DataFrame:
    return learn_bounds(order_fact(spark, sf, [(day, LEARN_BACK)]), day, C)


@query
def bounds_table(spark: SparkSession, sf: str) -> DataFrame:
    return _learned(spark, sf)


@query
def merged_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Intervals from stored moments of each month, the newest month stored a second time."""
    keys = ["usersource", "metric", "horizon"]
    sums = stage(kpi(spark, sf, LEARN_BACK), "kpi")
    samples = bounds.all_samples(sums).where("value IS NOT NULL")
    samples = stage(
        samples.withColumn("d", F.date_format("label_period", "yyyy-MM")), "samples"
    )
    folder = _new_folder(spark, "moments")
    early = samples.where(f"label_period <= DATE'{EARLIER_DAYS[0]}'")
    for known in (early, samples.where(f"d >= '{DAY[:7]}'")):
        save_partitions_to_path(moments.moments(known, [*keys, "d"]), folder)
    parts = spark.read.schema(moments.moments(samples, [*keys, "d"]).schema).parquet(folder)
    return moments.intervals(parts, keys)


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/ratiolens/{name}-{uuid.uuid4().hex}"


def _latest_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds of two days saved by day, one day written twice; the newer day wins."""
    path = _new_folder(spark, "bounds")
    for day in EARLIER_DAYS:
        learned = _learned(spark, sf, day)
        save_partitions_to_path(learned, path)
    save_partitions_to_path(learned, path)
    return latest_bounds(spark.read.schema(learned.schema).parquet(path), DAY)


REGISTRY["latest_bounds"] = _latest_bounds


DETECT_RATIOS = [
    column
    for metric in bounds.METRICS
    for column in (
        f"this_year_{metric}",
        f"{metric}_qoq",
        f"{metric}_yoy",
        f"{metric}_qy_value",
        f"{metric}_top",
        f"{metric}_bottom",
        f"{metric}_qy_value_numerator",
        f"{metric}_qy_value_denominator",
    )
]


def _shared_kpi(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sums per source and category over the longer lookback: a few rows a day.

    They keep the fact's columns, so learning and detection both run on them and
    the order tables are read once.
    """
    return stage(
        compact(order_fact(spark, sf, [(DAY, DETECT_BACK)]), ("paycategory",), ("amt", "self_amt")),
        "kpi",
    )


def _detection(spark: SparkSession, sf: str) -> DataFrame:
    shared = _shared_kpi(spark, sf)
    series = D.daily(paired_windows(shared, DAY, DETECT_BACK, C), (), D.kpi_measures(C))
    return detect.detection_series(series, latest_bounds(learn_bounds(shared, DAY, C), DAY), C)


def _detect_period(period: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = _detection(spark, sf).where(f"period = '{period}'")
        return shaped(rows, ["label_period", "usersource", "period"], ratios=DETECT_RATIOS)

    return run


REGISTRY["detect_day"] = _detect_period(C.day)
REGISTRY["detect_week"] = _detect_period(C.week)
REGISTRY["detect_month"] = _detect_period(C.month)


@query
def detect_flags(spark: SparkSession, sf: str) -> DataFrame:
    flags = [f"{metric}_flag" for metric in bounds.METRICS]
    rows = detect.flag_anomalies(_detection(spark, sf), DAY)
    return shaped(
        rows, ["label_period", "usersource", "period", "d"], ratios=DETECT_RATIOS, counts=flags
    )


@query
def saved_flags(spark: SparkSession, sf: str) -> DataFrame:
    """The runs as users call them: bounds saved on two earlier days, flags of two days, one twice.

    Each day is judged by the newest bounds saved up to it.
    """
    folder = _new_folder(spark, "runs")
    shared = _shared_kpi(spark, sf)
    for day in EARLIER_DAYS:
        save_partitions_to_path(learn_bounds(shared, day, C), f"{folder}/bounds")
    saved = spark.read.parquet(f"{folder}/bounds").withColumn("d", F.col("d").cast("string"))
    for day in ("2000-06-12", DAY, DAY):
        save_partitions_to_path(run_detection(shared, saved, day, C), f"{folder}/flags")
    flags = [f"{metric}_flag" for metric in bounds.METRICS]
    rows = spark.read.parquet(f"{folder}/flags").where(F.col("d") == DAY)
    return shaped(
        rows, ["label_period", "usersource", "period", "d"], ratios=DETECT_RATIOS, counts=flags
    )


@query
def saved_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds of three days in a catalog table, one day written twice; the newest up to a day."""
    name = f"bounds_{uuid.uuid4().hex}"
    shared = _shared_kpi(spark, sf)
    for day in (*EARLIER_DAYS, DAY, EARLIER_DAYS[1]):
        save_partitions(learn_bounds(shared, day, C), name, _new_folder(spark, name))
    return read_bounds(spark, name, "2000-06-12")


def _late_fact(spark: SparkSession, sf: str) -> tuple[str, Callable[[], DataFrame]]:
    """A stored fact whose rows paid by the second channel arrive late, and its reader.

    On time rows are in the partition of their date; the late ones are yet to be added
    three days on. Both sides of the year are written.
    """
    folder = _new_folder(spark, "late-fact")
    fact = stage(compact(order_fact(spark, sf, [(DAY, BACK)]), DIMENSIONS), "fact")
    late = F.col("paycategory") == C.channels[1]
    fact.where(~late).repartition("d").write.partitionBy("d").parquet(f"{folder}/fact")
    fact.where(late).withColumn("d", F.date_add("d", 3)).repartition("d").write.partitionBy(
        "d"
    ).parquet(f"{folder}/late")

    def read(name: str = "fact") -> DataFrame:
        return read_fact(spark, path=f"{folder}/{name}")

    return folder, read


def _add_late_rows(read: Callable[..., DataFrame], folder: str) -> None:
    read("late").write.mode("append").partitionBy("d").parquet(f"{folder}/fact")


@query
def maintained_kpi(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sums from the maintained table: summed once, then only where late rows came."""
    folder, read = _late_fact(spark, sf)
    kept = f"{folder}/series"
    series.update(read(), kept)
    _add_late_rows(read, folder)
    series.update(read(), kept)
    sums = series.read_series(spark, kept, read())
    windows = paired_windows(sums, DAY, BACK, C, date_column="label_period")
    return shaped(D.daily(windows, (), D.kpi_measures(C)), SERIES, amounts=KPI)


@query
def late_rows_kpi(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sums by business date from the fact itself, reading the partitions that hold it."""
    folder, read = _late_fact(spark, sf)
    _add_late_rows(read, folder)
    series.update(read(), f"{folder}/series")
    held = series.read_series(spark, f"{folder}/series", read())
    windows = paired_windows(read(), DAY, BACK, C, "label_period", held)
    return shaped(D.daily(windows, (), D.kpi_measures(C)), SERIES, amounts=KPI)


@query
def stored_fact_kpi(spark: SparkSession, sf: str) -> DataFrame:
    """A stored fact table with text dates and decimal amounts, read and summed exactly."""
    folder = _new_folder(spark, "fact")
    amounts = {n: f"cast({n} AS decimal(18,4)) AS {n}" for n in AMOUNTS}
    texts = {n: f"cast({n} AS string) AS {n}" for n in ("d", "label_period")}
    fact = order_fact(spark, sf, [(DAY, BACK)])
    fact.selectExpr(*[(amounts | texts).get(n, n) for n in fact.columns]).write.parquet(folder)
    read = paired_windows(read_fact(spark, path=folder), DAY, BACK, C)
    return shaped(D.daily(read, (), D.kpi_measures(C)), SERIES, amounts=KPI)


@query
def daily_kpi_long(spark: SparkSession, sf: str) -> DataFrame:
    """A lookback beyond a year: days in both windows count on both sides."""
    return shaped(kpi(spark, sf, 400), SERIES, amounts=KPI)


# -------------------------------------------------------------------- baseline


def _lines(spark: SparkSession, sf: str, measures: dict[str, str] | None = None) -> DataFrame:
    """Baselines of every source and business line, staged: a split reads them twice."""
    source = tagged(spark, sf)
    if measures:
        # Sum the raw rows once per combination, then fan out the many conditions.
        source = compact(source, D.FUNNEL_DIMS)
    return stage(
        level_baseline(source, DAY, C, business.LEVELS, D.kpi_measures(C) | (measures or {})),
        "lines",
    )


def _baseline_period(period: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        base = level_baseline(
            tagged(spark, sf), DAY, C, business.LEVELS, D.kpi_measures(C), (period,)
        )
        values = [f"{tag}_{n}" for tag in ("a", "p") for n in KPI]
        return shaped(
            base,
            ["period", "usersource", "level", "bu"],
            amounts=values,
            counts=["n_cur", "n_prev"],
        )

    return run


REGISTRY["baseline_day"] = _baseline_period(C.day)
REGISTRY["baseline_week"] = _baseline_period(C.week)
REGISTRY["baseline_month"] = _baseline_period(C.month)


def _indicator(spark: SparkSession, sf: str) -> DataFrame:
    base = level_baseline(tagged(spark, sf), DAY, C, [()], D.kpi_measures(C))
    return shaped(indicator(base), ["period", "usersource"], ratios=["actual", "pred"])


REGISTRY["indicator"] = _indicator


def _scene(indicator_name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        base = level_baseline(tagged(spark, sf), DAY, C, special.LEVELS, D.special_measures())
        rows = special.special_scenes(base, C).where(f"indicator = '{indicator_name}'")
        return shaped(
            rows,
            ["period", "usersource", "indicator", "element"],
            ratios=["actual", "pred", "gap", "ratio"],
        )

    return run


REGISTRY["special_refund"] = _scene(special.REFUND)
REGISTRY["special_channel"] = _scene(special.PAY_CHANNEL)
REGISTRY["special_platform"] = _scene(special.PAY_PLATFORM)

BU_KEYS = ["period", "usersource", "bu"]
FACTOR_VALUES = ["actual", "pred", "cta", "cts", "ctb", "ratio"]


def _bu_split(numerator: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        split = business.bu_split(_lines(spark, sf), numerator)
        rows = business.bu_rows(split).selectExpr(
            *BU_KEYS, "indicator", "actual", "pred", "cts", "try_divide(cts, total_gap) AS ratio"
        )
        return shaped(rows, [*BU_KEYS, "indicator"], ratios=["actual", "pred", "cts", "ratio"])

    return run


REGISTRY["bu_split"] = _bu_split("self_amt")
REGISTRY["bu_split_high_rate"] = _bu_split("highRate_amt")


# ------------------------------------------------------------------ Adtributor


def _leaves(spark: SparkSession, sf: str) -> DataFrame:
    return level_baseline(tagged(spark, sf), DAY, C, adtributor.LEAF, D.kpi_measures(C))


ELEMENT_KEYS = [*BU_KEYS, "dim", "element"]


@query
def ep_additive(spark: SparkSession, sf: str) -> DataFrame:
    rows = adtributor.explain_additive(_leaves(spark, sf))
    return shaped(rows, ELEMENT_KEYS, ratios=["ep"], amounts=["actual", "pred"])


@query
def surprise(spark: SparkSession, sf: str) -> DataFrame:
    return shaped(
        adtributor.explain_additive(_leaves(spark, sf)), ELEMENT_KEYS, ratios=["surprise"]
    )


@query
def ep_ratio(spark: SparkSession, sf: str) -> DataFrame:
    rows = adtributor.explain_ratio(_leaves(spark, sf))
    return shaped(rows, ELEMENT_KEYS, ratios=["actual", "pred", "ep", "surprise"])


@query
def adtributor_topk(spark: SparkSession, sf: str) -> DataFrame:
    rows = adtributor.top_elements(adtributor.explain_additive(_leaves(spark, sf)))
    return shaped(rows, ELEMENT_KEYS, ratios=["ep"], counts=["rank"])


@query
def adtributor_ratio_topk(spark: SparkSession, sf: str) -> DataFrame:
    explained = adtributor.explain_ratio(_leaves(spark, sf))
    rows = adtributor.top_elements(explained, threshold=None)
    return shaped(rows, ELEMENT_KEYS, ratios=["ep"], counts=["rank"])


@query
def structure_split(spark: SparkSession, sf: str) -> DataFrame:
    """Every line's structure elements with their parts of the overall gap.

    Totals, lines and leaves are levels of one baseline.
    """
    levels = [*business.LEVELS, *adtributor.LEAF]
    both = stage(level_baseline(tagged(spark, sf), DAY, C, levels, D.kpi_measures(C)), "lines")
    split = business.bu_split(both.where("level IN ('total', 'bu')"))
    parents = business.bu_rows(split).where(f"indicator = '{business.STRUCTURE}'")
    leaves = both.where("level NOT IN ('total', 'bu')")
    rows = adtributor.contributions(adtributor.explain_additive(leaves), parents)
    return shaped(
        rows, ELEMENT_KEYS, ratios=["ep", "cts", "ctb", "ratio"], amounts=["actual", "pred", "cta"]
    )


# ---------------------------------------------------------------- permeability


@query
def lmdi_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Net amount = orders x amount per order, per pay category, under both zero rules."""
    measures = {"amt": "sum(amt)", "cnt": "sum(cnt_payonly)"}
    base = level_baseline(tagged(spark, sf), DAY, C, [("paycategory",)], measures)
    factors = base.selectExpr(
        "period",
        "usersource",
        "paycategory",
        *[
            f"coalesce({sql}, 0D) AS {tag}_{name}"
            for tag in ("a", "p")
            for name, sql in (
                ("orders", f"{tag}_cnt"),
                ("ticket", f"try_divide({tag}_amt, {tag}_cnt)"),
            )
        ],
    )
    chains = [["orders", "ticket"]]
    split = lmdi_split(factors, chains, skip_first_on_zero=True).selectExpr(
        *factors.columns, "g_orders AS skip_orders", "g_ticket AS skip_ticket"
    )
    both = lmdi_split(split, chains, skip_first_on_zero=False)
    return shaped(
        both,
        ["period", "usersource", "paycategory"],
        amounts=["skip_orders", "skip_ticket", "g_orders", "g_ticket"],
    )


def _counters(spark: SparkSession, sf: str, measures: dict[str, str]) -> DataFrame:
    lines = _lines(spark, sf, D.counter_measures(C) | measures)
    return permeability.counter_split(business.bu_split(lines))


@query
def counter_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_contributions(permeability.counter_rows(_counters(spark, sf, {}), C))
    return shaped(rows, [*BU_KEYS, "indicator", "element"], ratios=FACTOR_VALUES)


def _second(spark: SparkSession, sf: str, counter: str, third: bool = False) -> DataFrame:
    names = permeability.second_model(counter).measures()
    if third:
        for code, at in permeability.THIRD_COUNTER.items():
            if at == counter:
                names |= permeability.third_models()[code].measures()
    every = D.second_measures(C) | D.third_measures(C)
    counters = _counters(spark, sf, {n: sql for n, sql in every.items() if n in names})
    return permeability.second_level(counters, counter, with_deeper=third)


def _second_query(counter: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        split = _second(spark, sf, counter)
        rows = permeability.factor_rows(
            split, permeability.second_model(counter), counter, None, L.SECOND_LABELS
        )
        return shaped(
            with_contributions(rows),
            [*BU_KEYS, "factor", "element"],
            ratios=FACTOR_VALUES[3:],
            fines=FACTOR_VALUES[:3],
        )

    return run


def _third_query(code: str, mode: str = "delta") -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        counter = permeability.THIRD_COUNTER[code]
        second = _second(spark, sf, counter, third=True)
        split = permeability.third_level(second, code, mode)
        rows = permeability.factor_rows(
            split, permeability.third_models()[code], counter, code, L.THIRD_LABELS
        )
        return shaped(
            with_contributions(rows), [*BU_KEYS, "factor", "element"], ratios=FACTOR_VALUES
        )

    return run


REGISTRY["sec_prepay"] = _second_query("prepay")
REGISTRY["sec_quick"] = _second_query("quick")
REGISTRY["sec_postpay"] = _second_query("postpay")
REGISTRY["thd_card"] = _third_query("prepay_card_rt")
REGISTRY["thd_credit"] = _third_query("prepay_credit_rt")
REGISTRY["thd_quicknew"] = _third_query("quick_new_self_rt")
REGISTRY["thd_quicknew_chain"] = _third_query("quick_new_self_rt", "chain")


# ------------------------------------------------------------- whole analysis


@query
def drill_top3(spark: SparkSession, sf: str) -> DataFrame:
    """The top lines and the chosen branches below them, with ranks."""
    base = stage(compact(tagged(spark, sf), D.FUNNEL_DIMS), "base")
    lines = level_baseline(base, DAY, C, business.LEVELS, D.kpi_measures(C))
    split = stage(business.bu_split(lines), "split")
    picks = stage(A.top_lines(split), "picks")
    deep = A.below(base, A.picked(picks, business.PERMEABILITY))
    funnel = level_baseline(deep, DAY, C, business.LEVELS[1:], D.funnel_measures(C))
    chosen = stage(A.chosen_lines(split, picks, funnel), "chosen")
    nodes = A.choose_branches(A.permeability_nodes(chosen, C)).where("rank <= 3")
    top = picks.selectExpr(
        "period",
        "usersource",
        f"'{L.LAYER_BU}' AS layer",
        "bu AS line",
        "indicator",
        "bu AS element",
        "ratio",
        "bu_rank AS rank",
    )
    return shaped(
        nodes.drop("bu_rank").unionByName(top, allowMissingColumns=True),
        ["period", "usersource", "layer", "line", "counter", "code", "indicator", "element"],
        ratios=["ratio"],
        counts=["rank"],
    )


REPORT_KEYS = ["Date", "Period", "Target", "Usersource", "Layer", "Indicator", "Element"]


def _analysis(spark: SparkSession, sf: str, bu_text: str = "ratio") -> DataFrame:
    return A.analyse(order_fact(spark, sf, [(DAY, BACK)]), DAY, C, bu_text=bu_text)


def _report_numbers() -> list[str]:
    amount = f"Layer = '{L.LAYER_STRUCTURE}'"
    return [
        *[
            f"CASE WHEN {amount} THEN {r4(c)} ELSE {fine(c)} END AS {c}"
            for c in ("Actual", "Pred", "CTA")
        ],
        *[f"{r6(c)} AS {c}" for c in ("CTS", "CTB", "CTBRatio")],
    ]


@query
def contributions(spark: SparkSession, sf: str) -> DataFrame:
    """The numeric rows of the analysis table."""
    rows = _analysis(spark, sf).where("Conclusion IS NULL")
    return rows.selectExpr(*REPORT_KEYS, *_report_numbers())


ANALYSED_DAYS = ("2000-06-11", DAY)


@query
def saved_analysis(spark: SparkSession, sf: str) -> DataFrame:
    """The analysis of two days and two periods saved in a catalog table and read back.

    The newer day is first saved for one period alone and then replaced.
    """
    name = f"causes_{uuid.uuid4().hex}"
    folder = _new_folder(spark, name)
    fact = stage(compact(order_fact(spark, sf, [(d, BACK) for d in ANALYSED_DAYS]), DIMENSIONS), "fact")
    older, newer = ANALYSED_DAYS
    both = (C.day, C.week)
    for day, periods in ((older, both), (newer, (C.week,)), (newer, both)):
        save_partitions(A.analyse(fact, day, C, periods), name, folder)
    return spark.table(name).selectExpr(*REPORT_KEYS, *_report_numbers(), "Conclusion", "d")


@query
def conclusions(spark: SparkSession, sf: str) -> DataFrame:
    """The text rows of the analysis table."""
    rows = _analysis(spark, sf).where("Conclusion IS NOT NULL")
    return rows.select(*REPORT_KEYS, "Conclusion", "d")


@query
def conclusions_pred(spark: SparkSession, sf: str) -> DataFrame:
    """The line texts with the prediction instead of the contribution."""
    rows = _analysis(spark, sf, bu_text="pred").where("Conclusion IS NOT NULL")
    return rows.where(f"Layer = '{L.LAYER_BU}'").select(*REPORT_KEYS, "Conclusion", "d")
