"""The daily KPI fact table: schema, reading, and the paired year windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratiolens.codes import Codes
from ratiolens.functions.scalar import quoted

DIMENSIONS = ("bu", "platform", "paycategory", "new_post_flag", "paytype", "label_a")
AMOUNTS = ("amt", "self_amt", "self_amt_payonly", "self_amt_refund", "amt_payonly")
COUNTS = (
    "cnt_payonly",
    "self_cnt_payonly",
    "card_cnt",
    "nqh_cnt",
    "quickpay_haveself_cnt_payonly",
)
MEASURES = AMOUNTS + COUNTS

# The columns of the fact table.
FACT_SCHEMA = T.StructType(
    [
        T.StructField("label_period", T.DateType()),
        T.StructField("d", T.DateType()),
        T.StructField("period", T.StringType()),
        T.StructField("usersource", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in DIMENSIONS],
        *[T.StructField(c, T.DoubleType()) for c in AMOUNTS],
        *[T.StructField(c, T.LongType()) for c in COUNTS],
    ]
)

CURRENT, PREVIOUS = "cur", "prev"


def read_fact(spark: SparkSession, table: str | None = None, path: str | None = None) -> DataFrame:
    """The fact table from the catalog, or from a parquet folder partitioned by ``d``.

    Either may keep dates as text and amounts as decimals. Dates, texts and counts
    are cast to the schema (casts of matching types vanish in the plan, and a cast
    partition column still prunes). Decimal amounts stay decimals, so that their
    sums are exact; ``compact`` and ``daily`` cast the sums.
    """
    source = spark.read.parquet(path) if table is None else spark.table(table)
    types = dict(source.dtypes)
    casts = [
        f.name
        if f.name in AMOUNTS and types[f.name].startswith("decimal")
        else f"cast({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in FACT_SCHEMA
    ]
    return source.selectExpr(*casts)


def check_lookback(back: int) -> None:
    if back < 0:
        raise ValueError("lookback must not be negative")


def paired_windows(
    fact: DataFrame,
    day: str,
    back: int,
    codes: Codes,
    date_column: str = "d",
    held: DataFrame | None = None,
) -> DataFrame:
    """Daily rows of both year windows from one scan, tagged ``side`` cur or prev.

    The range is on the partition column ``d`` unless ``date_column`` names the
    business date; all bounds fold to literals, so on ``d`` the scan prunes to
    the two windows. The earlier window ends on the same calendar day a year
    before (29 February becomes the 28th). A lookback of a year or more lets the
    windows overlap; a row in both counts on both sides.

    ``held`` names the partitions that hold a business date (columns label_period and d,
    such as ``series.read_series`` has). With it a range over the business date prunes
    too: only partitions with rows in the windows are read, found when the plan runs.
    """
    check_lookback(back)
    last = f"DATE'{day}'"
    last_prev = f"add_months({last}, -12)"
    in_current = f"{date_column} BETWEEN date_sub({last}, {back}) AND {last}"
    in_previous = f"{date_column} BETWEEN date_sub({last_prev}, {back}) AND {last_prev}"
    if held is not None:
        inside = held.where(f"{in_current} OR {in_previous}")
        parts = inside.select(F.col("d").cast("date").alias("held_d")).distinct()
        fact = fact.join(parts, F.col("d") == F.col("held_d"), "left_semi")
    return fact.where(
        f"period = {quoted(codes.day)} AND ({in_current} OR {in_previous})"
    ).selectExpr(
        "*",
        f"explode(array_compact(array(CASE WHEN {in_current} THEN '{CURRENT}' END, "
        f"CASE WHEN {in_previous} THEN '{PREVIOUS}' END))) AS side",
    )


def with_doubles(sums: DataFrame) -> DataFrame:
    """Exact decimal sums as doubles, once the rows are added up."""
    return sums.selectExpr(
        *[f"cast({n} AS double) AS {n}" if t.startswith("decimal") else n for n, t in sums.dtypes]
    )


def compact(fact: DataFrame, dims: tuple[str, ...], measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """Fact rows summed to one row per date and dimension combination.

    The result keeps the fact's column names, so every operator runs on it as on
    the fact table. This is the only step that meets raw rows: a partial
    aggregate shrinks each partition to the existing combinations before the
    shuffle, which also evens out a source or business line holding most rows.
    """
    keys = ("period", "side", "usersource", "label_period", "d") + dims
    keys = tuple(k for k in keys if k in fact.columns)
    return with_doubles(fact.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures]))
