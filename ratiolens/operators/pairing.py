"""This year's daily series beside last year's, paired by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ratiolens.operators.daily import aggregates
from ratiolens.sources.fact import CURRENT


def year_pairs(
    series: DataFrame, keys: list[str], values: list[str], pair: str = "newest"
) -> DataFrame:
    """One row per rank: this year's row and last year's row of the same rank.

    ``pair`` counts ranks from the newest or from the oldest date. The two sides
    come out of one aggregate over (keys, rank) instead of a join; ranks that
    this year lacks are left out. Arrange ``series`` by the keys beforehand and
    no further exchange is needed.
    """
    if pair not in ("newest", "oldest"):
        raise ValueError("pair must be 'newest' or 'oldest'")
    date = F.desc("label_period") if pair == "newest" else F.asc("label_period")
    rank = F.row_number().over(W.partitionBy(*keys, "side").orderBy(date))
    sides = {}
    for value in ("label_period", *values):
        sides[f"cur_{value}"] = f"max(CASE WHEN side = '{CURRENT}' THEN {value} END)"
        sides[f"prev_{value}"] = f"max(CASE WHEN side <> '{CURRENT}' THEN {value} END)"
    return (
        series.withColumn("rk", rank)
        .groupBy(*keys, "rk")
        .agg(*aggregates(sides))
        .where("cur_label_period IS NOT NULL")
        .withColumnRenamed("cur_label_period", "label_period")
    )
