"""A maintained table of daily sums, kept per partition of the fact table.

A run needs two years' daily sums, of which all but the newest days were summed before.
The table holds, for each partition ``d`` of the fact, its sums per business date,
source and category. Late rows arrive in new partitions, or in old ones that then hold
more rows than were summed; either way only those partitions are summed again and
replaced. What belongs to a business date is added up over partitions when the table is
read, and since it keeps the fact's column names, every run takes it in place of the fact.

The table also tells which partitions hold a business date, so that a scan of the fact
itself by business date reads those alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratiolens.sources.results import save_partitions_to_path

#: What the daily rates are made of.
DIMS = ("paycategory",)
MEASURES = ("amt", "self_amt")
KEYS = ("d", "period", "usersource", "label_period")
ROWS = "n_rows"


def partition_sums(fact: DataFrame) -> DataFrame:
    """Rows and sums of every partition, business date, source and category."""
    sums = [F.sum(m).alias(m) for m in MEASURES]
    return fact.groupBy(*KEYS, *DIMS).agg(F.count(F.lit(1)).alias(ROWS), *sums)


def stale_days(fact: DataFrame, series: DataFrame | None) -> list:
    """Partitions not summed yet, or with another number of rows than were summed.

    Both sides are one row per partition; counting rows by a partition column reads no
    other column. A partition whose rows changed but not in number must be named to
    ``refresh``.
    """
    now = fact.groupBy("d").agg(F.count(F.lit(1)).alias("now"))
    if series is None:
        return [r.d for r in now.select("d").collect()]
    kept = series.groupBy("d").agg(F.sum(ROWS).alias("kept"))
    changed = now.join(kept, "d", "full").where("NOT now <=> kept")
    return [r.d for r in changed.select("d").collect()]


def refresh(fact: DataFrame, path: str, days: list) -> None:
    """Sum the given partitions again and replace them in the table at ``path``.

    A day that the fact no longer holds is left as it is.
    """
    if days:
        rows = partition_sums(fact.where(F.col("d").isin(days)))
        save_partitions_to_path(rows.repartition("d"), path)


def update(fact: DataFrame, path: str) -> list:
    """Bring the table up to the fact; the partitions that were summed."""
    days = stale_days(fact, read_series(fact.sparkSession, path, fact))
    refresh(fact, path, days)
    return days


def read_series(spark: SparkSession, path: str, fact: DataFrame) -> DataFrame | None:
    """The table with the types that sums of ``fact`` have, or None before the first write."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(partition_sums(fact).schema).parquet(path)
