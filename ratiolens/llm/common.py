"""Helpers that several operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import ratiolens
from ratiolens.sources.staging import stage

#: The white space of the word rules, as a character class.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

__all__ = [
    "SPACES",
    "WORD",
    "join_by_parts",
    "marked",
    "numbered",
    "ship_package",
    "shuffle_parts",
    "slices",
    "stage",
    "table",
    "text_or_empty",
]


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python once per session, wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_ratiolens_shipped", False):
        return
    package = Path(ratiolens.__file__).parent
    folder = tempfile.mkdtemp(prefix="ratiolens-code-")  # the driver's own; Spark hands it out
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = Path(folder) / "ratiolens_code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    context._ratiolens_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column) -> Column:
    column = F.col(f"`{column}`") if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` written once as (row_no, row): a row number stays the same from then on.

    The original columns stay packed in the struct ``row``, so that no column of
    theirs can clash with an operator's own.
    """
    packed = docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.struct("*").alias("row")
    )
    return stage(packed, name)


#: Parts of the rows of one key where these are joined with their key's answer.
PARTS = 64


def join_by_parts(rows: DataFrame, answers: DataFrame, key: str, by: str) -> DataFrame:
    """``rows`` with the columns of ``answers``, which has one row per ``key``, none of them hot.

    Rows of one key go to ``PARTS`` tasks by a hash of ``by``, and a key's answer to those
    of them that it has rows in, so the rows of a large group need not meet.
    """
    parted = rows.withColumn("part", F.pmod(F.xxhash64(by), F.lit(PARTS)))
    spread = parted.select(key, "part").distinct().join(answers, key)
    return parted.join(spread, [key, "part"]).drop("part")


#: Bits of a filter for each of its hashes (up to twice as many), of one row of it and of all rows.
HASH_BITS, ROW_BITS, FILTER_BITS = 16, 1 << 15, 1 << 27


def marked(rows: DataFrame, of: Column, hashes: DataFrame) -> DataFrame:
    """``rows`` with the column ``maybe``: true wherever the hash ``of`` is among ``hashes``.

    ``hashes`` has one column of longs. Each sets a bit of a bitmap of at most 16 MB that
    goes to all tasks, so most of the other rows are told without a shuffle; some share a
    bit and are true, too. Whoever needs to know compares those that are true.
    """
    bits = min(FILTER_BITS, max(ROW_BITS, 1 << (HASH_BITS * hashes.count()).bit_length()))

    def placed(df: DataFrame, of: Column) -> DataFrame:
        place = F.pmod(of, F.lit(bits).cast("long"))
        at = F.struct(
            F.floor(place / ROW_BITS).alias("filter_row"), (place % ROW_BITS).alias("bit")
        )
        return df.withColumn("filter_at", at)

    bitmaps = (
        placed(hashes, F.col(hashes.columns[0]))
        .select("filter_at.*")
        .groupBy("filter_row")
        .agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    )
    byte = F.expr("conv(hex(substring(bitmap, int(filter_at.bit div 8) + 1, 1)), 16, 10)").cast("int")
    here = byte.bitwiseAND(F.expr("shiftleft(1, int(filter_at.bit % 8))")) > 0
    return (
        placed(rows, of)
        .join(F.broadcast(bitmaps), F.col("filter_at.filter_row") == F.col("filter_row"), "left")
        .withColumn("maybe", F.coalesce(here, F.lit(False)))
        .drop("filter_at", "filter_row", "bitmap")
    )


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of record batches with about ``limit`` bytes of text each (one row at least)."""
    for batch in batches:
        sizes = np.array(
            pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64
        )
        if not len(sizes):
            continue
        part = (np.cumsum(sizes) - sizes) // limit
        edges = np.flatnonzero(np.diff(part)) + 1
        for start, end in zip([0, *edges], [*edges, len(sizes)], strict=True):
            yield batch.slice(start, end - start)
