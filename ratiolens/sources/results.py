"""Saved results: partition-safe writing, and the newest saved bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Formats whose folders of days a plain write can replace.
FORMATS = ("parquet", "orc")


def save_partitions(df: DataFrame, table: str, path: str | None = None) -> None:
    """Write ``df`` to a table partitioned by ``d``, replacing only the days it holds.

    The days go into the table's own folder, where this one write replaces them, and are
    then made known to the catalog. No setting of the session is touched, so writes of
    other days may run side by side, in this session or another. A missing table is
    created, at ``path`` if given. Columns go by name and take the table's types.
    """
    spark = df.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY (d){place}"
    )
    stored, folder = table_folder(spark, table)
    if stored not in FORMATS:
        raise ValueError(f"{table} is stored as {stored}, not as {' or '.join(FORMATS)}")
    typed = [F.col(f"`{f.name}`").cast(f.dataType) for f in spark.table(table).schema]
    save_partitions_to_path(df.select(*typed), folder, stored)
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)


def table_folder(spark: SparkSession, table: str) -> tuple[str, str]:
    """Format and folder of a catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    names = [r.col_name for r in rows]
    facts = {r.col_name: r.data_type for r in rows[names.index("# Detailed Table Information") :]}
    return facts["Provider"].lower(), facts["Location"]


def save_partitions_to_path(df: DataFrame, path: str, stored: str = "parquet") -> None:
    """Same as :func:`save_partitions` for a folder."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("d")
        .format(stored)
        .save(path)
    )


def read_bounds(spark: SparkSession, table: str, day: str) -> DataFrame:
    """The newest bounds saved up to ``day``."""
    return latest_bounds(spark.table(table), day)


def latest_bounds(bounds: DataFrame, day: str) -> DataFrame:
    """Per source, the bounds row with the newest ``d`` not after ``day``.

    ``max_by`` combines before the shuffle, so a source with a long history
    sends one row per input partition.
    """
    newest = F.max_by(F.struct(*[F.col(c) for c in bounds.columns]), "d").alias("row")
    return (
        bounds.where(F.col("d") <= day)
        .groupBy(F.col("Usersource").alias("source"))
        .agg(newest)
        .select("row.*")
    )
