"""Cut points: intermediate tables written to the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only a local session may go without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder().name


@cache
def _local_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="ratiolens-")


#: The folder of the run that is going on, if one was opened.
_run: ContextVar[str | None] = ContextVar("ratiolens_run", default=None)
#: Called with every frame before it is staged, so that a test can read its plan.
watchers: list[Callable[[DataFrame], None]] = []


@contextmanager
def staged_run(spark: SparkSession) -> Iterator[str]:
    """Tables staged inside go to one folder, which is removed at the end.

    Use the results (write or collect them) before leaving.
    """
    folder = f"{shared_folder(spark)}/ratiolens/run-{uuid.uuid4().hex}"
    token = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: With this on, a plan's shuffle files go as soon as it has run (Spark 4.1; others know no such key).
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside are deleted at its end, not when the driver collects garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet and read it back.

    The readers prune columns and see true sizes, and a lost executor costs a
    re-read of these files instead of another pass over the fact table. Outside of
    ``staged_run`` the files stay, like Spark's own checkpoints; the shuffle files
    of the plan that wrote them go at once.
    """
    spark = df.sparkSession
    for watch in watchers:
        watch(df)
    folder = _run.get() or f"{shared_folder(spark)}/ratiolens"
    target = f"{folder}/{name}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.parquet(target)
    return spark.read.schema(df.schema).parquet(target)
