"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def local_session(cpus: int | str = "*", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("idlewatch")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    A local session without the setting gets a temporary folder of its own; on a cluster
    a machine-local folder would be wrong, so the setting is required there.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a shared folder")
    folder = tempfile.mkdtemp(prefix="idlewatch-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def through_shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from the table.

    Unlike a cache it survives lost executors without a second pass over the source, and
    its readers prune columns and row groups.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/idlewatch/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def open_writers(spark: SparkSession, number: int = 256) -> Iterator[None]:
    """Partitioned writes inside keep up to this many files open in a task, instead of sorting its rows.

    Beyond the number a task sorts the rest, as Spark does without the setting.
    """
    before = spark.conf.get(OPEN_WRITERS, None)
    spark.conf.set(OPEN_WRITERS, str(number))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(OPEN_WRITERS)
        else:
            spark.conf.set(OPEN_WRITERS, before)
