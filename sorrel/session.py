"""Session helpers: a local session for tests, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def local_session(cpus: str = "*", partitions: int = 8) -> SparkSession:
    """Session used by the tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sorrel")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, else a folder set here.

    A machine-local folder is only acceptable when the whole session is one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sorrel-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Used where a result is read several times and must be the same each time (range
    partition numbers, for one), also after an executor is lost.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_by_key(df: DataFrame, key: str, label: str = "keyed") -> DataFrame:
    """`df` written once in buckets of `key`: aggregates and joins by that key then need no exchange of it.

    The table is an unnamed one to its readers: it lies in the shared folder and is known to this session only.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{label}_{uuid.uuid4().hex}"
    rows = df.repartition(n, key)
    with unsorted_writes(spark):
        rows.write.option("path", new_folder(spark, label)).bucketBy(n, key).saveAsTable(name)
    return spark.table(name)


@contextmanager
def unsorted_writes(spark: SparkSession):
    """Writes by bucket or part keep a few files open in a task, instead of sorting its rows first in memory that grows with them."""
    before = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, str(max(int(before), 4)))
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES, before)
