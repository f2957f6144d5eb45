"""Tables on the shared file system: feature views, splits, snapshots, dated raw data, reports."""

from __future__ import annotations

import warnings
from collections.abc import Collection, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from sorrel.session import unsorted_writes


def read_feature_view(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame | None:
    """The view's table with its declared schema; a view that is not there is warned about."""
    try:
        if fmt == "csv":
            return spark.read.csv(path, schema=schema, header=True)
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException:
        warnings.warn(f"no feature view at {path}", stacklevel=2)
        return None


def write_split(df: DataFrame, path: str) -> None:
    """Train and test rows as partitions of one table, features and label together.

    A task keeps a file open for each part and does not sort its rows by part.
    """
    with unsorted_writes(df.sparkSession):
        df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_feature_columns(spark: SparkSession, names: Sequence[str], path: str) -> None:
    rows = spark.createDataFrame([(list(names),)], "names array<string>")
    rows.select(F.posexplode("names").alias("position", "feature")).write.mode("overwrite").parquet(path)


def read_feature_columns(spark: SparkSession, path: str) -> list[str]:
    """Feature order; as many rows as the matrix has columns."""
    return [r.feature for r in spark.read.parquet(path).orderBy("position").collect()]


COMMITS = "version long, writer string, buckets int, touched array<int>, sizes array<bigint>"


def bucket_number(h: int, n: int) -> int:
    """Linear hashing: with n buckets, the hash modulo the power of two above n, or the one below where that is no bucket."""
    high = 1 << n.bit_length()
    return h % high if h % high < n else h % (high // 2)


def bucket_of(key: str, n: int) -> Column:
    """`bucket_number` of the key's hash. With more buckets, rows only move from a bucket that is split to its new one."""
    high = 1 << n.bit_length()
    x = F.pmod(F.xxhash64(key), F.lit(high))
    return F.when(x < n, x).otherwise(F.pmod(x, F.lit(high // 2))).cast("int")


def grown(n: int, rows: int, rows_per_bucket: int) -> int:
    """Number of buckets for so many rows: never fewer, and at most twice as many at once."""
    return max(n, min(2 * n, -(-rows // rows_per_bucket)))


def online_commits(spark: SparkSession, path: str) -> list[Row]:
    """Versions of a snapshot that still matter: at most one per key bucket and two per writer."""
    try:
        return spark.read.schema(COMMITS).json(f"{path}/commits").collect()
    except AnalysisException:
        return []


def _live(commits: Sequence[Row], before: int | None = None) -> dict[int, tuple[int, int]]:
    """Newest version of each bucket (older than `before`), and its rows there."""
    newest: dict[int, tuple[int, int]] = {}
    for c in commits:
        if before is None or c.version < before:
            for b, size in zip(c.touched, c.sizes):
                newest[b] = max(newest.get(b, (-1, 0)), (c.version, size))
    return newest


def online_shape(commits: Sequence[Row], before: int | None = None, default: int = 64) -> tuple[int, int]:
    """(buckets, rows) of a snapshot as its newest version (older than `before`) left it."""
    known = [c for c in commits if before is None or c.version < before]
    n = max(known, key=lambda c: c.version).buckets if known else default
    return n, sum(size for _, size in _live(known).values())


def write_online(
    df: DataFrame, path: str, version: int, key: str, buckets: int = 64, writer: str = "", files: int = 8, replaces: Sequence[int] | None = None
) -> None:
    """One version of a snapshot, split by key bucket into up to `files` files each; writing a version again replaces it.

    `df` holds the whole content of the buckets it `replaces`, by default of those it has rows in. With more buckets than
    before, these have to include every bucket that is split and every new one; fewer are refused. The version counts
    once its commit is written. Bucket folders that an earlier version had replaced already are removed then, so readers
    and a repeat of this version still find what was newest before it.
    """
    spark, target = df.sparkSession, f"{path}/data/version={version}"
    commits = [c for c in online_commits(spark, path) if c.version != version]
    before, _ = online_shape(commits, version, buckets)
    needed = {b for k in range(before, buckets) for b in (k, bucket_number(k, before))} if any(c.version < version for c in commits) else set()
    if buckets < before or not needed <= set(replaces or ()):
        raise ValueError(f"the table at {path} has {before} buckets; {buckets} need the split ones written too")
    rows = df.withColumn("bucket", bucket_of(key, buckets))
    part = F.pmod(F.xxhash64(key, F.lit(1)), F.lit(files))
    rows.repartition("bucket", part).write.mode("overwrite").partitionBy("bucket").parquet(target)
    # at most `buckets` numbers
    sizes = {r.bucket: r.n for r in spark.read.schema(rows.schema).parquet(target).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    touched = sorted({*sizes, *(replaces or ())})
    commit = spark.createDataFrame([(writer, buckets, touched, [sizes.get(b, 0) for b in touched])], "writer string, buckets int, touched array<int>, sizes array<bigint>")
    commit.coalesce(1).write.mode("overwrite").json(f"{path}/commits/version={version}")
    _retire(spark, path, commits, version)


def _retire(spark: SparkSession, path: str, commits: Sequence[Row], version: int) -> None:
    """Remove what was replaced before `version`, and commits that own nothing unless they are their writer's last."""
    live = _live(commits, version)
    last = {}
    for c in commits:
        name = c.writer.rpartition("/")[0]
        last[name] = max(last.get(name, c.version), c.version)
    gone = [f"data/version={c.version}/bucket={b}" for c in commits for b in c.touched if c.version < live.get(b, (-1, 0))[0]]
    idle = [c for c in commits if c.version < version and all(c.version < live[b][0] for b in c.touched)]
    gone += [f"{kind}/version={c.version}" for c in idle if c.version not in last.values() for kind in ("data", "commits")]
    files = spark._jvm.org.apache.hadoop.fs
    for name in gone:
        folder = files.Path(f"{path}/{name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_online(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None, only: Collection[int] | None = None) -> DataFrame:
    """Newest rows of a snapshot: for each key bucket (in `only`) the folder of its latest version (older than `before`)."""
    live = _live(online_commits(spark, path), before)
    folders = [f"{path}/data/version={v}/bucket={b}" for b, (v, size) in sorted(live.items()) if size and (only is None or b in only)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def online_as_json(df: DataFrame, key: str) -> DataFrame:
    """Export form of a snapshot: the key and its features as a JSON object."""
    names = [c for c in df.columns if c != key]
    return df.select(F.col(key).cast("string").alias(key), F.to_json(F.struct(*names)).alias("features"))


def land_raw(df: DataFrame, path: str, ingest_date: str) -> None:
    """Store raw rows under their ingest date; a second run of a day replaces that day only."""
    (
        df.withColumn("ingest_date", F.lit(ingest_date).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date")
        .parquet(path)
    )


def read_latest(spark: SparkSession, path: str, by: str = "ingest_date") -> DataFrame:
    """Rows of the newest date; the date is found from partition names and prunes the scan."""
    table = spark.read.parquet(path)
    return table.where(F.col(by) == table.agg(F.max(by)).scalar())


def write_report(df: DataFrame, path: str, run_date: str) -> None:
    """Append report rows as JSON under their run date."""
    df.withColumn("run_date", F.lit(run_date)).write.mode("append").partitionBy("run_date").json(path)
