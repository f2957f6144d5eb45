"""Running a stream into tables: a file source, an upsert sink for online features."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, types as T

from sorrel.operators.ordered import latest_per_key
from sorrel.operators.store import FeatureView, upsert
from sorrel.sources.tables import bucket_number, bucket_of, grown, online_commits, online_shape, read_online, write_online


def read_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """File stream over a parquet table; the path may be a glob."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_materialize(rows: DataFrame, view: FeatureView, path: str, checkpoint: str, buckets: int = 64, rows_per_bucket: int = 1_000_000, writer: str | None = None):
    """Keep an online snapshot current from new feature rows; returns the started query.

    Each batch is reduced to its newest row per key and merged with the stored rows of the key buckets it touches; only
    those buckets are read and written, under the version after the highest stored one. A table starts with `buckets`;
    as it outgrows `rows_per_bucket`, a batch also splits buckets, and the commit says how many there are. The version
    is recorded with the stream's name and the batch's number, so a repeated batch reads the versions before its own and
    replaces that one, and a stream with a new checkpoint goes on from what is stored. The name is `writer`, else made
    from the checkpoint's path.
    """
    name = writer or hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        writes, commits = f"{name}/{batch_id}", online_commits(spark, path)
        own = [c.version for c in commits if c.writer == writes]
        version = own[0] if own else max((c.version for c in commits), default=-1) + 1
        delta = latest_per_key(batch, view.key, view.ts, view.created if view.created in batch.columns else None)
        before, stored = online_shape(commits, version, buckets)
        after = grown(before, stored, rows_per_bucket)
        # bucket numbers only
        touched = {r.b for r in delta.select(bucket_of(view.key, before).alias("b")).distinct().collect()}
        touched |= {bucket_number(k, before) for k in range(before, after)}
        old = read_online(spark, path, rows.schema, before=version, only=touched)
        write_online(upsert(old, delta, view), path, version, view.key, after, writes, replaces=sorted(touched | set(range(before, after))))

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
