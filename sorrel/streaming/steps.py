"""What is kept of a log per time step: sums, least and greatest values that add up over batches, steps and streams.

A stream turns every batch into such rows and stores them beside the earlier ones; windows and alerts are evaluated on
the stored steps, and on the steps of a finished log alike. So nothing has to close before it is seen, a row of any
lateness corrects its step, and the state is a table of a few rows per step, not memory of the running query.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

START = "step_start"
#: bins per doubling of a value: a bin's middle is at most 1/128 of any value of the bin away from it
BINS_PER_DOUBLING = 64
FOLD_EVERY = 20


@dataclass(frozen=True)
class Steps:
    """Length of a step, the columns that split it, and (name, SQL expression) of what is summed or compared."""

    step: str
    keys: tuple[str, ...] = ()
    sums: tuple[tuple[str, str], ...] = ()
    lows: tuple[tuple[str, str], ...] = ()
    highs: tuple[tuple[str, str], ...] = ()

    def measures(self, stored: bool) -> list[Column]:
        kinds = ((F.sum, self.sums), (F.min, self.lows), (F.max, self.highs))
        return [f(F.col(name) if stored else F.expr(sql)).alias(name) for f, pairs in kinds for name, sql in pairs]


def summarise(df: DataFrame, spec: Steps, ts: str = "ts") -> DataFrame:
    """One row per step and key of a log, batch or micro-batch; rows without a time are in no step."""
    start = F.window(F.col(ts).cast("timestamp"), spec.step)["start"].alias(START)
    return df.groupBy(start, *spec.keys).agg(*spec.measures(stored=False))


def merge(rows: DataFrame, spec: Steps) -> DataFrame:
    """Rows of the same step and key joined into one."""
    return rows.groupBy(START, *spec.keys).agg(*spec.measures(stored=True))


def value_bin(value: Column) -> Column:
    """Number of the log-linear bin of a value: BINS_PER_DOUBLING equal bins between neighbouring powers of two.

    Numbers rise with the value; zero is bin 0 and negative values mirror positive ones. NULL and NaN have no bin. The
    width of a bin is the same share of its values everywhere, so the error does not depend on how many there are.
    """
    v = value.cast("double")
    size = F.abs(v)
    guess = F.floor(F.log2(size)).cast("int")
    power = F.pow(F.lit(2.0), guess)
    # the logarithm may round over the next power of two
    e = guess + F.when(power > size, -1).when(power * 2 <= size, 1).otherwise(0)
    within = F.floor((size / F.pow(F.lit(2.0), e) - 1) * BINS_PER_DOUBLING)
    number = ((e + 1100) * BINS_PER_DOUBLING + within + 1).cast("int")
    return F.when(v.isNull() | F.isnan(v), None).when(v == 0, 0).when(v > 0, number).otherwise(-number)


def bin_value(number: Column) -> Column:
    """Middle of a bin."""
    at = F.abs(number) - 1
    e = F.floor(at / BINS_PER_DOUBLING) - 1100
    middle = F.pow(F.lit(2.0), e) * (1 + (F.pmod(at, F.lit(BINS_PER_DOUBLING)) + 0.5) / BINS_PER_DOUBLING)
    return F.when(number == 0, F.lit(0.0)).otherwise(F.signum(number.cast("double")) * middle)


def _covered(spark: SparkSession, path: str) -> tuple[int, dict[str, int]]:
    """The newest base table's number (-1: none), and the last batch of each writer that is in it."""
    try:
        rows = spark.read.schema("base long, writer string, upto long").json(f"{path}/bases").collect()
    except AnalysisException:
        return -1, {}
    newest = max((r.base for r in rows), default=-1)
    return newest, {r.writer: r.upto for r in rows if r.base == newest}


def _parts(spark: SparkSession, path: str, schema: T.StructType, covered: dict[str, int]) -> DataFrame | None:
    """Rows of batches that no base table holds, with `writer` and `batch`."""
    full = T.StructType([*schema.fields, T.StructField("writer", T.StringType()), T.StructField("batch", T.LongType())])
    try:
        rows = spark.read.schema(full).parquet(f"{path}/parts")
    except AnalysisException:
        return None
    for writer, upto in covered.items():
        rows = rows.where((F.col("writer") != writer) | (F.col("batch") > upto))
    return rows


def kept(spark: SparkSession, path: str, spec: Steps, schema: T.StructType) -> DataFrame:
    """The stored steps, one row per step and key; `schema` is that of `summarise`."""
    base, covered = _covered(spark, path)
    parts = _parts(spark, path, schema, covered)
    found = [spark.read.schema(schema).parquet(f"{path}/base/base={base}")] if base >= 0 else []
    found += [parts.drop("writer", "batch")] if parts is not None else []
    if not found:
        return spark.createDataFrame([], schema)
    return merge(found[0] if len(found) == 1 else found[0].unionByName(found[1]), spec)


def fold(spark: SparkSession, path: str, spec: Steps, schema: T.StructType) -> None:
    """Join all stored batches into one base table. Batches count as folded once the base is listed; then they go."""
    base, covered = _covered(spark, path)
    parts = _parts(spark, path, schema, covered)
    if parts is None:
        return
    # as many rows as there are writers
    upto = {r.writer: r.batch for r in parts.groupBy("writer").agg(F.max("batch").alias("batch")).collect()}
    if not upto:
        return
    kept(spark, path, spec, schema).write.mode("overwrite").parquet(f"{path}/base/base={base + 1}")
    listed = spark.createDataFrame(sorted({**covered, **upto}.items()), "writer string, upto long")
    listed.coalesce(1).write.mode("overwrite").json(f"{path}/bases/base={base + 1}")
    files = spark._jvm.org.apache.hadoop.fs
    gone = [f"parts/writer={w}/batch={b}" for w, last in upto.items() for b in range(covered.get(w, -1) + 1, last + 1)]
    # a reader may still be at the base before this one
    gone += [f"{kind}/base={base - 1}" for kind in ("base", "bases")]
    for name in gone:
        folder = files.Path(f"{path}/{name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _unseen(batch: DataFrame, spec: Steps, path: str, own: str, key: Sequence[str], ts: str) -> DataFrame:
    """Rows of the batch whose key is new in its step; remembers them. Only days that the batch touches are read."""
    spark = batch.sparkSession
    start = F.window(F.col(ts).cast("timestamp"), spec.step)["start"]
    marked = batch.where(F.col(ts).isNotNull()).withColumn("seen_step", start).withColumn("seen_day", F.to_date("seen_step")).dropDuplicates([*key, "seen_step"])
    first, last = marked.agg(F.min("seen_day"), F.max("seen_day")).first()
    if first is None:
        return batch
    names = marked.select(*key, "seen_step", "seen_day")
    schema = T.StructType([*names.schema.fields, T.StructField("own", T.StringType())])
    try:
        stored = spark.read.schema(schema).parquet(f"{path}/seen").where(F.col("seen_day").between(first, last) & (F.col("own") != own))
    except AnalysisException:
        stored = spark.createDataFrame([], schema)
    old = stored.select(*[F.col(c).alias(f"old_{i}") for i, c in enumerate([*key, "seen_step"])])
    same = F.lit(True)
    for i, c in enumerate([*key, "seen_step"]):
        same = same & F.col(c).eqNullSafe(F.col(f"old_{i}"))
    fresh = marked.join(old, same, "left_anti")
    fresh.select(*names.columns).write.mode("overwrite").partitionBy("seen_day").parquet(f"{path}/seen/own={own}")
    return fresh.drop("seen_step", "seen_day")


def keep(stream: DataFrame, spec: Steps, path: str, checkpoint: str, ts: str = "ts", key: Sequence[str] = (), fold_every: int = FOLD_EVERY, writer: str | None = None) -> StreamingQuery:
    """Store the steps of a stream; returns the started query, which ends when what is there has been read.

    A batch is stored under the stream's name and the batch's number, so a batch that is run again replaces itself, or
    does nothing if a base table holds it. The name is `writer`, else made from the checkpoint's path. With `key`, a row
    whose key was seen in the same step before does not count, however late it comes. One stream at a time folds.
    """
    name = writer or hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    schema = summarise(stream, spec, ts).schema

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number <= _covered(spark, path)[1].get(name, -1):
            return
        rows = _unseen(batch, spec, path, f"{name}-{number}", key, ts) if key else batch
        summarise(rows, spec, ts).write.mode("overwrite").parquet(f"{path}/parts/writer={name}/batch={number}")
        if (number + 1) % fold_every == 0:
            fold(spark, path, spec, schema)

    return stream.writeStream.foreachBatch(add).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
