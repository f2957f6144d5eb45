"""Helpers on rows: content keys, seeded order, and numbering that no single task has to do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sorrel.operators.ordered import running_sums
from sorrel.session import new_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a table in the shared folder, packed tightly, for results that are read more than once."""
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """`df` with its columns called in_0, in_1, ..., and what each is called now: what an operator adds beside clashes with none."""
    names = {c: f"in_{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def shuffled(*keys: str, seed: int) -> Column:
    """A seeded order that any SQL engine can repeat: md5 of the seed and the keys; null reads as empty."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def with_row_number(df: DataFrame, label: str) -> DataFrame:
    """`df`, written once, with a column `uid` that tells equal rows apart and stays the same from then on."""
    return written(df.withColumn("uid", F.monotonically_increasing_id()), label)


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Add `name`, the row's place from 0 in its group, and `<name>_of`, the group's size; a group may be of any size."""
    out = running_sums(df.withColumn("one", F.lit(1).cast("bigint")), group, order, ["one"])
    return out.withColumnsRenamed({"one_before": name, "one_all": f"{name}_of"}).drop("one")


def in_ranges(df: DataFrame, key: str, name: str = "range_no") -> tuple[DataFrame, int]:
    """`df` with the number of its key range, and how many ranges there are; ranges rise with the key, null is in the first.

    Only quantiles of the key reach the driver, one per shuffle partition. Unlike range partitioning this does not run
    the plan of `df` twice, and the ranges are known to later steps.
    """
    # here and not above, as every Python worker imports this module and the package takes 48 MB
    from pyspark.ml.feature import Bucketizer

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    probs = [k / parts for k in range(1, parts)]
    cuts = df.select(F.col(key).cast("double").alias("k")).approxQuantile("k", probs, 0.1 / parts) if probs else []
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) == 2:
        return df.withColumn(name, F.lit(0)), 1
    at = Bucketizer(splits=splits, inputCol="_k", outputCol="_r", handleInvalid="keep")
    out = at.transform(df.withColumn("_k", F.col(key).cast("double"))).withColumn(name, F.coalesce(F.col("_r"), F.lit(0.0)).cast("int"))
    return out.drop("_k", "_r"), len(splits) - 1
