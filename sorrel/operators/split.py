"""Train/test splits and folds that do not depend on row order or partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sorrel.functions.hashing import FAST_RANGE, fast_hash
from sorrel.operators.ordered import running_sums


def stratified_split(
    df: DataFrame, label: str, key: Sequence[str], test_share: float = 0.2, seed: int = 42, hashed: Column | None = None
) -> DataFrame:
    """Add `split`: a key's hash decides, independently of the label, so both classes keep their share.

    No shuffle. Class shares are met within sampling error; `exact_split` meets them within a row.
    """
    h = fast_hash(key, seed) if hashed is None else hashed
    return df.withColumn("split", F.when(h < int(test_share * FAST_RANGE), "test").otherwise("train"))


def stratified_folds(df: DataFrame, key: Sequence[str], k: int = 5, seed: int = 42, hashed: Column | None = None) -> DataFrame:
    """Add `fold` in 0..k-1 by hash, without a shuffle."""
    h = fast_hash(key, seed) if hashed is None else hashed
    return df.withColumn("fold", F.pmod(h, F.lit(k)).cast("int"))


def _ranked(df: DataFrame, label: str, key: Sequence[str], hashed: Column) -> DataFrame:
    marked = df.withColumns({"h": hashed, "one": F.lit(1).cast("bigint")})
    return running_sums(marked, [label], ["h", *key], ["one"])


def exact_split(
    df: DataFrame, label: str, key: Sequence[str], test_share: float = 0.2, seed: int = 42, hashed: Column | None = None
) -> DataFrame:
    """Split whose class sizes are exact to a row: rank by hash within each class.

    `key` must identify a row. The rank is a distributed running count, not one window per class.
    """
    h = fast_hash(key, seed) if hashed is None else hashed
    size = F.round(F.col("one_all") * F.lit(test_share))
    split = F.when(F.col("one_before") < size, "test").otherwise("train")
    return _ranked(df, label, key, h).select(*df.columns, split.alias("split"))


def exact_folds(
    df: DataFrame, label: str, key: Sequence[str], k: int = 5, seed: int = 42, hashed: Column | None = None
) -> DataFrame:
    """Folds in which every class is spread to within one row."""
    h = fast_hash(key, seed) if hashed is None else hashed
    fold = F.pmod(F.col("one_before"), F.lit(k)).cast("int")
    return _ranked(df, label, key, h).select(*df.columns, fold.alias("fold"))
