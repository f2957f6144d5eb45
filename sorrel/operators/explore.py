"""Exploration summaries of ratings, users and items."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from sorrel.functions import columns as C
from sorrel.operators.ordered import exact_percentiles


def value_distribution(df: DataFrame, col: str) -> DataFrame:
    """Count and percent per value, in value order."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("percent", F.col("n") * 100.0 / total).orderBy(col)


def describe_ratings(df: DataFrame, col: str = "rating") -> DataFrame:
    """Mean, median and sample deviation as one row."""
    basics = df.agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"))
    median = exact_percentiles(df, [], col, {"median": 0.5}).scalar()
    return basics.select("mean", median.alias("median"), "std")


def token_counts(df: DataFrame, col: str, sep: str = "|") -> DataFrame:
    return (
        C.explode_tokens(df.select(col), col, sep)
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "token")
    )


def coverage(
    ratings: DataFrame, users: DataFrame, items: DataFrame, item: str = "item_id", at_least: int = 10
) -> DataFrame:
    """Row counts, density in percent, items never rated and items rated often, as one row."""
    per_item = ratings.groupBy(item).agg(F.count(F.lit(1)).alias("n"))
    sums = per_item.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_ratings"),
        F.count(item).alias("n_rated"),
        F.count_if(F.col("n") >= at_least).alias("n_often"),
    )
    n_users = users.agg(F.count(F.lit(1)).alias("n")).scalar()
    n_items = items.agg(F.count(F.lit(1)).alias("n")).scalar()
    return sums.select(
        n_items.alias("n_items"), n_users.alias("n_users"), "n_ratings", "n_rated", "n_often"
    ).select(
        "n_items",
        "n_users",
        "n_ratings",
        F.try_divide(F.col("n_ratings") * 100.0, F.col("n_items") * F.col("n_users")).alias("density"),
        (F.col("n_items") - F.col("n_rated")).alias("n_never_rated"),
        "n_often",
    )


def activity_summary(ratings: DataFrame, user: str = "user_id") -> DataFrame:
    """Ratings per user: least, most, mean and median.

    Users are first counted by their number of ratings, so the median is taken over that short table.
    """
    per_user = ratings.groupBy(user).agg(F.count(F.lit(1)).alias("n"))
    sizes = per_user.groupBy("n").agg(F.count(F.lit(1)).alias("users"))
    # as many rows as there are distinct counts, which grows with the square root of the ratings
    run = F.sum("users").over(W.orderBy("n").rowsBetween(W.unboundedPreceding, -1))
    seen = sizes.select("n", "users", F.coalesce(run, F.lit(0)).alias("before"), F.sum("users").over(W.partitionBy(F.lit(0))).alias("all"))
    middle = (F.col("all") - 1) / 2.0

    def at(rank):
        return F.max(F.when(rank.between(F.col("before"), F.col("before") + F.col("users") - 1), F.col("n")))

    return seen.agg(
        F.min("n").alias("min"),
        F.max("n").alias("max"),
        (F.sum(F.col("n") * F.col("users")) / F.sum("users")).alias("mean"),
        ((at(F.floor(middle)) + at(F.ceil(middle))) / 2.0).alias("median"),
    )


def attr_counts(users: DataFrame, attr: str, labels: Mapping | None = None) -> DataFrame:
    counts = users.groupBy(attr).agg(F.count(F.lit(1)).alias("n"))
    if labels is None:
        return counts
    return counts.withColumn("label", C.map_labels(attr, labels))


def label_correlation(df: DataFrame, cols: Sequence[str], label: str, top: int = 10) -> DataFrame:
    """Absolute Pearson correlation of each feature with the label, largest first, from one pass.

    A constant feature has no correlation and is left out.
    """
    y = F.col(label).cast("double")

    def corr(c: str):
        x = F.col(c).cast("double")
        # as a ratio of its parts: the built-in one divides by zero for a constant column
        return F.abs(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))).alias(c)

    wide = df.agg(*[corr(c) for c in cols])
    long = wide.unpivot([], list(cols), "feature", "correlation")
    return long.where(C.present("correlation")).orderBy(F.col("correlation").desc(), "feature").limit(top)


def positive_rate(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.avg(label).alias("positive_rate"))


def top_rated(ratings: DataFrame, items: DataFrame, item: str = "item_id", title: str = "title", k: int = 10) -> DataFrame:
    """The k items with the most ratings, joined to their titles after aggregation."""
    counts = ratings.groupBy(item).agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias("mean"))
    return counts.join(items.select(item, title), item).orderBy(F.col("n").desc(), item).limit(k)


def mean_by_user_attr(ratings: DataFrame, users: DataFrame, attr: str, user: str = "user_id") -> DataFrame:
    """Mean rating and count by a user attribute; ratings are summed per user before the join."""
    per_user = ratings.groupBy(user).agg(F.sum("rating").alias("total"), F.count("rating").alias("n"))
    joined = per_user.join(users.select(user, attr), user)
    return joined.groupBy(attr).agg((F.sum("total") / F.sum("n")).alias("mean"), F.sum("n").alias("n"))
