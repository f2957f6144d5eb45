"""Per-entity statistics and the feature matrix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sorrel.functions import columns as C, fixed


def user_stats(df: DataFrame, user: str = "user_id", rating: str = "rating") -> DataFrame:
    """Mean, count and sample deviation per user; a single rating has deviation 0."""
    return df.groupBy(user).agg(
        F.avg(rating).alias("user_avg_rating"),
        F.count(rating).alias("user_n_ratings"),
        F.coalesce(F.stddev_samp(rating), F.lit(0.0)).alias("user_std_rating"),
    )


def item_stats(df: DataFrame, item: str = "item_id", rating: str = "rating", prefix: str = "item") -> DataFrame:
    return df.groupBy(item).agg(
        F.avg(rating).alias(f"{prefix}_avg_rating"), F.count(rating).alias(f"{prefix}_n_ratings")
    )


def build_feature_matrix(
    ratings: DataFrame,
    users: DataFrame,
    items: DataFrame,
    user: str = "user_id",
    item: str = "item_id",
    check_keys: bool = False,
) -> DataFrame:
    """ratings left-joined with users and items, missing numbers 0; one row per rating.

    The join sides are chosen by their measured size (adaptive execution), and a key that holds a
    large share of the ratings is split by the skew-join rule. `check_keys` counts repeated keys in
    the small tables first, because they would multiply rows.
    """
    if check_keys:
        for side, key in ((users, user), (items, item)):
            if not side.groupBy(key).count().where("count > 1").isEmpty():
                raise ValueError(f"{key} is not unique")
    return C.fill_missing(ratings.join(users, user, "left").join(items, item, "left"))


def attach_stats(
    df: DataFrame, u_stats: DataFrame, i_stats: DataFrame, user: str = "user_id", item: str = "item_id"
) -> DataFrame:
    return C.fill_missing(df.join(u_stats, user, "left").join(i_stats, item, "left"))


def lookup_default(
    df: DataFrame, stats: DataFrame, key: str, defaults: Mapping[str, float] = fixed.ITEM_DEFAULTS
) -> DataFrame:
    """Left join with a default for each column that has no partner."""
    wide = df.join(stats.select(key, *defaults), key, "left")
    return wide.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(d))) for c, d in defaults.items()})


def exclude_pairs(df: DataFrame, excluded: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the exclusion table."""
    return df.join(excluded, list(on), "left_anti")


def exclude_ids(df: DataFrame, key: str, ids: Sequence) -> DataFrame:
    """Rows whose key is not in a literal list."""
    return df.where(~F.col(key).isin(list(ids))) if ids else df


def min_support(df: DataFrame, group: str | Sequence[str], n: int = 10) -> DataFrame:
    keys = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= n)


def filter_time_range(df: DataFrame, ts: str, start: Column, end: Column, fallback: bool = True) -> DataFrame:
    """Rows with start <= ts <= end; with `fallback`, all rows when the range holds none.

    Whether the range is empty is a scalar subquery, so the filter stays one lazy plan.
    """
    inside = F.coalesce(F.col(ts).between(start, end), F.lit(False))
    if not fallback:
        return df.where(inside)
    found = df.agg(F.coalesce(F.bool_or(inside), F.lit(False)).alias("found")).scalar()
    return df.where(inside | ~found)


def global_means(stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the mean of each statistic over all entities."""
    return stats.agg(*[F.avg(c).alias(c) for c in cols])


def cold_start_means(profiles: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill a profile's missing statistics with the mean over all users."""
    means = global_means(stats, cols).select(F.struct(*cols)).scalar()
    have = set(profiles.columns)
    # held as a column first, so that the subquery is planned once
    held = profiles.withColumn("_means", means)
    mean = {c: F.col("_means")[c] for c in cols}
    return held.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), mean[c]) if c in have else mean[c] for c in cols}
    ).drop("_means")


def entity_table(entities: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Attributes and statistics of each entity in one row, also for entities known to one side only.

    Joining at entity size first leaves a single join per entity for the large ratings table.
    """
    return entities.join(stats, key, "full_outer")
