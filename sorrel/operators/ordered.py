"""Order statistics without a single-task sort: running sums over range partitions.

Rows are first summed per distinct (group, value). The distinct rows are range partitioned by
(group, value) and written out, so that the partition numbers stay what they are. A group of any
size then lies in consecutive partitions: one small total per (group, partition) gives the offset
at which that partition starts, and the running sum is local to it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from sorrel.functions import columns as C
from sorrel.session import stage


def distinct_sums(
    df: DataFrame, group: Sequence[str], value: str, sums: Mapping[str, Column]
) -> DataFrame:
    """One row per (group, value) with summed weights; combined before the shuffle."""
    return df.groupBy(*group, value).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def range_stage(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`df` in range order with a fixed partition number `part`.

    The number of ranges is left to adaptive execution, which merges neighbouring small ones.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in (*group, *order)])
    return stage(ranged.withColumn("part", F.spark_partition_id()), "ranged")


def running_sums(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str],
    next_of: str | None = None,
) -> DataFrame:
    """Add `<s>_before`, the sum of `s` over earlier rows of the group, and `<s>_all`.

    `order` must be unique within a group. With `next_of`, `next_value` is that column's value in
    the group's next row.
    """
    ranged = range_stage(df, group, order)
    totals = ranged.groupBy(*group, "part").agg(
        *[F.sum(s).alias(s) for s in sums],
        *([F.min(next_of).alias("low")] if next_of else []),
    )
    by_group = W.partitionBy(*group).orderBy("part") if group else W.orderBy("part")
    whole = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    before = by_group.rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *group,
        "part",
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_offset") for s in sums],
        *[F.sum(s).over(whole).alias(f"{s}_all") for s in sums],
        *([F.lead("low").over(by_group).alias("next_low")] if next_of else []),
    )
    local = W.partitionBy(*group, "part").orderBy(*order)
    earlier = local.rowsBetween(W.unboundedPreceding, -1)
    # a NULL group is a group like any other
    same = F.lit(True)
    for c in (*group, "part"):
        same = same & ranged[c].eqNullSafe(offsets[c])
    out = ranged.join(offsets, same)
    for c in (*group, "part"):
        out = out.drop(offsets[c])
    added = {
        f"{s}_before": F.col(f"{s}_offset") + F.coalesce(F.sum(s).over(earlier), F.lit(0)) for s in sums
    }
    if next_of:
        added["next_value"] = F.coalesce(F.lead(next_of).over(local), F.col("next_low"))
    keep = [c for c in ranged.columns if c != "part"]
    return out.select(
        *keep, *[c.alias(n) for n, c in added.items()], *[f"{s}_all" for s in sums]
    )


def last_known(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Add `name`: the last `value` that is not NULL at or before each row, in the group's order.

    A segmented scan: rows are cut into ranges of (group, order), whatever the size of a group, the last value of every
    range is carried over the ranges after it, and the rest is local to a range. `order` decides where ranges are cut, so
    its last column should tell equal rows apart. Only a group that crosses from one range to the next carries a value,
    so the carried rows are fewer than the ranges, which bounds the broadcast.
    """
    ranged = range_stage(df, group, order)
    place = F.when(F.col(value).isNotNull(), F.struct(*order))
    ends = ranged.groupBy(*group, "part").agg(F.max_by(value, place).alias("last"))
    earlier = W.partitionBy(*group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(*[F.col(c).alias(f"of_{c}") for c in (*group, "part")], F.last("last", ignorenulls=True).over(earlier).alias("carried")).where(F.col("carried").isNotNull())
    same = F.lit(True)
    for c in (*group, "part"):
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    local = W.partitionBy(*group, "part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    known = F.coalesce(F.last(value, ignorenulls=True).over(local), F.col("carried"))
    return ranged.join(F.broadcast(carried), same, "left").withColumn(name, known).select(*df.columns, name)


def exact_percentiles(
    df: DataFrame, group: Sequence[str], value: str, probs: Mapping[str, float], nearest: bool = False
) -> DataFrame:
    """Percentiles with linear interpolation, or by nearest rank, one row per group and a column per name.

    The wanted ranks are picked out of the running counts, so no task holds a whole group.
    """
    rows = df.where(F.col(value).isNotNull())
    counted = distinct_sums(rows, group, value, {"n": F.lit(1).cast("bigint")})
    run = running_sums(counted, group, [value], ["n"])
    first, last = F.col("n_before"), F.col("n_before") + F.col("n") - 1
    picks = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("n_all") - 1)
        if nearest:
            # rounded, as 0.99 is not a binary fraction
            at = F.greatest(F.ceil(F.round(F.lit(float(p)) * F.col("n_all"), 9)) - 1, F.lit(0)).cast("double")
        low, high = F.floor(at), F.ceil(at)
        picks += [
            F.max(F.when(low.between(first, last), F.col(value))).alias(f"{name}_low"),
            F.max(F.when(high.between(first, last), F.col(value))).alias(f"{name}_high"),
            F.max(at - low).alias(f"{name}_part"),
        ]
    found = run.groupBy(*group).agg(*picks)

    def between(name):
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        return (low + (high - low) * F.col(f"{name}_part")).alias(name)

    return found.select(*group, *[between(n) for n in probs])


def roc_auc(df: DataFrame, score: str, label: str, group: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve with tied scores counted half, one row per group."""
    sums = {
        "pos": F.when(F.col(label) == 1, 1).otherwise(0).cast("bigint"),
        "neg": F.when(F.col(label) == 1, 0).otherwise(1).cast("bigint"),
    }
    run = running_sums(distinct_sums(df, group, score, sums), group, [score], ["pos", "neg"])
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2.0))
    pairs = F.max("pos_all").cast("double") * F.max("neg_all")
    return run.groupBy(*group).agg(F.try_divide(wins, F.when(pairs > 0, pairs)).alias("roc_auc"))


def ecdf_pair(counts: DataFrame, feature: str = "feature", value: str = "value") -> DataFrame:
    """Both empirical distribution functions at every distinct value of a feature.

    `counts` has one row per (feature, value) with `n_ref` and `n_cur`; `next_value` is the
    feature's next larger value.
    """
    run = running_sums(counts, [feature], [value], ["n_ref", "n_cur"], next_of=value)
    return run.select(
        feature,
        value,
        "n_ref",
        "n_cur",
        "n_ref_all",
        "n_cur_all",
        ((F.col("n_ref_before") + F.col("n_ref")) / F.col("n_ref_all")).alias("f_ref"),
        ((F.col("n_cur_before") + F.col("n_cur")) / F.col("n_cur_all")).alias("f_cur"),
        "next_value",
    )


def latest_per_key(df: DataFrame, key: str | Sequence[str], ts: str, created: str | None = None) -> DataFrame:
    """The newest row of each key by (ts, created), as an aggregate that combines before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [c for c in (ts, created) if c]
    # remaining columns make the choice among equal times the same on every run
    rest = [c for c in df.columns if c not in keys and c not in order and _sortable(df, c)]
    row = F.struct(*[c for c in df.columns if c not in keys])
    best = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order, *rest)).alias("row"))
    return best.select(*keys, "row.*").select(*df.columns)


def _sortable(df: DataFrame, c: str) -> bool:
    return not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))


def last_n(df: DataFrame, ts: str, n: int = 10, ties: Sequence[str] = ()) -> DataFrame:
    """The newest n rows, newest first; equal times in the order of `ties`."""
    return df.orderBy(F.col(ts).desc(), *ties).limit(n)


def top_k_per_user(df: DataFrame, user: str, order: Sequence[Column], k: int = 10) -> DataFrame:
    """First k rows per user with `rank`; rows beyond k are dropped before the shuffle."""
    rank = F.row_number().over(W.partitionBy(user).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def page(df: DataFrame, by: str, limit: int = 20, offset: int = 0) -> DataFrame:
    """One page of `limit` rows in key order, each row with the table's `total`."""
    if limit < 1 or offset < 0:
        raise ValueError("limit must be 1 or more, offset 0 or more")
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.orderBy(by).offset(offset).limit(limit).withColumn("total", total)


def rolling_percentile(
    df: DataFrame,
    order: Sequence[str],
    value: str,
    size: int = 1000,
    p: float = 0.99,
    at_least: int = 10,
    by: Sequence[str] = (),
    span: int = 256,
) -> DataFrame:
    """Mean and percentile of the last `size` rows at every row, percentile 0 below `at_least` rows.

    Rows are numbered by distributed running counts and packed into runs of about sqrt(size). A percentile of `size` rows
    lies among their K extreme values, and lists of K extremes join: the runs that lie wholly in a row's window are
    joined once per run, and a row adds the parts of the two runs at the window's old end and of its own run. `span` runs
    are a task's unit; the runs that a unit needs from the one before it are copied to it. Missing values count as rows
    and not as values; without values the mean and the percentile are NULL.
    """
    run = max(2, round(size**0.5))
    back = -(-size // run)
    high = p >= 0.5
    # places from the near end of the sorted window to the percentile, at most
    extremes = size - math.floor(p * (size - 1)) if high else math.ceil(p * (size - 1)) + 1
    span = max(span, 2 * back + 2)
    one = df.withColumn("one", F.lit(1).cast("bigint"))
    numbered = running_sums(one, by, order, ["one"])
    v = F.col(value).cast("double")
    packed = numbered.select(
        *by,
        F.floor(F.col("one_before") / run).alias("run"),
        F.struct(F.col("one_before").alias("rn"), F.when(C.present(value), v).alias("v"), F.struct(*df.columns).alias("row")).alias("item"),
    )
    packed = packed.groupBy(*by, "run").agg(F.collect_list("item").alias("items"))

    def values(items: Column) -> Column:
        return F.transform(F.filter(items, lambda x: x["v"].isNotNull()), lambda x: x["v"])

    def ends(xs: Column) -> Column:
        return F.slice(F.sort_array(xs, asc=not high), 1, extremes)

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)

    own = F.floor(F.col("run") / span)
    needed_next = F.pmod(F.col("run"), F.lit(span)) >= span - back
    units = packed.withColumn("unit", F.explode(F.when(needed_next, F.array(own, own + 1)).otherwise(F.array(own))))
    # in row order, so that sums come out the same on every run
    units = units.withColumn("points", F.sort_array(F.transform("items", lambda x: F.struct(x["rn"].alias("rn"), x["v"].alias("v")))))
    units = units.withColumn("known", values(F.col("points")))
    units = units.withColumns({"ends": ends(F.col("known")), "sum": total(F.col("known")), "count": F.size("known")})
    in_order = W.partitionBy(*by, "unit").orderBy("run")
    # runs wholly inside the window of every row of this run
    whole = in_order.rangeBetween(-(back - 2), -1) if back > 2 else None
    none = F.array().cast("array<struct<rn:bigint,v:double>>")
    wide = units.withColumns(
        {
            "mid": ends(F.flatten(F.collect_list("ends").over(whole))) if whole is not None else F.array().cast("array<double>"),
            "mid_sum": F.coalesce(F.sum("sum").over(whole), F.lit(0.0)) if whole is not None else F.lit(0.0),
            "mid_count": F.coalesce(F.sum("count").over(whole), F.lit(0)) if whole is not None else F.lit(0),
            "old": F.concat(*[F.coalesce(F.lag("points", k).over(in_order), none) for k in sorted({back, max(back - 1, 1)}, reverse=True)]),
        }
    ).where(F.col("unit") == own)
    rows = wide.select("points", "mid", "mid_sum", "mid_count", "old", F.explode("items").alias("item"))
    rn = F.col("item.rn")
    here = F.concat(F.filter("old", lambda x: x["rn"] > rn - size), F.filter("points", lambda x: (x["rn"] <= rn) & (x["rn"] > rn - size)))
    rows = rows.withColumn("near", values(here)).withColumns({"n": F.size("near") + F.col("mid_count"), "far": F.concat("near", "mid")})
    rows = rows.withColumn("far", F.sort_array("far", asc=not high))
    at = F.lit(float(p)) * (F.col("n") - 1)

    def place(k: Column) -> Column:
        return F.get("far", (F.col("n") - 1 - k if high else k).cast("int"))

    low, up = place(F.floor(at)), place(F.ceil(at))
    n_window = F.least(rn + 1, F.lit(size)).cast("bigint")
    return rows.select(
        *[F.col("item.row")[c].alias(c) for c in df.columns],
        n_window.alias("n_window"),
        F.try_divide(F.aggregate("near", F.col("mid_sum"), lambda a, x: a + x), F.col("n").cast("double")).alias("mean_latency"),
        F.when(n_window < at_least, 0.0).otherwise(low + (up - low) * (at - F.floor(at))).alias("p_latency"),
    )
