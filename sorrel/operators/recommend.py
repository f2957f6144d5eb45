"""Top-k items for every user without building user x item pairs.

Under naive Bayes the log-odds of a (user, item) row is a user part plus an item part, so an item is
fully described by two numbers: `b`, its Gaussian part, and `d`, its Bernoulli part. The score rises
in both. An item that at least n others beat in both cannot be among the first n of any user, and
items are sorted into classes by the number that beat them. A user then meets only the
classes that can hold one of their first k + (number of their excluded items). Items of a class are
packed into short arrays, each user row is joined to array rows by block number, and the best of a
block are picked inside the row. Nothing is cut off: an item left out is provably not in the answer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sorrel.functions import columns as C, fixed
from sorrel.operators import naive_bayes as nb
from sorrel.operators.features import cold_start_means, lookup_default
from sorrel.operators.ordered import running_sums, top_k_per_user
from sorrel.session import stage

BLOCK = 512
#: users of a block before it is copied
SHARE = 50_000
PARTS_DIGITS = 9
ORDER_DIGITS = 6


def item_parts(items: DataFrame, model: nb.Model, item: str, cols: Sequence[str]) -> DataFrame:
    """The two log-odds parts of each item, rounded so that equal items are equal."""
    return items.select(
        item,
        F.round(nb.gaussian_terms(model, cols), PARTS_DIGITS).alias("b"),
        F.round(nb.bernoulli_terms(model, cols), PARTS_DIGITS).alias("d"),
    )


def user_parts(users: DataFrame, model: nb.Model, user: str, cols: Sequence[str]) -> DataFrame:
    prior = nb.prior_term(model)
    return users.select(
        user,
        (nb.gaussian_terms(model, cols) + F.lit(prior)).alias("a"),
        (nb.bernoulli_terms(model, cols) + F.lit(prior)).alias("c"),
    )


def with_beaten_by(parts: DataFrame, item: str) -> DataFrame:
    """Add `beaten_by`, the number of items that come before an item for every user.

    Those have a greater `b` and a `d` at least as great, or are equal and have a smaller id (at an equal `b`, scores that
    round to the same go by id, so a greater `d` does not decide). Items are ranked by `b`. At every bit of the rank, two neighbouring runs of ranks are merged in the order of `d`, and
    an item of the later run counts the items of the earlier run that come before it: each better item is met at one bit
    only. All merges are one running sum over (bit, pair of runs), in which a group may be of any size.
    """
    ordered = parts.select(item, "b", "d", (-F.col("b")).alias("nb"), (-F.col("d")).alias("nd"), F.lit(1).cast("bigint").alias("one"))
    ranked = running_sums(ordered, [], ["nb", "d", item], ["one"]).withColumnsRenamed({"one_before": "rank", "one_all": "items"})
    bits = F.sequence(F.lit(0), F.greatest(F.ceil(F.log2("items")).cast("int"), F.lit(1)))
    at_bit = ranked.select("*", F.explode(bits).alias("bit"))
    runs = at_bit.withColumns({"pair": F.expr("shiftright(rank, bit + 1)"), "later": F.expr("shiftright(rank, bit) & 1")})
    merged = running_sums(runs.withColumn("earlier", 1 - F.col("later")), ["bit", "pair"], ["nd", "rank"], ["earlier"])
    return merged.groupBy(item, "b", "d").agg(F.sum(F.col("later") * F.col("earlier_before")).alias("beaten_by"))


def item_blocks(parts: DataFrame, item: str, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(items with block number, blocks with `at_best`): blocks hold about `block` items of one class."""
    level = F.floor(F.log2(F.col("beaten_by") + 1)).cast("int")
    ranked = with_beaten_by(parts, item).withColumn("level", level)
    sizes = ranked.groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    # one row per power of two
    first = W.orderBy("level").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.withColumn("n_blocks", F.ceil(F.col("n") / block).cast("bigint")).withColumn(
        "start", F.coalesce(F.sum("n_blocks").over(first), F.lit(0))
    )
    number = F.col("start") + F.pmod(F.xxhash64(item), F.col("n_blocks"))
    placed = ranked.join(sizes, "level").select(item, "b", "d", "level", number.alias("block"))
    placed = stage(placed, "items")
    row = F.struct(F.col(item).alias("item"), F.col("b"), F.col("d"))
    blocks = placed.groupBy("block", "level").agg(F.collect_list(row).alias("items"))
    return placed, blocks


def candidate_blocks(users: DataFrame, placed: DataFrame, blocks: DataFrame, user: str, per_block: DataFrame | None = None) -> DataFrame:
    """Each user with the arrays of items that can be among their first `need`; no pairs are built.

    All users want the blocks of the best items. So demand is counted, a block is copied once per SHARE users that want
    it, and users are dealt over the copies: no key of the join has more than about SHARE users, and there is one copy
    per SHARE (user, block) rows besides one of each block. `per_block` has columns of (user, block) that come beside,
    before the arrays do. The rows are dealt by a fixed number of partitions, as their scores are work and not bytes, and
    the arrays are looked up: they are not sorted, and users are never copied to blocks.
    """
    # one row per power of two: at most a few dozen numbers
    levels = (
        placed.groupBy("level")
        .agg(F.min("block").alias("first"), F.max("block").alias("last"))
        .collect()
    )
    # level l holds items beaten by at least 2^l - 1 others; a block number without items finds no partner
    wants = {r.level: F.lit(2**r.level - 1) < F.col("need") for r in levels}
    demand = users.agg(F.count(F.lit(1)), *[F.count_if(w) for w in wants.values()]).first()[1:]
    copies = {level: max(1, -(-n // SHARE)) for level, n in zip(wants, demand)}
    none = F.array().cast("array<struct<block:bigint,copy:int>>")

    def dealt(r) -> Column:
        mine = F.pmod(F.xxhash64(user), F.lit(copies[r.level])).cast("int")
        return F.transform(F.sequence(F.lit(r["first"]), F.lit(r["last"])), lambda x: F.struct(x.alias("block"), mine.alias("copy")))

    wanted = F.flatten(F.array(none, *[F.when(wants[r.level], dealt(r)).otherwise(none) for r in levels]))
    spread = users.select("*", F.inline(wanted))
    if per_block is not None:
        spread = spread.join(per_block, [user, "block"], "left")
    n = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.coalesce(*[F.when(F.col("level") == level, n - 1) for level, n in copies.items()], F.lit(0))
    asked = [level for level, n_users in zip(wants, demand) if n_users]
    held = blocks.where(F.col("level").isin(asked)).select("*", F.explode(F.sequence(F.lit(0), last)).alias("copy"))
    return spread.repartition(n, "block", "copy").join(held.hint("shuffle_hash"), ["block", "copy"])


def recommend(
    users: DataFrame,
    items: DataFrame,
    model: nb.Model,
    k: int = 10,
    user: str = "user_id",
    item: str = "item_id",
    excluded: DataFrame | None = None,
    user_cols: Sequence[str] | None = None,
    item_cols: Sequence[str] | None = None,
) -> DataFrame:
    """First k items per user by score, then item part, then id; `excluded` holds (user, item) rows.

    `users` and `items` carry the feature columns of their side with missing values filled.
    """
    user_cols = [c for c in (user_cols or users.columns) if c != user]
    item_cols = [c for c in (item_cols or items.columns) if c != item]
    left = [c for c in (*model.continuous, *model.binary) if c not in user_cols and c not in item_cols]
    if left:
        # a feature nobody has is 0 everywhere, as when columns are aligned to the model
        items = items.withColumns({c: F.lit(0.0) for c in left})
        item_cols = [*item_cols, *left]
    placed, blocks = item_blocks(stage(item_parts(items, model, item, item_cols), "parts"), item)
    people = user_parts(users, model, user, user_cols)
    # scoring is CPU work on short rows, so users are spread by count and not by bytes
    n = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if excluded is None:
        people = people.repartition(n, user).withColumn("need", F.lit(k).cast("bigint"))
        wanted = candidate_blocks(stage(people, "people"), placed, blocks, user).withColumn("here", F.lit(k).cast("bigint"))
    else:
        # of one block, a user can lose at most as many items as they excluded there
        where = placed.groupBy(item, "block").agg(F.count(F.lit(1)).alias("times"))
        out = excluded.select(user, item).join(where, item)
        per_block = out.groupBy(user, "block").agg(F.collect_set(F.struct(F.col(item).alias("item"), "times")).alias("gone"))
        n_gone = F.aggregate("gone", F.lit(0).cast("bigint"), lambda a, x: a + x["times"])
        per_block = stage(per_block.select(user, "block", F.transform("gone", lambda x: x["item"]).alias("gone"), n_gone.alias("lost")), "gone")
        per_user = per_block.groupBy(user).agg(F.sum("lost").alias("lost"))
        people = people.repartition(n, user).join(per_user, user, "left").withColumn("need", F.lit(k) + F.coalesce("lost", F.lit(0))).drop("lost")
        wanted = candidate_blocks(stage(people, "people"), placed, blocks, user, per_block)
        wanted = wanted.withColumn("here", F.lit(k) + F.coalesce("lost", F.lit(0)))

    # the sorts are ascending: negate what has to be largest first
    def minus_score(x) -> Column:
        return -nb.mix(model, F.col("a") + x["b"], F.col("c") + x["d"])

    def scored(i) -> Column:
        p = -F.get("minus", i)
        return F.struct((-F.round(p, ORDER_DIGITS)).alias("s"), (-F.get("items", i)["b"]).alias("nb"), F.get("items", i)["item"].alias("item"), p.alias("score"))

    # plain numbers say how far down the first `here` lie, so that few items are rounded and sorted; a null sorts first
    first = F.lit(float("-inf"))
    numbers = wanted.withColumn("minus", F.transform("items", minus_score))
    at = F.least(F.col("here"), F.size("minus")).cast("int") - 1
    last = F.get(F.sort_array(F.transform("minus", lambda m: F.coalesce(m, first))), at) + 2 * 10.0**-ORDER_DIGITS
    # `last` is named twice, as a column named once would be worked out anew inside the lambda, at every item
    near = F.filter(F.sequence(F.lit(0), F.size("minus") - 1), lambda i: F.col("last").isNull() | (F.coalesce(F.get("minus", i), first) <= F.col("last")))
    near = numbers.withColumn("last", last).withColumn("near", near)
    best = F.slice(F.sort_array(F.transform("near", scored)), F.lit(1), F.col("here").cast("int"))
    if excluded is not None:
        best = F.when(F.col("gone").isNull(), best).otherwise(F.filter(best, lambda x: ~F.array_contains("gone", x["item"])))
    pairs = near.select(user, F.inline(best)).withColumnRenamed("item", item)
    ranked = top_k_per_user(pairs, user, [F.col("s"), F.col("nb"), F.col(item)], k)
    return ranked.select(user, "rank", item, "score")


def model_profiles(profiles: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """User side of the model's own method: missing statistics become the mean over users."""
    return cold_start_means(profiles, stats, cols)


def served_profiles(profiles: DataFrame, defaults: Mapping[str, float] = fixed.PROFILE_DEFAULTS) -> DataFrame:
    """User side as served: missing or zero statistics become fixed defaults."""
    return C.profile_defaults(profiles, defaults)


def catalogue(
    items: DataFrame, stats: DataFrame, item: str, year: str = "year", defaults: Mapping[str, float] = fixed.ITEM_DEFAULTS
) -> DataFrame:
    """Item side: missing year 0, statistics with defaults for items never rated."""
    return lookup_default(items.withColumn(year, C.or_zero(year)), stats, item, defaults)


def predict_like(
    pairs: DataFrame,
    profiles: DataFrame,
    items: DataFrame,
    model: nb.Model,
    user: str = "user_id",
    item: str = "item_id",
    year: str = "year",
    item_defaults: Mapping[str, float] = fixed.ITEM_DEFAULTS,
) -> DataFrame:
    """Flag and probability for given (user, item) pairs; an unknown item has year 2000 and no tags."""
    known = items.withColumn("known", F.lit(True))
    wide = attach_stats_free(pairs, profiles, known, user, item)
    fills = {year: F.when(F.col("known"), C.or_zero(year)).otherwise(F.lit(fixed.UNKNOWN_YEAR))}
    fills |= {c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in item_defaults.items() if c in wide.columns}
    wide = wide.withColumns(fills)
    need = [c for c in (*model.continuous, *model.binary)]
    ready = C.align_columns(wide, need, keep=list(pairs.columns))
    scored = nb.score(ready, model)
    return scored.select(*pairs.columns, (F.col("score") >= 0.5).alias("will_like"), "score")


def attach_stats_free(pairs: DataFrame, profiles: DataFrame, items: DataFrame, user: str, item: str) -> DataFrame:
    """Pairs with both sides' columns, missing ones left NULL."""
    return pairs.join(profiles, user, "left").join(items, item, "left")


def attach_labels(recs: DataFrame, items: DataFrame, item: str, cols: Sequence[str]) -> DataFrame:
    """Descriptive item columns beside each recommendation."""
    return recs.join(items.select(item, *cols), item, "left")
