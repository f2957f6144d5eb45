"""Mixing sources to target weights over a curriculum.

Every source has a weight that changes over training progress 0 to 1, as a line through a few knots. Its integral is the
source's demand for tokens up to a moment; inverting it gives the moment at which a document's tokens are asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from sorrel.llm.rows import numbered, shuffled, with_row_number, written
from sorrel.operators.ordered import running_sums

SEED = 9
WEIGHTS = (5.0, 2.0, 1.0)
#: Weight over progress, relative to its mean, of the sources that have the first, second and third of WEIGHTS.
CURVES = (((0.0, 1.4), (1.0, 0.6)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
MOST_REPEATS = 3


def word_count(text: str):
    """Runs of characters other than space and U+0009 to U+000D; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source with `weight`, `turn` (which of `weights`) and `target` in tokens.

    `sizes` has one row per source: source, source_size. Weights go round the sources in code point order, null last.
    Targets share the total by weight; none exceeds `most` times its source's size, and what they give up goes to the
    others by weight: with sources sorted by size per weight, the first one that keeps its share fixes the rate for all
    that follow (rates rise up to it and fall after it, so it has the highest of those that keep theirs). The windows run over one row per source.
    """
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("turn", turn % len(weights)).withColumn("weight", F.get(table, F.col("turn")))
    by_ratio = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("source_size").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    whole = W.partitionBy(F.lit(0))
    rows = rows.withColumn("rate", (F.sum("source_size").over(whole) - most * before) / left)
    keeps = F.col("rate") * F.col("weight") <= most * F.col("source_size")
    rows = rows.withColumn("level", F.max(F.when(keeps, F.col("rate"))).over(whole))
    target = F.least((most * F.col("source_size")).cast("double"), F.col("level") * F.col("weight"))
    return rows.select("source", "source_size", "turn", "weight", target.alias("target"))


def segments(curve: Sequence[tuple[float, float]]) -> list[tuple[float, ...]]:
    """(start, length, weight at start, weight at end, area before, area) of each piece, with area 1 in all."""
    pieces = [(a[0], b[0] - a[0], a[1], b[1]) for a, b in zip(curve, curve[1:])]
    total = sum(d * (u + v) / 2 for _, d, u, v in pieces)
    if not total > 0 or any(d <= 0 or min(u, v) < 0 for _, d, u, v in pieces):
        raise ValueError("a curve needs rising moments and weights of 0 or more that are not all 0")
    out, before = [], 0.0
    for t, d, u, v in pieces:
        area = d * (u + v) / 2 / total
        out.append((t, d, u / total, v / total, before, area))
        before += area
    return out


def moment(share, curve: Sequence[tuple[float, float]]):
    """The progress at which a source has asked for `share` (0 to 1) of its tokens: the inverse of the integral."""
    out = F.lit(float(curve[-1][0]))
    for t, d, u, v, before, area in reversed(segments(curve)):
        rest = F.least(F.greatest(share - before, F.lit(0.0)), F.lit(area))
        if area == 0:
            continue
        slope = (v - u) / d
        # u*x + slope*x*x/2 = rest, in the form that stays exact for small slopes
        x = 2 * rest / (u + F.sqrt(F.greatest(F.lit(u * u) + 2 * slope * rest, F.lit(0.0))))
        out = F.when(share <= before + area, t + F.when(rest > 0, x).otherwise(0.0)).otherwise(out)
    return out


def plan(
    rows: DataFrame,
    source: str,
    key: str,
    size: str,
    weights: Sequence[float] = WEIGHTS,
    curves: Sequence[Sequence[tuple[float, float]]] = CURVES,
    most: int = MOST_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """`rows` with source_size, target, `copies` (how often the mix takes the row) and `moments` (one per copy).

    A source is read in a seeded order, up to `most` times; a pass takes a row when the middle of its tokens lies below
    the source's target, so that the tokens taken differ from it by half a row at most. A row of size 0 is taken once.
    `rows` should be narrow; it is written once. A null source is a source, a null key sorts first, a null size counts
    as 0, repeated rows are separate rows. The running sums go over range partitions, so one source may hold most rows.
    """
    rows = rows.drop("target", "source_size", "copies", "moments")
    sized = {"mix_source": F.col(source), "mix_size": F.coalesce(F.col(size).cast("bigint"), F.lit(0)), "drawn": shuffled(key, seed=seed)}
    base = with_row_number(rows.withColumns(sized), "mix")
    sums = base.groupBy(F.col("mix_source").alias("source")).agg(F.sum("mix_size").alias("source_size"))
    targets = source_targets(sums, weights, most).withColumnRenamed("source", "target_source")
    run = running_sums(base, ["mix_source"], ["drawn", key, "uid"], ["mix_size"])
    run = run.drop("source_size").join(targets, F.col("mix_source").eqNullSafe(F.col("target_source")))
    passes = F.sequence(F.lit(0), F.lit(most - 1))

    def taken(e):
        middle = 2 * (e * F.col("source_size") + F.col("mix_size_before")) + F.col("mix_size")
        return (middle <= 2 * F.col("target")) & ((F.col("mix_size") > 0) | (e == 0))

    def when(e):
        middle = e * F.col("source_size") + F.col("mix_size_before") + F.col("mix_size") / 2
        share = F.coalesce(F.try_divide(middle, F.col("target")), F.lit(0.0))
        out = moment(share, curves[-1])
        for k in range(len(weights) - 1):
            out = F.when(F.col("turn") == k, moment(share, curves[k % len(curves)])).otherwise(out)
        return out

    moments = F.transform(F.filter(passes, taken), when)
    out = run.withColumn("moments", moments).withColumn("copies", F.size("moments"))
    return out.drop("mix_source", "mix_size", "mix_size_before", "mix_size_all", "drawn", "uid", "turn", "weight", "target_source")


def _packed(docs: DataFrame, text: str, source: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows as one struct with a number, their narrow form): columns keep any name, and equal rows stay apart."""
    rows = with_row_number(docs.select(F.struct(*docs.columns).alias("row")), "mix-rows")
    at = F.col("row")
    return rows, rows.select(F.col("uid").alias("row_uid"), at[source].alias("source"), at[key].alias("key"), word_count(at[text].cast("string")).alias("size"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **how) -> DataFrame:
    """The mixed documents in training order: each row of `docs` as often as the mix takes it, range-sorted by moment.

    Every row is numbered once and planned by itself, so equal rows each get their own copies and columns may have any
    name and type. The texts are shuffled to their plan and once more into training order; columns stay as they were.
    """
    rows, narrow = _packed(docs, text, source, key)
    placed = plan(narrow, "source", "key", "size", **how).where("copies > 0").select("row_uid", "moments")
    out = rows.join(placed, F.col("uid") == F.col("row_uid")).select("row", "uid", F.explode("moments").alias("at"))
    return out.repartitionByRange("at", "uid").sortWithinPartitions("at", "uid").select("row.*")


def schedule(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    curves: Sequence[Sequence[tuple[float, float]]] = CURVES,
    seed: int = SEED,
    name: str = "moment",
    stored: bool = False,
) -> DataFrame:
    """`docs`, already mixed, with the moment of training at which each row is asked for, as `name`.

    Rows of a source follow its curve: copies of a document lie in passes one after another, each pass in the seeded
    order, and a row's moment is where its source has asked for the tokens before the row's middle. A source without
    tokens starts at once. Null sources, keys and texts are as in `plan`.

    The texts are shuffled once, by a hash of source, key and text that they have in common with their moments: rows that
    share a hash take its moments one each. `docs` is read twice, so it is written first unless it is `stored`, that is,
    a table that gives the same rows at every read.
    """
    if not stored:
        docs = written(docs, "mix-rows")
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    at = F.col("row")
    parts = [at[c].cast("string") for c in (source, key, text)]
    rows = rows.withColumn("content", F.xxhash64(*[x for p in parts for x in (p.isNull(), p)]))
    narrow = rows.select("content", at[source].alias("source"), at[key].alias("key"), word_count(parts[2]).alias("size"))
    narrow = with_row_number(narrow, "mix-sizes").withColumnRenamed("uid", "row_uid")
    # copies are rows of one source, key and size
    copies = numbered(narrow.withColumn("drawn", shuffled("key", seed=seed)), ["source", "drawn", "key", "size"], ["row_uid"], "turn_no").drop("turn_no_of")
    run = running_sums(copies, ["source"], ["turn_no", "drawn", "key", "size", "row_uid"], ["size"])
    sources = narrow.select("source").distinct().withColumn("curve", (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(curves))
    placed = run.join(sources.withColumnRenamed("source", "of_source"), F.col("source").eqNullSafe(F.col("of_source")))
    share = F.coalesce(F.try_divide(F.col("size_before") + F.col("size") / 2, F.col("size_all").cast("double")), F.lit(0.0))
    when = moment(share, curves[-1])
    for k, curve in enumerate(curves[:-1]):
        when = F.when(F.col("curve") == k, moment(share, curve)).otherwise(when)
    moments = written(placed.groupBy(F.col("content").alias("of_content")).agg(F.sort_array(F.collect_list(when)).alias("moments")), "moments")
    rows = rows.withColumn("copy", F.row_number().over(W.partitionBy("content").orderBy("content")) - 1)
    out = rows.join(moments, F.col("content") == F.col("of_content"))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != name], F.get("moments", F.col("copy")).alias(name))
