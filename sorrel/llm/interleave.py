"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sorrel.llm.rows import numbered, plain_names, shuffled, with_row_number

SEED = 20


def text_size(text: str):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def interleave(rows: DataFrame, source: str, key: str, shards: int, seed: int = SEED) -> DataFrame:
    """`rows` with `shard` and `slot`: shards of equal row counts (at most one apart), each with the mixture of sources.

    Rows of a source are put in a seeded order and the k-th of n stands at (k + 0.5) / n; all rows are sorted by that
    fraction and cut into `shards` runs. Both rankings are sums over range partitions, so one source may hold most of the
    rows. A null source is a stratum of its own; rows with a null or repeated key are kept apart by their place in the
    input. `rows` should be narrow: it is written once and sorted twice. An empty table gives an empty result. Columns
    called shard and slot are replaced; others may have any name.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    rows = rows.drop("shard", "slot")
    given = rows.columns
    rows, called = plain_names(rows)
    source, key = called[source], called[key]
    base = with_row_number(rows.withColumns({"stratum": F.col(source), "drawn": shuffled(key, seed=seed)}), "strata")
    ranked = numbered(base, ["stratum"], ["drawn", key, "uid"], "rank")
    ranked = ranked.withColumn("fraction", (F.col("rank") + 0.5) / F.col("rank_of"))
    placed = numbered(ranked, [], ["fraction", "stratum", "drawn", key, "uid"], "place")
    shard = F.expr(f"cast(place * {shards} div place_of as int)")
    first = F.expr(f"(shard * place_of + {shards - 1}) div {shards}")
    out = placed.withColumn("shard", shard).withColumn("slot", F.col("place") - first)
    return out.select(*rows.columns, "shard", "slot").toDF(*given, "shard", "slot")
