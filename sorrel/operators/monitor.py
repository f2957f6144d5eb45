"""Monitoring of score batches and request logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sorrel.functions import fixed
from sorrel.operators import drift
from sorrel.operators import naive_bayes as nb
from sorrel.operators.ordered import exact_percentiles, rolling_percentile, running_sums
from sorrel.session import stage

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
LATENCY = {"lat_p50": 0.5, "lat_p95": 0.95, "lat_p99": 0.99}
STATS = ("mean", "std", "min", "max", "p25", "p50", "p75", "positive_rate")


def reference_scores(df: DataFrame, model: nb.Model) -> DataFrame:
    """Scores of the reference set."""
    return df.select(nb.predict_proba(model).alias("score"))


def _moments(df: DataFrame, by: Sequence[str], score: str) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(score).alias("n"),
        F.avg(score).alias("mean"),
        F.stddev_pop(score).alias("std"),
        F.min(score).alias("min"),
        F.max(score).alias("max"),
        F.avg((F.col(score) >= 0.5).cast("double")).alias("positive_rate"),
    )


def score_stats(df: DataFrame, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Size, moments, quartiles and positive rate to four decimals, per group or as one row."""
    base = _moments(df, by, score)
    quart = exact_percentiles(df, by, score, QUARTILES)
    if by:
        wide = base.join(quart, list(by))
    else:
        q = quart.select(F.struct(*QUARTILES)).scalar()
        wide = base.select("*", *[q[c].alias(c) for c in QUARTILES])
    return wide.select(*by, "n", *[F.round(c, 4).alias(c) for c in STATS])


def latency_stats(df: DataFrame, latency: str = "latency_ms", by: Sequence[str] = ()) -> DataFrame:
    """Median, p95, p99 and mean latency, per group or as one row."""
    base = df.groupBy(*by).agg(F.avg(latency).alias("lat_mean"))
    tails = exact_percentiles(df, by, latency, LATENCY)
    if by:
        return tails.join(base, list(by))
    return tails.select("*", base.scalar().alias("lat_mean"))


def psi_per_batch(scores: DataFrame, ref: DataFrame, by: str, score: str = "score", n_bins: int = drift.BINS) -> DataFrame:
    """PSI of each batch against the reference, over the joint range of that batch and the reference.

    The bins differ from batch to batch. Counting the reference below every batch's edges is a rank
    question: the edges are merged into the reference's distinct values and read off one running sum,
    so the work is their sum and not their product.
    """
    ref_counts = ref.groupBy(F.col(score).cast("double").alias("value")).agg(F.count(score).alias("n")).where("value IS NOT NULL")
    ref_counts = stage(ref_counts, "ref")
    # three numbers
    span = ref_counts.agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum("n").alias("n")).first()
    cur_counts = stage(
        scores.where(F.col(score).isNotNull()).groupBy(by, F.col(score).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n")),
        "batches",
    )
    spans = cur_counts.groupBy(by).agg(F.min("value").alias("a"), F.max("value").alias("b"), F.sum("n").alias("cur_n"))
    spans = spans.select(by, F.least("a", F.lit(span.lo)).alias("lo"), F.greatest("b", F.lit(span.hi)).alias("hi"), "cur_n")

    cur_bins = (
        cur_counts.join(spans, by)
        .groupBy(by, drift.bin_of(F.col("value"), F.col("lo"), F.col("hi"), n_bins).alias("bin"))
        .agg(F.sum("n").alias("n_cur"))
    )
    bins = F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1)))
    edges = spans.withColumn("bin", bins).withColumn("value", drift.edge(F.col("lo"), F.col("hi"), F.col("bin"), n_bins))
    # kind 0 sorts an edge before an equal reference value, so the running sum counts strictly lower ones
    points = (
        edges.select(F.lit(0).alias("kind"), F.col(by).alias("batch"), "bin", "value", F.lit(0).cast("bigint").alias("n"))
        .unionByName(
            ref_counts.select(
                F.lit(1).alias("kind"), F.lit(None).cast(scores.schema[by].dataType).alias("batch"), F.lit(0).alias("bin"), "value", "n"
            )
        )
    )
    below = (
        running_sums(points, [], ["value", "kind", "batch", "bin"], ["n"])
        .where(F.col("kind") == 0)
        .select(F.col("batch").alias(by), "bin", F.when(F.col("bin") == 0, 0).otherwise(F.col("n_before")).alias("below"))
    )
    # one row per batch and bin
    upper = F.lead("below").over(W.partitionBy(by).orderBy("bin"))
    ref_bins = below.withColumn("n_ref", F.coalesce(upper, F.lit(span.n)) - F.col("below"))
    both = (
        edges.select(by, "bin", "lo", "hi", "cur_n")
        .join(ref_bins.select(by, "bin", "n_ref"), [by, "bin"])
        .join(cur_bins, [by, "bin"], "left")
        .na.fill(0, ["n_cur"])
    )
    total = drift.psi_sum(drift.share(F.col("n_ref"), F.lit(span.n)), drift.share(F.col("n_cur"), F.col("cur_n")))
    got = both.groupBy(by).agg(total.alias("psi"), F.bool_and(F.col("lo") == F.col("hi")).alias("constant"))
    return got.select(by, F.when(F.col("constant"), 0.0).otherwise(F.round(F.abs("psi"), 6)).alias("psi"))


def score_batch_stats(
    scores: DataFrame, ref: DataFrame, by: str = "batch_id", score: str = "score", latency: str | None = "latency_ms"
) -> DataFrame:
    """Per batch: score statistics, PSI against the reference, latency percentiles if there are any."""
    rows = score_stats(scores, score, [by]).join(psi_per_batch(scores, ref, by, score), by)
    if latency and latency in scores.columns:
        rows = rows.join(latency_stats(scores.where(F.col(latency).isNotNull()), latency, [by]), by, "left")
    return rows


def prediction_report(batches: DataFrame, ref_stats: DataFrame) -> DataFrame:
    """One row over all batches. Batches count equally; the rate weighted by size stands beside it."""
    has_latency = "lat_p99" in batches.columns
    ref_rate = ref_stats.select("positive_rate").scalar()
    got = batches.agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.sum("n").alias("total_predictions"),
        F.avg("psi").alias("psi"),
        F.max("psi").alias("worst"),
        F.avg("positive_rate").alias("rate"),
        (F.sum(F.col("positive_rate") * F.col("n")) / F.sum("n")).alias("weighted"),
        *([F.avg(c).alias(c) for c in LATENCY] + [F.max("lat_p99").alias("lat_max_p99")] if has_latency else []),
    )
    shift = F.abs(F.col("rate") - ref_rate)
    return got.select(
        "n_batches",
        "total_predictions",
        F.round("psi", 6).alias("mean_psi"),
        F.round("worst", 6).alias("max_psi"),
        F.round("rate", 4).alias("mean_pos_rate"),
        F.round("weighted", 4).alias("weighted_pos_rate"),
        F.round(shift, 4).alias("pos_rate_drift"),
        # unrounded values decide the alerts
        F.struct(F.col("psi").alias("psi"), shift.alias("shift")).alias("raw"),
        *([*LATENCY, "lat_max_p99"] if has_latency else []),
    )


def alert_array(report: DataFrame) -> Column:
    """Alerts of a report row as an array of structs."""

    def alert(kind, level, value, text):
        return F.struct(
            F.lit(kind).alias("type"), level.alias("severity"), text.alias("message"), value.cast("double").alias("value")
        )

    psi, shift = F.col("raw.psi"), F.col("raw.shift")
    over = [
        F.when(
            psi > fixed.PSI_ORANGE,
            alert(
                "score_distribution_drift",
                F.when(psi > fixed.PSI_RED, "red").otherwise("orange"),
                psi,
                F.format_string("mean score PSI %.4f", psi),
            ),
        ),
        F.when(
            shift > fixed.SHIFT_ORANGE,
            alert(
                "positive_rate_shift",
                F.when(shift < fixed.SHIFT_RED, "orange").otherwise("red"),
                shift,
                F.format_string("positive rate moved by %.3f", shift),
            ),
        ),
    ]
    if "lat_p99" in report.columns:
        p99 = F.col("lat_p99")
        over.append(
            F.when(p99 > fixed.P99_LIMIT_MS, alert("high_latency", F.lit("warning"), p99, F.format_string("p99 latency %.0f ms", p99)))
        )
    return F.array_compact(F.array(*over))


def with_alerts(report: DataFrame) -> DataFrame:
    """Report with `alerts` and `retrain_needed`, which is true when any alert is red."""
    out = report.withColumn("alerts", alert_array(report))
    return out.withColumn("retrain_needed", F.exists("alerts", lambda a: a["severity"] == "red"))


def alerts(report: DataFrame) -> DataFrame:
    """One row per alert."""
    return report.select(F.inline(alert_array(report)))


def request_metrics(log: DataFrame, ts: str = "ts", endpoint: str = "endpoint", latency: str = "latency_ms") -> DataFrame:
    """Per endpoint and in total (NULL endpoint): requests, rate per minute, mean and p99 latency.

    Both levels come from one staged table of distinct latencies per endpoint.
    """
    counts = log.groupBy(endpoint, latency).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last")
    )
    counts = stage(counts, "latency")
    level = F.explode(F.array(F.col(endpoint), F.lit(None).cast("string")))
    both = counts.withColumn("level", level).groupBy("level", latency).agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    run = running_sums(both, ["level"], [latency], ["n"])
    at = F.lit(0.99) * (F.col("n_all") - 1)
    low, high, a, b = F.floor(at), F.ceil(at), F.col("n_before"), F.col("n_before") + F.col("n") - 1
    got = run.groupBy("level").agg(
        F.sum("n").alias("requests"),
        (F.sum(F.col(latency) * F.col("n")) / F.sum("n")).alias("mean_latency"),
        F.max(F.when(low.between(a, b), F.col(latency))).alias("x"),
        F.max(F.when(high.between(a, b), F.col(latency))).alias("y"),
        F.max(at - low).alias("part"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    span = got.where(F.col("level").isNull()).select(
        ((F.unix_micros(F.col("last").cast("timestamp")) - F.unix_micros(F.col("first").cast("timestamp"))) / 60e6).alias("m")
    ).scalar()
    p99 = F.when(F.col("requests") >= 10, F.col("x") + (F.col("y") - F.col("x")) * F.col("part")).otherwise(0.0)
    return got.select(
        F.col("level").alias(endpoint),
        "requests",
        F.try_divide(F.col("requests").cast("double"), span).alias("per_minute"),
        "mean_latency",
        p99.alias("p99_latency"),
    )


def rolling_latency(log: DataFrame, ts: Sequence[str], latency: str = "latency_ms", size: int = 1000, by: Sequence[str] = ()) -> DataFrame:
    """Mean and p99 of the last `size` requests, at every request."""
    return rolling_percentile(log, ts, latency, size, 0.99, 10, by=by)
