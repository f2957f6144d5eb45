"""Windows and alerts over the steps of a log (`steps.summarise`) or of a stream (`steps.kept`): the same rows for both.

Every row says whether it is `final`: whether its window ended at least LATENESS before the newest event. Windows that are
still open are there too, and a late row changes the window it belongs to. Percentiles are middles of log-linear bins at
every size (`steps.value_bin`), by nearest rank; `exact_latency_breaches` has exact ones, for finished logs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sorrel.functions import fixed
from sorrel.operators import drift
from sorrel.operators.ordered import exact_percentiles
from sorrel.streaming.steps import START, Steps, bin_value, summarise, value_bin

LATENESS = "1 hour"
NEWEST = (("newest", "ts"),)


def timed(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Event time as TIMESTAMP, under the name `ts`."""
    return df.withColumn("ts", F.col(ts).cast("timestamp"))


def newest_event(steps: DataFrame) -> Column:
    """Time of the newest event in the steps, as a scalar."""
    return steps.agg(F.max("newest")).scalar()


def final(end: Column, steps: DataFrame) -> Column:
    """Whether no event later than LATENESS can belong to a window that ends then."""
    return (end <= newest_event(steps) - F.expr(f"INTERVAL {LATENESS}")).alias("final")


def _flat(df: DataFrame, steps: DataFrame, *cols) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *cols, final(F.col("window.end"), steps))


def _with_percentiles(rows: DataFrame, by: Sequence[str], percents: Mapping[str, int], sums: Sequence[str]) -> DataFrame:
    """Per group of `by`: sums, and nearest-rank percentiles of the values counted by `n_values` in each `bin`.

    A group has at most some thousand bins, whatever it counts: they are few per doubling.
    """
    binned = rows.groupBy(*by, "bin").agg(*[F.sum(c).alias(c) for c in (*sums, "n_values")])
    counted = F.when(F.col("bin").isNotNull(), F.col("n_values")).otherwise(0)
    up_to = F.sum(counted).over(W.partitionBy(*by).orderBy("bin").rowsBetween(W.unboundedPreceding, 0))
    placed = binned.withColumn("up_to", up_to).withColumn("of", F.sum(counted).over(W.partitionBy(*by)))
    first = [F.min(F.when(F.col("bin").isNotNull() & (F.col("up_to") * 100 >= F.col("of") * p), F.col("bin"))).alias(name) for name, p in percents.items()]
    got = placed.groupBy(*by).agg(*[F.sum(c).alias(c) for c in (*sums, "n_values")], *first)
    return got.withColumns({name: bin_value(F.col(name)) for name in percents})


def score_steps(step: str = "1 hour", score: str = "score") -> Steps:
    """Counts, sums and bins of scores. Rows need a column `bin` (`with_bin`)."""
    return Steps(step, ("bin",), (("n_values", f"int({score} IS NOT NULL)"), ("total", f"double({score})"), ("positive", f"int({score} >= 0.5)")), highs=NEWEST)


def with_bin(df: DataFrame, value: str) -> DataFrame:
    return df.withColumn("bin", value_bin(F.col(value)))


def score_windows(steps: DataFrame, size: str = "1 hour") -> DataFrame:
    """Per window: count, mean, positive rate, quartiles. `size` is a multiple of the step: hours and days from minutes."""
    rows = steps.withColumn("window", F.window(START, size))
    got = _with_percentiles(rows, ["window"], {"p25": 25, "p50": 50, "p75": 75}, ["total", "positive"])
    rate = [F.try_divide(c, F.col("n_values").cast("double")).alias(name) for c, name in ((F.col("total"), "mean"), (F.col("positive"), "positive_rate"))]
    return _flat(got, steps, F.col("n_values").alias("n"), *rate, "p25", "p50", "p75")


@dataclass(frozen=True)
class ReferenceBins:
    """Histogram of the reference scores: fixed edges, so that windows can be compared without the future."""

    lo: float
    hi: float
    shares: tuple[float, ...]


def reference_bins(ref: DataFrame, score: str = "score", n_bins: int = drift.BINS) -> ReferenceBins:
    """Range and bin shares of the reference; `n_bins` numbers reach the driver."""
    span = ref.agg(F.struct(F.min(score).alias("lo"), F.max(score).alias("hi"))).scalar()
    lo, hi = span["lo"].cast("double"), span["hi"].cast("double")
    at = drift.bin_of(F.col(score).cast("double"), lo, hi, n_bins)
    row = ref.agg(
        F.min(score).alias("lo"), F.max(score).alias("hi"), F.count(score).alias("n"),
        F.array(*[F.count_if(at == i) for i in range(n_bins)]).alias("bins"),
    ).first()
    return ReferenceBins(float(row.lo), float(row.hi), tuple((b / row.n) or fixed.EMPTY_SHARE for b in row.bins))


def psi_steps(step: str = "1 hour", score: str = "score") -> Steps:
    """Scores per reference bin. Rows need a column `bin` (`with_reference_bin`)."""
    return Steps(step, ("bin",), (("n", f"int({score} IS NOT NULL)"),), highs=NEWEST)


def with_reference_bin(df: DataFrame, bins: ReferenceBins, score: str = "score") -> DataFrame:
    """The reference bin of each score; scores beyond the reference's range go to the end bins."""
    return df.withColumn("bin", drift.bin_of(F.col(score).cast("double"), F.lit(bins.lo), F.lit(bins.hi), len(bins.shares)).cast("int"))


def psi_windows(steps: DataFrame, bins: ReferenceBins, size: str = "1 day") -> DataFrame:
    """PSI of each window against the reference histogram."""
    counts = F.array(*[F.coalesce(F.sum(F.when(F.col("bin") == i, F.col("n"))), F.lit(0)) for i in range(len(bins.shares))])
    got = steps.groupBy(F.window(START, size)).agg(F.sum("n").alias("n"), counts.alias("bins"))
    total = F.lit(0.0)
    for i, r in enumerate(bins.shares):
        c = drift.share(F.col("bins")[i], F.col("n"))
        total = total + (c - F.lit(r)) * F.log(c / F.lit(r))
    return _flat(got, steps, "n", F.round(F.abs(total), 6).alias("psi"))


def request_steps(step: str = "1 minute", endpoint: str = "endpoint", latency: str = "latency_ms", status: str = "status") -> Steps:
    """Requests, errors and latency bins per endpoint. Rows need a column `bin` (`with_bin`)."""
    sums = (("n", "1"), ("n_values", f"int({latency} IS NOT NULL)"), ("total", f"double({latency})"), ("errors", f"int(coalesce({status} >= 500, false))"))
    return Steps(step, (endpoint, "bin"), sums, highs=NEWEST)


def request_windows(steps: DataFrame, endpoint: str = "endpoint", size: str = "1 minute") -> DataFrame:
    """Per window and endpoint: requests, mean and p99 latency."""
    rows = steps.withColumn("window", F.window(START, size))
    got = _with_percentiles(rows, ["window", endpoint], {"p99": 99}, ["n", "total"])
    return _flat(got, steps, endpoint, "n", F.try_divide("total", F.col("n_values").cast("double")).alias("mean"), "p99")


def _held(breaches: DataFrame, steps: DataFrame, hold: str, step: str, n_steps: int, kind: str, level: str) -> DataFrame:
    """Alerts where every one of the `n_steps` evaluations of a hold window was a breach."""
    got = breaches.groupBy(F.window("at", hold, step)).agg(F.count_if("breach").alias("n"), F.max("value").alias("value"))
    return _flat(got.where(F.col("n") == n_steps), steps, F.lit(kind).alias("type"), F.lit(level).alias("severity"), "value")


def _latency_alerts(p99: DataFrame, steps: DataFrame, limit: float, step: str, hold: str, n_steps: int) -> DataFrame:
    breaches = p99.select(F.col(START).alias("at"), (F.col("p99") > limit).alias("breach"), F.col("p99").alias("value"))
    return _held(breaches, steps, hold, step, n_steps, "high_latency", "warning")


def latency_breaches(steps: DataFrame, limit: float = fixed.P99_LIMIT_MS, step: str = "1 minute", hold: str = "5 minutes", n_steps: int = 5) -> DataFrame:
    """p99 above the limit for a whole hold period; `step` is that of `steps`."""
    return _latency_alerts(_with_percentiles(steps, [START], {"p99": 99}, []), steps, limit, step, hold, n_steps)


def exact_latency_breaches(
    log: DataFrame, latency: str = "latency_ms", limit: float = fixed.P99_LIMIT_MS, step: str = "1 minute", hold: str = "5 minutes", n_steps: int = 5
) -> DataFrame:
    """The same for a finished log, from exact nearest-rank percentiles."""
    log = timed(log)
    p99 = exact_percentiles(log.withColumn(START, F.window("ts", step)["start"]), [START], latency, {"p99": 0.99}, nearest=True)
    return _latency_alerts(p99, summarise(log, Steps(step, highs=NEWEST)), limit, step, hold, n_steps)


def error_rate_breaches(
    steps: DataFrame, limit: float = 0.05, size: str = "5 minutes", seconds: float = 300.0, step: str = "1 minute", hold: str = "2 minutes", n_steps: int = 2
) -> DataFrame:
    """Server errors per second over a sliding window above the limit for a whole hold period."""
    sliding = steps.groupBy(F.window(START, size, step)).agg((F.sum("errors") / F.lit(seconds)).alias("rate"))
    breaches = sliding.select(F.window_time("window").alias("at"), (F.col("rate") > limit).alias("breach"), F.col("rate").alias("value"))
    return _held(breaches, steps, hold, step, n_steps, "high_error_rate", "critical")


def target_steps(step: str = "1 minute", target: str = "target") -> Steps:
    """First and last request of a target. Within a step as long as the gap there can be no silence."""
    return Steps(step, (target,), lows=(("first_seen", "ts"),), highs=(("last_seen", "ts"), *NEWEST))


def silences(steps: DataFrame, target: str = "target", gap_seconds: int = 60) -> DataFrame:
    """Targets without a request for longer than the gap; `back_at` is null for one that has not come back.

    Evaluated on steps no longer than the gap, so a busy target is a row per step before it is ordered. A silence that
    is open now ends, under the same `silent_from`, when the target's next request has been read.
    """
    gap = F.expr(f"INTERVAL {gap_seconds} SECONDS")
    following = F.lead("first_seen").over(W.partitionBy(target).orderBy(START))
    newest = newest_event(steps)
    return (
        steps.withColumn("back_at", following)
        .where(F.coalesce("back_at", newest) > F.col("last_seen") + gap)
        .select(target, (F.col("last_seen") + gap).alias("silent_from"), "back_at", F.lit("target_down").alias("type"), F.lit("critical").alias("severity"))
    )
