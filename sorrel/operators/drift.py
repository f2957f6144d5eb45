"""Drift of many features at once between a reference and a current data set.

Both sides are turned into (feature, value) counts with one shuffle that combines first; the staged
counts then give every statistic: PSI, Kolmogorov-Smirnov, chi-squared, Wasserstein and moments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sorrel.functions import columns as C, fixed
from sorrel.functions.special import chi2_sf, kolmogorov_sf
from sorrel.operators.ordered import ecdf_pair
from sorrel.session import stage

BINS = 10


def shared_columns(ref: DataFrame, cur: DataFrame, not_features: Sequence[str]) -> list[str]:
    return [c for c in ref.columns if c in cur.columns and c not in not_features]


def value_counts(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, value, n_ref, n_cur) over both sides, staged because every statistic reads it.

    A row becomes (position, value) pairs, so the shuffle moves numbers and no names. Missing values drop out.
    """

    def long(df: DataFrame, is_ref: bool) -> DataFrame:
        values = F.array(*[F.col(c).cast("double") for c in cols])
        one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        return (
            df.select(F.posexplode(values).alias("position", "value"))
            .where(C.present("value"))
            # -0.0 and 0.0 are one value
            .withColumn("value", F.col("value") + F.lit(0.0))
            .withColumns({"n_ref": one if is_ref else zero, "n_cur": zero if is_ref else one})
        )

    counts = (
        long(ref, True)
        .unionByName(long(cur, False))
        .groupBy("position", "value")
        .agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    )
    names = F.array(*[F.lit(c) for c in cols])
    return stage(counts.select(F.get(names, F.col("position")).alias("feature"), "value", "n_ref", "n_cur"), "counts")


def category_counts(ref: DataFrame, cur: DataFrame, col: str) -> DataFrame:
    """Counts of every category of either side, 0 where it is absent, for a column of any type."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    a = ref.select(F.col(col).alias("category"), one.alias("n_ref"), zero.alias("n_cur"))
    b = cur.select(F.col(col).alias("category"), zero.alias("n_ref"), one.alias("n_cur"))
    both = a.unionByName(b).where(F.col("category").isNotNull())
    return both.groupBy("category").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def edge(lo: Column, hi: Column, i: Column | int, n: int) -> Column:
    """Lower edge of bin i of n equal-width bins."""
    return (F.lit(i) if isinstance(i, int) else i) * ((hi - lo) / F.lit(float(n))) + lo


def bin_of(v: Column, lo: Column, hi: Column, n: int = BINS) -> Column:
    """Bin 0..n-1 by comparison with the edge values; the largest value is in the last bin."""
    guess = F.floor(F.try_divide((v - lo) * F.lit(float(n)), hi - lo))
    guess = F.greatest(F.lit(0), F.least(F.lit(n - 1), F.coalesce(guess, F.lit(0)))).cast("int")
    # the division can land one bin off where a value sits on an edge
    down = (guess > 0) & (v < edge(lo, hi, guess, n))
    up = (guess < n - 1) & (v >= edge(lo, hi, guess + 1, n))
    return F.when(down, guess - 1).when(up, guess + 1).otherwise(guess)


def psi_sum(ref_share: Column, cur_share: Column) -> Column:
    return F.sum((cur_share - ref_share) * F.log(cur_share / ref_share))


def share(n: Column, total: Column) -> Column:
    return F.when(n == 0, F.lit(fixed.EMPTY_SHARE)).otherwise(n / total)


def profile(counts: DataFrame, binary: Sequence[str] = (), min_values: int = 0) -> DataFrame:
    """One row per feature: joint range, sizes, and whether it is binary (named so, or only 0 and 1 in the reference).

    Features with fewer than `min_values` values on a side are left out. The few rows, one per input
    column, are fetched once and handed on as a literal table, so that no statistic aggregates them again.
    """
    zero_one = F.bool_and(F.when(F.col("n_ref") > 0, F.col("value").isin(0.0, 1.0)))
    named = F.col("feature").isin(list(binary)) if binary else F.lit(False)
    rows = counts.groupBy("feature").agg(
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.sum("n_ref").alias("ref_n"),
        F.sum("n_cur").alias("cur_n"),
        F.coalesce(zero_one, F.lit(False)).alias("zero_one"),
    )
    enough = (F.col("ref_n") >= min_values) & (F.col("cur_n") >= min_values)
    rows = rows.where(enough).withColumn("is_binary", F.col("zero_one") | named).drop("zero_one")
    return counts.sparkSession.createDataFrame(rows.collect(), rows.schema)


def bin_sums(counts: DataFrame, spans: DataFrame, n_bins: int = BINS) -> DataFrame:
    """Counts and centred power sums of both sides in the bins of the joint range, empty bins included."""
    x = F.col("value") - F.col("lo")
    sums = {f"n_{s}": F.col(f"n_{s}") for s in ("ref", "cur")}
    sums |= {f"{s}_1": x * F.col(f"n_{s}") for s in ("ref", "cur")}
    sums |= {f"{s}_2": x * x * F.col(f"n_{s}") for s in ("ref", "cur")}
    # one row per feature is broadcast
    binned = counts.join(F.broadcast(spans.select("feature", "lo", "hi")), "feature").withColumn(
        "bin", bin_of(F.col("value"), F.col("lo"), F.col("hi"), n_bins)
    )
    filled = binned.groupBy("feature", "bin").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    every = spans.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))))
    return every.join(filled, ["feature", "bin"], "left").na.fill(0, list(sums))


def psi_and_moments(bins: DataFrame) -> DataFrame:
    """Per feature the stability index (0 for a constant) and both sides' means and population deviations."""
    total = psi_sum(share(F.col("n_ref"), F.col("ref_n")), share(F.col("n_cur"), F.col("cur_n")))
    got = bins.groupBy("feature", "lo", "hi", "ref_n", "cur_n", "is_binary").agg(
        total.alias("psi"), *[F.sum(c).alias(c) for c in ("ref_1", "ref_2", "cur_1", "cur_2")]
    )

    def mean(s):
        return F.col(f"{s}_1") / F.col(f"{s}_n")

    def std(s):
        return F.sqrt(F.greatest(F.lit(0.0), F.col(f"{s}_2") / F.col(f"{s}_n") - mean(s) * mean(s)))

    return got.select(
        "feature",
        "is_binary",
        F.when(F.col("lo") == F.col("hi"), 0.0).otherwise(F.round(F.abs("psi"), 6)).alias("psi"),
        (F.col("lo") + mean("ref")).alias("ref_mean"),
        (F.col("lo") + mean("cur")).alias("cur_mean"),
        std("ref").alias("ref_std"),
        std("cur").alias("cur_std"),
        F.abs(mean("cur") - mean("ref")).alias("mean_shift"),
    )


def psi_of_counts(counts: DataFrame, n_bins: int = BINS) -> DataFrame:
    """Population stability index per feature; a constant feature has 0."""
    return psi_and_moments(bin_sums(counts, profile(counts), n_bins)).select("feature", "psi")


def spans_of(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, lo, hi, ref_n, cur_n) by one wide aggregate a side: a task sends on one row, and one row per column is kept."""

    def wide(df: DataFrame) -> list:
        values = [F.when(C.present(c), F.col(c).cast("double") + F.lit(0.0)) for c in cols]
        return list(df.agg(*[F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n")).alias(f"f{i}") for i, v in enumerate(values)]).first())

    rows = []
    for c, a, b in zip(cols, wide(ref), wide(cur)):
        ends = [x for s in (a, b) for x in (s.lo, s.hi) if x is not None]
        rows += [(c, min(ends), max(ends), a.n, b.n)] if ends else []
    return ref.sparkSession.createDataFrame(rows, "feature string, lo double, hi double, ref_n long, cur_n long")


def wide_bins(ref: DataFrame, cur: DataFrame, spans: DataFrame, n_bins: int = BINS) -> DataFrame:
    """(feature, bin, n_ref, n_cur) for every bin of every feature in `spans`.

    A row turns into its bins where it is read, and these are counted before anything is sent: a task sends on at most
    one count per feature and bin. No value is shuffled.
    """
    ranges = spans.collect()

    def long(df: DataFrame, n_ref: int, n_cur: int) -> DataFrame:
        at = [F.when(C.present(r.feature), bin_of(F.col(r.feature).cast("double") + F.lit(0.0), F.lit(r.lo), F.lit(r.hi), n_bins)) for r in ranges]
        pairs = df.select(F.posexplode(F.array(*at) if at else F.array().cast("array<int>")).alias("position", "bin")).where("bin IS NOT NULL")
        return pairs.select("position", "bin", F.lit(n_ref).cast("bigint").alias("n_ref"), F.lit(n_cur).cast("bigint").alias("n_cur"))

    counts = long(ref, 1, 0).unionByName(long(cur, 0, 1)).groupBy("position", "bin").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    every = ref.sparkSession.createDataFrame([(i, r.feature) for i, r in enumerate(ranges)], "position int, feature string")
    every = every.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))))
    return every.join(counts, ["position", "bin"], "left").na.fill(0, ["n_ref", "n_cur"]).drop("position")


def psi(ref: DataFrame, cur: DataFrame, cols: Sequence[str], n_bins: int = BINS) -> DataFrame:
    """Population stability index per feature; a constant feature has 0, a feature without values is left out."""
    spans = spans_of(ref, cur, cols)
    total = psi_sum(share(F.col("n_ref"), F.col("ref_n")), share(F.col("n_cur"), F.col("cur_n")))
    # one row per feature
    got = wide_bins(ref, cur, spans, n_bins).join(F.broadcast(spans), "feature").groupBy("feature", "lo", "hi").agg(total.alias("psi"))
    return got.select("feature", F.when(F.col("lo") == F.col("hi"), 0.0).otherwise(F.round(F.abs("psi"), 6)).alias("psi"))


def ks_of_counts(counts: DataFrame) -> DataFrame:
    """Two-sample KS statistic and p-value, and the Wasserstein distance, from one pair of running sums."""
    e = ecdf_pair(counts)
    gap = F.abs(F.col("f_ref") - F.col("f_cur"))
    got = e.groupBy("feature").agg(
        F.max(gap).alias("ks"),
        F.coalesce(F.sum(gap * (F.col("next_value") - F.col("value"))), F.lit(0.0)).alias("wasserstein"),
        F.max("n_ref_all").cast("double").alias("n"),
        F.max("n_cur_all").cast("double").alias("m"),
    )
    lam = F.col("ks") * F.sqrt(F.col("n") * F.col("m") / (F.col("n") + F.col("m")))
    return got.select("feature", "ks", kolmogorov_sf(lam).alias("p_value"), "wasserstein")


def ks_test(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    got = ks_of_counts(value_counts(ref, cur, cols))
    return got.select("feature", F.col("ks").alias("statistic"), "p_value", (F.col("p_value") < fixed.P_LIMIT).alias("drifted"))


def wasserstein(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    return ks_of_counts(value_counts(ref, cur, cols)).select("feature", "wasserstein")


def chi2_of_counts(counts: DataFrame, group: str = "feature") -> DataFrame:
    """Chi-squared of the current counts against the reference shares.

    Categories the reference lacks are left out of the sum but stay in the total, as in the original
    rule; `unseen_count` says how many current rows they hold. Fewer than two categories: (0, 1).
    """
    totals = counts.groupBy(group).agg(F.sum("n_ref").alias("ref_n"), F.sum("n_cur").alias("cur_n"))
    expected = F.col("n_ref") * F.col("cur_n") / F.col("ref_n")
    seen = F.col("n_ref") > 0
    # one row per group beside all their categories
    got = (
        counts.join(F.broadcast(totals) if group == "feature" else totals, group)
        .groupBy(group)
        .agg(
            F.sum(F.when(seen, F.try_divide((F.col("n_cur") - expected) * (F.col("n_cur") - expected), expected))).alias("chi2"),
            F.count_if(seen).alias("k"),
            F.sum(F.when(~seen, F.col("n_cur")).otherwise(0)).alias("unseen_count"),
        )
    )
    stat = F.when(F.col("k") < 2, 0.0).otherwise(F.col("chi2"))
    with_stat = got.select(group, stat.alias("statistic"), (F.col("k") - 1).alias("dof"), "k", "unseen_count")
    p = F.when(F.col("k") < 2, 1.0).otherwise(chi2_sf(F.col("statistic"), F.col("dof")))
    return with_stat.select(group, "statistic", "dof", p.alias("p_value"), "unseen_count")


def chi2_test(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Chi-squared test per categorical column of any type."""
    parts = None
    for c in cols:
        one = category_counts(ref, cur, c).select(F.lit(c).alias("feature"), F.col("category").cast("string"), "n_ref", "n_cur")
        parts = one if parts is None else parts.unionByName(one)
    return chi2_of_counts(parts).withColumn("drifted", F.col("p_value") < fixed.P_LIMIT)


def feature_drift(
    ref: DataFrame,
    cur: DataFrame,
    cols: Sequence[str],
    binary: Sequence[str] = (),
    min_values: int = fixed.MIN_VALUES,
) -> DataFrame:
    """One row per feature with PSI, its test, and moments.

    Features named binary, or with reference values in {0, 1}, take the chi-squared test on whole
    numbers; the others KS and Wasserstein. Drifted means the test says so or PSI is above the limit.
    """
    counts = value_counts(ref, cur, cols)
    spans = profile(counts, binary, min_values)
    marked = counts.join(F.broadcast(spans.select("feature", "is_binary")), "feature")
    binary_counts = (
        marked.where("is_binary")
        .groupBy("feature", F.col("value").cast("bigint").alias("value"))
        .agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    )
    chi = chi2_of_counts(binary_counts).select("feature", F.col("statistic").alias("chi_s"), F.col("p_value").alias("chi_p"), "unseen_count")
    ks = ks_of_counts(marked.where(~F.col("is_binary")).select("feature", "value", "n_ref", "n_cur")).select(
        "feature", F.col("ks").alias("ks_s"), F.col("p_value").alias("ks_p"), "wasserstein"
    )
    wide = psi_and_moments(bin_sums(counts, spans)).join(chi, "feature", "left").join(ks, "feature", "left")
    p = F.coalesce("chi_p", "ks_p")
    return wide.select(
        "feature",
        "psi",
        F.when(F.col("is_binary"), "chi2").otherwise("ks").alias("test"),
        F.round(F.coalesce("chi_s", "ks_s"), 6).alias("statistic"),
        F.round(p, 6).alias("p_value"),
        F.round("wasserstein", 6).alias("wasserstein"),
        ((p < fixed.P_LIMIT) | (F.col("psi") > fixed.PSI_RED)).alias("drifted"),
        *[F.round(c, 4).alias(c) for c in ("ref_mean", "cur_mean", "ref_std", "cur_std", "mean_shift")],
        F.coalesce("unseen_count", F.lit(0)).alias("unseen_count"),
    )


def severity(value: Column) -> Column:
    return F.when(value < fixed.PSI_ORANGE, "green").when(value < fixed.PSI_RED, "orange").otherwise("red")


def drift_summary(rows: DataFrame) -> DataFrame:
    """One row over all features: mean PSI, counts, names of the drifted, severity, retrain flag."""
    got = rows.agg(
        F.coalesce(F.avg("psi"), F.lit(0.0)).alias("mean_psi"),
        F.count(F.lit(1)).alias("n_features"),
        F.count_if("drifted").alias("n_drifted"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature")))).alias("drifted_features"),
    )
    ratio = F.coalesce(F.try_divide(F.col("n_drifted"), F.col("n_features")), F.lit(0.0))
    return got.select(
        F.round("mean_psi", 6).alias("global_psi"),
        "n_features",
        "n_drifted",
        F.round(ratio, 4).alias("drift_ratio"),
        "drifted_features",
        severity(F.col("mean_psi")).alias("severity"),
        (F.col("mean_psi") > fixed.PSI_RED).alias("retrain_needed"),
    )


def rank_features(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.col("psi").desc(), "feature")


def drift_report(
    ref: DataFrame, cur: DataFrame, cols: Sequence[str], dataset: str, at: Column, binary: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(feature rows, summary row) with data set name, time and sizes on the summary."""
    rows = stage(feature_drift(ref, cur, cols, binary), "drift")
    n_ref, n_cur = (df.agg(F.count(F.lit(1)).alias("n")).scalar() for df in (ref, cur))
    head = drift_summary(rows).select(
        F.lit(dataset).alias("dataset"), at.alias("timestamp"), n_ref.alias("n_reference"), n_cur.alias("n_current"), "*"
    )
    return rows, head


def retrain_decision(reports: DataFrame, ts: str = "timestamp", threshold: float = fixed.RETRAIN_OVER) -> DataFrame:
    """Whether to train, by the newest report's score; without any report, train."""
    newest = reports.agg(F.max_by(F.col("global_psi"), F.col(ts)).alias("score"), F.count(F.lit(1)).alias("n"))
    none = F.col("n") == 0
    return newest.select(
        F.when(none, -1.0).otherwise(F.col("score")).alias("drift_score"),
        F.when(none, "no_report").otherwise("drift_report").alias("reason"),
        (none | F.coalesce(F.col("score") > threshold, F.lit(False))).alias("retrain"),
    )
