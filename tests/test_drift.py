import pytest
from pyspark.sql import functions as F

from sorrel.operators import drift as dr, monitor as mo

REF = list(range(1, 21))
CUR = [1, 5, 8, 10, 12, 13, 14, 15, 16, 17, 18, 18, 19, 19, 20, 20, 21, 22, 24, 25]


@pytest.fixture(scope="module")
def sides(spark):
    def frame(v, b):
        return spark.createDataFrame([(float(x), y, 3.0, None) for x, y in zip(v, b)], "x double, b int, const double, empty double")

    return frame(REF, [0] * 12 + [1] * 8), frame(CUR, [0] * 5 + [1] * 15)


def test_literal_frame(sides):
    ref, cur = sides
    counts = dr.value_counts(ref, cur, ["x"])
    bins = dr.bin_sums(counts, dr.profile(counts)).orderBy("bin").collect()
    assert [r.n_ref for r in bins] == [3, 2, 3, 2, 2, 3, 2, 3, 0, 0]
    assert [r.n_cur for r in bins] == [1, 1, 1, 1, 1, 3, 2, 6, 2, 2]
    got = {r.feature: r for r in dr.feature_drift(ref, cur, ["x", "b", "const", "empty"]).collect()}
    assert set(got) == {"x", "b", "const"}
    x, b = got["x"], got["b"]
    assert x.psi == pytest.approx(1.33949, abs=5e-6) and x.test == "ks" and x.drifted
    assert (x.statistic, x.p_value, x.wasserstein) == (0.35, 0.172476, 5.35)
    assert (x.ref_mean, x.cur_mean, x.ref_std, x.cur_std, x.mean_shift) == (10.5, 15.85, 5.7663, 6.0850, 5.35)
    assert (b.test, b.statistic, b.p_value) == ("chi2", 10.208333, 0.001398)
    assert got["const"].psi == 0.0 and not got["const"].drifted


def test_same_data_does_not_drift(sides):
    ref, _ = sides
    for r in dr.feature_drift(ref, ref, ["x", "b"]).collect():
        assert r.psi == 0.0 and r.statistic == 0.0 and r.p_value == 1.0 and not r.drifted


def test_partitioning_does_not_matter(sides):
    ref, cur = sides
    a = dr.feature_drift(ref.repartition(1), cur.repartition(1), ["x", "b"]).collect()
    b = dr.feature_drift(ref.repartition(8), cur.repartition(8), ["x", "b"]).collect()
    assert sorted(a) == sorted(b)


def test_small_columns_are_skipped(spark):
    nine = spark.range(20).select(F.when(F.col("id") < 9, F.col("id") * 1.0).alias("nine"), F.when(F.col("id") < 10, F.col("id") * 1.0).alias("ten"))
    assert [r.feature for r in dr.feature_drift(nine, nine, ["nine", "ten"]).collect()] == ["ten"]


def test_categories(spark):
    ref = spark.createDataFrame([("a",)] * 6 + [("b",)] * 4, "c string")
    cur = spark.createDataFrame([("a",)] * 3 + [("b",)] * 5 + [("new",)] * 2, "c string")
    r = dr.chi2_test(ref, cur, ["c"]).first()
    assert r.statistic == pytest.approx((3 - 6) ** 2 / 6 + (5 - 4) ** 2 / 4)
    assert (r.dof, r.unseen_count) == (1, 2)
    one = dr.chi2_test(ref.where("c = 'a'"), cur, ["c"]).first()
    assert (one.statistic, one.p_value, one.drifted) == (0.0, 1.0, False)
    counts = {x.category: (x.n_ref, x.n_cur) for x in dr.category_counts(ref, cur, "c").collect()}
    assert counts == {"a": (6, 3), "b": (4, 5), "new": (0, 2)}


def test_values_on_edges_go_where_the_edges_say(spark):
    np = pytest.importorskip("numpy")
    lo, hi = 0.0, 0.7
    edges = np.linspace(lo, hi, 11)
    vals = sorted(set(edges) | {np.nextafter(e, -1) for e in edges[1:]})
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = [r.b for r in df.select(dr.bin_of(F.col("v"), F.lit(lo), F.lit(hi)).alias("b")).collect()]
    # the last edge is open upwards, as the largest value belongs to the last bin
    assert got == [int(min(9, np.searchsorted(edges[1:-1], v, side="right"))) for v in vals]


def test_severity_and_summary_limits(spark):
    rows = spark.createDataFrame([("a", 0.25, True), ("b", 0.25, False)], "feature string, psi double, drifted boolean")
    s = dr.drift_summary(rows).first()
    assert (s.severity, s.retrain_needed, s.n_drifted, s.drift_ratio, s.drifted_features) == ("red", False, 1, 0.5, ["a"])
    names = spark.createDataFrame([(0.0999,), (0.10,), (0.2499,), (0.25,)], "p double").select(dr.severity(F.col("p"))).collect()
    assert [r[0] for r in names] == ["green", "orange", "orange", "red"]
    assert dr.rank_features(rows.withColumn("psi", F.when(F.col("feature") == "b", 0.9).otherwise(0.1))).first().feature == "b"
    empty = dr.drift_summary(rows.where("false")).first()
    assert (empty.global_psi, empty.n_features, empty.drift_ratio) == (0.0, 0, 0.0)


def test_report_and_decision(spark, sides):
    ref, cur = sides
    rows, head = dr.drift_report(ref, cur, ["x", "b"], "movies", F.lit("2024-01-02"))
    h = head.first()
    assert (h.dataset, h.n_reference, h.n_current, h.n_features) == ("movies", 20, 20, 2)
    assert dr.retrain_decision(head).first().retrain
    old = head.withColumn("timestamp", F.lit("2023-01-01"))
    calm = old.withColumn("global_psi", F.lit(0.01)).withColumn("timestamp", F.lit("2025-01-01"))
    d = dr.retrain_decision(old.unionByName(calm)).first()
    assert (d.drift_score, d.retrain) == (0.01, False)
    none = dr.retrain_decision(head.where("false")).first()
    assert (none.drift_score, none.reason, none.retrain) == (-1.0, "no_report", True)
    assert dr.shared_columns(ref, cur.drop("b"), ["const"]) == ["x", "empty"]


def test_score_and_latency_statistics(spark):
    df = spark.createDataFrame([(x,) for x in (0.1, 0.4, 0.5, 0.8)], "score double")
    s = mo.score_stats(df).first()
    assert (s.n, s["mean"], s["std"], s["min"], s["max"], s.p25, s.p50, s.p75, s.positive_rate) == (4, 0.45, 0.25, 0.1, 0.8, 0.325, 0.45, 0.575, 0.5)
    lat = mo.latency_stats(spark.createDataFrame([(float(x),) for x in (10, 20, 30, 40, 1000)], "latency_ms double")).first()
    assert tuple(lat) == pytest.approx((30.0, 808.0, 961.6, 220.0))


def test_batch_psi_uses_each_batch_range(spark):
    np = pytest.importorskip("numpy")
    rng = np.random.default_rng(8)
    ref = rng.beta(2, 3, 400).round(3)
    batches = {"inside": rng.beta(2, 2, 60).round(3) * 0.5 + 0.2, "wide": np.append(rng.beta(5, 1, 80), [1.4, -0.3]), "same": ref}
    df = spark.createDataFrame([(k, float(v), 10.0) for k, vs in batches.items() for v in vs], "batch_id string, score double, latency_ms double")
    rdf = spark.createDataFrame([(float(v),) for v in ref], "score double")

    def psi(r, c):
        edges = np.linspace(min(r.min(), c.min()), max(r.max(), c.max()), 11)
        edges[-1] += 1e-10
        a, b = (np.histogram(x, edges)[0] / len(x) for x in (r, c))
        a, b = np.where(a == 0, 0.001, a), np.where(b == 0, 0.001, b)
        return round(abs(float(((b - a) * np.log(b / a)).sum())), 6)

    got = {r.batch_id: r for r in mo.score_batch_stats(df, rdf).collect()}
    assert {k: r.psi for k, r in got.items()} == pytest.approx({k: psi(ref, v) for k, v in batches.items()}, abs=1.1e-6)
    assert got["wide"].n == 82 and got["wide"].lat_p99 == 10.0


def report(spark, psi, rate, p99=None):
    row = [(100, psi, rate, *([1.0, 2.0, p99] if p99 else []))]
    schema = "n long, psi double, positive_rate double" + (", lat_p50 double, lat_p95 double, lat_p99 double" if p99 else "")
    base = spark.createDataFrame([(0.5,)], "positive_rate double")
    return mo.with_alerts(mo.prediction_report(spark.createDataFrame(row, schema), base)).first()


@pytest.mark.parametrize(
    "psi,rate,p99,want,retrain",
    [
        (0.05, 0.5, None, [], False),
        (0.10, 0.649, None, [], False),
        (0.2, 0.66, None, [("score_distribution_drift", "orange"), ("positive_rate_shift", "orange")], False),
        (0.25, 0.75, None, [("score_distribution_drift", "orange"), ("positive_rate_shift", "red")], True),
        (0.26, 0.5, 501.0, [("score_distribution_drift", "red"), ("high_latency", "warning")], True),
        (0.0, 0.5, 500.0, [], False),
    ],
)
def test_alert_limits(spark, psi, rate, p99, want, retrain):
    r = report(spark, psi, rate, p99)
    assert [(a.type, a.severity) for a in r.alerts] == want
    assert r.retrain_needed == retrain


def test_unweighted_and_weighted_rates(spark):
    batches = spark.createDataFrame([(10, 0.0, 1.0), (90, 0.2, 0.0)], "n long, psi double, positive_rate double")
    r = mo.prediction_report(batches, spark.createDataFrame([(0.5,)], "positive_rate double")).first()
    assert (r.n_batches, r.total_predictions, r.mean_psi, r.max_psi, r.mean_pos_rate, r.weighted_pos_rate) == (2, 100, 0.1, 0.2, 0.5, 0.1)


def test_request_metrics(spark):
    log = spark.range(60).select(
        F.timestamp_seconds(F.col("id") * 60).alias("ts"),
        F.when(F.col("id") < 5, "few").otherwise("many").alias("endpoint"),
        (F.col("id") * 1.0).alias("latency_ms"),
    )
    got = {r.endpoint: r for r in mo.request_metrics(log).collect()}
    assert (got[None].requests, got["few"].requests) == (60, 5)
    assert got["few"].p99_latency == 0.0
    assert got[None].p99_latency == pytest.approx(58.41)
    assert got[None].per_minute == pytest.approx(60 / 59)


def test_psi_shuffles_counts_and_equals_the_psi_of_values(spark):
    ref = spark.range(500).selectExpr("double(id % 37) a", "int(id % 3) b", "double('nan') c", "CAST(NULL AS double) d", "5 e", "if(id % 4 = 0, NULL, -0.0D + id) f")
    cur = spark.range(300).selectExpr("double(id % 50) a", "int(id % 2) b", "double(id) c", "CAST(NULL AS double) d", "5 e", "double(id * 3) f")
    cols = ["a", "b", "e", "f"]
    got = {r.feature: r.psi for r in dr.psi(ref, cur, [*cols, "d"]).collect()}
    want = {r.feature: r.psi for r in dr.psi_of_counts(dr.value_counts(ref, cur, cols)).collect()}
    assert got == want and got["e"] == 0.0 and got["f"] > 0
    # a side without values has empty bins only
    assert dr.psi(ref, cur, ["c"]).first().psi > 0
    spans = dr.spans_of(ref, cur, cols)
    counts = dr.wide_bins(ref, cur, spans)
    assert counts.count() == 4 * dr.BINS
    assert dr.psi(ref.limit(0), cur.limit(0), cols).count() == 0
