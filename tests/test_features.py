import pytest
from pyspark.sql import functions as F

from sorrel.operators import explore as ex, features as ft, ordered as od, split as sp, validate as va


@pytest.fixture(scope="module")
def ratings(spark):
    data = [(1, 10, 5), (1, 11, 3), (2, 10, 4), (3, 99, 1), (1, 10, 5)]
    return spark.createDataFrame(data, "user_id long, item_id long, rating int")


def test_user_and_item_stats(ratings):
    got = {r.user_id: r for r in ft.user_stats(ratings).collect()}
    assert got[2].user_std_rating == 0.0
    assert got[1].user_n_ratings == 3
    assert got[1].user_std_rating == pytest.approx(1.1547005, abs=1e-6)
    items = {r.item_id: r for r in ft.item_stats(ratings).collect()}
    assert items[10].item_avg_rating == pytest.approx(14 / 3)


def test_matrix_keeps_rows_and_has_no_nulls(spark, ratings):
    users = spark.createDataFrame([(1, 25), (2, 18)], "user_id long, age int")
    items = spark.createDataFrame([(10, 1995.0, "t"), (11, None, "u")], "item_id long, year double, title string")
    m = ft.build_feature_matrix(ratings, users, items, check_keys=True)
    assert m.count() == ratings.count()
    nulls = m.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ("age", "year")]).first()
    assert tuple(nulls) == (0, 0)
    absent = m.where("item_id = 99").first()
    assert (absent.age, absent.year, absent.title) == (0, 0.0, None)
    with pytest.raises(ValueError):
        ft.build_feature_matrix(ratings, users.union(users), items, check_keys=True)
    full = ft.attach_stats(m, ft.user_stats(ratings), ft.item_stats(ratings))
    assert full.count() == ratings.count()


def test_entity_table_keeps_both_sides(spark, rows):
    a = spark.createDataFrame([(1, 5)], "user_id long, age int")
    b = spark.createDataFrame([(2, 3.0)], "user_id long, s double")
    assert rows(ft.entity_table(a, b, "user_id")) == [(1, 5, None), (2, None, 3.0)]


def test_filters(spark, ratings, rows):
    assert rows(ft.min_support(ratings, "item_id", 3)) == [(10, 3)]
    assert ft.exclude_ids(ratings, "item_id", [10, 99]).count() == 1
    excluded = spark.createDataFrame([(1, 10)], "user_id long, item_id long")
    assert ft.exclude_pairs(ratings, excluded, ["user_id", "item_id"]).count() == 3
    df = spark.createDataFrame([(1,), (5,), (None,)], "t int")
    assert ft.filter_time_range(df, "t", F.lit(2), F.lit(6)).count() == 1
    assert ft.filter_time_range(df, "t", F.lit(7), F.lit(9)).count() == 3
    assert ft.filter_time_range(df, "t", F.lit(7), F.lit(9), fallback=False).count() == 0


def test_lookup_and_cold_start(spark, rows):
    stats = spark.createDataFrame([(1, 4.0, 7)], "item_id long, movie_avg_rating double, movie_n_ratings long")
    df = spark.createDataFrame([(1,), (2,)], "item_id long")
    assert rows(ft.lookup_default(df, stats, "item_id")) == [(1, 4.0, 7.0), (2, 3.5, 10.0)]
    means = spark.createDataFrame([(2.0,), (4.0,)], "user_avg_rating double")
    people = spark.createDataFrame([(1, None), (2, 5.0)], "user_id int, user_avg_rating double")
    assert rows(ft.cold_start_means(people, means, ["user_avg_rating"])) == [(1, 3.0), (2, 5.0)]


def test_exploration(spark, ratings, rows):
    items = spark.createDataFrame([(10, "a"), (11, "b"), (12, "c")], "item_id long, title string")
    users = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "user_id long, g string")
    top = ex.top_rated(ratings, items, k=1).first()
    assert (top.item_id, top.n) == (10, 3)
    c = ex.coverage(ratings, users, items, at_least=3).first()
    assert (c.n_items, c.n_users, c.n_ratings, c.n_never_rated, c.n_often) == (3, 3, 5, 0, 1)
    assert c.density == pytest.approx(5 / 9 * 100)
    a = ex.activity_summary(ratings).first()
    assert (a["min"], a["max"], a["median"]) == (1, 3, 1.0)
    assert rows(ex.mean_by_user_attr(ratings, users, "g")) == [("x", 3.5, 4), ("y", 4.0, 1)]
    d = ex.describe_ratings(ratings).first()
    assert (d["mean"], d["median"]) == (3.6, 4.0)
    assert rows(ex.value_distribution(ratings, "rating"))[-1] == (5, 2, 40.0)
    corr = ex.label_correlation(spark.createDataFrame([(0, 1.0, 7.0), (1, 2.0, 7.0)], "y int, a double, const double"), ["a", "const"], "y")
    assert rows(corr) == [("a", 1.0)]


def test_percentiles_match_numpy(spark):
    np = pytest.importorskip("numpy")
    rng = np.random.default_rng(1)
    data = [(int(g), float(v)) for g, v in zip(rng.integers(0, 3, 500), rng.normal(size=500).round(1))] + [(9, 4.0), (None, 2.0), (None, 6.0)]
    df = spark.createDataFrame(data, "g int, v double").repartition(7)
    got = {r.g: (r.a, r.b) for r in od.exact_percentiles(df, ["g"], "v", {"a": 0.25, "b": 0.99}).collect()}
    for g in (0, 1, 2, 9, None):
        v = [x for k, x in data if k == g]
        assert got[g] == pytest.approx(tuple(np.percentile(v, [25, 99])))


def test_auc_with_ties_and_groups(spark, rows):
    df = spark.createDataFrame([(0, 0.2), (0, 0.5), (1, 0.5), (1, 0.7), (1, 0.1)], "y int, s double")
    assert od.roc_auc(df, "s", "y").first().roc_auc == pytest.approx(0.5833333333)
    assert od.roc_auc(df.where("y = 1"), "s", "y").first().roc_auc is None
    both = df.withColumn("g", F.lit("a")).union(df.withColumn("s", -F.col("s")).withColumn("g", F.lit("b")))
    assert dict(rows(od.roc_auc(both, "s", "y", ["g"])))["b"] == pytest.approx(1 - 0.5833333333)


def test_one_value_can_hold_most_rows(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id") * 1.0).alias("v"))
    got = od.exact_percentiles(df, [], "v", {"m": 0.5}).first().m
    vals = sorted(5.0 if i % 3 == 0 else float(i) for i in range(2000))
    assert got == (vals[999] + vals[1000]) / 2


def test_latest_top_and_page(spark, rows):
    df = spark.createDataFrame([(1, 5, 1, "a"), (1, 5, 2, "b"), (1, 4, 9, "c"), (0, 1, 1, "z")], "k int, ts int, created int, v string")
    assert rows(od.latest_per_key(df, "k", "ts", "created"), "k", "v") == [(0, "z"), (1, "b")]
    top = od.top_k_per_user(df, "k", [F.col("ts").desc(), F.col("v")], 2)
    assert rows(top, "k", "rank", "v") == [(0, 1, "z"), (1, 1, "a"), (1, 2, "b")]
    a, b = od.page(spark.range(10), "id", 4, 0), od.page(spark.range(10), "id", 4, 4)
    assert {r.id for r in a.collect()} == {0, 1, 2, 3} and {r.id for r in b.collect()} == {4, 5, 6, 7}
    assert a.first().total == 10


def test_rolling_window_over_blocks(spark):
    np = pytest.importorskip("numpy")
    v = np.random.default_rng(2).exponential(100, 700).round(2)
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "i int, v double").repartition(5)
    got = sorted(od.rolling_percentile(df, ["i"], "v", size=50, span=16).collect(), key=lambda r: r.i)
    for i in (0, 8, 9, 49, 50, 63, 64, 127, 128, 500, 699):
        w = v[max(0, i - 49) : i + 1]
        assert got[i].n_window == len(w)
        assert got[i].mean_latency == pytest.approx(w.mean())
        assert got[i].p_latency == pytest.approx(np.percentile(w, 99) if len(w) >= 10 else 0.0)
    assert len(got) == 700


@pytest.mark.parametrize("size,p,span", [(1, 0.99, 4), (2, 0.5, 4), (3, 0.01, 4), (7, 0.5, 6), (49, 0.9, 256), (50, 0.25, 9), (64, 1.0, 16), (200, 0.0, 31)])
def test_rolling_window_of_any_size(spark, size, p, span):
    np = pytest.importorskip("numpy")
    rng = np.random.default_rng(size)
    data = [(g, i, None if rng.random() < 0.1 else float("nan") if rng.random() < 0.1 else float(rng.integers(0, 30))) for g in (None, 1) for i in range(260)]
    df = spark.createDataFrame(data, "g int, i int, v double").repartition(4)
    got = {(r.g, r.i): r for r in od.rolling_percentile(df, ["i"], "v", size, p, 1, by=["g"], span=span).collect()}
    assert len(got) == len(data)
    for g in (None, 1):
        v = [np.nan if x is None else x for h, _, x in data if h == g]
        for i in range(260):
            w = [x for x in v[max(0, i - size + 1) : i + 1] if x == x]
            r = got[g, i]
            assert r.n_window == min(i + 1, size) and (r.p_latency is None) == (not w) == (r.mean_latency is None)
            assert not w or (r.mean_latency == pytest.approx(np.mean(w)) and r.p_latency == pytest.approx(np.percentile(w, 100 * p)))


def test_splits_are_stable_and_balanced(spark):
    df = spark.range(4000).select("id", (F.col("id") % 5 == 0).cast("int").alias("y"))
    a = sp.stratified_split(df, "y", ["id"])
    b = sp.stratified_split(df.repartition(7), "y", ["id"])
    assert a.exceptAll(b).isEmpty()
    share = a.groupBy("y").agg(F.avg((F.col("split") == "test").cast("double")).alias("s")).collect()
    assert all(abs(r.s - 0.2) < 0.04 for r in share)
    exact = sp.exact_split(df, "y", ["id"]).groupBy("y").agg(F.count_if(F.col("split") == "test").alias("n")).collect()
    assert {r.y: r.n for r in exact} == {0: 640, 1: 160}
    folds = sp.exact_folds(df, "y", ["id"], 3).groupBy("y", "fold").count().collect()
    for y, n in ((0, 3200), (1, 800)):
        sizes = [r["count"] for r in folds if r.y == y]
        assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1 and sum(sizes) == n


def quality(spark, n, positives, dup=0, nulls=0.0):
    base = spark.range(n).select(
        F.when(F.col("id") < dup, F.lit(-1)).otherwise(F.col("id")).alias("a"),
        F.when(F.col("id") >= nulls * n, F.lit(1.0)).alias("b"),
        (F.col("id") < positives).cast("int").alias("y"),
    )
    got = va.run_quality_checks(base, ["a", "b"], "y").collect()
    return {r.check: r.passed for r in got}, got[0].all_passed


def test_quality_limits(spark):
    checks, ok = quality(spark, 1000, 100)
    assert all(checks.values()) and ok
    assert not quality(spark, 999, 500)[0]["min_rows"]
    assert quality(spark, 1000, 900, nulls=0.05)[0] == dict.fromkeys(checks, True)
    assert not quality(spark, 1000, 90)[0]["class_balance"]
    assert not quality(spark, 1000, 910)[0]["class_balance"]
    assert not quality(spark, 1000, 500, nulls=0.06)[0]["no_nulls"]
    allnull, ok = quality(spark, 1000, 500, nulls=1.0)
    assert not allnull["no_null_columns"] and not ok
    # ten repeats in a thousand rows reach one percent; that is recorded but does not fail the run
    assert quality(spark, 1000, 500, dup=10)[0]["no_duplicates"]
    few, ok = quality(spark, 1000, 500, dup=12, nulls=0.02)
    assert not few["no_duplicates"] and ok


def test_null_columns_and_rates(spark, rows):
    df = spark.createDataFrame([(None, float("nan"), "x"), (None, 1.0, None)], "a int, b double, c string")
    assert rows(va.check_null_columns(df, ["a", "b", "c"])) == [("a",)]
    assert rows(va.null_rates(df, ["a", "b", "c"])) == [("a", 1.0), ("b", 0.5), ("c", 0.5)]
