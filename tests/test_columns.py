import math

import pytest
from pyspark.sql import functions as F

from sorrel.functions import columns as C, fixed
from sorrel.functions.special import chi2_sf, erfc, kolmogorov_sf


def test_year_takes_the_first_and_is_null_without_one(spark):
    df = spark.createDataFrame([("Toy (1995)",), ("No year",), ("A (1990) (2001)",), (None,)], "t string")
    assert [r.y for r in df.select(C.extract_year("t").alias("y")).collect()] == [1995.0, None, 1990.0, None]


def test_one_hot_is_sorted_binary_and_zero_for_missing(spark):
    df = spark.createDataFrame([("Drama|Comedy",), ("War",), (None,)], "g string")
    out = df.select(*C.one_hot("g", ["War", "Drama", "Comedy"]))
    assert out.columns == ["Comedy", "Drama", "War"]
    assert [tuple(r) for r in out.collect()] == [(1, 1, 0), (0, 0, 1), (0, 0, 0)]


def test_vocabulary_and_tokens(spark, rows):
    df = spark.createDataFrame([(1, "a|b"), (2, "b")], "i int, g string")
    assert rows(C.vocabulary(df, "g")) == [("a",), ("b",)]
    assert rows(C.explode_tokens(df, "g"), "i", "token") == [(1, "a"), (1, "b"), (2, "b")]


def test_binary_and_label(spark):
    df = spark.createDataFrame([("M", 4), ("F", 3), (None, None)], "g string, r int")
    got = df.select(C.encode_binary("g"), C.label_threshold("r")).collect()
    assert [tuple(r) for r in got] == [(1, 1), (0, 0), (0, 0)]


def test_missing_is_null_and_nan(spark):
    df = spark.createDataFrame([(None, "x"), (float("nan"), None), (2.0, "y")], "v double, s string")
    filled = C.fill_missing(df).collect()
    assert [r.v for r in filled] == [0.0, 0.0, 2.0]
    assert [r.s for r in filled] == ["x", None, "y"]
    assert df.where(C.missing_in(df, "v")).count() == 2
    assert df.where(C.missing_in(df, "s")).count() == 1


def test_align_adds_drops_and_reorders(spark):
    df = spark.createDataFrame([(1, None, 5.0)], "k int, a double, extra double")
    out = C.align_columns(df, ["b", "a"], keep=["k"])
    assert out.columns == ["k", "b", "a"]
    assert tuple(out.first()) == (1, 0.0, 0.0)


def test_profile_defaults_zero_counts_as_missing(spark):
    df = spark.createDataFrame([(0.0, None, 0.8)], "user_avg_rating double, user_n_ratings long, user_std_rating double")
    assert tuple(C.profile_defaults(df).first()) == (3.5, 20.0, 0.8)
    kept = C.profile_defaults(df, zero_is_missing=False).first()
    assert kept.user_avg_rating == 0.0


def test_labels_names_and_epoch(spark):
    df = spark.createDataFrame([(1,), (77,)], "age int")
    assert [r[0] for r in df.select(C.map_labels("age", fixed.AGE_LABELS)).collect()] == ["<18", "77"]
    odd = spark.createDataFrame([(1, 2, 3)], "UserID int, `Film-Noir` int, `Children's` int")
    assert C.normalise_names(odd, {"userid": "user_id"}).columns == ["user_id", "film_noir", "childrens"]
    at = spark.range(1).select(F.date_format(C.epoch_to_ts(F.lit(956703932)), "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert at == "2000-04-25 23:05:32"


def test_scaling_is_not_clipped_and_survives_a_zero_range(spark):
    df = spark.createDataFrame([(15.0, 3.0)], "a double, b double")
    assert tuple(C.minmax_scale(df, {"a": (0.0, 10.0), "b": (3.0, 3.0)}).first()) == (1.5, 0.0)


def test_feature_order(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "id int, stat int, a int, b int")
    assert C.feature_columns(df, ["id"], ["stat"]) == ["a", "b", "stat"]


@pytest.mark.parametrize("x,df,p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (18.307038, 10, 0.05), (10.2083333333, 1, 0.0013980747), (124.342113, 100, 0.05)])
def test_chi2_critical_values(spark, x, df, p):
    got = spark.range(1).select(chi2_sf(F.lit(x), F.lit(df))).first()[0]
    assert got == pytest.approx(p, abs=2e-7)


@pytest.mark.parametrize("n", [19_999, 20_001, 1_000_000, 1_000_001, 100_000_000])
def test_chi2_of_many_degrees(spark, n):
    # points of the normal approximation, whose error shrinks with n
    for z, p in ((1.6448536, 0.05), (-1.6448536, 0.95), (0.0, 0.5)):
        x = n * (1 - 2 / (9 * n) + z * math.sqrt(2 / (9 * n))) ** 3
        got = spark.range(1).select(chi2_sf(F.lit(x), F.lit(n))).first()[0]
        assert got == pytest.approx(p, abs=1e-5)


def test_kolmogorov_and_erfc(spark):
    got = spark.range(1).select(kolmogorov_sf(F.lit(1.358)), kolmogorov_sf(F.lit(0.1)), kolmogorov_sf(F.lit(1.1067971811)), erfc(F.lit(0.5)), erfc(F.lit(3.0))).first()
    assert got[0] == pytest.approx(0.05, abs=1e-4)
    assert got[1] == 1.0
    assert got[2] == pytest.approx(0.1724762703, abs=1e-9)
    assert got[3] == pytest.approx(math.erfc(0.5), abs=1e-14)
    assert got[4] == pytest.approx(math.erfc(3.0), abs=1e-14)
