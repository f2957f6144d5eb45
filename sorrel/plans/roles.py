"""How the supplied sample tables take the roles of ratings, users, items, logs and features."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sorrel.functions import columns as C, fixed
from sorrel.functions.hashing import portable_hash
from sorrel.operators import features as ft, split as sp
from sorrel.operators.store import FeatureView
from sorrel.session import stage_by_key

TAGS = [
    "anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large",
    "new", "old", "plate", "red", "ring", "rod", "small", "widget",
]
ROW_KEY = ["order_id", "line_no", "item_id"]
STATS = ["user_avg_rating", "user_n_ratings", "user_std_rating", "item_avg_rating", "item_n_ratings"]
USER_SIDE = ["gender_enc", "age", "occupation", "user_avg_rating", "user_n_ratings", "user_std_rating"]
ITEM_SIDE = ["year", "item_avg_rating", "item_n_ratings", *TAGS]
CONTINUOUS = ["gender_enc", "age", "occupation", "year", *STATS]
ITEM_DEFAULTS = {"item_avg_rating": 3.5, "item_n_ratings": 10.0}
CUT = "1998-07-01"
EVENT_CUT = "2024-01-16"
DRIFT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "returned", "is_open"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rating_of(quantity: str):
    return F.ceil(F.col(quantity) / 10).cast("int")


def interactions(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        rating_of("l_quantity").alias("rating"),
        F.col("l_shipdate").alias("ts"),
    )


def item_ratings(spark: SparkSession, d: str) -> DataFrame:
    """Ratings for questions about items only: no join with the orders."""
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("item_id"), rating_of("l_quantity").alias("rating"))


def users(spark: SparkSession, d: str) -> DataFrame:
    seg = F.col("c_mktsegment")
    gender = F.when(seg.isin("MACHINERY", "AUTOMOBILE"), "M").when(seg.isin("HOUSEHOLD", "FURNITURE"), "F").otherwise("X")
    ages = F.array(*[F.lit(a) for a in fixed.AGES])
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"),
        gender.alias("gender"),
        C.encode_binary(gender).alias("gender_enc"),
        F.get(ages, F.floor(F.abs("c_acctbal") / 1500).cast("int")).alias("age"),
        F.col("c_nationkey").alias("occupation"),
    )


def raw_items(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.concat("p_name", F.lit(" ("), (F.lit(1950) + F.col("p_size")).cast("string"), F.lit(")")).alias("title"),
        F.replace("p_name", F.lit(" "), F.lit("|")).alias("genres"),
    )


def items(spark: SparkSession, d: str) -> DataFrame:
    return raw_items(spark, d).select("*", C.extract_year("title").alias("year"), *C.one_hot("genres", TAGS))


def staged_ratings(spark: SparkSession, d: str) -> DataFrame:
    """The ratings, made once and written in buckets by user."""
    return stage_by_key(interactions(spark, d), "user_id", "ratings")


def matrix(spark: SparkSession, d: str, ratings: DataFrame | None = None) -> DataFrame:
    """One row per rating with all features; the ratings are made once, in buckets by user, and joined once per entity."""
    ratings = staged_ratings(spark, d) if ratings is None else ratings
    people = ft.entity_table(users(spark, d).drop("gender"), ft.user_stats(ratings), "user_id")
    things = ft.entity_table(items(spark, d).drop("title", "genres"), ft.item_stats(ratings), "item_id")
    rows = ratings.drop("ts").withColumn("liked", C.label_threshold("rating"))
    # a task looks its users and items up in a hash table of them; sorting its ratings would take memory for each rating
    wide = ft.build_feature_matrix(rows, people.hint("shuffle_hash"), things.hint("shuffle_hash"))
    return wide.select("user_id", *ROW_KEY, "rating", "liked", *CONTINUOUS[:4], *TAGS, *STATS)


def split_matrix(spark: SparkSession, d: str, ratings: DataFrame | None = None) -> DataFrame:
    return sp.stratified_split(matrix(spark, d, ratings), "liked", ROW_KEY, 0.2, hashed=portable_hash(ROW_KEY, 42))


def with_folds(df: DataFrame, k: int = 5) -> DataFrame:
    return sp.stratified_folds(df, ROW_KEY, k, hashed=portable_hash(ROW_KEY, 7))


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


def request_log(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id",
        "ts",
        F.col("event_type").alias("endpoint"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        F.col("value").alias("latency_ms"),
    )


def score_log(df: DataFrame) -> DataFrame:
    """Scores in (0, 1) from event values, a batch per day; values of the second half are stretched."""
    late = F.when(F.col("ts") >= F.lit(EVENT_CUT).cast("timestamp_ntz"), 2.0).otherwise(1.0)
    v = F.col("value") * late
    return df.select(
        "event_id", "ts", F.date_format("ts", "yyyy-MM-dd").alias("batch_id"), (v / (v + 50.0)).alias("score"), F.col("value").alias("latency_ms")
    )


def drift_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Shipments before and from a date; later tax is read in a wider unit so that one feature drifts."""
    base = table(spark, d, "lineitem")
    cut = F.lit(CUT).cast("timestamp_ntz")

    def side(df: DataFrame, factor: float) -> DataFrame:
        return df.select(
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            (F.col("l_tax") * F.lit(factor)).alias("l_tax"),
            (F.col("l_returnflag") == "R").cast("int").alias("returned"),
            (F.col("l_linestatus") == "O").cast("int").alias("is_open"),
        )

    return side(base.where(F.col("l_shipdate") < cut), 1.0), side(base.where(F.col("l_shipdate") >= cut), 1.5)


DAILY = FeatureView(
    "daily",
    "user_id",
    (("mean_value", T.DoubleType()), ("n_events", T.LongType())),
    timedelta(days=2),
)


def daily_view(spark: SparkSession, d: str) -> DataFrame:
    """Per user and day; the row is known from the following midnight."""
    day = F.date_trunc("day", F.col("ts").cast("timestamp")) + F.expr("INTERVAL 1 DAY")
    per_day = events(spark, d).groupBy("user_id", day.alias("event_timestamp"))
    return per_day.agg(F.avg("value").alias("mean_value"), F.count(F.lit(1)).alias("n_events")).withColumn(
        "created", F.col("event_timestamp")
    )


def user_view(spark: SparkSession, d: str) -> DataFrame:
    return users(spark, d).drop("gender").join(ft.user_stats(interactions(spark, d)), "user_id")


USER_FEATURES = FeatureView(
    "user_features",
    "user_id",
    (
        ("gender_enc", T.IntegerType()),
        ("age", T.IntegerType()),
        ("occupation", T.IntegerType()),
        ("user_avg_rating", T.DoubleType()),
        ("user_n_ratings", T.LongType()),
        ("user_std_rating", T.DoubleType()),
    ),
    timedelta(days=7),
)
ITEM_FEATURES = FeatureView(
    "item_features",
    "item_id",
    (("year", T.DoubleType()), ("item_avg_rating", T.DoubleType()), ("item_n_ratings", T.LongType())),
    timedelta(days=30),
)


def item_view(spark: SparkSession, d: str) -> DataFrame:
    return items(spark, d).select("item_id", "year").join(ft.item_stats(item_ratings(spark, d)), "item_id")


def rounded(df: DataFrame, digits: int = 6, keep: Sequence[str] = ()) -> DataFrame:
    """Doubles rounded for comparison between engines that sum in different orders."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) and f.name not in keep else F.col(f.name)
            for f in df.schema.fields
        ]
    )
