"""One query per operator over the sample tables: name -> function of (session, folder)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from sorrel.functions import columns as C, fixed
from sorrel.functions.hashing import portable_hash
from sorrel.operators import (
    drift,
    explore as ex,
    features as ft,
    metrics as me,
    monitor as mo,
    naive_bayes as nb,
    ordered as od,
    recommend as rc,
    split as sp,
    store as st,
    validate as va,
)
from sorrel.plans import roles as R
from sorrel.session import new_folder, stage
from sorrel.streaming import sinks, steps, windows as sw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def stamp(c) -> "F.Column":
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# projections ------------------------------------------------------------------------------------


@query
def one_hot_tags(spark, d):
    return R.raw_items(spark, d).select("item_id", *C.one_hot("genres", R.TAGS))


@query
def explode_tokens(spark, d):
    return C.explode_tokens(R.raw_items(spark, d).select("item_id", "genres"), "genres").select("item_id", "token")


@query
def extract_year(spark, d):
    return R.raw_items(spark, d).select("item_id", "title", C.extract_year("title").alias("year"))


@query
def encode_binary(spark, d):
    return R.users(spark, d).select("user_id", C.encode_binary("gender").alias("gender_enc"))


@query
def label_threshold(spark, d):
    rows = R.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", R.rating_of("l_quantity").alias("rating"))
    return rows.select("*", C.label_threshold("rating").alias("liked"))


@query
def map_labels(spark, d):
    # two labels are left out, so their codes pass through
    known = {k: v for k, v in fixed.AGE_LABELS.items() if k not in (35, 56)}
    return R.users(spark, d).select("user_id", "age", C.map_labels("age", known).alias("age_label"))


def respaced(stats: DataFrame, key: str) -> DataFrame:
    """Statistics under doubled ids, so that every other entity has none."""
    return stats.withColumn(key, F.col(key) * 2)


@query
def profile_defaults(spark, d):
    stats = respaced(ft.user_stats(R.interactions(spark, d)), "user_id")
    return R.rounded(C.profile_defaults(R.users(spark, d).select("user_id").join(stats, "user_id", "left")))


@query
def minmax_scale(spark, d):
    part = R.table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    return R.rounded(C.minmax_scale(part, nb.fit_minmax(part, ["p_size", "p_retailprice"])))


@query
def align_columns(spark, d):
    wide = R.items(spark, d)
    return C.align_columns(wide, ["year", "red", "no_such_column", "blue"], keep=["item_id"])


@query
def fill_missing(spark, d):
    stats = respaced(ft.item_stats(R.item_ratings(spark, d)), "item_id")
    return R.rounded(C.fill_missing(R.raw_items(spark, d).select("item_id", "title").join(stats, "item_id", "left")))


@query
def normalise_names(spark, d):
    odd = R.table(spark, d, "customer").select(
        F.col("c_custkey").alias("UserID"), F.col("c_nationkey").alias("Film-Noir"), F.col("c_mktsegment").alias("Children's")
    )
    return C.normalise_names(odd, {"userid": "user_id"})


@query
def epoch_to_ts(spark, d):
    orders = R.table(spark, d, "orders").select(
        "o_orderkey", F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("epoch")
    )
    return orders.select("o_orderkey", stamp(C.epoch_to_ts("epoch")).alias("at"))


# filters and validation -------------------------------------------------------------------------


@query
def validate_items(spark, d):
    rows = R.raw_items(spark, d)
    rules = va.item_rules(F.col("item_id"), F.col("title"), F.col("genres"), R.TAGS[:14])
    return va.validate(rows, rules).select("item_id", "error", F.array_join("errors", ",").alias("errors"))


@query
def validate_users(spark, d):
    rows = R.users(spark, d)
    rules = va.user_rules(F.col("user_id"), F.col("gender"), F.col("age"), F.col("occupation"))
    return va.validate(rows, rules).select("user_id", "error", F.array_join("errors", ",").alias("errors"))


@query
def validate_interactions(spark, d):
    rows = R.interactions(spark, d)
    rules = va.interaction_rules(
        F.col("user_id"), F.col("item_id"), F.col("rating"), F.unix_seconds(F.col("ts").cast("timestamp")), [1, 2, 3, 4]
    )
    return va.validate(rows, rules).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query
def quality_checks(spark, d):
    rows = R.table(spark, d, "lineitem").select(
        "l_partkey",
        "l_quantity",
        F.when(F.col("l_discount") > 0.01, F.col("l_discount")).alias("discount"),
        F.lit(None).cast("double").alias("nothing"),
        (F.col("l_quantity") > 30).cast("int").alias("liked"),
    )
    return R.rounded(va.run_quality_checks(rows, ["l_partkey", "l_quantity", "discount", "nothing"], "liked"))


@query
def null_rates(spark, d):
    rows = R.table(spark, d, "lineitem").select(
        F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("tax"), F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("flag"), "l_quantity"
    )
    return R.rounded(va.check_nulls(rows, ["tax", "flag", "l_quantity"]))


@query
def duplicate_count(spark, d):
    return va.duplicate_count(R.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def min_support(spark, d):
    return ft.min_support(R.item_ratings(spark, d), "item_id", 30)


@query
def filter_time_range(spark, d):
    ev = R.events(spark, d).select("event_id", "ts", "value")
    def day(x):
        return F.lit(x).cast("timestamp_ntz")
    some = ft.filter_time_range(ev, "ts", day("2024-01-10"), day("2024-01-12")).select(F.lit("inside").alias("case"), "event_id", "value")
    none = ft.filter_time_range(ev, "ts", day("2025-01-01"), day("2025-01-02")).select(F.lit("fallback").alias("case"), "event_id", "value")
    return some.unionByName(none)


@query
def exclude_ids(spark, d):
    seen = R.interactions(spark, d).where("rating < 5").select("user_id", "item_id")
    pairs = R.interactions(spark, d).select("user_id", "item_id", "order_id")
    return ft.exclude_pairs(pairs, seen, ["user_id", "item_id"])


@query
def file_stats(spark, d):
    from sorrel.sources import delimited as D

    path = new_folder(spark, "lines")
    rows = R.interactions(spark, d)
    # lines with the top rating lose their last field
    line = F.concat_ws("::", "user_id", "item_id", "rating", F.when(F.col("rating") < 5, F.lit("9")))
    rows.select(line.alias("value")).write.text(path)
    got = D.raw_file_stats(spark, path, 4)
    return got.agg(F.sum("n_lines").alias("n_lines"), F.sum("n_bad_fields").alias("n_bad_fields"))


def rating_lines(spark, d) -> str:
    """Path of the ratings as delimited lines in key order; ratings of 5 are written as 6."""
    from sorrel.session import new_folder

    path = new_folder(spark, "ratings")
    epoch = F.unix_seconds(F.col("ts").cast("timestamp"))
    value = F.when(F.col("rating") == 5, 6).otherwise(F.col("rating"))
    rows = R.interactions(spark, d).orderBy("order_id", "line_no", "item_id")
    rows.select(F.concat_ws("::", "user_id", "item_id", value, epoch).alias("value")).write.text(path)
    return path


@query
def validate_file(spark, d):
    from sorrel.sources import delimited as D

    counts, _ = D.validate_file(spark, rating_lines(spark, d), D.RATINGS, va.rating_file_rules)
    return counts


@query
def first_bad_lines(spark, d):
    from sorrel.sources import delimited as D

    _, bad = D.validate_file(spark, rating_lines(spark, d), D.RATINGS, va.rating_file_rules)
    return bad.select("line")


# stored files -----------------------------------------------------------------------------------


def raw_files(spark, d) -> dict[str, str]:
    """The sample tables as the three delimited raw files, written to the shared folder."""
    from sorrel.session import new_folder

    path = new_folder(spark, "raw")
    people, things, ratings = R.users(spark, d), R.raw_items(spark, d), R.interactions(spark, d)
    lines = {
        "movies": things.select(F.concat_ws("::", "item_id", "title", "genres").alias("value")),
        "users": people.select(F.concat_ws("::", "user_id", "gender", "age", "occupation", F.lit("00000")).alias("value")),
        "ratings": ratings.select(
            F.concat_ws("::", "user_id", "item_id", "rating", F.unix_seconds(F.col("ts").cast("timestamp"))).alias("value")
        ),
    }
    for name, rows in lines.items():
        rows.write.text(f"{path}/{name}")
    return {name: f"{path}/{name}" for name in lines}


@query
def read_delimited(spark, d):
    from sorrel.sources import delimited as D

    return D.read_delimited(spark, raw_files(spark, d)["users"], D.USERS)


@query
def rejected_lines(spark, d):
    """Ratings as lines of which some do not parse: a word for the rating 5, no time for the rating 1, a blank line for each 2."""
    from sorrel.sources import delimited as D

    path = new_folder(spark, "odd-lines")
    epoch = F.when(F.col("rating") > 1, F.unix_seconds(F.col("ts").cast("timestamp")))
    rating = F.when(F.col("rating") == 5, F.lit("five")).otherwise(F.col("rating").cast("string"))
    line = F.concat_ws("::", "user_id", "item_id", rating, epoch)
    R.interactions(spark, d).select(F.concat(line, F.when(F.col("rating") == 2, "\n").otherwise("")).alias("value")).write.text(path)
    rows, bad = D.read_checked(spark, path, D.RATINGS)
    good = rows.select(F.lit("row").alias("side"), F.concat_ws("::", *rows.columns).alias("line"), F.lit(None).cast("string").alias("reason"))
    return good.unionByName(bad.select(F.lit("rejected").alias("side"), "line", "reason"))


@query
def load_items(spark, d):
    from sorrel.sources import delimited as D

    return D.load_items(D.read_delimited(spark, raw_files(spark, d)["movies"], D.MOVIES), vocab=R.TAGS)


@query
def load_users(spark, d):
    from sorrel.sources import delimited as D

    return D.load_users(D.read_delimited(spark, raw_files(spark, d)["users"], D.USERS)).drop("Zip")


@query
def load_interactions(spark, d):
    from sorrel.sources import delimited as D

    return D.load_interactions(D.read_delimited(spark, raw_files(spark, d)["ratings"], D.RATINGS), threshold=4)


@query
def prepared_files(spark, d):
    """Raw files to the feature matrix, in the feature order stored beside it."""
    from sorrel.plans import training
    from sorrel.sources import tables as tb

    matrix, order = training.prepare(spark, raw_files(spark, d), threshold=4, vocab=R.TAGS)
    path = new_folder(spark, "order")
    tb.write_feature_columns(spark, order, path)
    keep = [c for c in training.NOT_FEATURES if c in matrix.columns]
    return R.rounded(C.select_features(matrix, keep, tb.read_feature_columns(spark, path)))


@query
def stored_split(spark, d):
    from sorrel.sources import tables as tb

    path = new_folder(spark, "split")
    tb.write_split(R.split_matrix(spark, d).select("user_id", *R.ROW_KEY, "year", "liked", "split"), path)
    return spark.read.parquet(path)


@query
def stored_model(spark, d):
    """Scores of the test rows by a model that was saved and read back."""
    from sorrel.session import new_folder

    parts, model = fitted(spark, d)
    path = new_folder(spark, "model")
    nb.save_model(spark, model, path, "hybrid")
    again = nb.load_model(spark, path, ["missing", "hybrid"])
    rows = nb.score(parts.where("split = 'test'"), again).withColumn("pred", nb.predict("score"))
    return R.rounded(rows.select(*R.ROW_KEY, "user_id", F.col("liked").alias("label"), "score", "pred"))


@query
def training_set(spark, d):
    from sorrel.plans import training

    rows = R.interactions(spark, d).withColumn("epoch", F.unix_seconds(F.col("ts").cast("timestamp"))).drop("ts")
    views = {"user_features": (R.USER_FEATURES, R.user_view(spark, d)), "item_features": (R.ITEM_FEATURES, R.item_view(spark, d))}
    refs = ["user_features:age", "user_features:user_avg_rating", "item_features:year"]
    wide, names = training.build_training_set(rows, views, refs, epoch="epoch", rating="rating")
    kept = wide.select("user_id", *R.ROW_KEY, "rating", F.col("Liked").alias("liked"), stamp("event_timestamp").alias("at"), *names)
    return R.rounded(kept)


@query
def latest_landing(spark, d):
    """Events landed under two dates, the second one twice; the newest date is read."""
    from sorrel.sources import tables as tb

    path = new_folder(spark, "landing")
    log = R.events(spark, d).select("event_id", "user_id", "value", "ts")
    late = F.col("ts") >= F.lit(R.EVENT_CUT).cast("timestamp_ntz")
    tb.land_raw(log.where(~late), path, "2024-01-15")
    tb.land_raw(log, path, "2024-01-16")
    tb.land_raw(log.where(late), path, "2024-01-16")
    got = tb.read_latest(spark, path)
    return got.select("event_id", "user_id", "value", F.col("ingest_date").cast("string").alias("ingest_date"))


@query
def feature_view(spark, d):
    from sorrel.sources import tables as tb

    path = new_folder(spark, "view")
    R.daily_view(spark, d).write.parquet(path)
    got = tb.read_feature_view(spark, path, R.DAILY.schema)
    (name,) = st.list_views([R.DAILY])
    times = {c: stamp(c) for c in ("event_timestamp", "created")}
    return R.rounded(got.withColumns(times).withColumn("view", F.lit(name)))


@query
def drift_report(spark, d):
    """The head row of the report, written as JSON under its date and read back."""
    from sorrel.sources import tables as tb

    path = new_folder(spark, "report")
    _, head = drift.drift_report(*R.drift_sides(spark, d), R.DRIFT_COLUMNS, "lines", F.lit("2024-02-01 00:00:00"))
    tb.write_report(head, path, "2024-02-01")
    got = spark.read.schema(head.schema.add("run_date", "string")).json(path)
    return got.withColumn("drifted_features", F.array_join("drifted_features", ","))


@query
def few_values(spark, d):
    """A feature that the current rows lack is left out of the drift rows."""
    ref, cur = R.drift_sides(spark, d)
    ref, cur = ref.withColumn("gone", F.col("l_quantity")), cur.withColumn("gone", F.lit(None).cast("double"))
    return drift.feature_drift(ref, cur, [*R.DRIFT_COLUMNS, "gone"])


# joins ------------------------------------------------------------------------------------------


@query
def feature_matrix(spark, d):
    return R.rounded(R.matrix(spark, d))


@query
def historical_features(spark, d):
    orders = R.table(spark, d, "orders").select(F.col("o_orderkey"), (F.col("o_custkey") * 2).alias("user_id"))
    views = {"user_features": (R.USER_FEATURES, R.user_view(spark, d))}
    refs = ["user_features:age", "user_features:user_avg_rating", "user_features:no_such_feature", "no_such_view:x"]
    return R.rounded(st.get_historical_features(orders, views, refs))


@query
def point_in_time(spark, d):
    asked = R.events(spark, d).select("event_id", "user_id", "ts")
    views = {"daily": (R.DAILY, R.daily_view(spark, d))}
    got = st.get_historical_features(asked, views, ["daily:mean_value", "daily:n_events"], True, "ts")
    return R.rounded(got.select("event_id", "user_id", "mean_value", "n_events"))


@query
def offline_views(spark, d):
    stats = respaced(ft.user_stats(R.interactions(spark, d)), "user_id")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    view = st.build_offline_view(R.users(spark, d).drop("gender"), stats, "user_id", at)
    return R.rounded(view.withColumns({"event_timestamp": stamp("event_timestamp"), "created": stamp("created")}))


@query
def top_rated(spark, d):
    return R.rounded(ex.top_rated(R.item_ratings(spark, d), R.raw_items(spark, d)))


@query
def mean_by_attr(spark, d):
    return R.rounded(ex.mean_by_user_attr(R.interactions(spark, d), R.users(spark, d), "age"))


@query
def lookup_default(spark, d):
    stats = respaced(ft.item_stats(R.item_ratings(spark, d)), "item_id")
    return R.rounded(ft.lookup_default(R.raw_items(spark, d).select("item_id"), stats, "item_id", R.ITEM_DEFAULTS))


@query
def online_features(spark, d):
    pairs = R.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("user_id"), (F.col("l_partkey") * 2).alias("item_id")
    )
    views = {"user_features": (R.USER_FEATURES, R.user_view(spark, d)), "item_features": (R.ITEM_FEATURES, R.item_view(spark, d))}
    refs = ["user_features:user_n_ratings", "item_features:year", "item_features:item_avg_rating", "item_features:nothing"]
    return R.rounded(st.get_online_features(pairs, views, refs))


@query
def attach_labels(spark, d):
    return rc.attach_labels(recommend(spark, d), R.raw_items(spark, d), "item_id", ["title", "genres"])


# aggregates -------------------------------------------------------------------------------------


@query
def user_stats(spark, d):
    return R.rounded(ft.user_stats(R.interactions(spark, d)))


@query
def item_stats(spark, d):
    return R.rounded(ft.item_stats(R.item_ratings(spark, d)))


@query
def value_distribution(spark, d):
    return R.rounded(ex.value_distribution(R.item_ratings(spark, d), "rating"))


@query
def describe(spark, d):
    return R.rounded(ex.describe_ratings(R.table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("rating"))))


@query
def token_counts(spark, d):
    return ex.token_counts(R.raw_items(spark, d), "genres")


@query
def coverage(spark, d):
    # ratings go to the lower half of the catalogue
    rated = R.table(spark, d, "lineitem").select(F.floor(F.col("l_partkey") / 2).alias("item_id"))
    return R.rounded(ex.coverage(rated, R.users(spark, d), R.raw_items(spark, d)))


@query
def activity(spark, d):
    return R.rounded(ex.activity_summary(R.interactions(spark, d)))


@query
def attr_counts(spark, d):
    return ex.attr_counts(R.users(spark, d), "age", fixed.AGE_LABELS)


@query
def label_corr(spark, d):
    return R.rounded(ex.label_correlation(R.matrix(spark, d), R.CONTINUOUS + R.TAGS, "liked"))


@query
def positive_rate(spark, d):
    rows = R.item_ratings(spark, d).select(C.label_threshold("rating").alias("liked"))
    return R.rounded(ex.positive_rate(rows, "liked"))


@query
def cold_start(spark, d):
    stats = respaced(ft.user_stats(R.interactions(spark, d)), "user_id")
    people = R.users(spark, d).select("user_id").join(stats, "user_id", "left")
    return R.rounded(ft.cold_start_means(people, stats, R.STATS[:3]))


# order statistics -------------------------------------------------------------------------------


@query
def roc_auc(spark, d):
    rows = R.table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("score"), (F.col("l_quantity") > 30).cast("int").alias("label"))
    return R.rounded(od.roc_auc(rows, "score", "label"))


@query
def latest_per_key(spark, d):
    ev = R.events(spark, d).select("user_id", "ts", "event_id", "event_type", "value")
    return od.latest_per_key(ev, "user_id", "ts").select("user_id", "event_id", "event_type", "value")


@query
def split(spark, d):
    rows = R.interactions(spark, d).withColumn("liked", C.label_threshold("rating"))
    got = sp.stratified_split(rows, "liked", R.ROW_KEY, 0.2, hashed=portable_hash(R.ROW_KEY, 42))
    return got.select(*R.ROW_KEY, "user_id", "liked", "split")


@query
def folds(spark, d):
    return R.with_folds(R.interactions(spark, d)).select(*R.ROW_KEY, "user_id", "rating", "fold")


@query
def exact_split(spark, d):
    rows = R.table(spark, d, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    got = sp.exact_split(rows, "label", ["o_orderkey"], 0.2, hashed=portable_hash(["o_orderkey"], 42))
    return got


@query
def exact_folds(spark, d):
    rows = R.table(spark, d, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    return sp.exact_folds(rows, "label", ["o_orderkey"], 5, hashed=portable_hash(["o_orderkey"], 42))


@query
def last_n(spark, d):
    ev = R.events(spark, d).select("event_id", "ts", "value")
    return od.last_n(ev, "ts", 10, ["event_id"]).select("event_id", "value")


@query
def rolling_latency(spark, d):
    log = R.request_log(R.events(spark, d)).select("event_id", "ts", "latency_ms")
    got = mo.rolling_latency(log, ["ts", "event_id"], size=1000)
    return R.rounded(got.select("event_id", "n_window", "mean_latency", "p_latency"))


@query
def top_k(spark, d):
    rows = R.interactions(spark, d).select("user_id", "item_id", "order_id", "line_no", "rating", "ts")
    order = [F.col("rating").desc(), F.col("item_id"), F.col("order_id"), F.col("line_no")]
    return od.top_k_per_user(rows, "user_id", order, 5).select("user_id", "rank", "item_id", "rating")


@query
def page(spark, d):
    return od.page(R.raw_items(spark, d), "item_id", 20, 40)


@query
def long_page(spark, d):
    return od.page(R.raw_items(spark, d), "item_id", 300, 40)


# model ------------------------------------------------------------------------------------------


def fitted(spark, d) -> tuple[DataFrame, nb.Model]:
    """The staged split matrix and the model of its training part."""
    parts = stage(R.split_matrix(spark, d), "matrix")
    return parts, nb.fit_hybrid(parts.where("split = 'train'"), R.CONTINUOUS, R.TAGS)


def scored_test(spark, d) -> DataFrame:
    parts, model = fitted(spark, d)
    rows = nb.score(parts.where("split = 'test'"), model).withColumn("pred", nb.predict("score"))
    return rows.select(*R.ROW_KEY, "user_id", F.col("liked").alias("label"), "score", "pred", *R.TAGS)


@query
def nb_params(spark, d):
    model = nb.fit_hybrid(R.split_matrix(spark, d).where("split = 'train'"), R.CONTINUOUS, R.TAGS)
    rows = nb.model_table(spark, model).where("role IN ('continuous', 'binary', 'prior')").drop("run_id", "position")
    return R.rounded(rows)


@query
def nb_scores(spark, d):
    return R.rounded(scored_test(spark, d).select(*R.ROW_KEY, "user_id", "label", "score", "pred"))


@query
def confusion(spark, d):
    return me.confusion_matrix(scored_test(spark, d))


@query
def metrics(spark, d):
    return me.binary_metrics(stage(scored_test(spark, d), "scored"))


@query
def report(spark, d):
    return R.rounded(me.classification_report(scored_test(spark, d)))


@query
def precision_by_tag(spark, d):
    return R.rounded(me.precision_by_tag(scored_test(spark, d), R.TAGS))


@query
def score_by_class(spark, d):
    return R.rounded(me.score_by_class(scored_test(spark, d)))


@query
def gate(spark, d):
    parts, model = fitted(spark, d)
    scored = stage(nb.score(parts, model).select("split", F.col("liked").alias("label"), "score", nb.predict("score").alias("pred")), "scored")
    by_split = scored.groupBy("split").agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("accuracy"))
    held = scored.where("split = 'test'")
    folds = nb.cross_validate(R.with_folds(parts.where("split = 'train'")), R.CONTINUOUS, R.TAGS)
    found = me.long_metrics(me.binary_metrics(held))
    for more in (nb.cv_summary(folds).drop("run"), me.separation(held), me.train_test_gap(by_split)):
        found = found.unionByName(me.long_metrics(more))
    return R.rounded(me.promotion_gate(found, required=True))


@query
def training_run(spark, d):
    """A whole run in stages with its manifest: a row per stage, per rule of the gate, and for the run."""
    from sorrel.plans import runs, training

    split = lambda df: sp.stratified_split(df, "liked", R.ROW_KEY, 0.2, hashed=portable_hash(R.ROW_KEY, 42))
    stages = training.training_stages(lambda: R.matrix(spark, d), R.CONTINUOUS, R.TAGS, R.ROW_KEY, "liked", split=split, fold=R.with_folds)
    path = new_folder(spark, "run")
    done = runs.run_stages(spark, path, stages, {"tables": d})
    return R.rounded(training.run_report(spark, path, done))


@query
def cv(spark, d):
    train = stage(R.with_folds(R.split_matrix(spark, d).where("split = 'train'")), "train")
    return R.rounded(nb.cross_validate(train, R.CONTINUOUS, R.TAGS).select("fold", "accuracy"))


@query
def grid(spark, d):
    parts = stage(R.split_matrix(spark, d), "matrix")
    train = R.with_folds(parts.where("split = 'train'"))
    got = me.compare_runs(train, parts.where("split = 'test'"), R.CONTINUOUS, R.TAGS, R.ROW_KEY, folds=train)
    return got


@query
def best_run(spark, d):
    return me.best_run(grid(spark, d)).select("run", "accuracy")


def model_of(spark, d, ratings: DataFrame) -> nb.Model:
    """The model of the training part, where nothing else reads the matrix: it is not written."""
    return nb.fit_hybrid(R.split_matrix(spark, d, ratings).where("split = 'train'"), R.CONTINUOUS, R.TAGS)


def sides(spark, d, ratings: DataFrame | None = None):
    """User and item sides for recommendation, with served defaults."""
    inter = R.interactions(spark, d) if ratings is None else ratings
    people = R.users(spark, d).drop("gender").join(ft.user_stats(inter), "user_id", "left")
    things = rc.catalogue(R.items(spark, d), ft.item_stats(R.item_ratings(spark, d)), "item_id", "year", R.ITEM_DEFAULTS)
    return people, things.select("item_id", *R.ITEM_SIDE)


@query
def recommend(spark, d):
    ratings = R.staged_ratings(spark, d)
    model = model_of(spark, d, ratings)
    people, things = sides(spark, d, ratings)
    got = rc.recommend(rc.served_profiles(people), things, model, 10)
    return R.rounded(got)


@query
def recommend_unseen(spark, d):
    inter = R.staged_ratings(spark, d)
    model = model_of(spark, d, inter)
    people, things = sides(spark, d, inter)
    people = rc.model_profiles(people, ft.user_stats(inter), R.STATS[:3])
    return R.rounded(rc.recommend(people, things, model, 5, excluded=inter.select("user_id", "item_id")))


@query
def predict_like(spark, d):
    _, model = fitted(spark, d)
    people, things = sides(spark, d)
    orders = R.table(spark, d, "orders")
    # half of the item ids are unknown
    pairs = orders.select("o_orderkey", F.col("o_custkey").alias("user_id"), (F.col("o_custkey") * 2).alias("item_id"))
    return R.rounded(rc.predict_like(pairs, rc.served_profiles(people), things, model, item_defaults=R.ITEM_DEFAULTS))


# store ------------------------------------------------------------------------------------------


def at(day: str):
    return F.lit(day).cast("timestamp")


@query
def materialize(spark, d):
    got = st.materialize(R.daily_view(spark, d), R.DAILY, at("2024-01-20"))
    return R.rounded(got.select("user_id", "mean_value", "n_events", stamp("event_timestamp").alias("at")))


@query
def materialize_incremental(spark, d):
    view = R.daily_view(spark, d)
    online = st.materialize(view, R.DAILY, at("2024-01-20"))
    got = st.materialize_incremental(online, view, R.DAILY, at("2024-01-21"))
    return R.rounded(got.select("user_id", "mean_value", "n_events", stamp("event_timestamp").alias("at")))


@query
def materialize_counts(spark, d):
    day = st.materialize(R.daily_view(spark, d), R.DAILY, at("2024-01-20"), at("2024-01-19"))
    none = st.materialize(R.daily_view(spark, d), R.DAILY, at("2030-01-01"))
    return st.materialize_counts({"one_day": day, "fallback": none})


@query
def validate_online(spark, d):
    pairs = R.events(spark, d).select("event_id", "user_id")
    online = st.materialize(R.daily_view(spark, d), R.DAILY, at("2024-01-20"), at("2024-01-19"))
    answer = st.get_online_features(pairs, {"daily": (R.DAILY, online)}, ["daily:mean_value", "daily:n_events"])
    return st.validate_online(pairs, answer, ["mean_value", "n_events", "absent"])


@query
def view_stats(spark, d):
    views = {"daily": (R.DAILY, R.daily_view(spark, d)), "item_features": (R.ITEM_FEATURES, R.item_view(spark, d))}
    return st.view_stats(views)


# drift ------------------------------------------------------------------------------------------


@query
def psi(spark, d):
    return drift.psi(*R.drift_sides(spark, d), R.DRIFT_COLUMNS)


@query
def ks(spark, d):
    return R.rounded(drift.ks_test(*R.drift_sides(spark, d), R.DRIFT_COLUMNS[:4]))


@query
def wasserstein(spark, d):
    return R.rounded(drift.wasserstein(*R.drift_sides(spark, d), R.DRIFT_COLUMNS[:4]))


@query
def chi2(spark, d):
    ev = R.events(spark, d)
    cut = F.lit(R.EVENT_CUT).cast("timestamp_ntz")
    ref, cur = ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)
    rows = [x.select("event_type", F.length("props").alias("size")) for x in (ref, cur)]
    return R.rounded(drift.chi2_test(*rows, ["event_type", "size"]))


@query
def feature_drift(spark, d):
    return drift.feature_drift(*R.drift_sides(spark, d), R.DRIFT_COLUMNS)


@query
def drift_summary(spark, d):
    got = drift.drift_summary(drift.feature_drift(*R.drift_sides(spark, d), R.DRIFT_COLUMNS))
    return got.withColumn("drifted_features", F.array_join("drifted_features", ","))


@query
def drift_ranking(spark, d):
    rows = drift.psi(*R.drift_sides(spark, d), R.DRIFT_COLUMNS)
    return drift.rank_features(rows).withColumn("severity", drift.severity(F.col("psi")))


@query
def retrain_decision(spark, d):
    rows = drift.feature_drift(*R.drift_sides(spark, d), R.DRIFT_COLUMNS)
    reports = drift.drift_summary(rows).withColumn("timestamp", at("2024-02-01"))
    return drift.retrain_decision(reports)


@query
def retrain_without_report(spark, d):
    """The decision on the reports since a day on which none was written."""
    rows = drift.psi(*R.drift_sides(spark, d), R.DRIFT_COLUMNS).withColumn("drifted", F.lit(False))
    reports = drift.drift_summary(rows).withColumn("timestamp", at("2024-02-01"))
    return drift.retrain_decision(reports.where(F.col("timestamp") > at("2024-03-01")))


# monitoring -------------------------------------------------------------------------------------


def score_sides(spark, d) -> tuple[DataFrame, DataFrame]:
    log = R.score_log(R.events(spark, d))
    cut = F.lit(R.EVENT_CUT).cast("timestamp_ntz")
    return log.where(F.col("ts") < cut), log.where(F.col("ts") >= cut)


@query
def score_stats(spark, d):
    return mo.score_stats(R.score_log(R.events(spark, d)))


@query
def latency_stats(spark, d):
    return R.rounded(mo.latency_stats(R.request_log(R.events(spark, d)), by=["endpoint"]))


@query
def score_batches(spark, d):
    ref, cur = score_sides(spark, d)
    return R.rounded(mo.score_batch_stats(cur, ref))


@query
def prediction_report(spark, d):
    ref, cur = score_sides(spark, d)
    got = mo.prediction_report(mo.score_batch_stats(cur, ref), mo.score_stats(ref))
    return R.rounded(mo.with_alerts(got).drop("raw", "alerts"))


@query
def alerts(spark, d):
    ref, cur = score_sides(spark, d)
    got = mo.alerts(mo.prediction_report(mo.score_batch_stats(cur, ref), mo.score_stats(ref)))
    return R.rounded(got.drop("message"))


@query
def request_metrics(spark, d):
    return R.rounded(mo.request_metrics(R.request_log(R.events(spark, d))))


@query
def reference_scores(spark, d):
    train = R.split_matrix(spark, d).where("split = 'train'").select(*R.CONTINUOUS, *R.TAGS, "liked")
    train = stage(train, "train")
    model = nb.fit_hybrid(train, R.CONTINUOUS, R.TAGS)
    # moments and quartiles read the scores and not the features again
    return mo.score_stats(stage(mo.reference_scores(train, model), "scores"))


HOLD = {"step": "1 hour", "hold": "3 hours", "n_steps": 3}
HOURLY = {"limit": 200.0, **HOLD}
ERRORS = {"limit": 0.0004, "size": "2 hours", "seconds": 7200.0, "step": "1 hour", "hold": "2 hours", "n_steps": 2}


def windowed(df: DataFrame) -> DataFrame:
    return R.rounded(df.withColumns({"window_start": stamp("window_start"), "window_end": stamp("window_end")}))


def requests(events: DataFrame) -> DataFrame:
    return sw.with_bin(sw.timed(R.request_log(events)), "latency_ms")


def targets(events: DataFrame) -> DataFrame:
    return sw.timed(R.request_log(events)).withColumnRenamed("endpoint", "target")


@query
def latency_breach(spark, d):
    return windowed(sw.exact_latency_breaches(R.request_log(R.events(spark, d)), **HOURLY))


@query
def error_rate(spark, d):
    return windowed(sw.error_rate_breaches(steps.summarise(requests(R.events(spark, d)), sw.request_steps("1 hour")), **ERRORS))


def silent(found: DataFrame) -> DataFrame:
    return found.withColumns({"silent_from": stamp("silent_from"), "back_at": stamp("back_at")})


@query
def silence(spark, d):
    return silent(sw.silences(steps.summarise(targets(R.events(spark, d)), sw.target_steps("1 hour")), gap_seconds=3600))


# streaming --------------------------------------------------------------------------------------


def stream_of(spark, d) -> DataFrame:
    schema = R.events(spark, d).schema
    # a glob, because the stream source wants a folder or a pattern
    return sinks.read_stream(spark, f"{d}/event[s].parquet", schema)


def streamed(stream: DataFrame, spec: steps.Steps, key=()) -> DataFrame:
    """The steps that a stream stored, when it has read what is there."""
    spark, path = stream.sparkSession, new_folder(stream.sparkSession, "steps")
    steps.keep(stream, spec, path, f"{path}/checkpoint", key=key).awaitTermination()
    return steps.kept(spark, path, spec, steps.summarise(stream, spec).schema)


@query
def stream_windows(spark, d):
    scores = sw.with_bin(sw.timed(R.score_log(stream_of(spark, d))), "score")
    return windowed(sw.score_windows(streamed(scores, sw.score_steps("10 minutes"))))


@query
def stream_psi(spark, d):
    ref, _ = score_sides(spark, d)
    bins = sw.reference_bins(ref)
    scores = sw.with_reference_bin(sw.timed(R.score_log(stream_of(spark, d))), bins)
    return windowed(sw.psi_windows(streamed(scores, sw.psi_steps()), bins, size="12 hours"))


@query
def stream_requests(spark, d):
    log = requests(stream_of(spark, d))
    return windowed(sw.request_windows(streamed(log, sw.request_steps("10 minutes"), key=["event_id"]), size="1 hour"))


@query
def stream_latency_breach(spark, d):
    return windowed(sw.latency_breaches(streamed(requests(stream_of(spark, d)), sw.request_steps("1 hour")), **HOURLY))


@query
def stream_error_rate(spark, d):
    return windowed(sw.error_rate_breaches(streamed(requests(stream_of(spark, d)), sw.request_steps("1 hour")), **ERRORS))


@query
def stream_silence(spark, d):
    return silent(sw.silences(streamed(targets(stream_of(spark, d)), sw.target_steps("1 hour")), gap_seconds=3600))


@query
def stream_materialize(spark, d):
    from pyspark.sql import types as T

    from sorrel.sources.tables import read_online

    path = new_folder(spark, "online")
    rows = stream_of(spark, d).select(
        "user_id", F.col("ts").cast("timestamp").alias("event_timestamp"), "value", F.col("event_id").cast("double").alias("event_id")
    )
    view = st.FeatureView("last_event", "user_id", (("value", T.DoubleType()), ("event_id", T.DoubleType())), timedelta(days=7))
    sinks.stream_materialize(rows, view, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return read_online(spark, f"{path}/table", rows.schema).select("user_id", "value", "event_id", stamp("event_timestamp").alias("at"))


@query
def stream_corrections(spark, d):
    """A snapshot kept by two streams with checkpoints of their own; the second brings corrections of equal event times."""
    from pyspark.sql import types as T

    from sorrel.sources.tables import read_online

    path = new_folder(spark, "online")
    when = F.col("ts").cast("timestamp")
    rows = R.events(spark, d).select("user_id", when.alias("event_timestamp"), when.alias("created"), "value", F.col("event_id").cast("double").alias("event_id"), "event_type")
    fixed_later = rows.where("event_type = 'click'").withColumns({"value": -F.col("value"), "created": F.col("created") + F.expr("INTERVAL 1 DAY")})
    view = st.FeatureView("last_event", "user_id", (("value", T.DoubleType()), ("event_id", T.DoubleType())), timedelta(days=7))
    for name, part in (("first", rows), ("second", fixed_later)):
        part.drop("event_type").write.parquet(f"{path}/{name}/in")
        stream = sinks.read_stream(spark, f"{path}/{name}/i[n]", part.drop("event_type").schema)
        sinks.stream_materialize(stream, view, f"{path}/table", f"{path}/{name}/checkpoint", buckets=8, rows_per_bucket=100).awaitTermination()
    got = read_online(spark, f"{path}/table", rows.drop("event_type").schema)
    return got.select("user_id", "value", "event_id", stamp("event_timestamp").alias("at"), stamp("created").alias("created"))
