"""Whole flows composed from the operators: training sets and prepare-train-evaluate-gate runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sorrel.functions import columns as C, fixed
from sorrel.operators import features, metrics, naive_bayes as nb, split as sp, store
from sorrel.plans import runs
from sorrel.session import new_folder
from sorrel.sources import delimited as D

NOT_FEATURES = ("UserID", "MovieID", "Rating", "Liked", "Timestamp")
STATS = ("user_avg_rating", "user_n_ratings", "user_std_rating", "movie_avg_rating", "movie_n_ratings")
CONTINUOUS = ("Gender_enc", "Age", "Occupation", "Year", *STATS)


def prepare(
    spark: SparkSession,
    paths: Mapping[str, str],
    extra_stats: bool = True,
    threshold: float | None = None,
    vocab: Sequence[str] = fixed.GENRES,
) -> tuple[DataFrame, list[str]]:
    """Raw files to the feature matrix and its feature order."""
    movies = D.load_items(D.read_delimited(spark, paths["movies"], D.MOVIES), vocab=vocab).drop("Title", "Genres")
    users = D.load_users(D.read_delimited(spark, paths["users"], D.USERS)).drop("Gender", "Zip")
    ratings = D.load_interactions(D.read_delimited(spark, paths["ratings"], D.RATINGS), threshold=threshold)
    matrix = features.build_feature_matrix(ratings, users, movies, "UserID", "MovieID")
    if extra_stats:
        matrix = features.attach_stats(
            matrix,
            features.user_stats(ratings, "UserID", "Rating"),
            features.item_stats(ratings, "MovieID", "Rating", "movie"),
            "UserID",
            "MovieID",
        )
    order = C.feature_columns(matrix, NOT_FEATURES, STATS)
    return C.select_features(matrix, NOT_FEATURES, order), order


def training_stages(
    prepared: Callable[[], DataFrame],
    continuous: Sequence[str],
    binary: Sequence[str],
    key: Sequence[str],
    label: str = "Liked",
    params: nb.Params = nb.Params(),
    folds: int = 5,
    rules: Sequence[tuple[str, str, float]] = fixed.GATE,
    split: Callable[[DataFrame], DataFrame] | None = None,
    fold: Callable[[DataFrame], DataFrame] | None = None,
    run_id: str = "run",
) -> list[runs.Stage]:
    """Split, fit, cross-validate, score, evaluate and judge, as stages of a run.

    `split` adds the column `split` (train, test) and `fold` the column `fold`; by default both follow from a hash of `key`.
    """
    split = split or (lambda df: sp.stratified_split(df, label, key, 0.2, 42))
    fold = fold or (lambda df: sp.stratified_folds(df, key, folds, 43))

    def train(done: runs.Results) -> DataFrame:
        return done["prepare"].where("split = 'train'")

    def fit(done: runs.Results) -> DataFrame:
        spark = done["prepare"].sparkSession
        return nb.model_table(spark, nb.fit_hybrid(train(done), continuous, binary, label, params), run_id)

    def cross_validate(done: runs.Results) -> DataFrame:
        return nb.cross_validate(fold(train(done)), continuous, binary, label, "fold", folds, {"run": params})

    def score(done: runs.Results) -> DataFrame:
        scored = nb.score(done["prepare"], nb.model_from_table(done["fit"]))
        return scored.select("split", F.col(label).alias("label"), "score", nb.predict("score").alias("pred"))

    def evaluate(done: runs.Results) -> DataFrame:
        held, right = done["score"].where("split = 'test'"), F.avg((F.col("pred") == F.col("label")).cast("double"))
        gap = metrics.train_test_gap(done["score"].groupBy("split").agg(right.alias("accuracy")))
        out = metrics.long_metrics(metrics.binary_metrics(held))
        for more in (nb.cv_summary(done["cross_validate"]).drop("run"), metrics.separation(held), gap):
            out = out.unionByName(metrics.long_metrics(more))
        return out

    def judge(done: runs.Results) -> DataFrame:
        return metrics.promotion_gate(done["evaluate"], rules, required=True)

    steps = (fit, cross_validate, score, evaluate, judge)
    return [("prepare", lambda done: split(prepared())), *((step.__name__, step) for step in steps)]


def run_report(spark: SparkSession, path: str, done: runs.Results) -> DataFrame:
    """(kind, name, status, value): a row per stage, per rule of the gate, and one for the run, promoted or rejected."""
    stages = runs.status(spark, path).select(F.lit("stage").alias("kind"), F.col("stage").alias("name"), "status", F.col("n_rows").cast("double").alias("value"))
    rule = F.when(F.col("passed"), "passed").otherwise("failed")
    rules = done["judge"].select(F.lit("rule").alias("kind"), F.col("metric").alias("name"), rule.alias("status"), "value")
    verdict = F.when(F.bool_and("passed"), "promoted").otherwise("rejected")
    whole = done["judge"].agg(F.lit("run").alias("kind"), F.lit("run").alias("name"), verdict.alias("status"), F.count_if("passed").cast("double").alias("value"))
    return stages.unionByName(rules).unionByName(whole)


def run_training(
    spark: SparkSession,
    paths: Mapping[str, str],
    params: nb.Params = nb.Params(),
    min_accuracy: float = 0.60,
    model_path: str | None = None,
    run_id: str = "run",
    run_path: str | None = None,
) -> tuple[nb.Model, DataFrame, DataFrame]:
    """Prepare, train, evaluate, gate: (model, metrics, gate rows); raises when a rule of the gate fails.

    With `run_path` the run can be repeated after a failure and goes on with the stage that failed. The model is stored
    under `model_path` only after the gate.
    """
    path = run_path or new_folder(spark, "run")
    matrix, order = prepare(spark, paths)
    continuous = [c for c in order if c in CONTINUOUS]
    binary = [c for c in order if c not in CONTINUOUS]
    rules = [r if r[0] != "accuracy" else ("accuracy", ">=", min_accuracy) for r in fixed.GATE]
    stages = training_stages(lambda: matrix, continuous, binary, ["UserID", "MovieID", "Timestamp"], params=params, rules=rules, run_id=run_id)
    done = runs.run_stages(spark, path, stages, {"paths": dict(paths), "params": params, "rules": rules, "features": order})
    metrics.require_gate(done["judge"])
    model = nb.model_from_table(done["fit"])
    if model_path:
        nb.save_model(spark, model, model_path, run_id)
    return model, done["evaluate"], done["judge"]


def build_training_set(
    ratings: DataFrame,
    views: store.Views,
    refs: Sequence[str],
    threshold: float = fixed.LIKE_AT,
    epoch: str = "Timestamp",
    rating: str = "Rating",
    point_in_time: bool = False,
) -> tuple[DataFrame, list[str]]:
    """Ratings with label and event time, joined to features of the store; the label travels with its row."""
    labelled = ratings.withColumns({"Liked": C.label_threshold(rating, threshold), "event_timestamp": C.epoch_to_ts(epoch)})
    wide = store.get_historical_features(labelled, views, refs, point_in_time)
    return wide, [c for c in wide.columns if c not in labelled.columns]
