"""Classification metrics as aggregates over label, prediction and score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sorrel.functions import fixed
from sorrel.operators import naive_bayes as nb
from sorrel.operators.ordered import roc_auc
from sorrel.operators.split import stratified_folds


def _over(top: Column, bottom: Column) -> Column:
    """Ratio that is 0 where nothing can be divided."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred", group: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label) == 1, F.col(pred) == 1
    return df.groupBy(*group).agg(
        F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp")
    )


def ratios(digits: int | None = 4) -> dict[str, Column]:
    """Accuracy, precision, recall and F1 from the four counts."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    out = {
        "accuracy": _over(tp + tn, tn + fp + fn + tp),
        "precision": _over(tp, tp + fp),
        "recall": _over(tp, tp + fn),
        "f1_score": _over(2 * tp, 2 * tp + fp + fn),
    }
    return {k: F.round(v, digits) if digits is not None else v for k, v in out.items()}


def binary_metrics(
    df: DataFrame, label: str = "label", pred: str = "pred", score: str = "score", group: Sequence[str] = ()
) -> DataFrame:
    """Accuracy, precision, recall, F1 and ROC-AUC to four decimals, one row per group."""
    counts = confusion_matrix(df, label, pred, group)
    values = counts.select(*group, *[c.alias(n) for n, c in ratios().items()])
    auc = roc_auc(df, score, label, group).withColumn("roc_auc", F.round("roc_auc", 4))
    if group:
        return values.join(auc, list(group))
    return values.select("*", auc.scalar().alias("roc_auc"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy, macro and weighted averages."""
    m = confusion_matrix(df, label, pred)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def line(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1_score"),
            support.cast("bigint").alias("support"),
        )

    p0, r0, f0, n0 = _over(tn, tn + fn), _over(tn, tn + fp), _over(2 * tn, 2 * tn + fn + fp), tn + fp
    p1, r1, f1, n1 = _over(tp, tp + fp), _over(tp, tp + fn), _over(2 * tp, 2 * tp + fp + fn), tp + fn
    n = n0 + n1
    acc = _over(tn + tp, n)
    lines = F.array(
        line("0", p0, r0, f0, n0),
        line("1", p1, r1, f1, n1),
        line("accuracy", acc, acc, acc, n),
        line("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        line("weighted avg", _over(p0 * n0 + p1 * n1, n), _over(r0 * n0 + r1 * n1, n), _over(f0 * n0 + f1 * n1, n), n),
    )
    return m.select(F.inline(lines))


def precision_by_tag(
    df: DataFrame, tags: Sequence[str], label: str = "label", pred: str = "pred", at_least: int = 30, top: int = 12
) -> DataFrame:
    """Precision among the rows that carry a tag, for tags with enough rows, best first.

    All tags are counted in one aggregate instead of a row per tag and record.
    """
    hit = (F.col(pred) == 1) & (F.col(label) == 1)
    cells = [
        F.struct(
            F.lit(t).alias("tag"),
            F.count_if(F.col(t) == 1).alias("n"),
            F.count_if((F.col(t) == 1) & hit).alias("tp"),
            F.count_if((F.col(t) == 1) & (F.col(pred) == 1)).alias("predicted"),
        )
        for t in tags
    ]
    rows = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    return (
        rows.where(F.col("n") >= at_least)
        .select("tag", _over(F.col("tp"), F.col("predicted")).alias("precision"), "n")
        .orderBy(F.col("precision").desc(), "tag")
        .limit(top)
    )


def score_by_class(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Least, mean and largest score per true class, with the distance between the class means."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(y).alias("label"),
                F.min(F.when(F.col(label) == y, F.col(score))).alias("min"),
                F.avg(F.when(F.col(label) == y, F.col(score))).alias("mean"),
                F.max(F.when(F.col(label) == y, F.col(score))).alias("max"),
            ).alias(f"c{y}")
            for y in (0, 1)
        ]
    )
    gap = F.col("c1.mean") - F.col("c0.mean")
    return stats.select(F.inline(F.array("c0", "c1")), gap.alias("separation"))


def separation(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    one, zero = (F.avg(F.when(F.col(label) == y, F.col(score))) for y in (1, 0))
    return df.agg((one - zero).alias("separation"))


def long_metrics(wide: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Metrics table of (metric, value) rows."""
    names = [c for c in wide.columns if c not in group]
    return wide.select(*group, *[F.col(c).cast("double").alias(c) for c in names]).unpivot(list(group), names, "metric", "value")


def promotion_gate(
    metrics: DataFrame, rules: Sequence[tuple[str, str, float]] = fixed.GATE, required: bool = False
) -> DataFrame:
    """Pass or fail per rule that has a metric; with `required`, a missing metric fails."""
    spark = metrics.sparkSession
    table = spark.createDataFrame(list(rules), "metric string, comparison string, limit double")
    joined = table.join(metrics.select("metric", "value"), "metric", "left" if required else "inner")
    ok = F.when(F.col("comparison") == ">=", F.col("value") >= F.col("limit")).otherwise(F.col("value") <= F.col("limit"))
    return joined.select("metric", "comparison", "limit", "value", F.coalesce(ok, F.lit(False)).alias("passed"))


def require_gate(gate: DataFrame) -> None:
    """Raise when a rule failed; there is one row per rule."""
    failed = [f"{r.metric} {r.value} not {r.comparison} {r.limit}" for r in gate.where("not passed").collect()]
    if failed:
        raise ValueError("; ".join(failed))


def train_test_gap(metrics: DataFrame, split: str = "split") -> DataFrame:
    """Distance between train and test accuracy."""
    train, test = (F.max(F.when(F.col(split) == s, F.col("accuracy"))) for s in ("train", "test"))
    return metrics.agg(F.abs(train - test).alias("train_test_gap"))


def best_run(runs: DataFrame, order: str = "run_order") -> DataFrame:
    """The run with the highest accuracy above 0, the earliest among equals."""
    return runs.where(F.col("accuracy") > 0).orderBy(F.col("accuracy").desc(), order).limit(1)


def compare_runs(
    train: DataFrame,
    test: DataFrame,
    continuous: Sequence[str],
    binary: Sequence[str],
    key: Sequence[str],
    label: str = "liked",
    k: int = 5,
    runs: Sequence[tuple[str, float, float, float, float]] = fixed.RUNS,
    folds: DataFrame | None = None,
) -> DataFrame:
    """Test metrics and cross-validation of several settings, one row per run.

    The class summaries do not depend on the settings: they are aggregated once per fold, their sum
    is the whole training set, and one scan of the test rows scores every run.
    """
    settings = {name: nb.Params(*values) for name, *values in runs}
    folds = stratified_folds(train, key, k) if folds is None else folds
    sums = nb.fold_summaries(folds, continuous, binary, label, "fold")
    whole = {y: nb.merged([s for s in sums if s["label"] == y], len(continuous), len(binary)) for y in (0, 1)}
    scores = F.array(
        *[
            F.struct(
                F.lit(i).alias("run_order"),
                F.lit(name).alias("run"),
                nb.predict_proba(nb.model_from_summaries(whole, continuous, binary, p)).alias("score"),
            )
            for i, (name, p) in enumerate(settings.items())
        ]
    )
    long = test.select(F.col(label).alias("label"), F.inline(scores)).withColumn("pred", nb.predict("score"))
    cv = nb.cv_summary(nb.cross_validate(folds, continuous, binary, label, "fold", k, settings, sums))
    return binary_metrics(long, group=["run_order", "run"]).join(cv, "run")
