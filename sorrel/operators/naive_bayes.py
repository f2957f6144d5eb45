"""Hybrid naive Bayes: Gaussian on scaled continuous columns, Bernoulli on binary ones.

Every fit is one grouped aggregate. What comes back to the driver is a summary of fixed size (a few
numbers per class and column, never rows); scoring is a column expression over its constants.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sorrel.functions import columns as C


@dataclass(frozen=True)
class Params:
    var_smoothing: float = 1e-2
    alpha: float = 1.0
    gaussian_weight: float = 0.6
    bernoulli_weight: float = 0.4


@dataclass(frozen=True)
class Model:
    """Fitted constants; tuples follow the order of `continuous` and `binary`, pairs are (class 0, class 1)."""

    continuous: tuple[str, ...]
    binary: tuple[str, ...]
    params: Params
    priors: tuple[float, float]
    lo: tuple[float, ...]
    hi: tuple[float, ...]
    mean: tuple[tuple[float, float], ...]
    var: tuple[tuple[float, float], ...]
    prob: tuple[tuple[float, float], ...]


def class_summaries(
    df: DataFrame, continuous: Sequence[str], binary: Sequence[str], label: str, by: Sequence[str] = ()
) -> DataFrame:
    """One row per class (and `by`): count, and per column what the fit needs."""
    aggs = ["count(1) AS n"]
    for i, c in enumerate(continuous):
        x = f"CAST({_name(c)} AS DOUBLE)"
        aggs += [f"min({x}) AS lo{i}", f"max({x}) AS hi{i}", f"avg({x}) AS mean{i}", f"var_pop({x}) AS var{i}"]
    aggs += [f"count_if({_name(c)} > 0) AS ones{j}" for j, c in enumerate(binary)]
    return df.groupBy(*by, F.col(label).cast("int").alias("label")).agg(*[F.expr(a) for a in aggs])


def merged(parts: Sequence[Mapping], n_cont: int, n_bin: int) -> dict:
    """One summary out of several, means and variances pooled without cancellation."""
    n = sum(p["n"] for p in parts)
    out = {"n": n}
    for i in range(n_cont):
        out[f"lo{i}"] = min(p[f"lo{i}"] for p in parts)
        out[f"hi{i}"] = max(p[f"hi{i}"] for p in parts)
        mean = math.fsum(p["n"] * p[f"mean{i}"] for p in parts) / n
        spread = math.fsum(p["n"] * (p[f"var{i}"] + (p[f"mean{i}"] - mean) ** 2) for p in parts)
        out[f"mean{i}"], out[f"var{i}"] = mean, spread / n
    for j in range(n_bin):
        out[f"ones{j}"] = sum(p[f"ones{j}"] for p in parts)
    return out


def model_from_summaries(
    by_class: Mapping[int, Mapping], continuous: Sequence[str], binary: Sequence[str], params: Params
) -> Model:
    """Turn the two class summaries into constants. Scaling is affine, so it is applied to the moments."""
    zero, one = by_class[0], by_class[1]
    whole = merged([zero, one], len(continuous), len(binary))
    lo, hi, width = [], [], []
    for i in range(len(continuous)):
        lo.append(whole[f"lo{i}"])
        hi.append(whole[f"hi{i}"])
        width.append((hi[i] - lo[i]) or 1.0)
    scaled_vars = [whole[f"var{i}"] / width[i] ** 2 for i in range(len(continuous))]
    eps = params.var_smoothing * max(scaled_vars, default=0.0)

    def pair(fn):
        return (fn(zero), fn(one))

    return Model(
        tuple(continuous),
        tuple(binary),
        params,
        pair(lambda s: s["n"] / whole["n"]),
        tuple(lo),
        tuple(hi),
        tuple(pair(lambda s, i=i: (s[f"mean{i}"] - lo[i]) / width[i]) for i in range(len(continuous))),
        tuple(pair(lambda s, i=i: s[f"var{i}"] / width[i] ** 2 + eps) for i in range(len(continuous))),
        tuple(
            pair(lambda s, j=j: (s[f"ones{j}"] + params.alpha) / (s["n"] + 2 * params.alpha))
            for j in range(len(binary))
        ),
    )


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest value per column, from one aggregate."""
    row = df.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in cols]).first()
    return {c: (row[c]["lo"], row[c]["hi"]) for c in cols}


def fit_hybrid(
    df: DataFrame, continuous: Sequence[str], binary: Sequence[str], label: str = "liked", params: Params = Params()
) -> Model:
    """Fit both parts in one pass; two summary rows reach the driver."""
    rows = class_summaries(df, continuous, binary, label).collect()
    by_class = {r["label"]: r.asDict() for r in rows}
    if set(by_class) != {0, 1}:
        raise ValueError("both classes are needed to fit")
    return model_from_summaries(by_class, continuous, binary, params)


def fit_gaussian_nb(df: DataFrame, cols: Sequence[str], label: str, var_smoothing: float = 1e-2) -> Model:
    return fit_hybrid(df, cols, [], label, Params(var_smoothing=var_smoothing))


def fit_bernoulli_nb(df: DataFrame, cols: Sequence[str], label: str, alpha: float = 1.0) -> Model:
    return fit_hybrid(df, [], cols, label, Params(alpha=alpha))


def _num(x: float) -> str:
    """A double literal in SQL."""
    return f"({float(x)!r}D)"


def _name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _sum(terms: Sequence[str]) -> Column:
    """One parsed expression instead of a call per operator: a model has hundreds of them."""
    return F.expr(" + ".join(terms)) if terms else F.lit(0.0)


def gaussian_terms(model: Model, cols: Sequence[str] | None = None) -> Column:
    """Log-odds contribution of continuous columns, without the priors."""
    terms = []
    for i, c in enumerate(model.continuous):
        if cols is not None and c not in cols:
            continue
        lo, width = model.lo[i], (model.hi[i] - model.lo[i]) or 1.0
        (m0, m1), (v0, v1) = model.mean[i], model.var[i]
        s = f"(CAST({_name(c)} AS DOUBLE) - {_num(lo)}) / {_num(width)}"
        d0, d1 = f"({s} - {_num(m0)})", f"({s} - {_num(m1)})"
        terms.append(
            f"({d0} * {d0} * {_num(0.5 / v0)} - {d1} * {d1} * {_num(0.5 / v1)} + {_num(0.5 * math.log(v0 / v1))})"
        )
    return _sum(terms)


def bernoulli_terms(model: Model, cols: Sequence[str] | None = None) -> Column:
    """Log-odds contribution of binary columns, without the priors."""
    terms = []
    for j, c in enumerate(model.binary):
        if cols is not None and c not in cols:
            continue
        p0, p1 = model.prob[j]
        on, off = math.log(p1 / p0), math.log((1 - p1) / (1 - p0))
        terms.append(f"IF({_name(c)} > 0, {_num(on)}, {_num(off)})")
    return _sum(terms)


def prior_term(model: Model) -> float:
    return math.log(model.priors[1] / model.priors[0])


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def mix(model: Model, gaussian_logit: Column, bernoulli_logit: Column) -> Column:
    """Weighted mean of the two posteriors; one part alone when the other has no columns."""
    if not model.binary:
        return sigmoid(gaussian_logit)
    wg, wb = model.params.gaussian_weight, model.params.bernoulli_weight
    return (F.lit(wg) * sigmoid(gaussian_logit) + F.lit(wb) * sigmoid(bernoulli_logit)) / F.lit(wg + wb)


def predict_proba(model: Model) -> Column:
    """P(label = 1) of a row as one expression; P(label = 0) is its complement."""
    prior = F.lit(prior_term(model))
    return mix(model, gaussian_terms(model) + prior, bernoulli_terms(model) + prior)


def predict(score: Column | str, at: float = 0.5) -> Column:
    return (C.as_col(score) >= at).cast("int")


def accuracy(df: DataFrame, pred: str, label: str) -> DataFrame:
    return df.agg(F.avg((F.col(pred) == F.col(label)).cast("double")).alias("accuracy"))


def score(df: DataFrame, model: Model, name: str = "score") -> DataFrame:
    return df.withColumn(name, predict_proba(model))


MODEL_SCHEMA = (
    "run_id string, position int, role string, feature string, lo double, hi double, "
    "zero double, one double, zero_var double, one_var double"
)


def model_table(spark: SparkSession, model: Model, run_id: str = "run") -> DataFrame:
    """The model as rows: priors, settings, then one row per column in feature order."""
    p = model.params
    rows = [
        (run_id, 0, "prior", None, None, None, *model.priors, None, None),
        (run_id, 1, "params", None, p.var_smoothing, p.alpha, p.gaussian_weight, p.bernoulli_weight, None, None),
    ]
    for i, c in enumerate(model.continuous):
        rows.append((run_id, len(rows), "continuous", c, model.lo[i], model.hi[i], *model.mean[i], *model.var[i]))
    for j, c in enumerate(model.binary):
        rows.append((run_id, len(rows), "binary", c, None, None, *model.prob[j], None, None))
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def model_from_table(table: DataFrame) -> Model:
    """Read a model back; the table has one row per feature."""
    rows = table.orderBy("position").collect()
    cont = [r for r in rows if r.role == "continuous"]
    bins = [r for r in rows if r.role == "binary"]
    prior = next(r for r in rows if r.role == "prior")
    p = next(r for r in rows if r.role == "params")
    return Model(
        tuple(r.feature for r in cont),
        tuple(r.feature for r in bins),
        Params(p.lo, p.hi, p.zero, p.one),
        (prior.zero, prior.one),
        tuple(r.lo for r in cont),
        tuple(r.hi for r in cont),
        tuple((r.zero, r.one) for r in cont),
        tuple((r.zero_var, r.one_var) for r in cont),
        tuple((r.zero, r.one) for r in bins),
    )


def save_model(spark: SparkSession, model: Model, path: str, run_id: str) -> None:
    model_table(spark, model, run_id).write.mode("append").partitionBy("run_id").parquet(path)


def load_model(spark: SparkSession, path: str, preference: Sequence[str]) -> Model:
    """The first run of the preference list that is stored."""
    table = spark.read.schema(MODEL_SCHEMA).parquet(path)
    order = F.array_position(F.array(*[F.lit(r) for r in preference]), F.col("run_id"))
    best = table.where(F.col("run_id").isin(list(preference))).agg(F.min_by("run_id", order)).scalar()
    rows = table.where(F.col("run_id") == best)
    if rows.isEmpty():
        raise LookupError("no stored model among " + ", ".join(preference))
    return model_from_table(rows)


def indexed_proba(models: Sequence[Model], index: str) -> Column:
    """P(label = 1) under the model numbered by column `index`, all models over the same columns.

    Used for folds: the constants become short arrays looked up by fold, so all folds are scored in
    one pass over the rows.
    """
    first = models[0]

    def pick(fn) -> str:
        return f"array({', '.join(_num(fn(m)) for m in models)})[{_name(index)}]"

    gauss, bern = [pick(prior_term)], [pick(prior_term)]
    for i, c in enumerate(first.continuous):
        width = pick(lambda m: (m.hi[i] - m.lo[i]) or 1.0)
        s = f"(CAST({_name(c)} AS DOUBLE) - {pick(lambda m: m.lo[i])}) / {width}"
        d0 = f"({s} - {pick(lambda m: m.mean[i][0])})"
        d1 = f"({s} - {pick(lambda m: m.mean[i][1])})"
        gauss.append(
            f"({d0} * {d0} * {pick(lambda m: 0.5 / m.var[i][0])} - {d1} * {d1} * {pick(lambda m: 0.5 / m.var[i][1])}"
            f" + {pick(lambda m: 0.5 * math.log(m.var[i][0] / m.var[i][1]))})"
        )
    for j, c in enumerate(first.binary):
        on = pick(lambda m: math.log(m.prob[j][1] / m.prob[j][0]))
        off = pick(lambda m: math.log((1 - m.prob[j][1]) / (1 - m.prob[j][0])))
        bern.append(f"IF({_name(c)} > 0, {on}, {off})")
    return mix(first, _sum(gauss), _sum(bern))


def fold_summaries(
    df: DataFrame, continuous: Sequence[str], binary: Sequence[str], label: str, fold: str
) -> list[dict]:
    """Summaries per (fold, class), k x 2 rows, shared by every setting that is compared."""
    return [r.asDict() for r in class_summaries(df, continuous, binary, label, [fold]).collect()]


def fold_models(
    summaries: Sequence[Mapping], fold: str, k: int, continuous: Sequence[str], binary: Sequence[str], params: Params
) -> list[Model]:
    """Per held-out fold, the model of all other folds' summaries."""
    out = []
    for held in range(k):
        by_class = {
            y: merged([s for s in summaries if s[fold] != held and s["label"] == y], len(continuous), len(binary))
            for y in (0, 1)
        }
        out.append(model_from_summaries(by_class, continuous, binary, params))
    return out


def cross_validate(
    df: DataFrame,
    continuous: Sequence[str],
    binary: Sequence[str],
    label: str = "liked",
    fold: str = "fold",
    k: int = 5,
    settings: Mapping[str, Params] | None = None,
    summaries: Sequence[Mapping] | None = None,
) -> DataFrame:
    """Accuracy per (run, fold): one pass for the summaries, one pass that scores all runs and folds."""
    settings = settings or {"baseline": Params()}
    sums = summaries or fold_summaries(df, continuous, binary, label, fold)
    hits = []
    for name, params in settings.items():
        models = fold_models(sums, fold, k, continuous, binary, params)
        right = predict(indexed_proba(models, fold)) == F.col(label)
        hits.append(F.avg(right.cast("double")).alias(name))
    wide = df.groupBy(fold).agg(*hits)
    return wide.unpivot([fold], list(settings), "run", "accuracy").select("run", fold, "accuracy")


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold accuracies of each run."""
    return folds.groupBy("run").agg(
        F.round(F.avg("accuracy"), 4).alias("cv_mean"), F.round(F.stddev_pop("accuracy"), 4).alias("cv_std")
    )
