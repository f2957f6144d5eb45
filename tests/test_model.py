import math
import random

import pytest
from pyspark.sql import functions as F

from sorrel.functions import fixed
from sorrel.operators import metrics as me, naive_bayes as nb, recommend as rc


@pytest.fixture(scope="module")
def four(spark):
    data = [(1, 10, 1, 0, 0), (2, 20, 0, 0, 0), (3, 10, 1, 1, 1), (4, 40, 0, 1, 1)]
    return spark.createDataFrame(data, "a int, b int, p int, q int, y int")


def test_hybrid_on_four_rows(four):
    model = nb.fit_hybrid(four, ["a", "b"], ["p", "q"], "y")
    assert model.var[0][0] == pytest.approx(0.25 / 9 + 0.0016666667, abs=1e-9)
    got = [r.score for r in nb.score(four, model).orderBy("a").collect()]
    assert got == pytest.approx([0.1000024257, 0.1070653996, 0.8613498680, 0.8999999997], abs=1e-9)
    gauss = nb.fit_gaussian_nb(four, ["a", "b"], "y")
    only = [r.score for r in nb.score(four, gauss).orderBy("a").collect()]
    assert only == pytest.approx([4.0428951783e-06, 0.0117756659, 0.9355831133, 0.9999999996], abs=1e-9)
    bern = nb.fit_bernoulli_nb(four, ["p", "q"], "y")
    assert bern.prob == ((0.5, 0.5), (0.25, 0.75))


def test_one_class_is_refused(four):
    with pytest.raises(ValueError):
        nb.fit_hybrid(four.where("y = 1"), ["a"], ["p"], "y")


def test_model_table_round_trip(spark, four, tmp_path):
    model = nb.fit_hybrid(four, ["a", "b"], ["p", "q"], "y", nb.Params(0.1, 0.5, 0.3, 0.7))
    path = str(tmp_path / "models")
    nb.save_model(spark, model, path, "second")
    assert nb.load_model(spark, path, ["first", "second"]) == model
    with pytest.raises(LookupError):
        nb.load_model(spark, path, ["third"])


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(3)
    data = []
    for i in range(600):
        y = int(rng.random() < 0.6)
        data.append((i, rng.gauss(y, 1.0), rng.gauss(100 - 10 * y, 20.0), int(rng.random() < 0.3 + 0.3 * y), int(rng.random() < 0.5), y, i % 5))
    return spark.createDataFrame(data, "i int, u double, v double, s int, t int, y int, fold int")


def test_probabilities_and_determinism(noisy):
    model = nb.fit_hybrid(noisy, ["u", "v"], ["s", "t"], "y")
    again = nb.fit_hybrid(noisy.repartition(1), ["u", "v"], ["s", "t"], "y")
    for a, b in zip(model.mean, again.mean):
        assert a == pytest.approx(b, rel=1e-12)
    stats = nb.score(noisy, model).agg(F.min("score").alias("a"), F.max("score").alias("z"), F.countDistinct(nb.predict("score")).alias("k")).first()
    assert 0 <= stats.a and stats.z <= 1 and stats.k == 2
    wide = noisy.withColumn("more", F.lit(5))
    assert nb.score(wide, model).agg(F.sum("score")).first()[0] == pytest.approx(nb.score(noisy, model).agg(F.sum("score")).first()[0])


def test_folds_equal_separate_fits(noisy):
    cols = (["u", "v"], ["s", "t"])
    got = {r.fold: r.accuracy for r in nb.cross_validate(noisy, *cols, "y").collect()}
    for k in range(5):
        model = nb.fit_hybrid(noisy.where(F.col("fold") != k), *cols, "y")
        held = nb.score(noisy.where(F.col("fold") == k), model).withColumn("pred", nb.predict("score"))
        assert got[k] == pytest.approx(nb.accuracy(held, "pred", "y").first().accuracy)
    s = nb.cv_summary(nb.cross_validate(noisy, *cols, "y")).first()
    mean = sum(got.values()) / 5
    assert s.cv_mean == round(mean, 4)
    assert s.cv_std == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in got.values()) / 5), abs=1e-4)


def test_runs_are_compared_and_the_first_best_wins(spark, noisy):
    got = me.compare_runs(noisy, noisy, ["u", "v"], ["s", "t"], ["i"], "y", folds=noisy)
    table = {r.run: r for r in got.collect()}
    assert set(table) == {r[0] for r in fixed.RUNS}
    model = nb.fit_hybrid(noisy, ["u", "v"], ["s", "t"], "y", nb.Params(1e-2, 0.5, 0.3, 0.7))
    scored = nb.score(noisy, model).withColumn("pred", nb.predict("score")).withColumnRenamed("y", "label")
    assert table["genre_dominant"].roc_auc == me.binary_metrics(scored).first().roc_auc
    ties = spark.createDataFrame([("b", 1, 0.7), ("a", 0, 0.7), ("z", 2, 0.0)], "run string, run_order int, accuracy double")
    assert me.best_run(ties).first().run == "a"
    assert me.best_run(ties.where("run = 'z'")).isEmpty()


def test_metrics(spark, rows):
    df = spark.createDataFrame([(1, 1, 0.9, 1), (0, 1, 0.6, 1), (0, 0, 0.2, 0), (1, 0, 0.4, 1)], "label int, pred int, score double, tag int")
    m = me.binary_metrics(df).first()
    assert (m.accuracy, m.precision, m.recall, m.f1_score, m.roc_auc) == (0.5, 0.5, 0.5, 0.5, 0.75)
    assert tuple(me.confusion_matrix(df).first()) == (1, 1, 1, 1)
    none = me.binary_metrics(df.withColumn("pred", F.lit(0))).first()
    assert (none.precision, none.f1_score) == (0.0, 0.0)
    rep = {r[0]: r for r in me.classification_report(df).collect()}
    assert rep["macro avg"].precision == 0.5 and rep["weighted avg"].support == 4
    assert rows(me.precision_by_tag(df, ["tag"], at_least=3)) == [("tag", 0.5, 3)]
    assert me.precision_by_tag(df, ["tag"], at_least=4).isEmpty()
    sep = me.score_by_class(df).where("label = 1").first()
    assert sep.separation == pytest.approx(0.25) and sep["max"] == 0.9


def test_gate(spark):
    metrics = spark.createDataFrame([("accuracy", 0.6), ("f1_score", 0.49), ("cv_std", 0.05)], "metric string, value double")
    gate = {r.metric: r.passed for r in me.promotion_gate(metrics).collect()}
    assert gate == {"accuracy": True, "f1_score": False, "cv_std": True}
    with pytest.raises(ValueError):
        me.require_gate(me.promotion_gate(metrics))
    assert me.promotion_gate(metrics, required=True).where("not passed").count() == 4
    split = spark.createDataFrame([("train", 0.8), ("test", 0.65)], "split string, accuracy double")
    assert me.train_test_gap(split).first()[0] == pytest.approx(0.15)


def brute(users, items, model, k, excluded):
    """Every pair scored one by one."""
    def logit(row, cols, binary):
        total = 0.0
        for i, c in enumerate(model.continuous):
            if not binary and c in cols:
                s = (row[c] - model.lo[i]) / ((model.hi[i] - model.lo[i]) or 1.0)
                (m0, m1), (v0, v1) = model.mean[i], model.var[i]
                total += 0.5 * math.log(v0 / v1) + (s - m0) ** 2 / (2 * v0) - (s - m1) ** 2 / (2 * v1)
        for j, c in enumerate(model.binary):
            if binary and c in cols:
                p0, p1 = model.prob[j]
                total += math.log(p1 / p0) if row[c] > 0 else math.log((1 - p1) / (1 - p0))
        return total

    prior = nb.prior_term(model)
    out = {}
    for u in users:
        scored = []
        for it in items:
            if (u["user_id"], it["item_id"]) in excluded:
                continue
            b, d = round(logit(it, it, False), 9), round(logit(it, it, True), 9)
            g, c = logit(u, u, False) + b + prior, logit(u, u, True) + d + prior
            p = 0.6 / (1 + math.exp(-g)) + 0.4 / (1 + math.exp(-c))
            scored.append((-round(p, 6), -b, it["item_id"]))
        out[u["user_id"]] = [x[2] for x in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_recommendations_equal_brute_force(spark, hot):
    rng = random.Random(11)
    items = []
    for i in range(400):
        # `hot`: most items share their tags, and many are equal in everything
        tags = (1, 0, 0) if hot and rng.random() < 0.7 else tuple(int(rng.random() < 0.4) for _ in range(3))
        items.append({"item_id": i, "year": float(rng.randint(1980, 1984 if hot else 2000)), "t1": tags[0], "t2": tags[1], "t3": tags[2]})
    users = [{"user_id": u, "age": float(rng.choice([1, 18, 25, 35])), "vip": int(rng.random() < 0.5)} for u in range(12)]
    train = []
    for _ in range(500):
        it, u = rng.choice(items), rng.choice(users)
        train.append((u["age"], it["year"], u["vip"], it["t1"], it["t2"], it["t3"], int(rng.random() < 0.3 + 0.2 * it["t1"] + 0.2 * u["vip"])))
    model = nb.fit_hybrid(spark.createDataFrame(train, "age double, year double, vip int, t1 int, t2 int, t3 int, y int"), ["age", "year"], ["vip", "t1", "t2", "t3"], "y")
    udf = spark.createDataFrame([tuple(u.values()) for u in users], "user_id int, age double, vip int")
    idf = spark.createDataFrame([tuple(i.values()) for i in items], "item_id int, year double, t1 int, t2 int, t3 int")
    # one user has excluded nearly the whole catalogue
    pairs = {(u, i) for u in range(6) for i in rng.sample(range(400), 40 * u)} | {(11, i) for i in range(397)}
    edf = spark.createDataFrame(sorted(pairs) + sorted(pairs)[:50], "user_id int, item_id int")
    for excluded, frame, limit in ((set(), None, "10m"), (pairs, edf, "10m"), (pairs, edf, "-1")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        got = {}
        for r in sorted(rc.recommend(udf, idf, model, 5, excluded=frame).collect(), key=lambda r: (r.user_id, r.rank)):
            got.setdefault(r.user_id, []).append(r.item_id)
            assert 0 <= r.score <= 1
        assert got == brute(users, items, model, 5, excluded)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_absent_features_are_zero_and_labels_attach(spark, four):
    model = nb.fit_hybrid(four, ["a", "b"], ["p", "q"], "y")
    users = spark.createDataFrame([(1, 3.0)], "user_id int, a double")
    items = spark.createDataFrame([(7, 1, "x"), (8, 0, "y")], "item_id int, q int, genres string")
    recs = rc.recommend(users, items, model, 2, item_cols=["q"])
    assert [r.item_id for r in recs.orderBy("rank").collect()] == [7, 8]
    assert rc.attach_labels(recs, items, "item_id", ["genres"]).orderBy("rank").first().genres == "x"


def test_predict_like_unknown_item(spark):
    train = spark.createDataFrame([(1, 1990.0, 0, 0), (2, 2000.0, 1, 1), (3, 2001.0, 1, 1), (4, 1980.0, 0, 0)], "a int, year double, t int, y int")
    model = nb.fit_hybrid(train, ["a", "year"], ["t"], "y")
    people = spark.createDataFrame([(1, 3)], "user_id int, a int")
    items = spark.createDataFrame([(5, 1990.0, 1), (6, None, 1)], "item_id int, year double, t int")
    pairs = spark.createDataFrame([(1, 5), (1, 6), (1, 99)], "user_id int, item_id int")
    got = {r.item_id: r for r in rc.predict_like(pairs, people, items, model).collect()}
    want = spark.createDataFrame([(5, 3, 1990.0, 1), (6, 3, 0.0, 1), (99, 3, 2000.0, 0)], "i int, a int, year double, t int")
    for r in nb.score(want, model).collect():
        assert got[r.i].score == pytest.approx(r.score)
        assert got[r.i].will_like == (r.score >= 0.5)


@pytest.mark.parametrize("values", [2, 7, 1000])
def test_dominance_counts_equal_all_pairs(spark, values):
    import random

    rng = random.Random(values)
    data = [(i, float(rng.randrange(values)), float(rng.randrange(values))) for i in range(150)]
    got = {r.item_id: r.beaten_by for r in rc.with_beaten_by(spark.createDataFrame(data, "item_id long, b double, d double"), "item_id").collect()}
    for i, b, d in data:
        assert got[i] == sum((b2 > b and d2 >= d) or (b2 == b and d2 == d and j < i) for j, b2, d2 in data)
    one = spark.createDataFrame(data[:1], "item_id long, b double, d double")
    assert [r.beaten_by for r in rc.with_beaten_by(one, "item_id").collect()] == [0]


def test_users_of_a_block_are_dealt_over_its_copies(spark, monkeypatch):
    """All users want the one best block; no key of the join holds over twice the share, and no pair is lost."""
    monkeypatch.setattr(rc, "SHARE", 100)
    parts = spark.createDataFrame([(i, float(i % 17), float(i % 5)) for i in range(60)], "item_id long, b double, d double")
    placed, blocks = rc.item_blocks(parts, "item_id", block=16)
    users = spark.range(1000).select(F.col("id").alias("user_id"), F.lit(0.1).alias("a"), F.lit(0.2).alias("c"), (1 + F.col("id") % 3).alias("need"))
    got = rc.candidate_blocks(users, placed, blocks, "user_id")
    assert max(r["count"] for r in got.groupBy("block", "copy").count().collect()) < 200
    first = {r.level: (r.a, r.z) for r in placed.groupBy("level").agg(F.min("block").alias("a"), F.max("block").alias("z")).collect()}
    here = {r.block for r in placed.select("block").distinct().collect()}
    want = sum(b in here for i in range(1000) for level, (a, z) in first.items() if 2**level - 1 < 1 + i % 3 for b in range(a, z + 1))
    assert got.count() == want and got.select("user_id", "block").distinct().count() == want
