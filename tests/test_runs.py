"""Runs in stages: what is done stays done, what fails is recorded and run again."""

import pytest
from pyspark.sql import functions as F

from sorrel.functions import fixed
from sorrel.operators import metrics as me
from sorrel.plans import runs, training as tr
from sorrel.session import new_folder


def standing(spark, path):
    return {r.stage: (r.position, r.status, r.attempts, r.n_rows) for r in runs.status(spark, path).collect()}


def test_a_run_goes_on_with_the_stage_that_failed(spark):
    calls, path = [], new_folder(spark, "run")

    def first(done):
        calls.append("first")
        return spark.range(7)

    def second(done):
        calls.append("second")
        if calls.count("second") == 1:
            raise RuntimeError("lost\nsecond line")
        return done["first"].where("id > 2")

    def third(done):
        calls.append("third")
        return done["second"].agg(F.sum("id").alias("s"))

    stages = [("first", first), ("second", second), ("third", third)]
    assert standing(spark, path) == {}
    with pytest.raises(RuntimeError):
        runs.run_stages(spark, path, stages, {"k": 1})
    assert standing(spark, path) == {"first": (0, "done", 1, 7), "second": (1, "failed", 1, None)}
    assert runs.status(spark, path).where("stage = 'second'").first().message == "lost"
    done = runs.run_stages(spark, path, stages, {"k": 1})
    assert calls == ["first", "second", "second", "third"] and done["third"].first().s == 18
    assert standing(spark, path) == {"first": (0, "done", 1, 7), "second": (1, "done", 2, 4), "third": (2, "done", 1, 1)}
    # a third call reads everything back
    assert runs.run_stages(spark, path, stages, {"k": 1})["third"].first().s == 18 and len(calls) == 4
    with pytest.raises(ValueError, match="other settings"):
        runs.run_stages(spark, path, stages, {"k": 2})


def test_a_stage_that_fails_while_it_is_computed_is_not_done(spark):
    path = new_folder(spark, "run")
    bad = [("only", lambda done: spark.range(5).select(F.raise_error(F.lit("bad row")).cast("int").alias("x")))]
    with pytest.raises(Exception):
        runs.run_stages(spark, path, bad)
    assert standing(spark, path)["only"][1] == "failed"
    assert runs.run_stages(spark, path, [("only", lambda done: spark.range(5))])["only"].count() == 5


@pytest.fixture(scope="module")
def matrix(spark):
    rows = [(i, i % 5, float(i % 11) + 3 * (i % 2), i % 3, int(i % 2 == 0 or i % 7 == 0)) for i in range(600)]
    return spark.createDataFrame(rows, "u long, m long, x double, tag int, liked int")


@pytest.mark.parametrize("metric", [r[0] for r in fixed.GATE])
def test_every_rule_can_stop_a_run(spark, matrix, metric):
    """Each rule alone, with a limit no model meets."""
    rules = [(m, c, (2.0 if c == ">=" else -1.0) if m == metric else (-1.0 if c == ">=" else 2.0)) for m, c, _ in fixed.GATE]
    stages = tr.training_stages(lambda: matrix, ["x"], ["tag"], ["u", "m"], "liked", rules=rules)
    path = new_folder(spark, "run")
    if metric != "accuracy":
        # the stages before the gate do not depend on the rules; run them once
        stages = [(n, s) if n == "judge" else (n, lambda done, n=n: EARLIER[n]) for n, s in stages]
    done = runs.run_stages(spark, path, stages)
    EARLIER.update(done if not EARLIER else {})
    report = {(r.kind, r.name): r.status for r in tr.run_report(spark, path, done).collect()}
    assert report["run", "run"] == "rejected" and report["rule", metric] == "failed"
    assert [n for (k, n), s in report.items() if k == "rule" and s == "failed"] == [metric]
    with pytest.raises(ValueError, match=metric):
        me.require_gate(done["judge"])


EARLIER = {}
