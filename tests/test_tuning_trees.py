"""Trials at once, successive halving, importances from the trees, and fits against plain Newton steps."""

import random
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.operators import models as ML

COLS = ["signal", "noise", "kind"]


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(900):
        y = int(rnd.random() < 0.3)
        rows.append((i, y, rnd.gauss(1.5 * y, 1), rnd.gauss(0, 1), float(rnd.choice([0, 1, 1, 2]) if y else rnd.choice([2, 3]))))
    df = spark.createDataFrame(rows, "msno long, is_churn int, signal double, noise double, kind double")
    return ML.materialize(df)


def plain_newton(x, y, w, steps=30):
    x = np.c_[x, np.ones(len(x))]
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x, x.T @ (w * (p - y)))
    return 1 / (1 + np.exp(-x @ beta))


def test_logistic_scores_equal_a_plain_fit(spark, data):
    weighted = ML.with_class_weight(data)
    got = {r.msno: r.prob for r in ML.score(ML.lr_pipeline(COLS).fit(weighted), data).collect()}
    rows = weighted.collect()
    x, y, w = (np.array([f(r) for r in rows]) for f in (lambda r: [r[c] for c in COLS], lambda r: r.is_churn, lambda r: r.weight))
    want = plain_newton(x, y, w)
    assert max(abs(got[r.msno] - p) for r, p in zip(rows, want)) < 1e-3


@pytest.mark.parametrize("name", ["lr", "gbt", "rf"])
def test_models_beat_a_constant_score(spark, data, name):
    tr, te = ML.split(data)
    kw = {"gbt": {"max_iter": 8, "max_depth": 3}, "rf": {"num_trees": 15, "max_depth": 5}}.get(name, {})
    model = ML.BUILDERS[name](COLS, **kw).fit(ML.with_class_weight(tr))
    ev = ML.evaluate(ML.score(model, te)).first()
    flat = ML.evaluate(te.select("msno", "is_churn", F.lit(0.5).alias("prob"))).first()
    assert ev.roc_auc > 0.85 > flat.roc_auc == 0.5 and ev.log_loss < flat.log_loss


@pytest.mark.parametrize("name,kw", [("gbt", {"max_iter": 6, "max_depth": 3}), ("rf", {"num_trees": 7, "max_depth": 4})])
def test_importances_from_the_nodes(spark, data, name, kw):
    model = ML.BUILDERS[name](COLS, **kw).fit(ML.with_class_weight(data))
    got = {r.feature: r for r in ML.tree_importance(model, COLS).collect()}
    want = model.stages[-1].featureImportances.toArray()
    assert all(abs(got[c].gain_importance - want[i]) < 1e-9 for i, c in enumerate(COLS))
    splits = [0] * len(COLS)
    for tree in model.stages[-1].trees:
        for line in tree.toDebugString.splitlines():
            if line.strip().startswith("If (feature "):
                splits[int(line.split("feature ")[1].split()[0])] += 1
    assert [got[c].n_splits for c in COLS] == splits and sum(splits) > 0
    assert ML.feature_importance(model, COLS, 2)[0][0] == max(COLS, key=lambda c: got[c].gain_importance)


def test_halving_finds_the_winner_of_the_grid(spark, data):
    grid = {"reg": [0.0, 0.01, 5.0, 50.0]}
    full = ML.tune(data, COLS, grid, model="lr", k=2).collect()
    rows = ML.tune_halving(data, COLS, grid, model="lr", k=2, rungs=2).collect()
    assert [r.rung for r in rows] == [0] * 4 + [1] * 2 and [r.fraction for r in rows] == [0.5] * 4 + [1.0] * 2
    best = min(full, key=lambda r: (-r.roc_auc, r.trial))
    winner = [r for r in rows if r.rung == 1 and r.kept]
    assert len(winner) == 1 and winner[0].trial == best.trial
    again = {(r.rung, r.trial): r.roc_auc for r in ML.tune_halving(data, COLS, grid, model="lr", k=2, rungs=2).collect()}
    assert all(abs(again[r.rung, r.trial] - r.roc_auc) < 1e-12 for r in rows)
    with pytest.raises(ValueError):
        ML.tune_halving(data, COLS, grid, rungs=0)


def test_trials_really_run_at_once(spark, data, monkeypatch):
    meet = threading.Barrier(2, timeout=60)  # breaks if only one trial is under way

    def build(*a, **kw):
        meet.wait()
        return ML.lr_pipeline(*a, **kw)
    monkeypatch.setitem(ML.BUILDERS, "lr", build)
    trials = ML.tune(data, COLS, {"reg": [0.0, 0.1]}, model="lr", k=2, parallelism=2).collect()
    assert [r.trial for r in trials] == [0, 1] and not meet.broken
    assert ML.cross_validate(data, COLS, ("lr",), 2, parallelism=2).count() == 2


def test_missing_columns_stop_a_batch_before_any_job(spark, data):
    model = ML.lr_pipeline(COLS).fit(ML.with_class_weight(data))
    with pytest.raises(ValueError, match="noise"):
        ML.score_batch(model, data.drop("noise"), "2017-04", "1")
