import math
import random

from churnlab.operators import metrics as M
from churnlab.operators.quantiles import exact_quantiles


def _auc_pairs(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def _ap(rows):
    P = sum(y for y, _ in rows)
    out, tp, fp = 0.0, 0, 0
    for t in sorted({p for _, p in rows}, reverse=True):
        pos = sum(1 for y, p in rows if p == t and y == 1)
        tp += pos
        fp += sum(1 for y, p in rows if p == t and y == 0)
        out += pos / P * tp / (tp + fp)
    return out


def test_auc_ap_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(int(rnd.random() < 0.3), round(rnd.random(), 1)) for _ in range(400)]   # heavy ties
    df = spark.createDataFrame(rows, "label int, prob double")
    assert abs(M.roc_auc(df).first().roc_auc - _auc_pairs(rows)) < 1e-12
    assert abs(M.pr_auc(df).first().pr_auc - round(_ap(rows), 10)) < 1e-9


def test_auc_edge_cases(spark):
    ties = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5)], "label int, prob double")
    assert M.roc_auc(ties).first().roc_auc == 0.5
    one_class = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, prob double")
    assert M.roc_auc(one_class).first().roc_auc is None


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 0.0)], "label int, prob double")
    got = M.log_loss(df).first().log_loss
    assert abs(got - (-math.log(2.220446049250313e-16)) / 3) < 1e-6


def test_best_f1_and_report(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.6), (0, 0.1)], "label int, prob double")
    b = M.best_f1_threshold(df).first()
    assert b.threshold == 0.6 and abs(b.recall - 1.0) < 1e-9
    rep = {r["class"]: r for r in M.classification_report(df, thr=0.5).collect()}
    assert rep["1"].support == 3 and rep["accuracy"].precision == 0.8


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    rnd = random.Random(5)
    vals = [float(rnd.randint(0, 30)) for _ in range(501)] + [rnd.random() * 100 for _ in range(300)]
    df = spark.createDataFrame([(v, v * 2) for v in vals], "a double, b double")
    q = {(r.k, r.p): r.q for r in exact_quantiles(df, ["a", "b"], (0.1, 0.5, 0.99), per_range=40).collect()}
    for c, mult in (("a", 1), ("b", 2)):
        for p in (0.1, 0.5, 0.99):
            assert abs(q[(c, p)] - float(np.quantile(np.array(vals) * mult, p))) < 1e-9


def test_latest_prediction(spark):
    import datetime as dt
    rows = [("u", 0.1, "v1", "2017-03", dt.datetime(2017, 3, 1)), ("u", 0.7, "v2", "2017-03", dt.datetime(2017, 3, 2)),
            ("w", 0.4, "v1", "2017-03", dt.datetime(2017, 3, 1))]
    df = spark.createDataFrame(rows, "msno string, churn_prob double, model_version string, period string, "
                                     "predicted_at timestamp")
    got = {r.msno: r.churn_prob for r in M.latest_prediction(df, "2017-03").collect()}
    assert got == {"u": 0.7, "w": 0.4}


def test_exact_quantiles_same_for_any_ranges(spark):
    rnd = random.Random(8)
    vals = [float(rnd.randint(0, 40)) for _ in range(700)] + [rnd.random() for _ in range(700)]
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    probs = (0.01, 0.3, 0.5, 0.77, 1.0)
    one = {r.p: r.q for r in exact_quantiles(df, ["a"], probs).collect()}
    many = {r.p: r.q for r in exact_quantiles(df, ["a"], probs, per_range=50).collect()}
    assert one == many


def test_threshold_table_same_for_any_ranges(spark):
    rnd = random.Random(12)
    rows = [(int(rnd.random() < 0.35), round(rnd.random(), 3)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "label int, prob double")
    a = sorted(tuple(r) for r in M.threshold_table(df).collect())
    b = sorted(tuple(r) for r in M.threshold_table(df, per_range=60).collect())
    assert a == b


def test_two_thousand_ranges(spark):
    df = spark.range(2000).selectExpr("id * 0.5 AS a")
    q = {r.p: r.q for r in exact_quantiles(df, ["a"], (0.25, 0.5), per_range=1).collect()}
    assert q == {0.25: 249.875, 0.5: 499.75}


def test_auc_of_counts_beyond_a_long(spark):
    n = 10**12
    t = spark.createDataFrame([(0.9, 3 * n, n, 3 * n, 4 * n, 4 * n), (0.1, n, 3 * n, 4 * n, 4 * n, 4 * n)],
                              "threshold double, pos long, neg long, tp long, P long, N long")
    # 3/4 of the positives above, 1/4 of the negatives: 9/16 + half of the ties 3/16 + 3/16
    assert M.roc_auc(None, table=t).first().roc_auc == 0.75


def test_version_without_digits(spark):
    import datetime as dt

    from churnlab.operators.monitor import latest_version
    at = dt.datetime(2017, 3, 1)
    df = spark.createDataFrame([("champion", at), ("v2", at)], "model_version string, predicted_at timestamp")
    assert latest_version(df).first().model_version == "v2"
