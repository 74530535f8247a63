"""MLlib and streaming: invariants and seeded repeatability (no SQL twin exists for these)."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from churnlab.operators import metrics as M
from churnlab.operators import models as ML


def _planted(spark, n=400, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rnd.random() < 0.3)
        rows.append((f"u{i}", y, rnd.gauss(2.0 * y, 1.0), rnd.random()))
    return spark.createDataFrame(rows, "msno string, is_churn int, signal double, noise double")


def test_split_and_folds_deterministic(spark):
    df = _planted(spark)
    tr, te = ML.split(df, 0.8, seed=42)
    assert tr.count() + te.count() == 400 and tr.join(te, "msno").count() == 0
    a = {r.msno: r.fold for r in ML.stratified_folds(df, 5, 7).collect()}
    b = {r.msno: r.fold for r in ML.stratified_folds(df.repartition(3), 5, 7).collect()}
    assert a == b and set(a.values()) <= set(range(5))
    ex = ML.stratified_folds(df, 4, 7, exact=True).groupBy("is_churn", "fold").count().collect()
    per = {}
    for r in ex:
        per.setdefault(r.is_churn, []).append(r["count"])
    assert all(max(v) - min(v) <= 1 for v in per.values())


def test_lr_learns_planted_signal_and_blend(spark):
    df = ML.with_class_weight(_planted(spark))
    tr, te = ML.split(df, 0.7)
    lr = ML.lr_pipeline(["signal", "noise"]).fit(tr)
    rf = ML.rf_pipeline(["signal", "noise"], num_trees=10, max_depth=4).fit(tr)
    s = ML.score(lr, te, "p_lr").join(ML.score(rf, te, "p_rf"), ["msno", "is_churn"])
    probs = [r.p_lr for r in s.collect()]
    assert all(0.0 <= p <= 1.0 for p in probs)
    ev = ML.evaluate(ML.blend(s, ["p_lr", "p_rf"]).select("msno", "is_churn", "prob")).first()
    assert ev.roc_auc > 0.8
    imp = ML.feature_importance(rf, ["signal", "noise"])
    assert imp[0][0] == "signal"


def test_cross_validate_and_summary(spark):
    cv = ML.cross_validate(_planted(spark), ["signal", "noise"], ("lr",), k=2)
    s = M.cv_summary(cv).first()
    assert s.model == "lr" and s.roc_auc_mean > 0.8


def test_registry_promote(spark):
    v = ML.register_version(None, spark, "churn", 1, {"log_loss": 0.23, "roc_auc": 0.9}, "Production")
    v = ML.register_version(v, spark, "churn", 2, {"log_loss": 0.22, "roc_auc": 0.91}, "Staging")
    stages = {r.version: r.stage for r in ML.promote(v, "churn", 2).collect()}
    assert stages == {1: "Archived", 2: "Production"}


def test_model_roundtrip_checks_features(spark, tmp_path):
    from churnlab.sources.store import load_model, save_model
    df = ML.with_class_weight(_planted(spark))
    m = ML.lr_pipeline(["signal", "noise"]).fit(df)
    path = str(tmp_path / "model")
    save_model(m, path, ["signal", "noise"])
    m2, feats = load_model(path, ["signal", "noise"])
    assert feats == ["signal", "noise"] and ML.score(m2, df).count() == 400
    try:
        load_model(path, ["noise", "signal"])
        raise AssertionError("feature order change must be rejected")
    except ValueError:
        pass


def test_rate_stream_equals_batch(spark, tmp_path):
    from churnlab.operators.monitor import hourly_by_source
    from churnlab.streaming.scoring import final_rates, prediction_rate_stream
    base = dt.datetime(2017, 3, 1)
    rows = [("api" if i % 3 else "batch", base + dt.timedelta(minutes=7 * i)) for i in range(300)]
    df = spark.createDataFrame(rows, "source string, predicted_at timestamp")
    src = str(tmp_path / "src")
    df.repartition(3).write.parquet(src)
    prediction_rate_stream(spark, src, df.schema, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = {(r.window_start, r.source): r.n for r in final_rates(spark, str(tmp_path / "out")).collect()}
    want = {(r.hour, r.source): r.n for r in hourly_by_source(df, base + dt.timedelta(days=3), days=10).collect()}
    assert got == want


def test_log_agg_cache_is_of_its_input(spark, tmp_path):
    from churnlab.sources.store import materialize_log_agg
    schema = ("msno string, date int, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, num_unq int, "
              "total_secs double")
    logs = spark.createDataFrame([("u", 20170227, 1, 1, 1, 1, 1, 1, 10.0)], schema)
    run = lambda df, **kw: materialize_log_agg(
        spark, df, dt.date(2017, 2, 28), dt.date(2017, 1, 30), {"r7d": dt.date(2017, 2, 21)}, str(tmp_path), **kw)
    assert run(logs).first().n_days == 1
    assert run(logs.unionByName(logs)).first().n_days == 2        # changed input -> fresh data
    assert len(list(tmp_path.iterdir())) == 2
    run(logs)
    assert len(list(tmp_path.iterdir())) == 2                     # same input -> read again
    assert run(logs, version="x").first().n_days == 1 and run(logs.limit(0), version="x").count() == 1
    assert F is not None


def test_score_stream_scores_valid_rows_and_keeps_rejects(spark, tmp_path, base_record):
    from conftest import records_df

    from churnlab.schemas import FEATURE_COLS_V5 as V5
    from churnlab.streaming.scoring import score_stream
    recs = [dict(base_record, n_transactions=float(i)) for i in range(40)]
    train = ML.with_class_weight(records_df(spark, recs).withColumn("is_churn", (F.col("msno").cast("int") % 2)))
    model = ML.lr_pipeline(V5).fit(train)
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    df = records_df(spark, recs[:10] + [dict(base_record, age=-5.0), dict(base_record, days_since_last=None)])
    df.write.parquet(src)
    for ck in ("ck1", "ck2"):  # a second run from a fresh checkpoint is a retried batch: nothing doubles
        score_stream(spark, model, src, df.schema, V5, out, str(tmp_path / ck), "v1")
        scored, bad = spark.read.parquet(out), spark.read.parquet(f"{out}_rejects")
        assert {r.msno for r in scored.collect()} == {str(i) for i in range(10)} and scored.count() == 10
        assert {r.msno: r.failed_rules for r in bad.collect()} == {"10": ["range:age"], "11": ["no_nulls"]}


def test_score_batch_calibrate_export(spark, tmp_path):
    from churnlab.sources import store
    df = ML.with_class_weight(_planted(spark))
    m = ML.lr_pipeline(["signal", "noise"]).fit(df)
    path = str(tmp_path / "preds")
    out, dist = ML.score_batch(m, df, "2017-04", "7", path)
    assert store.read_predictions(spark, path).count() == 400 and 0.0 <= dist.first().mean <= 1.0
    scored = ML.score(m, df)
    iso = ML.calibrate(scored)
    cal = [r.calibrated_prob for r in iso.transform(scored).collect()]
    assert all(0.0 <= p <= 1.0 for p in cal)
    store.export_scores(out, str(tmp_path / "sub"))
    sub = spark.read.option("header", True).csv(str(tmp_path / "sub"))
    assert sub.columns == ["msno", "is_churn"] and sub.count() == 400
    store.append_predictions(out, str(tmp_path / "api"), "api", "7", dt.datetime(2017, 4, 2))
    store.append_predictions(out, str(tmp_path / "api"), "api", "7", dt.datetime(2017, 4, 3))
    assert store.read_predictions(spark, str(tmp_path / "api")).count() == 800


def test_tune_trials_and_subsample(spark):
    df = _planted(spark, n=300)
    trials = ML.tune(df, ["signal", "noise"], {"reg": [0.0, 0.1]}, model="lr", k=2)
    rows = trials.collect()
    assert len(rows) == 2 and all(r.roc_auc > 0.7 for r in rows)
    a = {r.msno for r in ML.subsample(df, 0.25).collect()}
    assert a == {r.msno for r in ML.subsample(df.repartition(5), 0.25).collect()} and 30 < len(a) < 120


def test_log_agg_cache_tells_repeated_pairs_apart(spark, tmp_path):
    from churnlab.sources.store import materialize_log_agg
    cols = "msno string, date int, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, num_unq int, " \
           "total_secs double"
    row = lambda u, n: (u, 20170227, n, n, n, n, n, n, 10.0 * n)
    make = lambda *rows: spark.createDataFrame(list(rows), cols)
    run = lambda df: sorted(map(str, materialize_log_agg(
        spark, df, dt.date(2017, 2, 28), dt.date(2017, 1, 30), {"r7d": dt.date(2017, 2, 21)}, str(tmp_path)).collect()))
    a, b, c = row("a", 1), row("a", 2), row("c", 3)
    assert run(make(a, a, c)) != run(make(b, b, c))
    assert len([p for p in os.listdir(tmp_path) if p.startswith("log_agg_")]) == 2


def test_temporal_validate_gives_the_metrics_of_the_next_period(spark):
    prev, cur, upcoming = (_planted(spark, seed=s) for s in (1, 2, 3))
    features = [c for c in prev.columns if c not in ("msno", "is_churn")]
    fit = lambda df: ML.lr_pipeline(features).fit(ML.with_class_weight(df))
    scored, metrics, after = ML.temporal_validate(fit, prev, cur, upcoming)
    got = metrics.first()
    assert got.asDict() == ML.evaluate(scored).first().asDict() and got.roc_auc > 0.7 and got.log_loss > 0
    flat = ML.evaluate(scored.withColumn("prob", F.lit(0.5))).first()
    assert flat.roc_auc == 0.5 and got.roc_auc != flat.roc_auc and got.log_loss != flat.log_loss
    assert scored.count() == cur.count() and after.count() == upcoming.count()
