import datetime as dt
import os

from pyspark.sql import functions as F


def test_upsert_period_idempotent(spark, tmp_path):
    from churnlab.sources import store
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "msno string, x double")
    path = str(tmp_path / "features")
    t = dt.datetime(2017, 3, 1)
    store.upsert_period(df, path, "2017-02", t)
    store.upsert_period(df.where("msno = 'a'"), path, "2017-03", t)
    store.upsert_period(df, path, "2017-02", t)
    assert store.read_period(spark, path, "2017-02").count() == 2
    assert store.read_period(spark, path, "2017-03").count() == 1


def test_upsert_predictions_keeps_api_rows(spark, tmp_path):
    from churnlab.sources import store
    df = spark.createDataFrame([("a", 0.2, 0)], "msno string, churn_prob double, churn_label int")
    path = str(tmp_path / "preds")
    store.upsert_predictions(df, path, "2017-04", "3", "api")
    store.upsert_predictions(df, path, "2017-04", "3", "batch")
    store.upsert_predictions(df, path, "2017-04", "3", "batch")
    got = store.read_predictions(spark, path).groupBy("source").count().collect()
    assert {r.source: r["count"] for r in got} == {"api": 1, "batch": 1}


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 11 and df.columns == ["feature", "renewal_mean", "churn_mean", "diff_pct"]
    assert E.entry(spark).schema == df.schema          # stable schema across runs
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 90


def test_feature_matrix_has_no_nulls_small(spark):
    from churnlab.plans.catalog import feature_matrix
    from churnlab.schemas import FEATURE_COLS_V5
    fm = feature_matrix(spark, "/root/testdata/sf0.001", "v5")
    assert fm.columns[2:] == FEATURE_COLS_V5
    nulls = fm.select([F.count_if(F.col(c).isNull()).alias(c) for c in FEATURE_COLS_V5]).first()
    assert sum(nulls) == 0


def test_plain_sinks_and_reports(spark, tmp_path):
    from churnlab.sources import store
    df = spark.createDataFrame([("a", 1.0)], "msno string, x double")
    store.write_features(df, str(tmp_path / "f"))
    assert store.read_features(spark, str(tmp_path / "f")).collect() == df.collect()
    for _ in range(2):
        store.write_metrics(df, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 2
    for score in (0.1, 0.3):
        store.append_drift_report(spark.createDataFrame([("2017-03", score)], "period string, drift_score double"),
                                  str(tmp_path / "d"))
    assert [tuple(r) for r in store.read_drift_reports(spark, str(tmp_path / "d")).collect()] == [("2017-03", 0.3)]
    truth = spark.createDataFrame([("a", "2017-03", 0), ("a", "2017-03", 1), ("b", "2017-03", 0)],
                                  "msno string, period string, actual_churn int")
    store.load_ground_truth(truth, str(tmp_path / "g"))
    store.load_ground_truth(truth, str(tmp_path / "g"))
    got = store.read_ground_truth(spark, str(tmp_path / "g")).select("msno", "actual_churn").collect()
    assert sorted(map(tuple, got)) == [("a", 1), ("b", 0)]


def test_versions_are_kept_and_promoted(spark, tmp_path):
    from churnlab.operators import models as ML
    from churnlab.sources import store
    path = str(tmp_path / "versions")
    for v in (1, 2):
        store.append_versions(ML.register_version(None, spark, "churn", v, {"log_loss": 0.2, "roc_auc": 0.9}), path)
    for v in (1, 2):
        store.append_versions(ML.promote(store.read_versions(spark, path), "churn", v), path)
    got = {r.version: r.stage for r in store.read_versions(spark, path).collect()}
    assert got == {1: "Archived", 2: "Production"}


def test_intermediate_tables_are_removed(spark):
    from churnlab import session
    session.remove_scratch(spark)
    df = session.materialize(spark.range(3))
    path = session._SCRATCH[-1]
    assert df.count() == 3 and os.path.isdir(path)
    assert session.remove_scratch(spark) == 1 and not os.path.exists(path) and session.remove_scratch(spark) == 0
