"""Commits: whole states before and after, failing jobs, two writers, merges by key, older versions."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from churnlab.sources import store
from churnlab.sources.snapshots import SnapshotTable, newest


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def failing(spark, n=4):
    """Rows of which one partition is written before another one's task fails."""
    bad = F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string"))
    return spark.range(0, n, 1, n).select(bad.cast("double").alias("x"), F.col("id").cast("string").alias("msno"))


def test_a_job_that_fails_leaves_the_old_state(spark, tmp_path):
    path, t = str(tmp_path / "f"), dt.datetime(2017, 3, 1)
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "msno string, x double")
    store.upsert_period(df, path, "2017-02", t)
    with pytest.raises(Exception, match="lost"):
        store.upsert_period(failing(spark), path, "2017-02", t)
    assert rows(store.read_period(spark, path, "2017-02", ["msno", "x"])) == [("a", 1.0), ("b", 2.0)]
    assert SnapshotTable(spark, path).versions() == [1]


def test_a_reader_between_two_writes_sees_one_state(spark, tmp_path):
    path, t = str(tmp_path / "f"), dt.datetime(2017, 3, 1)
    store.upsert_period(spark.range(5).select(F.col("id").alias("msno")), path, "2017-02", t)
    early = store.read_period(spark, path, "2017-02", ["msno"])  # planned, not read yet
    store.upsert_period(spark.range(5, 8).select(F.col("id").alias("msno")), path, "2017-02", t)
    assert rows(early) == [(i,) for i in range(5)]
    assert rows(store.read_period(spark, path, "2017-02", ["msno"])) == [(5,), (6,), (7,)]
    assert rows(store.read_period(spark, path, "2017-02", ["msno"], version=1)) == [(i,) for i in range(5)]
    table = SnapshotTable(spark, path)
    assert table.versions() == [1, 2] and table.expire(1) == 1 and table.versions() == [2]
    assert rows(store.read_period(spark, path, "2017-02", ["msno"])) == [(5,), (6,), (7,)]
    with pytest.raises(ValueError, match="no commit"):
        table.read(1)


def test_an_unfinished_commit_is_ignored(spark, tmp_path):
    path = str(tmp_path / "f")
    table = SnapshotTable(spark, path)
    with pytest.raises(ValueError, match="nothing"):
        table.read()
    table.replace(spark.createDataFrame([(1, "p")], "x int, part string"), ["part"])
    with open(os.path.join(path, "_commits", "000000000002.json"), "w") as f:
        f.write('{"live": {"part=p"')  # its writer died
    assert rows(table.read()) == [(1, "p")] and table.versions() == [1]
    table.replace(spark.createDataFrame([(2, "p")], "x int, part string"), ["part"])
    assert rows(table.read()) == [(2, "p")] and table.versions() == [1, 3]


def test_replace_of_a_scope_with_nothing_and_odd_names(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "f"))
    df = spark.createDataFrame([(1, "a/b=c d", "x"), (2, "a/b=c d", "y"), (3, "q", None)], "v int, p string, s string")
    table.replace(df, ["p", "s"])
    assert rows(table.read()) == rows(df)
    table.replace(df.where("v = 1").withColumn("v", F.lit(9)), ["p", "s"], {"p": "a/b=c d"})
    assert rows(table.read()) == [(3, "q", None), (9, "a/b=c d", "x")]
    table.replace(df.limit(0), ["p", "s"], {"p": "q"})
    assert rows(table.read()) == [(9, "a/b=c d", "x")]


def test_a_second_writer_of_the_same_keys_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "g")
    schema = "k int, v int, part string"
    table, other = SnapshotTable(spark, path), SnapshotTable(spark, path)
    table.merge(spark.createDataFrame([(1, 1, "p")], schema), ["k"], ["part"], newest("v"), 2)
    write, calls = table._write, []

    def meanwhile(df, parts):
        out = write(df, parts)
        calls.append(1)
        if len(calls) == 2:  # staged, merged with what was there: now another writer commits first
            other.merge(spark.createDataFrame([(1, 5, "p"), (3, 3, "p")], schema), ["k"], ["part"], newest("v"), 2)
        return out
    monkeypatch.setattr(table, "_write", meanwhile)
    table.merge(spark.createDataFrame([(1, 4, "p"), (2, 2, "p")], schema), ["k"], ["part"], newest("v"), 2)
    assert len(calls) == 3
    assert rows(table.read().select("k", "v")) == [(1, 5), (2, 2), (3, 3)]


def test_merge_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "g")
    gt = spark.range(300).select(F.col("id").alias("msno"), F.lit("2017-03").alias("period"), F.lit(0).alias("actual_churn"))
    store.load_ground_truth(gt, path)
    table = SnapshotTable(spark, path)
    before = table._commit(1)["live"]
    store.load_ground_truth(gt.where("msno = 7").withColumn("actual_churn", F.lit(1)), path)
    store.load_ground_truth(gt.where("msno = 7"), path)  # a churn stays one
    after = table._commit(3)["live"]
    assert len(before) > 20 and sum(before[p] != after[p] for p in before) == 1
    got = store.read_ground_truth(spark, path)
    assert got.count() == 300 and rows(got.where("actual_churn = 1").select("msno")) == [(7,)]


def test_batches_add_users_and_retries_add_nothing(spark, tmp_path):
    path = str(tmp_path / "g")
    make = lambda r: spark.createDataFrame(r, "msno string, period string, actual_churn int")
    one = make([("a", "2017-03", 0), ("a", "2017-03", 1), ("b", "2017-03", 0), (None, "2017-03", 0), ("z", None, 1)])
    two = make([("c", "2017-03", 1), ("b", "2017-04", 1)])
    for batch in (one, two, one, make([])):
        store.load_ground_truth(batch, path)
    got = rows(store.read_ground_truth(spark, path).select("msno", "period", "actual_churn"))
    assert got == sorted([("a", "2017-03", 1), ("b", "2017-03", 0), ("b", "2017-04", 1), ("c", "2017-03", 1),
                          (None, "2017-03", 0), ("z", None, 1)], key=str)
    preds, at = spark.createDataFrame([("a", 0.5, 1), ("b", 0.25, 0)], "msno string, churn_prob double, churn_label int"), []
    for hour in (1, 2, 1):
        store.append_predictions(preds, str(tmp_path / "p"), "api", "3", dt.datetime(2017, 4, 1, hour))
    assert store.read_predictions(spark, str(tmp_path / "p")).count() == 4
