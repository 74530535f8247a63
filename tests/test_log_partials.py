"""The log aggregate from stored partials: equal to a full pass, and reading new files only."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from test_event_log import tasks

from churnlab.operators.features import log_user_agg
from churnlab.sources.log_partials import LOG_SCHEMA, incremental_log_agg, merge_partials

CUTS = (dt.date(2017, 2, 28), dt.date(2017, 2, 1), {"r7d": dt.date(2017, 2, 22), "r90d": dt.date(2016, 12, 1)})


def some_logs(spark, seed, n=300, secs="double"):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, *range(12)]), 20170100 + rnd.choice([1, 25, 101, 128, 201]), 1, 0, None, 2, 1, rnd.randrange(5),
             rnd.choice([None, -5.0, 1e9, float(rnd.randrange(9000))])) for _ in range(n)]
    return spark.createDataFrame(rows, LOG_SCHEMA).withColumn("total_secs", F.col("total_secs").cast(secs))


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("secs", ["double", "decimal(18,2)"])
def test_new_changed_and_vanished_files(spark, tmp_path, secs):
    logs, store = str(tmp_path / "logs with space"), str(tmp_path / "store")
    os.makedirs(logs)
    report = {}

    def check(new, covered):
        got = incremental_log_agg(spark, logs, store, *CUTS, report=report)
        want = log_user_agg(spark.read.option("recursiveFileLookup", "true").parquet(logs), *CUTS)
        assert rows(got) == rows(want) and report == {"new": new, "covered": covered}
        assert got.schema["total_secs_sum"].dataType == want.schema["total_secs_sum"].dataType
    assert rows(incremental_log_agg(spark, logs, store, *CUTS)) == []
    for k in range(2):
        some_logs(spark, k, secs=secs).coalesce(1).write.parquet(f"{logs}/p{k}")
    check(2, 0)
    check(0, 2)
    some_logs(spark, 7, 20, secs).coalesce(1).write.parquet(f"{logs}/p2")
    check(1, 2)
    some_logs(spark, 9, 50, secs).coalesce(1).write.mode("overwrite").parquet(f"{logs}/p0")
    check(1, 2)
    for name in os.listdir(f"{logs}/p1"):
        os.remove(f"{logs}/p1/{name}")
    check(0, 2)


def test_a_failed_run_leaves_the_store(spark, tmp_path):
    logs, store = str(tmp_path / "logs"), str(tmp_path / "store")
    some_logs(spark, 1).write.parquet(f"{logs}/a")
    before = rows(incremental_log_agg(spark, logs, store, *CUTS))
    some_logs(spark, 2).write.parquet(f"{logs}/b")

    def broken(s, files):
        return s.read.parquet(*files).withColumn("date", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        incremental_log_agg(spark, logs, store, *CUTS, read=broken)
    report = {}
    after = incremental_log_agg(spark, logs, store, *CUTS, report=report)
    assert report["new"] > 0 and rows(after) == rows(log_user_agg(spark.read.parquet(f"{logs}/a", f"{logs}/b"), *CUTS))
    assert rows(after) != before


def test_merging_partials_in_any_order(spark):
    parts = [log_user_agg(some_logs(spark, k), *CUTS) for k in range(3)]
    whole = log_user_agg(some_logs(spark, 0).union(some_logs(spark, 1)).union(some_logs(spark, 2)), *CUTS)
    for order in ((0, 1, 2), (2, 0, 1)):
        both = merge_partials(parts[order[0]].union(parts[order[1]]))
        assert rows(merge_partials(both.union(parts[order[2]]))) == rows(whole)


def test_whole_units_give_the_same_sums(spark):
    exact = some_logs(spark, 3, 400, "decimal(18,2)")
    got = log_user_agg(exact, *CUTS).select("msno", "total_secs_sum", "r7d_secs_sum", "recent_total_secs_sum")
    want = log_user_agg(exact.withColumn("total_secs", F.col("total_secs").cast("double")), *CUTS).select(*got.columns)
    as_float = lambda df: sorted((str(r[0]), *[None if x is None else float(x) for x in r[1:]]) for r in df.collect())
    assert as_float(got) == as_float(want)


RUN = """
import datetime as dt
from churnlab.sources.log_partials import incremental_log_agg
cuts = (dt.date(2017, 2, 28), dt.date(2017, 2, 1), {{"r7d": dt.date(2017, 2, 22)}})
n = {n}
if n:
    spark.range(n).selectExpr("id % 10 AS msno", "20170101 AS date", "1 AS num_25", "1 AS num_50", "1 AS num_75",
        "1 AS num_985", "1 AS num_100", "1 AS num_unq", "1.0 AS total_secs").coalesce(1).write.parquet({logs!r} + "/f" + str(n))
incremental_log_agg(spark, {logs!r}, {store!r}, *cuts).write.format("noop").mode("overwrite").save()
"""


def test_unchanged_input_reads_no_log_row_and_a_new_file_only_itself(tmp_path):
    logs, store = str(tmp_path / "logs"), str(tmp_path / "store")
    read = []
    for k, n in enumerate((50_000, 3_000, 0)):
        _, rows_in = tasks(tmp_path / f"run{k}", RUN.format(n=n, logs=logs, store=store))
        read.append(max(x for x in rows_in.values()))
    assert read[0] >= 50_000 and 3_000 <= read[1] < 4_000 and read[2] < 100, read
