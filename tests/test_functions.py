import random

import pytest
from pyspark.sql import functions as F

from churnlab.functions import columns as C


def test_cut_right_closed_and_out_of_range(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 0.5, 18.0, 18.5, 100.0, 101.0, None]], "x double")
    got = df.select("x", C.cut("x", [0, 18, 25, 35, 45, 55, 100],
                               ["<18", "18-25", "25-35", "35-45", "45-55", "55+"]).alias("b")).collect()
    m = {r.x: r.b for r in got}
    assert m[0.0] is None            # left edge open
    assert m[0.5] == "<18" and m[18.0] == "<18" and m[18.5] == "18-25"
    assert m[100.0] == "55+" and m[101.0] is None and m[None] is None
    lowest = df.select(C.cut("x", [0, 18], ["a"], include_lowest=True).alias("b")).where("x = 0").first().b
    assert lowest == "a"


def test_clip_keeps_null_and_bounds(spark):
    df = spark.createDataFrame([(9.22e15,), (-9.22e15,), (100.0,), (None,)], "x double")
    got = [r.c for r in df.select(C.clip("x", 0, 86400).alias("c")).collect()]
    assert got == [86400.0, 0.0, 100.0, None]


def test_safe_ratio_and_row_sum(spark):
    df = spark.createDataFrame([(1, 0), (3, 2), (None, 2)], "n int, d int")
    got = [r.r for r in df.select(C.safe_ratio("n", "d").alias("r")).collect()]
    assert got == [None, 1.5, None]
    s = spark.createDataFrame([(1, None, 3)], "a int, b int, c int").select(C.row_sum("a", "b", "c").alias("s"))
    assert s.first().s == 4


def test_parse_yyyymmdd_coerce_and_strict(spark):
    df = spark.createDataFrame([(20170228,), (20170231,), (None,)], "d int")
    got = [r.x for r in df.select(C.parse_yyyymmdd("d").alias("x")).collect()]
    assert str(got[0]) == "2017-02-28" and got[1] is None and got[2] is None
    with pytest.raises(Exception):
        df.select(C.parse_yyyymmdd("d", strict=True)).collect()


def test_label_at_threshold_inclusive_and_bands(spark):
    df = spark.createDataFrame([(0.5,), (0.4999,), (0.29,), (0.3,)], "p double")
    got = df.select(C.label_at("p").alias("l"), C.risk_band("p").alias("b")).collect()
    assert [r.l for r in got] == [1, 0, 0, 0]
    assert [r.b for r in got] == ["high", "medium", "low", "medium"]


def test_desc_text_key_reverses_text_order(spark):
    rnd = random.Random(7)
    vals = list({"".join(rnd.choice("0123456789.") for _ in range(rnd.randint(1, 7))) for _ in range(300)})
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.s for r in df.orderBy(C.desc_text_key("s")).collect()]
    assert got == sorted(vals, reverse=True)
