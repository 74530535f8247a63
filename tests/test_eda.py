from churnlab.operators import eda


def test_value_counts_null_bucket_and_topn(spark):
    df = spark.createDataFrame([("m",), ("m",), ("f",), (None,)], "g string")
    got = {r.g: (r.n, r.share) for r in eda.value_counts(df, "g", dropna=False).collect()}
    assert got == {"m": (2, 0.5), "f": (1, 0.25), None: (1, 0.25)}
    top = eda.value_counts(df, "g", n=1).collect()
    assert [(r.g, r.n) for r in top] == [("m", 2)]


def test_rate_by_min_n_and_lift(spark):
    rows = [("a", 1), ("a", 0), ("a", 1), ("b", 0), (None, 1)]
    df = spark.createDataFrame(rows, "k string, is_churn int")
    got = {r.k: r for r in eda.rate_by(df, "k", min_n=2).collect()}
    assert set(got) == {"a"}                       # b below min_n, NULL key dropped
    assert got["a"].churn_rate == round(2 / 3, 6) and got["a"].lift == round((2 / 3) / 0.5, 6)


def test_crosstab_fills_zero(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 0)], "x int, is_churn int")
    got = {r.x: r for r in eda.crosstab_pct(df, "x").collect()}
    assert got[1].n_0 == 0 and got[1].pct_1 == 1.0 and got[0].n_1 == 0


def test_histogram_max_in_last_bin_and_density(spark):
    df = spark.createDataFrame([(float(v), v % 2) for v in range(11)], "x double, is_churn long")
    h = eda.histogram(df, "x", bins=5, density=True).collect()
    assert sum(r.n for r in h) == 11
    last = [r for r in h if r.bin == 4][0]
    assert last.n == 3 and last.bin_hi == 10.0    # 8, 9 and the maximum 10
    assert abs(sum(r.density * 2.0 for r in h) - 1.0) < 1e-6
    const = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [(r.bin, r.n) for r in eda.histogram(const, "x", bins=3).collect()] == [(0, 2)]


def test_bucket_counts_drop_outside(spark):
    df = spark.createDataFrame([(0.0, 1), (5.0, 0), (400.0, 1), (None, 1)], "d double, is_churn int")
    got = {r.bucket: r.n for r in eda.bucket_counts(df, "d", [0, 7, 365], ["<1w", "rest"], upper_clip=365).collect()}
    assert got == {"<1w": 1, "rest": 1}           # 0 is outside (open left edge), NULL dropped, 400 clipped


def test_key_sets_and_coverage(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",)], "msno string")
    b = spark.createDataFrame([("y",), ("z",)], "msno string")
    assert [r.msno for r in eda.key_intersect(a, b).collect()] == ["y"]
    assert [r.msno for r in eda.key_except(a, b).collect()] == ["x"]
    ov = eda.user_overlap(a, b).first()
    assert (ov.n_a, ov.n_b, ov.n_both) == (2, 2, 1)
    cov = eda.key_coverage(a, {"b": b}).first()
    assert cov.n_present == 1 and cov.coverage == 0.5


def test_profile_and_describe(spark):
    df = spark.createDataFrame([("u", 1.0, None), ("v", 3.0, 2)], "msno string, x double, y int")
    p = eda.dataset_profile(df, "msno").first()
    assert (p.n_rows, p.n_cols, p.n_null_cells, p.n_keys) == (2, 3, 1, 2)
    d = {r.column: r for r in eda.describe(df, ["x"]).collect()}
    assert d["x"].mean == 2.0 and d["x"].p50 == 2.0 and d["x"].p25 == 1.5 and d["x"].std == round(2 ** 0.5, 4)


def test_trim_and_winsorize(spark):
    df = spark.createDataFrame([(float(v),) for v in range(101)], "x double")
    assert eda.trim_quantiles(df, "x", 0.01, 0.99).count() == 99
    w = eda.winsorize(df, "x", 0.9).agg({"x": "max"}).first()[0]
    assert w == 90.0
    c = eda.winsorize(df, "x", cap=50).agg({"x": "max"}).first()[0]
    assert c == 50.0
