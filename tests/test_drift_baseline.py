"""Drift against a stored baseline profile, and correlations of many columns, by plain loops."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from churnlab.operators import eda
from churnlab.operators import monitor as MON
from churnlab.plans import catalog
from churnlab.schemas import FEATURE_COLS_V5

SCHEMA = "few double, many double, gone double, new double, never double"


def table(spark, seed, n, shift=0.0, late=False):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, 0.0, 1.0, 2.0 + shift]), rnd.gauss(shift, 1), None if late else 1.0, 3.0 if late else None, None)
            for _ in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def psi_and_ks(base, cur):
    base, cur = sorted(x for x in base if x is not None), sorted(x for x in cur if x is not None)
    if not base or not cur:
        return None, None
    if len(set(base)) <= MON.MAX_CATEGORIES:
        at = lambda v: v
    else:
        edges = np.quantile(base, [i / 10 for i in range(1, 10)])
        at = lambda v: int(np.searchsorted(edges, v, "left"))
    bins = {at(v) for v in base + cur}
    psi = 0.0
    for b in bins:
        p, q = (max(sum(at(v) == b for v in x) / len(x), 1e-6) for x in (base, cur))
        psi += (q - p) * math.log(q / p)
    ks = max(abs(np.searchsorted(base, v, "right") / len(base) - np.searchsorted(cur, v, "right") / len(cur)) for v in base + cur)
    return psi, ks


def test_by_plain_loops_with_columns_without_values(spark, tmp_path):
    base, cur = table(spark, 1, 400), table(spark, 2, 300, 0.7, True)
    path, cols = str(tmp_path / "b"), base.columns
    MON.write_baseline(base, cols, path)
    got = {r.feature: r for r in MON.drift_from_baseline(cur, cols, path).collect()}
    assert set(got) == set(cols)
    for c in cols:
        psi, ks = psi_and_ks([r[c] for r in base.collect()], [r[c] for r in cur.collect()])
        if psi is None:
            assert got[c].psi is got[c].ks is got[c].drifted is None
        else:
            assert abs(got[c].psi - psi) < 1e-6 and abs(got[c].ks - ks) < 1e-9 and got[c].drifted == (psi > 0.2)
    score = MON.drift_score(MON.drift_from_baseline(cur, cols, path)).first()
    assert score.n_cols == 2 and score.status in ("drift", "ok")
    same = MON.drift_score(MON.drift_from_baseline(base, ["few", "many"], path)).first()
    assert same.drift_score == 0 and same.status == "ok"
    none = MON.drift_score(MON.drift_from_baseline(cur.limit(0), cols, path)).first()
    assert none.n_cols == 0 and none.status == "no data"
    again = MON.drift_by_column(base, cur, cols).collect()
    assert sorted(map(str, again)) == sorted(map(str, got.values()))


def test_a_month_reads_only_the_profile_of_the_baseline(spark, tmp_path):
    """Every file that the comparison's plans read is the month's or below the profile."""
    base, cur = str(tmp_path / "base"), str(tmp_path / "cur")
    table(spark, 1, 300).write.parquet(base)
    table(spark, 2, 300).write.parquet(cur)
    path = str(tmp_path / "profile")
    MON.write_baseline(spark.read.parquet(base), ["few", "many"], path)
    import shutil
    shutil.move(base, str(tmp_path / "away"))  # the baseline table is not there any more
    assert MON.drift_from_baseline(spark.read.parquet(cur), ["few", "many"], path).count() == 2


def test_drift_of_all_features(spark):
    got = catalog.QUERIES["drift_by_column"](spark, "/root/testdata/sf0.001").collect()
    assert [r.feature for r in sorted(got)] == sorted(FEATURE_COLS_V5) and len(got) == 47


def test_correlations_by_numpy(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(200, 20))
    x[:, 3] = x[:, 1] * 2 + x[:, 3] / 10
    names = [f"c{i:02d}" for i in range(20)]
    y = (x[:, 3] + x[:, 7] > 0).astype(float)
    rows = [(*map(float, r), 5.0, None, float(t)) for r, t in zip(x, y)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*names, "same", "none", "is_churn"]))
    want = np.corrcoef(x.T)
    got = {(r.a, r.b): r.corr for r in eda.correlation_matrix(df, [*names, "same", "none"], 9).collect()}
    assert len(got) == 22 * 23 // 2
    for i, a in enumerate(names):
        assert got[a, "same"] is None and got[a, "none"] is None
        assert all(abs(got[a, b] - want[i, j]) < 1e-8 for j, b in enumerate(names) if j >= i)
    best = eda.top_correlated(df, [*names, "same", "none"], n=5)
    r = {c: abs(np.corrcoef(x[:, i], y)[0, 1]) for i, c in enumerate(names)}
    assert best == sorted(names, key=lambda c: -r[c])[:5]
    assert eda.top_correlated(df, ["none", "same", "c00"], n=3) == ["c00", "none", "same"]
    empty = eda.correlation_matrix(df.limit(0), names[:2])
    assert [tuple(r) for r in empty.collect()] == [("c00", "c00", None), ("c00", "c01", None), ("c01", "c01", None)]


def test_a_pair_of_rows_is_enough(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "a double, b double")
    got = {(r.a, r.b): r.corr for r in eda.correlation_matrix(df, ["a", "b"]).collect()}
    assert got == {("a", "a"): 1.0, ("a", "b"): -1.0, ("b", "b"): 1.0}
    assert eda.correlation_matrix(df.select(F.col("a")), ["a"]).count() == 1
