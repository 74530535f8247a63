import math
import random

import duckdb
import numpy as np
import pytest
from llm_helpers import rows_of

from churnlab.llm import hardneg as H
from churnlab.llm.catalog import ORACLE, QUERIES

VEC = "vec_id long, label int, embedding array<double>, score int, tile int"


def brute(rows, anchors, pos=5, neg=3, low=50, high=95):
    ok = lambda r: r[0] is not None and r[1] is not None and r[2] and all(
        x is not None and math.isfinite(x) for x in r[2])
    whole = lambda x: int(x) * 256 if abs(x) >= 2.0**53 else math.floor(x * 256)
    data = [(i, label, [whole(x) for x in v]) for i, label, v in filter(ok, rows)]
    one = {}
    for i, label, v in filter(ok, anchors):
        one[i] = min(one.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in one.items():
        v = [whole(x) for x in v]
        cut = lambda s: max(-(2**63) + 1, min(2**63 - 1, s))
        scored = sorted((-cut(sum(x * y for x, y in zip(v, w))), i, other) for i, other, w in data
                        if i != a and len(w) == len(v))
        best = [(-s, i) for s, i, other in scored if other == label][:pos]
        for place, (ps, p) in enumerate(best, 1):
            hits = [(-s, i) for s, i, other in scored if other != label and low * ps <= 100 * -s <= high * ps][:neg]
            out += [(a, place, p, ps, rank, n, s) for rank, (s, n) in enumerate(hits, 1)]
    return sorted(out, key=str)


def mined(spark, rows, anchors, **kw):
    make = lambda r: spark.createDataFrame([(*x, 1, 2) for x in r], VEC)
    return rows_of(H.mine(make(rows), make(anchors), **kw))


def test_by_brute_force_with_ties_odd_rows_and_a_hot_label(spark):
    rnd = random.Random(3)
    vec = lambda: [rnd.choice([0.5, 0.25, 0.0, rnd.random()]) for _ in range(5)]
    rows = [(i, 0 if i % 3 == 0 else rnd.randrange(8), vec()) for i in range(220)]
    rows += [(300, None, vec()), (301, 1, None), (302, 1, []), (303, 1, [math.nan] * 5), (304, 1, [0.0, None, 0.0, 0.0, 0.0]),
             (305, 1, [math.inf] * 5), (None, 1, vec()), (306, 1, [1.0, 2.0]), (310, 2, [2.0, 1.0]), (311, 1, [1.0, 1.9]),
             rows[6], (10, 3, vec()), (320, -7, vec()), (330, 10**9, vec())]
    anchors = [r for r in rows if r[0] is not None and r[0] % 10 == 0] + [(306, 1, [1.0, 2.0])]
    want = brute(rows, anchors)
    assert len(want) > 100
    for kw in ({}, {"tile": 7, "anchor_tile": 3, "fan": 2}):
        assert mined(spark, rows, anchors, **kw) == want
    assert mined(spark, rows, anchors, positives=2, negatives=1, low=10, high=90) == brute(rows, anchors, 2, 1, 10, 90)


def test_scores_beyond_a_long_and_beyond_floats(spark):
    rows = [(i, i % 2, [1e9 + i / 16, 2.0**60 * (i % 5), -1e300 * (i == 7), 1.7e308 * (i == 8)]) for i in range(24)]
    assert mined(spark, rows, rows[:10]) == brute(rows, rows[:10])


def test_empty_tables(spark):
    rows = [(0, 1, [1.0]), (1, 1, [0.5]), (2, 2, [0.7])]
    assert mined(spark, rows, rows) == brute(rows, rows) != []
    assert mined(spark, [], []) == mined(spark, rows, []) == mined(spark, [], rows) == []


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (33, 64, 41), (64, 64, 64), (70, 130, 90), (0, 4, 3)])
def test_strassen(shape):
    rnd = np.random.default_rng(sum(shape))
    m, k, n = shape
    for most in (10, 2**27, 2**62):
        a, b = rnd.integers(-most, most, (m, k)), rnd.integers(-most, most, (k, n))
        exact = a.astype(object) @ b.astype(object) if k else np.zeros((m, n), object)
        assert (H.strassen(a.astype(object), b.astype(object), 8) == exact).all()
        with np.errstate(over="ignore"):
            assert (H.strassen(a, b, 8) == np.vectorize(lambda x: (x + 2**63) % 2**64 - 2**63, otypes=[object])(
                exact)).all() if m else True


def test_windows_are_exact_at_the_ends_of_a_long():
    for s in (0, 1, 99, 100, 101, 12345, -1, -100, -12345, 2**63 - 1, -(2**63) + 1):
        lo, hi = H.windows(np.array([s], np.int64), 50, 95)
        assert int(lo[0]) == -(-50 * s // 100) and int(hi[0]) == 95 * s // 100


def test_sql_twin_agrees(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, rnd.randrange(4), [rnd.uniform(0, 1) for _ in range(6)]) for i in range(400)] + [(450, None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = rows_of(QUERIES["op12_hard_negatives"](spark, str(tmp_path)))
    assert got and got == sorted(con.sql(ORACLE["op12_hard_negatives"]).fetchall(), key=str)
