import math
import random

import duckdb
import numpy as np
from llm_helpers import rows_of  # noqa: F401

from churnlab.llm import topk as T
from churnlab.llm.catalog import ORACLE

VEC = "vec_id long, embedding array<float>, score int"


def brute(rows, queries, k=10, kind=np.float32):
    ok = lambda v: v and all(x is not None and math.isfinite(x) for x in v)
    whole = lambda x: int(x) * 1024 if abs(x) > 2**60 else math.floor(1024 * x)
    ints = lambda v: [whole(float(kind(x))) for x in v]
    data = [(i, ints(v)) for i, v in rows if i is not None and ok(v)]
    asked = {}
    for i, v in queries:
        if i is not None and ok(v):
            asked[i] = min(asked.get(i, ints(v)), ints(v))
    out = []
    for q, v in asked.items():
        cut = lambda x: max(-(2**63) + 1, min(2**63 - 1, x))
        s = sorted((-cut(sum(a * b for a, b in zip(v, w))), i) for i, w in data if i != q and len(w) == len(v))[:k]
        out += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s)]
    return sorted(out)


def run(spark, rows, queries, **kw):
    make = lambda r: spark.createDataFrame([(*x, 1) for x in r], VEC)
    return rows_of(T.search(make(rows), make(queries), **kw)), make(rows)


def test_by_brute_force_with_ties_and_odd_rows(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([-0.5, 0.0, 0.25, rnd.random()]) for _ in range(6)]) for i in range(150)]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [math.nan] * 6), (203, [math.inf] * 6), (204, []),
             (None, [1.0] * 6), (205, [1.0, 2.0]), (206, [2.0, 2.0]), (207, [3.0]), rows[7], rows[7], (7, [9.0] * 6)]
    queries = [r for r in rows if r[0] is not None and r[0] % 5 == 0] + [rows[7], (7, [9.0] * 6), (205, [1.0, 2.0])]
    want = sorted(brute(rows, queries), key=str)
    for kw in ({}, {"tile": 7, "query_tile": 3, "fan": 2}):
        assert run(spark, rows, queries, **kw)[0] == want


def test_scores_beyond_float_precision(spark):
    rows = [(i, [1e6 + i / 16, -2e5, 1.5e5]) for i in range(30)] + [(98, [1e-3, 0.0, 0.0]), (99, [3e38, 3e38, 3e38])]
    got, _ = run(spark, rows, rows[:3], k=4)
    assert got == sorted(brute(rows, rows[:3], 4), key=str)


def test_components_whose_multiple_exceeds_every_float(spark):
    rows = [(i, [1.7e308 * (i % 3 - 1), 1e306, 0.5 * i]) for i in range(20)] + [(30, [0.0, 0.0, 3.0])]
    make = lambda r: spark.createDataFrame(r, "vec_id long, embedding array<double>")
    got = rows_of(T.search(make(rows), make(rows[:4] + rows[-1:]), k=5))
    assert got == sorted(brute(rows, rows[:4] + rows[-1:], 5, float), key=str)


def test_a_grid_of_many_cells(spark, monkeypatch):
    rnd = random.Random(9)
    rows = [(i, [rnd.random() for _ in range(4)]) for i in range(120)]
    monkeypatch.setattr(T, "SHARD_TILES", 2)
    monkeypatch.setattr(T, "BLOCK_TILES", 2)
    assert run(spark, rows, rows[::3], tile=5, query_tile=3)[0] == sorted(brute(rows, rows[::3]), key=str)


def test_fewer_than_k_and_empty(spark):
    rows = [(0, [1.0]), (1, [0.5])]
    assert run(spark, rows, rows)[0] == [(0, 1, 1, 524288), (1, 1, 0, 524288)]
    assert run(spark, rows[:1], rows[:1])[0] == [] and run(spark, [], [])[0] == [] and run(spark, rows, [])[0] == []


def test_sql_twin_agrees(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(8)]) for i in range(250)] + [(300, None), (400, [math.nan] * 8)]
    queries = [r for r in rows if r[0] % 100 == 0]
    got, df = run(spark, rows, queries)
    df.write.parquet(str(tmp_path / "e"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/e/*.parquet'")
    assert sorted(con.sql(ORACLE["op2_exact_topk"]).fetchall(), key=str) == got
