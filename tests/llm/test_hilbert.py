import itertools
import random
import zlib

import pytest
from llm_helpers import make_docs, sentence  # noqa: F401
from pyspark.sql import functions as F

from churnlab.llm import hilbert as H


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_once_step_by_step(spark, dims, bits):
    cells = list(itertools.product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame(cells, ", ".join(f"c{i} int" for i in range(dims)))
    rows = df.withColumn("h", H.curve_index([F.col(f"c{i}") for i in range(dims)], bits)).collect()
    path = [r[:-1] for r in sorted(rows, key=lambda r: r.h)]
    assert sorted(r.h for r in rows) == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


def docs_of(n, seed=1):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["en", "en", "en", "de", None]), f"s{rnd.choice([0, 0, 0, 1, 2, 30])}",
             sentence(rnd, rnd.choice([0, 3, 50]))) for i in range(n)]
    rows += [(None, None, None, None), (5, "en", "s0", None), *rows[2:3] * 2, (n, "fr", "s9", "é" * 90_000)]
    return [(i, t, g, s, None if t is None else len(t)) for i, g, s, t in rows]


def shards_of(spark, rows, shards=H.SHARDS, extra=("'a' AS slot_", "1 AS rank", "2 AS run")):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    path = H.write_runs(df.selectExpr("*", *extra), ["lang", "source", "n_chars"], [F.crc32(F.col("text").cast("binary")),
                                                                                    "doc_id"])
    return H.read_shards(spark.read.parquet(path), shards)


@pytest.mark.parametrize("n", [400, 3])
def test_every_row_once_in_equal_gapless_shards(spark, n):
    rows = docs_of(n)
    out = shards_of(spark, rows).collect()
    assert sorted(map(str, rows)) == sorted(str((r.doc_id, r.text, r.lang, r.source, r.n_chars)) for r in out)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by.get(s, [])) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1 and set(by) <= set(range(16))
    # equal texts with equal metadata stand next to each other on the curve
    order = sorted(out, key=lambda r: (r.shard, r.slot))
    at = [k for k, r in enumerate(order) if r.doc_id == 2]
    assert at == list(range(at[0], at[0] + len(at)))
    key = [(r._hc_index, -1 if r.text is None else zlib.crc32(r.text.encode()), -1 if r.doc_id is None else r.doc_id)
           for r in order]
    assert key == sorted(key)


def test_manifest_prunes_without_losing_rows(spark):
    shards = shards_of(spark, docs_of(600), 8)
    dims = ["lang", "source", "n_chars"]
    pieces = H.manifest(shards, dims)
    assert pieces.agg(F.sum("rows")).first()[0] == shards.count()
    want = {"source": ("s2", "s2"), "n_chars": (1, 400)}
    left = {(r.shard, r.run) for r in H.pieces_with(pieces, **want).collect()}
    hold = {(r.shard, r._hc_run) for r in shards.where("source = 's2' AND n_chars BETWEEN 1 AND 400").collect()}
    assert hold <= left and len(left) < pieces.count()


def test_cells_are_equally_deep(spark):
    df = spark.range(1000).selectExpr("id * id AS v", "CAST(NULL AS string) AS w", "-id AS u")
    bounds = H.cell_bounds(df, ["v", "w", "u"], bits=2)
    assert [c for _, c in bounds["v"]] == [1, 2, 3] and bounds["w"] == []
    for d in ("v", "u"):
        cell = H._cell(H._sortable(df, d), bounds[d])
        assert [r["count"] for r in df.groupBy(cell.alias("c")).count().collect()] == [250] * 4


def test_native_and_empty(spark):
    out = shards_of(spark, docs_of(0)[:0])
    assert out.count() == 0
    plan = shards_of(spark, docs_of(20))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
