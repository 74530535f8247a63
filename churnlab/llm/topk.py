"""Exact top-k search by tiled matrix products.

Vectors are packed into tiles of bounded size, the queries likewise, and quantised to integers when they meet. Shards
are groups of a few tiles, blocks groups of a few query tiles; each (shard, block) cell of the grid is dealt by itself,
so no task reads all vectors or all queries. A task multiplies one query tile with one tile of the cell, selects each
query's best k there by partial selection, and passes on only those. The lists are merged in a tree: each step joins a
bounded number of lists of one query, so no task ever holds all lists of a query.

Scores are exact integers: products run in float64 only where every partial sum stays below 2^53, else in Python
integers, also where a component times ``SCALE`` exceeds every float. Scores beyond a long are cut to its ends.

Defined results: vectors that are null or empty, hold a null, NaN or infinite component, or have no id take no part.
A query meets vectors of its own length only. Ties go to the smaller vec_id. A row that repeats an id is a candidate
like any other, but never for the query of its own id; if a query id is repeated, its smallest vector (compared
component by component) is the query. With fewer candidates than k all are returned; a query without any has no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import cells, configure, map_batches, written

SCALE, K = 1024, 10
#: Rows of a tile of vectors and of queries, tiles of a shard and of a block, lists merged at once.
TILE, QUERY_TILE, SHARD_TILES, BLOCK_TILES, FAN = 2048, 512, 16, 16, 16
_EXACT = float(2**53)


def usable(vec: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    return vec.isNotNull() & (F.size(vec) > 0) & F.forall(vec, finite)


def _tiles(vectors: DataFrame, rows: int) -> DataFrame:
    """(dim, tile, n, ids, vecs): packed int64 ids and raw float64 components, ``rows`` vectors at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held: dict[int, tuple[list, list]] = {}

        def tile(dim: int) -> pa.RecordBatch:
            nonlocal made
            ids, vecs = held.pop(dim)
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([(part << 32) + made]), pa.array([len(ids)], pa.int32()),
                 pa.array([np.array(ids, np.int64).tobytes()]), pa.array([np.stack(vecs).tobytes()])],
                ["dim", "tile", "n", "ids", "vecs"])
        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1)):
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                ids, vecs = held.setdefault(len(x), ([], []))
                ids.append(i)
                vecs.append(x)
                if len(ids) == rows:
                    yield tile(len(x))
        for dim in list(held):
            yield tile(dim)
    return vectors.mapInArrow(run, "dim int, tile long, n int, ids binary, vecs binary")


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products, as int64, of the rows of two float64 matrices, each component x being floor(SCALE * x)."""
    most = (float(np.abs(q).max(initial=0)) * SCALE + 1) * (float(np.abs(v).max(initial=0)) * SCALE + 1) * q.shape[1]
    if most < _EXACT:
        return (np.floor(q * SCALE) @ np.floor(v * SCALE).T).astype(np.int64)
    whole = lambda x: int(x) * SCALE if abs(x) >= _EXACT else math.floor(x * SCALE)
    ints = lambda m: np.array([[whole(x) for x in r] for r in m.tolist()], object)
    exact = ints(q) @ ints(v).T
    return np.clip(exact, -(2**63) + 1, 2**63 - 1).astype(np.int64)


def best_of(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (score, id) of one query in a tile: partial selection, then ties at the border by id."""
    live = np.nonzero(ids != own)[0]
    s, i = scores[live], ids[live]
    if len(s) > k:
        border = np.partition(s, len(s) - k)[len(s) - k]
        s, i = s[(keep := s >= border)], i[keep]
    order = np.lexsort((i, -s))[:k]
    return s[order], i[order]


def _pair_lists(b: pa.RecordBatch, k: int) -> pa.RecordBatch:
    out_q, out_t, sizes, out_s, out_i = [], [], [], [], []
    for dim, tile, qi, qv, vi, vv in zip(*(c.to_pylist() for c in b.columns)):
        qids, ids = np.frombuffer(qi, np.int64), np.frombuffer(vi, np.int64)
        scores = products(np.frombuffer(qv).reshape(-1, dim), np.frombuffer(vv).reshape(-1, dim))
        for own, row in zip(qids, scores):
            s, i = best_of(row, ids, own, k)
            if len(s):
                out_q.append(own)
                out_t.append(tile)
                sizes.append(len(s))
                out_s.append(s)
                out_i.append(i)
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    flat = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
    entry = pa.StructArray.from_arrays([pa.array(-flat(out_s)), pa.array(flat(out_i))], ["worse", "vec_id"])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.array(out_q, np.int64)), pa.array(np.array(out_t, np.int64)),
         pa.ListArray.from_arrays(pa.array(ends), entry)], ["query_id", "grp", "best"])


def search(vectors: DataFrame, queries: DataFrame, k: int = K, tile: int = TILE, query_tile: int = QUERY_TILE,
           fan: int = FAN) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for each row of ``queries`` (vec_id, embedding)."""
    spark = configure(vectors.sparkSession)
    ready = lambda d: d.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull() & usable(F.col("v"))).withColumn("vec_id", F.col("vec_id").cast("long"))
    data = written(_tiles(ready(vectors), tile), "topk-tiles")
    n = max(1, data.count())
    one = ready(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = written(_tiles(one, query_tile), "topk-queries")
    shards, blocks = cells(n, SHARD_TILES, spark.sparkContext.defaultParallelism), cells(asked.count(), BLOCK_TILES, 1)
    deal = lambda count: F.pmod(F.xxhash64("tile"), F.lit(count)).cast("int")
    spread = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    asked = asked.select("dim", deal(blocks).alias("block"), F.col("ids").alias("qids"), F.col("vecs").alias("qvecs"),
                         spread(shards).alias("shard"))
    held = data.select("dim", deal(shards).alias("shard"), "tile", "ids", "vecs", spread(blocks).alias("block"))
    pairs = held.join(asked, ["dim", "shard", "block"]).select("dim", "tile", "qids", "qvecs", "ids", "vecs")
    lists = map_batches(pairs, lambda b: _pair_lists(b, k),
                        "query_id long, grp long, best array<struct<worse:long,vec_id:long>>")
    groups = -(-n // fan)
    lists = lists.withColumn("grp", F.pmod(F.xxhash64("grp"), F.lit(groups)))
    while True:
        lists = lists.groupBy("query_id", "grp").agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
        if groups == 1:
            break
        groups = -(-groups // fan)
        lists = lists.withColumn("grp", F.pmod("grp", F.lit(groups)))
    return lists.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"),
        (-F.col("b.worse")).alias("score"))
