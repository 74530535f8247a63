"""Hard-negative mining by Strassen products of anchor tiles and candidate tiles.

Rows are packed into tiles of one label and one vector length, anchors likewise. A grid deals them out: candidate tiles
to shards, anchor tiles to blocks, and a task multiplies the tiles of one (shard, block) cell, so neither side is ever
read whole by one task. Products run by Strassen's recursion on int64 tiles: odd sides are padded with zeros, the
seven half-size products are combined by exact integer additions, and the leaves are plain products (through float64
where every partial sum stays below 2^53, else int64). Wrapping in between is harmless, as sums modulo 2^64 are exact
once the result fits; where it might not fit, the same recursion runs on Python integers.

Two passes share the work of one: positives meet tiles of the anchor's own label only, negatives all the others.
Each tile keeps a bounded heap per anchor (first pass: its best positives) or per anchor and positive (second pass:
the best negatives inside that positive's score window). Heaps are merged in a tree, a bounded number at a time.

Defined results: rows without an id or a label, and vectors that are null or empty or hold a null or non-finite
component take no part. Anchors meet vectors of their own length. If an anchor's id is repeated, its smallest (label,
vector) is the anchor; rows of an anchor's own id are neither its positives nor its negatives; other repeated rows each
count. Ties go to the smaller vec_id. Scores beyond a long are cut to its ends. Anchors without positives, and
positives without a negative in their window, have no row. Other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import cells, configure, map_batches, written
from churnlab.llm.topk import usable

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 3, 50, 95
#: Rows of a candidate tile and an anchor tile; tiles of a cell's sides; heaps merged at once; smallest side split on.
TILE, ANCHOR_TILE, SHARD_TILES, BLOCK_TILES, FAN, LEAF = 1024, 512, 32, 16, 16, 32
#: Rows held in half-filled tiles of a task before they go out as small ones (there may be many labels).
HELD = 16_384
_FLOAT, _LONG = 2**53, 2**63


def quantised(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), exactly: int64, or Python integers where that could overflow."""
    if np.abs(x).max(initial=0.0) < _FLOAT:
        return np.floor(x * scale).astype(np.int64)
    whole = lambda c: int(c) * scale if abs(c) >= _FLOAT else math.floor(c * scale)
    return np.array([[whole(c) for c in row] for row in x.tolist()], object).reshape(x.shape)


def _most(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def _padded(x: np.ndarray, rows: int, cols: int) -> np.ndarray:
    out = np.zeros((rows, cols), x.dtype)  # plain zeros also among Python integers
    out[:x.shape[0], :x.shape[1]] = x
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two integer matrices: int64 modulo 2^64, or exact Python integers for object arrays."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        if a.dtype != object and _most(a) * _most(b) * k < _FLOAT:
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a, b = _padded(a, m + m % 2, k + k % 2), _padded(b, k + k % 2, n + n % 2)
    i, j, h = a.shape[0] // 2, b.shape[1] // 2, a.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :h], a[:i, h:], a[i:, :h], a[i:, h:]
    b11, b12, b21, b22 = b[:h, :j], b[:h, j:], b[h:, :j], b[h:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    return np.block([[p1 + p4 - p5 + p7, p3 + p5], [p2 + p4, p1 - p2 + p3 + p6]])[:m, :n]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products (int64, cut to a long) of the rows of two raw float64 matrices, once quantised."""
    a, b = quantised(a), quantised(b)
    if a.dtype == object or b.dtype == object or _most(a) * _most(b) * a.shape[1] >= _LONG:
        exact = strassen(a.astype(object), b.astype(object).T)
        return np.clip(exact, -_LONG + 1, _LONG - 1).astype(np.int64)
    return strassen(a, np.ascontiguousarray(b.T))


def heaps(key: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best (score descending, id ascending) entries of each key, ordered by key and place."""
    order = np.lexsort((ids, -score, key))
    key, score, ids = key[order], score[order], ids[order]
    first = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    begin = np.nonzero(first)[0]
    place = np.arange(len(key)) - np.repeat(begin, np.diff(np.r_[begin, len(key)]))
    return key[place < k], score[place < k], ids[place < k]


def row_heaps(scores: np.ndarray, live: np.ndarray, ids: np.ndarray, k: int):
    """``heaps`` of each row of a matrix over its ``live`` cells; partial selection first, then ties by id."""
    least = np.iinfo(np.int64).min
    masked = np.where(live, scores, least)
    if masked.shape[1] > k:
        border = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
        live = live & (masked >= border[:, None])
    row, col = np.nonzero(live)
    return heaps(row, scores[row, col], ids[col], k)


def _tiles(rows: DataFrame, size: int, heap: int = 0) -> DataFrame:
    """(dim, label, tile, ids, vecs): int64 ids and raw float64 components of at most ``size`` rows of one label.

    With ``heap``, each row's list ``best`` of (worse, vec_id) goes along as two int64 matrices of that width, padded,
    and its length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, open_rows = TaskContext.get().partitionId(), 0, 0
        held: dict[tuple[int, int], list[tuple]] = {}

        def tile(key: tuple[int, int]) -> pa.RecordBatch:
            nonlocal made, open_rows
            got = held.pop(key)
            made, open_rows = made + 1, open_rows - len(got)
            cols = [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([(part << 32) + made]),
                    pa.array([np.array([r[0] for r in got], np.int64).tobytes()]),
                    pa.array([np.stack([r[1] for r in got]).tobytes()])]
            names = ["dim", "label", "tile", "ids", "vecs"]
            if heap:
                lists = np.zeros((2, len(got), heap), np.int64)
                for at, r in enumerate(got):
                    lists[0, at, :len(r[2])] = [-x["worse"] for x in r[2]]
                    lists[1, at, :len(r[2])] = [x["vec_id"] for x in r[2]]
                cols += [pa.array([lists.tobytes()]), pa.array([np.array([len(r[2]) for r in got], np.int64).tobytes()])]
                names += ["lists", "sizes"]
            return pa.RecordBatch.from_arrays(cols, names)
        for b in batches:
            best = b.column(3).to_pylist() if heap else [None] * b.num_rows
            for i, label, v, more in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), best):
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                got = held.setdefault((len(x), label), [])
                got.append((i, x, more))
                open_rows += 1
                if len(got) == size:
                    yield tile((len(x), label))
            if open_rows > HELD:
                yield from [tile(key) for key in list(held)]
        yield from [tile(key) for key in list(held)]
    cols = ["vec_id", "label", "v"] + ["best"] * bool(heap)
    return rows.select(*cols).mapInArrow(
        run, "dim int, label long, tile long, ids binary, vecs binary" + ", lists binary, sizes binary" * bool(heap))


_ENTRY = "best array<struct<worse:long,vec_id:long>>"


def _lists(names: list[str], keys: list[np.ndarray], key: np.ndarray, score: np.ndarray, ids: np.ndarray):
    """A record batch with one list an entry of ``keys``; ``key`` numbers those entries in order."""
    sizes = np.bincount(key, minlength=len(keys[0])) if len(keys[0]) else np.empty(0, np.int64)
    used = np.nonzero(sizes)[0]
    ends = np.r_[0, np.cumsum(sizes[used])].astype(np.int32)
    entry = pa.StructArray.from_arrays([pa.array(-score), pa.array(ids)], ["worse", "vec_id"])
    return pa.RecordBatch.from_arrays([*(pa.array(x[used]) for x in keys), pa.ListArray.from_arrays(pa.array(ends), entry)],
                                      [*names, "best"])


def _merged_in_batch(parts: list[tuple], names: list[str], grp: int, k: int) -> pa.RecordBatch | None:
    """Merges the heaps of a batch's tile pairs; parts hold (key columns, score, id) of flat heap entries."""
    if not parts:
        return None
    cols = [np.concatenate([p[0][c] for p in parts]) for c in range(len(names) - 1)]
    score, ids = (np.concatenate([p[c] for p in parts]) for c in (1, 2))
    if not len(score):
        return None
    keys, number = np.unique(np.stack(cols, 1), axis=0, return_inverse=True)
    key, score, ids = heaps(number.ravel(), score, ids, k)
    return _lists(names, [*keys.T, np.full(len(keys), grp, np.int64)], key, score, ids)


def _positive_lists(b: pa.RecordBatch, k: int) -> pa.RecordBatch | None:
    parts, grp = [], 0
    for dim, tile, ai, av, ci, cv in zip(*(c.to_pylist() for c in b.columns)):
        anchors, ids, grp = np.frombuffer(ai, np.int64), np.frombuffer(ci, np.int64), tile
        scores = products(np.frombuffer(av).reshape(-1, dim), np.frombuffer(cv).reshape(-1, dim))
        row, s, i = row_heaps(scores, anchors[:, None] != ids[None, :], ids, k)
        parts.append(([anchors[row]], s, i))
    return _merged_in_batch(parts, ["anchor_id", "grp"], grp, k)


def windows(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest whole numbers n with low * score <= 100 * n <= high * score, without overflow."""
    q, r = score // 100, score % 100
    return low * q - (-low * r) // 100, high * q + high * r // 100


def _negative_lists(b: pa.RecordBatch, k: int, width: int, low: int, high: int) -> pa.RecordBatch | None:
    parts, grp = [], 0
    for dim, tile, ai, av, lists, sizes, ci, cv in zip(*(c.to_pylist() for c in b.columns)):
        anchors, ids, grp = np.frombuffer(ai, np.int64), np.frombuffer(ci, np.int64), tile
        best, sizes = np.frombuffer(lists, np.int64).reshape(2, -1, width), np.frombuffer(sizes, np.int64)
        scores = products(np.frombuffer(av).reshape(-1, dim), np.frombuffer(cv).reshape(-1, dim))
        other = anchors[:, None] != ids[None, :]
        lo, hi = windows(best[0], low, high)
        for place in range(width):
            have = np.nonzero((sizes > place) & (lo[:, place] <= hi[:, place]))[0]
            if len(have):
                s = scores[have]
                live = other[have] & (s >= lo[have, place, None]) & (s <= hi[have, place, None])
                row, top, i = row_heaps(s, live, ids, k)
                row = have[row]
                parts.append(([anchors[row], np.full(len(row), place), best[1, row, place], best[0, row, place]], top, i))
    return _merged_in_batch(parts, ["anchor_id", "place", "positive_id", "positive_score", "grp"], grp, k)


def _tree(lists: DataFrame, keys: list[str], k: int, groups: int, fan: int) -> DataFrame:
    """One heap a key: each step merges the heaps of a key in a bounded group of about ``fan``."""
    groups = max(1, -(-groups // fan))
    lists = lists.withColumn("grp", F.pmod(F.xxhash64("grp"), F.lit(groups)))
    while True:
        lists = lists.groupBy(*keys, "grp").agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
        if groups == 1:
            return lists.drop("grp")
        groups = -(-groups // fan)
        lists = lists.withColumn("grp", F.pmod("grp", F.lit(groups)))


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, tile: int = TILE, anchor_tile: int = ANCHOR_TILE, fan: int = FAN) -> DataFrame:
    """(anchor_id, place, positive_id, positive_score, rank, negative_id, negative_score).

    ``vectors`` and ``anchors`` have vec_id, label and embedding; ``place`` numbers an anchor's positives from 1. A
    negative has another label and low * positive_score <= 100 * its score <= high * positive_score.
    """
    spark = configure(vectors.sparkSession)
    ready = lambda d: d.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    one = written(ready(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select(
        "vec_id", "r.label", "r.v"), "hardneg-anchors")
    data = written(_tiles(ready(vectors), tile), "hardneg-tiles")
    n = max(1, data.count())
    blocks = cells(max(1, -(-one.count() // anchor_tile)), BLOCK_TILES, 1)
    deal = lambda c, count: F.pmod(F.xxhash64(c), count).cast("int")
    spread = lambda count, name: F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))).alias(name)
    width = spark.sparkContext.defaultParallelism
    cand = ["ids", "vecs"]
    ask = lambda t: [F.col(c).alias(f"a_{c}") for c in t.columns if c not in ("dim", "label", "tile")]

    # First pass: tiles of the anchor's label, as many shards a label as its tiles need.
    per = data.groupBy("dim", "label").agg(F.count(F.lit(1)).alias("tiles")).select(
        "dim", "label", F.greatest(F.ceil(F.col("tiles") / SHARD_TILES),
                                   F.least("tiles", F.ceil(F.col("tiles") * width / n))).cast("int").alias("shards"))
    asked = _tiles(one, anchor_tile)
    left = data.join(per, ["dim", "label"]).select(
        "dim", "label", deal("tile", F.col("shards")).alias("shard"), spread(F.lit(blocks), "block"), "tile", *cand)
    right = asked.join(per, ["dim", "label"]).select(
        "dim", "label", spread(F.col("shards"), "shard"), deal("tile", F.lit(blocks)).alias("block"), *ask(asked))
    pairs = left.join(right, ["dim", "label", "shard", "block"]).select("dim", "tile", "a_ids", "a_vecs", *cand)
    lists = map_batches(pairs, lambda b: _positive_lists(b, positives), f"anchor_id long, grp long, {_ENTRY}")
    found = _tree(lists, ["anchor_id"], positives, n, fan)

    # Second pass: all other labels, with each anchor's positives beside it.
    joined = one.join(found, F.col("anchor_id") == F.col("vec_id")).select("vec_id", "label", "v", "best")
    asked = written(_tiles(joined, anchor_tile, positives), "hardneg-windows")
    shards = cells(n, SHARD_TILES, width)
    left = data.select("dim", F.col("label").alias("c_label"), deal("tile", F.lit(shards)).alias("shard"),
                       spread(F.lit(blocks), "block"), "tile", *cand)
    right = asked.select("dim", "label", spread(F.lit(shards), "shard"), deal("tile", F.lit(blocks)).alias("block"),
                         *ask(asked))
    pairs = left.join(right, ["dim", "shard", "block"]).where(F.col("label") != F.col("c_label")).select(
        "dim", "tile", "a_ids", "a_vecs", "a_lists", "a_sizes", *cand)
    keys = ["anchor_id", "place", "positive_id", "positive_score"]
    lists = map_batches(pairs, lambda b: _negative_lists(b, negatives, positives, low, high),
                        "anchor_id long, place long, positive_id long, positive_score long, grp long, " + _ENTRY)
    return _tree(lists, keys, negatives, n, fan).select(
        "anchor_id", (F.col("place") + 1).alias("place"), "positive_id", "positive_score",
        F.posexplode("best").alias("at", "b")).select(
        "anchor_id", "place", "positive_id", "positive_score", (F.col("at") + 1).alias("rank"),
        F.col("b.vec_id").alias("negative_id"), (-F.col("b.worse")).alias("negative_score"))
