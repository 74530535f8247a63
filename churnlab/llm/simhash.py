"""SimHash near-duplicates by tiled exact comparison.

Fingerprints: 64 bits from the XXH64 values of word shingles. Equal fingerprints are reduced to one row first, so a
group of copies of any size costs one comparison. Distinct fingerprints are cut into tiles by their population
counts (of the whole word, or of its halves, quarters or eighths when there are many: the sum of the segments'
differences is a lower bound of the distance). Tile pairs whose counts differ by more than the radius are never
formed; the others are compared in full with numpy exclusive-or and bit counts. A tile pair returns a spanning
forest of its links, not all of them, so groups of near copies stay linear in size. Components come from
alternating star contraction.

Defined results: a null or blank text has no words and fingerprint 0, which links like any other. Repeated rows and
ids are rows like any other. A component's id is the smallest non-null ``doc_id`` in it (null if it has none). An
empty table gives an empty result. Only the id and text columns are read, so other columns never clash.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import configure, map_batches, semi_by_row, text_key, written

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Rows aimed at per tile, and the rows a tile should at least have before the counts are split further.
TILE_ROWS, LEAST_ROWS = 4096, 256
#: Segments of the word -> population-count keys that hold nearly all random fingerprints.
SEGMENT_KEYS = {1: 16, 2: 136, 4: 4_700, 8: 3_000_000}
_BASE = 128  # digits of a packed count key; a count never reaches it, so sums of digits cannot be confused


def fingerprint(words: list[bytes], shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit fingerprint of a word sequence; 0 if there are no words."""
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    if n == 1:
        hashes = [digest(joined, seed)]
    else:
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[shingle - 1:].tolist())]
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 15):
        part = np.array(hashes[k:k + (1 << 15)], np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text: A-Z lowered, split at space and tab to carriage return (all of it ASCII)."""
    return text.lower().split() if text else []


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, text_key, fp long) for every row of ``docs`` (doc_id, text)."""
    configure(docs.sparkSession)
    src = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), F.col("text").cast("binary").alias("t"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        fps = [fingerprint(words_of(t.as_py()), shingle, seed) for t in b.column(2)]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())],
                                          ["doc_id", "text_key", "fp"])
    return map_batches(src, fn, f"doc_id {kind}, text_key long, fp long")


class _Forest:
    """Keeps only links that join two parts not joined before."""

    def __init__(self, n: int):
        self.label, self.kept = np.arange(n), []

    def add(self, u: np.ndarray, v: np.ndarray) -> None:
        while True:
            a, b = self.label[u], self.label[v]
            live = a != b
            if not live.any():
                return
            u, v, a, b = u[live], v[live], a[live], b[live]
            high, low = np.maximum(a, b), np.minimum(a, b)
            roots, first = np.unique(high, return_index=True)
            self.label[roots] = low[first]  # high to low only: no cycles
            self.kept.append((u[first], v[first]))
            while not np.array_equal(nxt := self.label[self.label], self.label):
                self.label = nxt

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.kept:
            return np.empty(0, int), np.empty(0, int)
        return tuple(np.concatenate(x) for x in zip(*self.kept))


def tile_links(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between two tiles of distinct uint64 fingerprints (``same``: one tile)."""
    forest, off = _Forest(len(a) + (0 if same else len(b))), 0 if same else len(a)
    step = max(1, (1 << 20) // max(1, len(b)))
    for i in range(0, len(a), step):
        near = np.bitwise_count(a[i:i + step, None] ^ b[None, :]) <= radius
        u, v = np.nonzero(near)
        if same:
            u, v = u[(keep := v > u + i)], v[keep]
        if len(u):
            forest.add(u + i, v + off)
    both = a if same else np.concatenate((a, b))
    u, v = forest.links()
    return both[u], both[v]


def segments_for(n: int) -> int:
    """Segments of the count key: as many as leave ``LEAST_ROWS`` rows in a usual tile. Never changes a result."""
    return max((m for m, keys in SEGMENT_KEYS.items() if n >= keys * LEAST_ROWS), default=1)


def _offsets(m: int, radius: int) -> list[tuple[int, ...]]:
    """Count differences of two tiles worth comparing, one of each pair of opposites; the zero offset is first."""
    def grow(left: int, rest: int):
        if not rest:
            yield ()
            return
        for d in range(-left, left + 1):
            for tail in grow(left - abs(d), rest - 1):
                yield (d, *tail)
    return sorted(o for o in grow(radius, m) if o >= (0,) * m)


def _links(fps: DataFrame, radius: int, tile_rows: int, segments: int | None) -> DataFrame:
    """(u, v) links that connect the same distinct fingerprints as all links within ``radius`` do."""
    spark = fps.sparkSession
    m = segments or segments_for(fps.count())
    width = 64 // m
    mask = F.lit(-1 if width == 64 else (1 << width) - 1).cast("long")
    count = lambda i: F.bit_count(F.shiftrightunsigned("fp", width * i).bitwiseAND(mask)).cast("long")
    key = sum((count(i) * _BASE ** i for i in range(1, m)), count(0))
    keyed = fps.select("fp", key.alias("key"))
    sizes = written(keyed.groupBy("key").agg(F.ceil(F.count("*") / tile_rows).alias("parts")), "simhash-sizes")
    tiles = written(
        keyed.join(sizes, "key")
        .groupBy("key", F.pmod(F.xxhash64("fp"), F.col("parts")).alias("part"))
        .agg(F.collect_list("fp").alias("fps")), "simhash-tiles")
    deltas = [sum(d * _BASE ** i for i, d in enumerate(o)) for o in _offsets(m, radius)]
    left = tiles.select(F.col("key").alias("ka"), F.col("part").alias("pa"), F.col("fps").alias("fa"),
                        F.explode(F.lit(deltas).cast("array<bigint>")).alias("delta"))
    left = left.withColumn("kb", F.col("ka") + F.col("delta"))
    right = tiles.select(F.col("key").alias("kb"), F.col("part").alias("pb"), F.col("fps").alias("fb"))
    pairs = left.join(right, "kb").where((F.col("delta") != 0) | (F.col("pa") <= F.col("pb"))).select(
        "ka", "pa", "kb", "pb", "fa", "fb")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartition(parts, "ka", "pa", "kb", "pb").select(
        ((F.col("ka") == F.col("kb")) & (F.col("pa") == F.col("pb"))).alias("same"), "fa", "fb")

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for same, fa, fb in zip(batch.column(0), batch.column(1), batch.column(2)):
            a, b = (x.values.to_numpy().view(np.uint64) for x in (fa, fb))
            out.append(tile_links(a, b, radius, same.as_py()))
        u, v = (np.concatenate(x).view(np.int64) for x in zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
    return map_batches(pairs, fn, "u long, v long")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest node of its component.

    Alternating large-star and small-star steps; each round's edges are written, so lineage stays short and a lost
    executor costs one round at most.
    """
    e = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = written(e, "links")
    state = None
    while True:
        both = e.union(e.select("v", "u")).toDF("u", "v")
        # written, the least neighbours are a plain side of the join: broadcast if small, else a hub can be split
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = written(least, "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        large = written(large, "links")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", "m"))
        e = written(small.where("u != v").distinct(), "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return e.toDF("node", "root").union(e.select("v", "v").distinct())
        state = now


def components(fp_table: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS,
               segments: int | None = None) -> DataFrame:
    """(fp, root, component_id): fingerprints linked at ``radius`` or fewer differing bits, directly or by others.

    ``root`` names the component itself; components that share their smallest id have the same ``component_id``.
    """
    reps = written(fp_table.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-reps")
    roots = connected(_links(reps.select("fp"), radius, tile_rows, segments))
    whole = reps.join(roots, reps["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    whole = written(whole, "simhash-roots")
    ids = written(whole.groupBy("root").agg(F.min("least_id").alias("component_id")), "simhash-ids")
    return whole.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
                    tile_rows: int = TILE_ROWS, segments: int | None = None) -> DataFrame:
    """One row per document: doc_id, text_key, fp long, root long (of its component), component_id."""
    fp_table = written(fingerprints(docs, shingle, seed), "simhash")
    return fp_table.join(components(fp_table, radius, tile_rows, segments), "fp").select(
        "doc_id", "text_key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """Documents with one of each component left: the one with the smallest id.

    An id on unrelated texts stays once for each component it is the smallest of; within one, the text with the
    smallest key stays, and rows that repeat an id and its text count once. Rows without an id cannot be named; they stay, unless
    their component has a document with an id.
    """
    found = near_duplicates(docs, **options)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    named = kept.where("doc_id is not null").groupBy("root", "doc_id").agg(F.min("text_key").alias("_row_key"))
    nameless = kept.where("doc_id is null").select("doc_id", "text_key").distinct()
    # an equality join leaves rows dealt by (doc_id, key), so dropping repeated rows needs no shuffle of its own
    once = (docs.where("doc_id is not null").withColumn("_row_key", text_key(F.col("text")))
            .join(named, ["doc_id", "_row_key"], "left_semi").dropDuplicates(["doc_id", "_row_key"]))
    rest = semi_by_row(docs.where("doc_id is null"), nameless, "left_semi")
    return once.select(*docs.columns).union(rest.select(*docs.columns))


__all__ = ["fingerprint", "words_of", "fingerprints", "tile_links", "connected", "components", "near_duplicates",
           "keep_one"]
