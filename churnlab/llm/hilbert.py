"""Sharding along a Hilbert curve, with DataFrame functions only.

Metadata dimensions are quantised to equal-depth cells, a row's cells are turned into its index on the Hilbert curve,
rows are range-partitioned and sorted by that index and written as runs: files that each cover a stretch of the curve,
hence a small box of every dimension. Shards are cut from the runs by rank, so their row counts differ by one at
most. A manifest lists for every run and shard the rows and the least and greatest value of each dimension; a reader
with conditions on any dimensions skips the runs whose boxes miss them.

Quantising: the distinct values of a dimension with their row counts are sorted across partitions, and the values at
equal steps of the running count become the cell bounds (2^bits - 1 of them, the only thing that comes to the driver).
Ties on the curve are broken by the tie columns, so a hot cell spreads over as many runs as it fills; equal texts
with equal metadata stay next to each other.

Defined results: null values come first in their dimension; rows that are equal in all columns may take each other's
place. An empty table gives empty runs. The operator's own columns begin with ``_hc_``, so others never clash; a
column named ``shard`` or ``slot`` is replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.llm.common import configure, scratch_path, written

BITS, SHARDS, ROW_BITS = 6, 16, 33


def curve_tables(dims: int) -> tuple[list[int], list[int], int]:
    """(next state, digit) by state and cell corner, and the number of states, of the curve in ``dims`` dimensions.

    From the rule of the Gray code: within a cell at state (entry corner, direction) the corner ``c`` is visited as
    number w, the rank of the rotated corner in Gray code order; the sub-cell's entry and direction follow from w.
    """
    full = (1 << dims) - 1
    turn = lambda x, k: ((x >> (k % dims)) | (x << (dims - k % dims))) & full  # noqa: E731  right by k
    gray = lambda w: w ^ (w >> 1)
    rank = {gray(w): w for w in range(1 << dims)}
    entry = lambda w: 0 if w == 0 else gray(2 * ((w - 1) // 2))

    def ones(w: int) -> int:  # trailing ones
        return 0 if not w & 1 else 1 + ones(w >> 1)
    direction = lambda w: 0 if w == 0 else ones(w - 1) % dims if w % 2 == 0 else ones(w) % dims
    states, todo, moves = {(0, 0): 0}, [(0, 0)], {}
    for at in todo:
        for corner in range(1 << dims):
            e, d = at
            w = rank[turn(corner ^ e, d + 1)]
            new = (e ^ turn(entry(w), dims - (d + 1) % dims), (d + direction(w) + 1) % dims)
            if new not in states:
                states[new] = len(states)
                todo.append(new)
            moves[states[at], corner] = (states[new], w)
    size = len(states) << dims
    return ([moves[i >> dims, i & full][0] for i in range(size)], [moves[i >> dims, i & full][1] for i in range(size)],
            len(states))


def curve_index(cells: list[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of a row's cells (each an int of ``bits`` bits), as a long."""
    dims = len(cells)
    nxt, digit, _ = curve_tables(dims)
    table_next, table_digit = (F.array(*map(F.lit, t)) for t in (nxt, digit))
    corners = F.array(*(
        reduce(lambda a, b: a + b, (F.shiftright(c, bit).bitwiseAND(F.lit(1)) * (1 << i)
                                    for i, c in enumerate(cells))).cast("int")
        for bit in range(bits - 1, -1, -1)))
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))

    def move(acc: Column, corner: Column) -> Column:
        at = acc["state"] * (1 << dims) + corner
        return F.struct(F.get(table_next, at).alias("state"),
                        (acc["index"] * (1 << dims) + F.get(table_digit, at)).alias("index"))
    return F.aggregate(corners, start, move, lambda acc: acc["index"])


def _sortable(df: DataFrame, name: str) -> Column:
    """A string that sorts like the column: numbers are shifted and padded."""
    kind = df.schema[name].dataType.typeName()
    if kind in ("byte", "short", "integer", "long", "decimal"):
        return F.lpad((F.col(name).cast("decimal(38,0)") + F.lit("10000000000000000000").cast("decimal(38,0)"))
                      .cast("string"), 24, "0")
    return F.col(name).cast("string")


def cell_bounds(df: DataFrame, dims: list[str], bits: int = BITS) -> dict[str, list[tuple[str, int]]]:
    """For each dimension the lower bounds (as sortable strings) of the equal-depth cells after the first, and the cell.

    A value that fills several cells begins where its rows begin, so frequent values keep their room on the curve.

    Values are counted before they are shuffled; running counts go over range partitions of the distinct values.
    """
    parts = F.explode(F.array(*(F.struct(F.lit(i).alias("dim"), _sortable(df, d).alias("value"))
                                for i, d in enumerate(dims)))).alias("x")
    counted = df.select(parts).select("x.*").where("value is not null").groupBy("dim", "value").agg(
        F.count("*").alias("n"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = written(counted.repartitionByRange(n, "dim", "value").withColumn("part", F.spark_partition_id()),
                     "hilbert-values")
    sums = spread.groupBy("dim", "part").agg(F.sum("n").alias("s"))
    before = sums.select("dim", "part", (F.sum("s").over(Window.partitionBy("dim").orderBy("part")) - F.col("s"))
                         .alias("before"), F.sum("s").over(Window.partitionBy("dim")).alias("total"))
    running = F.sum("n").over(Window.partitionBy("dim", "part").orderBy("value")) - F.col("n")
    ranked = spread.withColumn("run", running).join(F.broadcast(before), ["dim", "part"])
    cell = F.floor((F.col("run") + F.col("before")) * (1 << bits) / F.col("total"))
    firsts = ranked.groupBy("dim", cell.alias("cell")).agg(F.min("value").alias("value")).where("cell > 0")
    out: dict[str, list[tuple[str, int]]] = {d: [] for d in dims}
    for r in firsts.orderBy("dim", "value").collect():
        out[dims[r["dim"]]].append((r["value"], r["cell"]))
    return out


def _cell(value: Column, bounds: list[tuple[str, int]]) -> Column:
    """Cell of the last bound not above the value, by a binary search unrolled over the bounds; null is in cell 0."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(bounds[low - 1][1] if low else 0)
        mid = (low + high) // 2
        return F.when(value < bounds[mid][0], search(low, mid)).otherwise(search(mid + 1, high))
    return F.when(value.isNull(), F.lit(0)).otherwise(search(0, len(bounds)))


def write_runs(docs: DataFrame, dims: list[str], ties: list[Column | str], path: str | None = None,
               bits: int = BITS) -> str:
    """Write ``docs`` as runs along the curve (one shuffle) and return their folder.

    Each row carries ``_hc_index`` and ``_hc_row``: the run in the high bits, the place in it in the low 33.
    """
    spark = configure(docs.sparkSession)
    bounds = cell_bounds(docs, dims, bits)
    index = curve_index([_cell(_sortable(docs, d), bounds[d]) for d in dims], bits)
    names = [f"_hc_tie{i}" for i in range(len(ties))]
    keyed = docs.withColumn("_hc_index", index).withColumns(
        {n: F.col(t) if isinstance(t, str) else t for n, t in zip(names, ties)})
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = keyed.repartitionByRange(n, "_hc_index", *names).sortWithinPartitions("_hc_index", *names).drop(*names)
    path = path or scratch_path(spark, "hilbert-runs")
    runs.withColumn("_hc_row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    return path


def _offsets(runs: DataFrame) -> DataFrame:
    """(_hc_at, _hc_before, _hc_total): a run, the rows before it and all rows; one small row a run."""
    per = runs.groupBy(F.shiftright("_hc_row", ROW_BITS).alias("_hc_at")).agg(F.count("*").alias("_hc_n"))
    w = Window.orderBy("_hc_at")
    return per.select("_hc_at", (F.sum("_hc_n").over(w) - F.col("_hc_n")).alias("_hc_before"),
                      F.sum("_hc_n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
                      .alias("_hc_total"))


def read_shards(runs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Written runs with ``shard`` and ``slot`` added: consecutive ranks cut so that counts differ by one at most."""
    rank = F.col("_hc_before") + F.col("_hc_row").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    out = runs.withColumn("_hc_run", F.shiftright("_hc_row", ROW_BITS)).join(
        F.broadcast(_offsets(runs)), F.col("_hc_run") == F.col("_hc_at")).drop("_hc_at")  # one row a run
    out = out.withColumn("_hc_rank", rank).withColumn(
        "shard", F.expr(f"(_hc_rank * {shards}) div _hc_total").cast("int"))
    first = F.expr(f"(shard * _hc_total + {shards - 1}) div {shards}")
    return out.withColumn("slot", F.col("_hc_rank") - first).drop("_hc_before", "_hc_total")


def manifest(shards: DataFrame, dims: list[str]) -> DataFrame:
    """(shard, run, rows, first and last slot, least and greatest of each dimension) of every piece of a run."""
    stats = [x for d in dims for x in (F.min(d).alias(f"min_{d}"), F.max(d).alias(f"max_{d}"),
                                       F.count(F.when(F.col(d).isNull(), 1)).alias(f"nulls_{d}"))]
    return shards.groupBy("shard", F.col("_hc_run").alias("run")).agg(
        F.count("*").alias("rows"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"), *stats)


def pieces_with(pieces: DataFrame, **ranges) -> DataFrame:
    """Pieces of a manifest that may hold rows with every ``dim=(low, high)``; the others need not be read."""
    for d, (low, high) in ranges.items():
        pieces = pieces.where((F.col(f"max_{d}") >= low) & (F.col(f"min_{d}") <= high))
    return pieces


