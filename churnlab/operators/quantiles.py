"""Exact quantiles of many columns without gathering a column into one task.

Plan (one path at every size, all distributed, bounded broadcasts):
1. unpivot to (k, v) and pre-aggregate to distinct values with weights (heavy ties collapse map-side);
2. range-partition the distinct values by (k, v) into ranges of about VALUES_PER_RANGE rows, written once;
3. total each (column, range), a small table, and from its running sums find the ranges that hold the two ranks
   around ``p * (n - 1)``: at most two ranges per column and probability;
4. only those ranges are read again and sorted, and the values at the ranks are interpolated linearly
   (``lo + (hi - lo) * frac``, the pandas / SQL ``quantile_cont`` rule).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.session import materialize

VALUES_PER_RANGE = 250_000   # rows a running-sum window task holds


def in_ranges(df: DataFrame, keys: Sequence[str | Column], per_range: int = VALUES_PER_RANGE,
              stored: bool = False) -> DataFrame:
    """``df`` written in the order of ``keys`` across ranges of about ``per_range`` rows; ``part`` numbers them.

    ``stored``: ``df`` only reads written tables, so it is not written once more to be counted.
    """
    rows = df if stored else materialize(df)
    n = max(1, -(-rows.count() // per_range))
    return materialize(rows.repartitionByRange(n, *keys).withColumn("part", F.spark_partition_id()))


def before(cols: Sequence[str], totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals of the ranges before each range (``<col>_before``) and of all (``<col>_all``), per ``by``.

    ``totals`` has one row a range, so its window holds as many rows as there are ranges.
    """
    w = Window.partitionBy(*by)
    up = w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("*", *[x for c in cols for x in (F.coalesce(F.sum(c).over(up), F.lit(0)).alias(f"{c}_before"),
                                                          F.sum(c).over(w).alias(f"{c}_all"))])


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.5,),
                    per_range: int = VALUES_PER_RANGE) -> DataFrame:
    """Rows (k, p, q): exact quantile ``q`` of column ``k`` at probability ``p`` (NULLs ignored)."""
    long = (df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in cols])).alias("r"))
        .select("r.k", "r.v"))
    return exact_quantiles_long(long, probs, per_range)


def exact_quantiles_long(long: DataFrame, probs: Sequence[float] = (0.5,), per_range: int = VALUES_PER_RANGE
                         ) -> DataFrame:
    """Same as ``exact_quantiles`` for data already in long form (k, v)."""
    counted = long.where(F.col("v").isNotNull()).groupBy("k", "v").agg(F.count(F.lit(1)).alias("w"))
    return quantiles_in_ranges(in_ranges(counted, ["k", "v"], per_range), probs)


def quantiles_in_ranges(values: DataFrame, probs: Sequence[float] = (0.5,)) -> DataFrame:
    """Exact quantiles of distinct values with weights (k, v, w, part) that ``in_ranges`` has written by (k, v)."""
    offs = before(["w"], values.groupBy("k", "part").agg(F.sum("w").alias("w")), ["k"])
    pos = F.col("p") * (F.col("w_all") - 1)
    targets = offs.select("k", "part", "w", "w_before", "w_all",
                          F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p")).select(
        "k", "part", "p", "w", "w_before", F.floor(pos).cast("long").alias("lo"), F.ceil(pos).cast("long").alias("hi"),
        (pos - F.floor(pos)).alias("frac"))
    inside = lambda r, a, b: (F.col(a) <= F.col(r)) & (F.col(r) < F.col(b))
    targets = targets.withColumn("w_end", F.col("w_before") + F.col("w")).where(
        inside("lo", "w_before", "w_end") | inside("hi", "w_before", "w_end")).drop("w", "w_end")
    wanted = targets.select("k", "part", "w_before").distinct()
    run = Window.partitionBy("k", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    cum = values.join(F.broadcast(wanted), ["k", "part"]).select(
        "k", "part", "v", "w", (F.col("w_before") + F.sum("w").over(run)).alias("end")).withColumn(
        "start", F.col("end") - F.col("w"))
    hit = cum.join(F.broadcast(targets.drop("w_before")), ["k", "part"])
    in_lo, in_hi = inside("lo", "start", "end"), inside("hi", "start", "end")
    res = hit.where(in_lo | in_hi).groupBy("k", "p", "frac").agg(
        F.max(F.when(in_lo, F.col("v"))).alias("vlo"), F.max(F.when(in_hi, F.col("v"))).alias("vhi"))
    return res.select("k", "p", (F.col("vlo") + (F.col("vhi") - F.col("vlo")) * F.col("frac")).alias("q"))


def exact_medians_row(df: DataFrame, cols: Sequence[str], **kw) -> DataFrame:
    """One row with one column per input column holding its exact median.

    Columns with no non-NULL value get NULL. The row is tiny and is meant to
    be broadcast (``crossJoin(broadcast(...))``).
    """
    q = exact_quantiles(df, cols, (0.5,), **kw)
    return q.groupBy().pivot("k", list(cols)).agg(F.first("q"))
