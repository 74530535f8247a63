"""Exploratory profiles as distributed aggregates.

Pattern throughout: aggregate first (partial aggregation map-side, tiny
result), reshape the small result afterwards (``stack`` / window over a
handful of rows). Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _stack(df: DataFrame, names: Sequence[str], value_cols: Sequence[Sequence[str]], out_cols: Sequence[str],
           keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot a (small) aggregate: one output row per name, ``value_cols[i]`` -> out_cols."""
    parts = []
    for name, vals in zip(names, value_cols):
        parts.append(F.struct(F.lit(name).alias("feature"), *[F.col(v).alias(o) for v, o in zip(vals, out_cols)]))
    return df.select(*keep, F.explode(F.array(*parts)).alias("_r")).select(*keep, "_r.*")


# ---------------------------------------------------------------- J3
def label_join(features: DataFrame, labels: DataFrame, key: str = "msno") -> DataFrame:
    """Inner join of per-user features and labels (both one row per user)."""
    return features.join(labels, key, "inner")


# ---------------------------------------------------------------- A14
def churn_contrast(df: DataFrame, cols: Sequence[str], label: str = "is_churn", digits: int = 6) -> DataFrame:
    """Mean of each column per class and the relative difference in percent.

    ``diff_pct = round((churn - renewal) / |renewal| * 100, 1)``; NULL when the
    renewal mean is 0. One aggregate pass, then the 1-row result is unpivoted.
    """
    y = F.col(label)
    aggs = []
    for c in cols:
        aggs.append(F.avg(F.when(y == 0, F.col(c).cast("double"))).alias(f"{c}__0"))
        aggs.append(F.avg(F.when(y == 1, F.col(c).cast("double"))).alias(f"{c}__1"))
    one = df.agg(*aggs)
    long = _stack(one, cols, [(f"{c}__0", f"{c}__1") for c in cols], ["renewal_mean", "churn_mean"])
    r, ch = F.col("renewal_mean"), F.col("churn_mean")
    return long.select(
        "feature",
        F.round(r, digits).alias("renewal_mean"),
        F.round(ch, digits).alias("churn_mean"),
        F.when(r != 0, F.round((ch - r) / F.abs(r) * 100, 1)).alias("diff_pct"),
    )


def _unpivot_one(one: DataFrame, names: Sequence[str], name_col: str, fields: dict[str, str]) -> DataFrame:
    """Unpivot a one-row aggregate whose columns are ``{name}__{field}``."""
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias(name_col), *[F.col(f"`{n}__{f}`").alias(o) for f, o in fields.items()])
        for n in names])).alias("_r")).select("_r.*")


# ---------------------------------------------------------------- A10
def dataset_profile(df: DataFrame, key: str, date_col: str | None = None, name: str = "table") -> DataFrame:
    """A10: rows, columns, NULL cells (all, and "column=count" of each), distinct keys, date range in one pass."""
    per = [F.count_if(F.col(c).isNull()) for c in df.columns]
    by_column = F.concat_ws(";", *[F.concat(F.lit(f"{c}="), n.cast("string")) for c, n in zip(df.columns, per)])
    aggs = [F.count(F.lit(1)).alias("n_rows"), sum(per[1:], per[0]).alias("n_null_cells"),
            by_column.alias("nulls_by_column"), F.count_distinct(key).alias("n_keys")]
    if date_col:
        aggs += [F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date")]
    return df.agg(*aggs).select(F.lit(name).alias("table"), F.lit(len(df.columns)).alias("n_cols"), "*")


# ---------------------------------------------------------------- A11
def describe(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles, max per column."""
    from churnlab.operators.quantiles import exact_quantiles
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [F.count(x).alias(f"{c}__count"), (F.sum(x).cast("double") / F.count(x)).alias(f"{c}__mean"),
                 F.stddev_samp(x.cast("double")).alias(f"{c}__std"), F.min(x).cast("double").alias(f"{c}__min"),
                 F.max(x).cast("double").alias(f"{c}__max")]
    base = _unpivot_one(df.agg(*aggs), cols, "column",
                        {"count": "count", "mean": "mean", "std": "std", "min": "min", "max": "max"})
    q = exact_quantiles(df, cols, (0.25, 0.5, 0.75))
    qw = q.groupBy("k").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q"))
    qw = qw.select(F.col("k").alias("column"), F.col("`0.25`").alias("p25"), F.col("`0.5`").alias("p50"),
                   F.col("`0.75`").alias("p75"))
    out = base.join(qw, "column", "left")
    return out.select("column", "count", F.round("mean", digits).alias("mean"), F.round("std", digits).alias("std"),
                      "min", "p25", "p50", "p75", "max")


# ---------------------------------------------------------------- A12
def value_counts(df: DataFrame, c: str, n: int | None = None, dropna: bool = True) -> DataFrame:
    """Frequency of each value, most frequent first (ties by value); optional NULL bucket."""
    src = df.where(F.col(c).isNotNull()) if dropna else df
    counts = src.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # from the counts: their shuffle is reused, the source read once
    out = counts.crossJoin(F.broadcast(total)).select(
        c, "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))
    if n is not None:
        out = out.orderBy(F.desc("n"), F.asc_nulls_first(c)).limit(n)
    return out


# ---------------------------------------------------------------- A13
def tx_overview(tx: DataFrame) -> DataFrame:
    """One-row transaction overview (exact sums, single division)."""
    disc = (F.col("plan_list_price") - F.col("actual_amount_paid"))
    pct = F.when(F.col("plan_list_price") > 0, disc / F.col("plan_list_price")).cast("decimal(18,8)")
    return tx.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.sum(disc).cast("double") / F.count(disc)).alias("mean_discount"),
        (F.sum(pct).cast("double") / F.count(pct)).alias("mean_discount_pct"),
        (F.count_if(F.col("actual_amount_paid") == 0) / F.count(F.lit(1))).alias("zero_price_share"),
        (F.sum("is_auto_renew") / F.count("is_auto_renew")).alias("auto_renew_rate"),
        (F.sum("is_cancel") / F.count("is_cancel")).alias("cancel_rate"),
        F.min("transaction_date").alias("first_date"),
        F.max("transaction_date").alias("last_date"),
    )


# ---------------------------------------------------------------- A15 + A16 (+ K4)
def rate_by(df: DataFrame, key, min_n: int = 0, label: str = "is_churn", lift: bool = True,
            dropna: bool = True) -> DataFrame:
    """Churn rate and size per group, groups below ``min_n`` dropped,
    lift = group rate / overall rate (overall over all rows, before the filter)."""
    k = F.col(key) if isinstance(key, str) else key
    kname = key if isinstance(key, str) else "key"
    src = df.select(k.alias(kname), F.col(label).alias("_y"))
    if dropna:
        src = src.where(F.col(kname).isNotNull())
    g = src.groupBy(kname).agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("_pos"))
    out = g.where(F.col("n") >= min_n)
    out = out.withColumn("churn_rate", F.col("_pos") / F.col("n"))
    if lift:
        overall = g.agg((F.sum("_pos") / F.sum("n")).alias("_overall"))  # from the groups: the source is read once
        out = out.crossJoin(F.broadcast(overall)).withColumn(
            "lift", F.round(F.col("churn_rate") / F.col("_overall"), 6)).drop("_overall")
    return out.withColumn("churn_rate", F.round("churn_rate", 6)).drop("_pos")


# ---------------------------------------------------------------- A17
def crosstab_pct(df: DataFrame, a: str, label: str = "is_churn", values=(0, 1)) -> DataFrame:
    """Counts by (a, label), row-normalised shares, missing cells 0."""
    p = df.groupBy(a).pivot(label, list(values)).agg(F.count(F.lit(1)))
    cols = [F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(f"n_{v}") for v in values]
    p = p.select(a, *cols)
    tot = None
    for v in values:
        tot = F.col(f"n_{v}") if tot is None else tot + F.col(f"n_{v}")
    return p.select(a, *[f"n_{v}" for v in values],
                    *[F.round(F.col(f"n_{v}") / tot, 6).alias(f"pct_{v}") for v in values])


# ---------------------------------------------------------------- A18
def histogram(df: DataFrame, c: str, bins: int = 20, by: str | None = None, density: bool = False) -> DataFrame:
    """Equal-width bins over the column's [min, max] (last bin closed), per class."""
    rng = df.agg(F.min(c).cast("double").alias("_lo"), F.max(c).cast("double").alias("_hi"))
    x = F.col(c).cast("double")
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((x - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1)))
    keys = [by] if by else []
    src = df.where(F.col(c).isNotNull()).crossJoin(F.broadcast(rng)).select(
        *keys, b.cast("int").alias("bin"), "_lo", "_hi")
    g = src.groupBy(*keys, "bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
    lo_edge = F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins
    hi_edge = F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / bins
    out = g.select(*keys, "bin", F.round(lo_edge, 6).alias("bin_lo"), F.round(hi_edge, 6).alias("bin_hi"), "n",
                   width.alias("_w"))
    if density:
        w = Window.partitionBy(*keys) if keys else Window.partitionBy()
        out = out.withColumn("density", F.round(
            F.col("n") / (F.sum("n").over(w) * F.when(F.col("_w") > 0, F.col("_w")).otherwise(F.lit(1.0))), 9))
    return out.drop("_w")


# ---------------------------------------------------------------- A19
def score_distribution(df: DataFrame, c: str = "prob", thr: float = 0.5) -> DataFrame:
    """Mean, exact p50 / p90 / p99, min, max and the share at or above ``thr``."""
    from churnlab.operators.quantiles import exact_quantiles
    one = df.agg(F.count(c).alias("n"), F.round(F.avg(c), 9).alias("mean"), F.min(c).alias("min"),
                 F.max(c).alias("max"), F.round(F.count_if(F.col(c) >= thr) / F.count(c), 9).alias("share_pos"))
    q = exact_quantiles(df, [c], (0.5, 0.9, 0.99)).groupBy().pivot("p", [0.5, 0.9, 0.99]).agg(F.first("q"))
    q = q.select(F.col("`0.5`").alias("p50"), F.col("`0.9`").alias("p90"), F.col("`0.99`").alias("p99"))
    return one.crossJoin(q)


# ---------------------------------------------------------------- A20
def _safe_corr(a: str, b: str) -> Column:
    """Pearson correlation; NULL when either side has zero variance.

    Built from population moments so a constant column cannot raise a
    division-by-zero under ANSI (``corr`` divides unguarded).
    """
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    sx, sy = F.stddev_pop(x), F.stddev_pop(y)
    ok = (sx > 0) & (sy > 0)
    return F.when(ok, F.covar_pop(x, y) / F.when(ok, sx * sy))


def target_correlation(df: DataFrame, cols: Sequence[str], target: str = "is_churn", digits: int = 6) -> DataFrame:
    """Pearson correlation of each column with the target (one pass)."""
    _corr = _safe_corr
    one = df.agg(*[_corr(c, target).alias(c) for c in cols])
    long = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr"))
                                          for c in cols])).alias("r")).select("r.*")
    return long.select("feature", F.round("corr", digits).alias("corr"), F.round(F.abs("corr"), digits).alias("abs_corr"))


def correlation_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Pairwise Pearson correlations (upper triangle incl. diagonal) of any number of columns.

    Two passes whatever the number of columns: means, then the sum of the rows' outer products of centred values, added
    up block by block in the JVM (MLlib's ``Correlation``). Pairs count over the rows where no column is NULL, leaving out
    columns without any value; pairs with such a column or a constant one are NULL.
    """
    spark = df.sparkSession
    seen = df.agg(*[F.count(c).alias(c) for c in cols]).first()
    used = [c for c in cols if seen[c]]
    whole = df.select(*[F.col(c).cast("double").alias(c) for c in used]).dropna()
    place = {c: i for i, c in enumerate(used)}
    matrix = variance = None
    if used:
        one = VectorAssembler(inputCols=used, outputCol="_v").transform(whole).select("_v")
        if one.limit(2).count() == 2:
            variance = one.select(Summarizer.metrics("variance").summary(F.col("_v")).alias("s")).first()["s"]["variance"]
            matrix = Correlation.corr(one, "_v").first()[0].toArray()  # as many rows as columns

    def corr(a: str, b: str) -> float | None:
        if matrix is None or not {a, b} <= place.keys() or not variance[place[a]] > 0 or not variance[place[b]] > 0:
            return None
        return float(matrix[place[a], place[b]])
    pairs = [(a, b, corr(a, b)) for i, a in enumerate(cols) for b in cols[i:]]
    return spark.createDataFrame(pairs, "a string, b string, corr double").withColumn("corr", F.round("corr", digits))


def top_correlated(df: DataFrame, cols: Sequence[str], target: str = "is_churn", n: int = 15) -> list[str]:
    """The ``n`` columns with the greatest absolute correlation with the target (ties by name, constants last)."""
    r = F.abs(F.round("corr", 9))
    found = target_correlation(df, cols, target, 12).orderBy(r.desc_nulls_last(), "feature").limit(n)
    return [x["feature"] for x in found.select("feature").collect()]


# ---------------------------------------------------------------- A21
def class_balance(df: DataFrame, label: str = "is_churn", by: str | None = None) -> DataFrame:
    """Rows and share per label value (optionally per dataset / period)."""
    keys = [by] if by else []
    g = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(w), 6))


# ---------------------------------------------------------------- A22
def outcome_profile(df: DataFrame, cols: Sequence[str], label: str = "is_churn", prob: str = "prob",
                    thr: float = 0.5, digits: int = 6) -> DataFrame:
    """Mean of each feature per confusion outcome (TP / FP / FN / TN)."""
    from churnlab.functions.columns import confusion_label, label_at
    x = df.withColumn("result", confusion_label(F.col(label), label_at(prob, thr)))
    return x.groupBy("result").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(prob), digits).alias(f"mean_{prob}"),
                                   *[F.round(F.avg(F.col(c).cast("double")), digits).alias(c) for c in cols])


def missed_by_bucket(df: DataFrame, c: str, edges: Sequence, names: Sequence[str], label: str = "is_churn",
                     prob: str = "prob", thr: float = 0.5, digits: int = 6) -> DataFrame:
    """Count and mean score of the false negatives per bucket of ``c``."""
    from churnlab.functions.columns import cut
    missed = df.where((F.col(label) == 1) & (F.col(prob) < thr))
    return missed.groupBy(cut(c, edges, names).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(prob), digits).alias(f"mean_{prob}"))


# ---------------------------------------------------------------- A23 / A24
def column_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact median of each column."""
    from churnlab.operators.quantiles import exact_quantiles
    return exact_quantiles(df, cols).select(F.col("k").alias("column"), F.col("q").alias("median"))


def feature_summary(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Mean, sample std and exact median of key features."""
    from churnlab.operators.quantiles import exact_quantiles
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std")]
    base = _unpivot_one(df.agg(*aggs), cols, "feature", {"mean": "mean", "std": "std"})
    med = exact_quantiles(df, cols).select(F.col("k").alias("feature"), F.col("q").alias("median"))
    return base.join(med, "feature", "left").select(
        "feature", F.round("mean", digits).alias("mean"), F.round("std", digits).alias("std"), "median")


# ---------------------------------------------------------------- J4 / J5 / J6, U2-U4
def key_coverage(left: DataFrame, rights: dict[str, DataFrame], key: str = "msno") -> DataFrame:
    """Share of distinct left keys present in each right table (every table read and shuffled once)."""
    seen = _seen_in([left, *rights.values()], key).where(F.col("seen").bitwiseAND(F.lit(1)) > 0)
    one = seen.agg(F.count(F.lit(1)).alias("n_left"), *[
        F.count_if(F.col("seen").bitwiseAND(F.lit(2 << i)) > 0).alias(name) for i, name in enumerate(rights)])
    return one.select("n_left", F.explode(F.array(*[
        F.struct(F.lit(name).alias("source"), F.col(f"`{name}`").alias("n_present")) for name in rights])).alias("r")
    ).select("r.source", "r.n_present", "n_left").withColumn(
        "coverage", F.round(F.col("n_present") / F.col("n_left"), 6))


def _seen_in(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """(key, seen): bit i of ``seen`` is set if table i has the key; one aggregate over all tables."""
    from functools import reduce
    tagged = [t.select(F.col(key), F.lit(1 << i).alias("seen")).where(F.col(key).isNotNull())
              for i, t in enumerate(tables)]
    return reduce(lambda a, b: a.union(b), tagged).groupBy(key).agg(F.bit_or("seen").alias("seen"))


def key_intersect(a: DataFrame, b: DataFrame, key: str = "msno") -> DataFrame:
    """Distinct keys present in both."""
    return a.select(key).intersect(b.select(key))


def key_except(a: DataFrame, b: DataFrame, key: str = "msno") -> DataFrame:
    """U4: distinct keys of ``a`` absent from ``b``."""
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def user_overlap(a: DataFrame, b: DataFrame, key: str = "msno") -> DataFrame:
    """Sizes of two key sets and of their intersection."""
    has = lambda bits: F.count_if(F.col("seen").bitwiseAND(F.lit(bits)) == bits)
    return _seen_in([a, b], key).agg(has(1).alias("n_a"), has(2).alias("n_b"), has(3).alias("n_both"))


def no_log_users(labels: DataFrame, logs: DataFrame, key: str = "msno", label: str = "is_churn") -> DataFrame:
    """Churn rate of users with and without any log history (semi / anti joins)."""
    lk = logs.select(key)
    with_logs = labels.join(lk, key, "left_semi").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(label), 6).alias("churn_rate")).select(
        F.lit(True).alias("has_logs"), "n", "churn_rate")
    without = labels.join(lk, key, "left_anti").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(label), 6).alias("churn_rate")).select(
        F.lit(False).alias("has_logs"), "n", "churn_rate")
    return with_logs.unionByName(without)


def stack_periods(*dfs: DataFrame) -> DataFrame:
    """Bag concatenation of period tables (same columns by name)."""
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b), dfs)


# ---------------------------------------------------------------- P19
def trim_quantiles(df: DataFrame, c: str, lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Keep rows whose value lies between the exact lo / hi quantiles (inclusive)."""
    from churnlab.operators.quantiles import exact_quantiles
    q = exact_quantiles(df, [c], (lo, hi)).groupBy().pivot("p", [lo, hi]).agg(F.first("q"))
    q = q.select(F.col(f"`{lo}`").alias("_qlo"), F.col(f"`{hi}`").alias("_qhi"))
    return df.crossJoin(F.broadcast(q)).where(F.col(c).between(F.col("_qlo"), F.col("_qhi"))).drop("_qlo", "_qhi")


def winsorize(df: DataFrame, c: str, hi: float | None = 0.99, cap: float | None = None) -> DataFrame:
    """Cap a column at its exact ``hi`` quantile, or at a constant ``cap``."""
    from churnlab.functions.columns import clip
    if cap is not None:
        return df.withColumn(c, clip(F.col(c).cast("double"), None, cap))
    from churnlab.operators.quantiles import exact_quantiles
    q = exact_quantiles(df, [c], (hi,)).select(F.col("q").alias("_cap"))
    return df.crossJoin(F.broadcast(q)).withColumn(
        c, F.when(F.col(c).isNotNull(), F.least(F.col(c).cast("double"), F.col("_cap")))).drop("_cap")


# ---------------------------------------------------------------- K1 / K4
def top_n(df: DataFrame, order_col: str, n: int, key="msno", ascending: bool = False) -> DataFrame:
    """K1/K4: top ``n`` rows by a column with key tie-breaks (TakeOrderedAndProject:
    each task keeps its own top ``n``, the driver merges n x tasks rows)."""
    o = F.asc(order_col) if ascending else F.desc(order_col)
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(o, *[F.asc(k) for k in keys]).limit(n)


def bucket_counts(df: DataFrame, c, edges, labels, label: str = "is_churn", include_lowest: bool = False,
                  upper_clip=None) -> DataFrame:
    """P9 + P21: right-closed buckets of a column, rows with no bucket dropped; size and churn rate."""
    from churnlab.functions.columns import clip, cut, cut_order
    x = F.col(c) if isinstance(c, str) else c
    if upper_clip is not None:
        x = clip(x, None, upper_clip)
    b = df.select(cut(x, edges, labels, include_lowest).alias("bucket"),
                  cut_order(x, edges, include_lowest).alias("bucket_order"), F.col(label).alias("_y"))
    return (b.na.drop(subset=["bucket"]).groupBy("bucket", "bucket_order")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("_y"), 6).alias("churn_rate")))
