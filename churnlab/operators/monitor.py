"""Monitoring (D-1..D-4, G1-G8, K2, K3, T3, T14) as aggregates over metric and prediction tables.

Time-relative panels take an explicit ``now`` so a rerun gives the same answer.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlab.functions.columns import count_less_sorted, risk_band
from churnlab.operators.quantiles import VALUES_PER_RANGE, before, in_ranges, quantiles_in_ranges
from churnlab.session import materialize, scratch_path


# fixed values: thresholds of the monitoring configuration
DRIFT_ALERT = 0.15        # share of drifted columns that raises an alert
DRIFT_WARN = 0.10         # dashboard warning band for the drift score
MIN_AUC = 0.85
MAX_LOG_LOSS = 0.240
PSI_COLUMN_DRIFT = 0.2    # per-column PSI above which a column counts as drifted
PSI_EPS = 1e-6            # floor for empty bin shares
MAX_CATEGORIES = 20       # at most this many distinct baseline values -> categorical bins
RECENT_CAP = 500


def _weights(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """(feature, v, ``name``): each column's distinct values (NULLs left out) with their rows; all columns in one pass."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])).alias("r")).select("r.*")
    return long.where(F.col("v").isNotNull()).groupBy("feature", "v").agg(F.count(F.lit(1)).alias(name))


def _bins(weights: DataFrame, info: DataFrame, name: str, bins: int) -> DataFrame:
    """(feature, bin, ``name``): rows a bin; ``info`` has one row a feature."""
    b = F.when(F.col("n_distinct") <= MAX_CATEGORIES, F.col("v")).otherwise(
        count_less_sorted("edges", "v", bins - 1).cast("double"))
    return weights.join(F.broadcast(info), "feature").select("feature", b.alias("bin"), name).groupBy(
        "feature", "bin").agg(F.sum(name).alias(name))


def write_baseline(df: DataFrame, cols: Sequence[str], path: str, bins: int = 10) -> None:
    """Profile of a baseline table, written once below ``path``: all that later comparisons need of it.

    ``values``: distinct values with weights; ``info``: per column the number of rows and distinct values and the exact
    inner quantiles; ``shares``: rows per bin. Bins are the quantiles (right-closed), or the values themselves where a
    column has at most 20 of them.
    """
    values = in_ranges(_weights(df, cols, "wb"), ["feature", "v"])
    values.drop("part").write.mode("overwrite").parquet(f"{path}/values")
    q = quantiles_in_ranges(values.select(F.col("feature").alias("k"), "v", F.col("wb").alias("w"), "part"),
                            [i / bins for i in range(1, bins)])
    edges = q.groupBy(F.col("k").alias("feature")).agg(F.array_sort(F.collect_list("q")).alias("edges"))
    size = values.groupBy("feature").agg(F.sum("wb").alias("n"), F.count(F.lit(1)).alias("n_distinct"))
    size.join(edges, "feature", "left").withColumn("bins", F.lit(bins)).write.mode("overwrite").parquet(f"{path}/info")
    info = values.sparkSession.read.parquet(f"{path}/info")
    _bins(values.withColumnRenamed("wb", "nb"), info, "nb", bins).write.mode("overwrite").parquet(f"{path}/shares")


def drift_from_baseline(cur: DataFrame, cols: Sequence[str], path: str) -> DataFrame:
    """D-1: PSI and KS of every column of ``cols`` between a stored baseline and a current table.

    Reads the current table once and of the baseline its profile only. Empty bin shares are floored at 1e-6. A column
    without values on either side has NULL for all three and does not count in the score.
    """
    spark = cur.sparkSession
    info, shares, base = (spark.read.parquet(f"{path}/{t}") for t in ("info", "shares", "values"))
    bins = (info.agg(F.max("bins")).first()[0] or 1)
    lc = materialize(_weights(cur, cols, "wc"))  # read by the bins and by KS
    nc = _bins(lc.withColumnRenamed("wc", "nc"), info, "nc", bins)
    j = shares.where(F.col("feature").isin(*cols)).join(nc, ["feature", "bin"], "full_outer").fillna(0, ["nb", "nc"])
    w = Window.partitionBy("feature")
    share = lambda c: F.when(F.sum(c).over(w) > 0, F.greatest(
        F.col(c) / F.when(F.sum(c).over(w) > 0, F.sum(c).over(w)), F.lit(PSI_EPS)))
    per_bin = j.select("feature", share("nb").alias("sb"), share("nc").alias("sc"))
    psi = per_bin.groupBy("feature").agg(F.sum((F.col("sc") - F.col("sb")) * F.log(F.col("sc") / F.col("sb"))).alias("psi"))
    names = spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("feature"))
    out = names.join(F.broadcast(psi), "feature", "left").join(
        F.broadcast(ks_by_column(base.where(F.col("feature").isin(*cols)), lc)), "feature", "left")
    return out.select("feature", F.round("psi", 9).alias("psi"), F.round("ks", 9).alias("ks"),
                      (F.col("psi") > PSI_COLUMN_DRIFT).alias("drifted"))


def drift_by_column(base: DataFrame, cur: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """D-1 for a baseline that is not stored yet: its profile is written to a scratch folder first."""
    path = scratch_path(base.sparkSession, "churnlab_baseline")
    write_baseline(base, cols, path, bins)
    return drift_from_baseline(cur, cols, path)


def ks_by_column(lb: DataFrame, lc: DataFrame, per_range: int = VALUES_PER_RANGE) -> DataFrame:
    """Exact two-sample KS statistic per feature: max |F_base(x) - F_cur(x)|, from (feature, v, wb) and (feature, v, wc).

    Both samples (written tables) are dealt by value to ranges of a bounded number of rows; the empirical CDFs are
    running sums inside the ranges, equal values together, plus the totals of the ranges before. So they are shuffled
    and written once, and a value of both samples needs no aggregate: its rows are in one range.
    """
    zero = lambda c: F.lit(0).cast("long").alias(c)
    vc = in_ranges(
        lb.select("feature", "v", "wb", zero("wc")).unionByName(lc.select("feature", "v", zero("wb"), "wc")),
        ["feature", "v"], per_range, stored=True)
    off = before(["b", "c"], vc.groupBy("feature", "part").agg(F.sum("wb").alias("b"), F.sum("wc").alias("c")),
                 ["feature"]).drop("b", "c")
    run = Window.partitionBy("feature", "part").orderBy("v").rangeBetween(Window.unboundedPreceding, 0)
    cum = vc.join(F.broadcast(off), ["feature", "part"]).select(
        "feature", (F.col("b_before") + F.sum("wb").over(run)).alias("cb"),
        (F.col("c_before") + F.sum("wc").over(run)).alias("cc"), F.col("b_all").alias("nb"), F.col("c_all").alias("nc"))
    ok = (F.col("nb") > 0) & (F.col("nc") > 0)
    d = F.when(ok, F.abs(F.col("cb") / F.when(ok, F.col("nb")) - F.col("cc") / F.when(ok, F.col("nc"))))
    return cum.groupBy("feature").agg(F.max(d).alias("ks"))


def drift_score(drift: DataFrame, alert: float = DRIFT_ALERT) -> DataFrame:
    """D-2: share of drifted columns among those with values on both sides; 'no data' when there is nothing to compare."""
    one = drift.agg(F.count("drifted").alias("n_cols"), F.count_if("drifted").alias("n_drifted"))
    score = F.when(F.col("n_cols") > 0, F.col("n_drifted") / F.col("n_cols"))
    return one.select("n_cols", "n_drifted", F.round(score, 6).alias("drift_score"),
                      F.coalesce(score > alert, F.lit(False)).alias("dataset_drift"),
                      F.when(F.col("n_cols") == 0, "no data").when(score > alert, "drift").otherwise("ok")
                      .alias("status"))


def alerts(drift_row: DataFrame, perf_row: DataFrame, drift_alert: float = DRIFT_ALERT,
           min_auc: float = MIN_AUC) -> DataFrame:
    """D-3: one row per check with value, threshold, whether it fires, and "no data" where there is no value."""
    d = drift_row.select(F.lit("drift_score").alias("check"), F.col("drift_score").cast("double").alias("value"),
                         F.lit(drift_alert).alias("threshold"),
                         F.coalesce(F.col("drift_score") > drift_alert, F.lit(False)).alias("alert"))
    p = perf_row.select(F.lit("roc_auc").alias("check"), F.col("roc_auc").cast("double").alias("value"),
                        F.lit(min_auc).alias("threshold"),
                        F.coalesce(F.col("roc_auc") < min_auc, F.lit(False)).alias("alert"))
    return d.unionByName(p).withColumn("status", F.when(F.col("value").isNull(), "no data").when(
        F.col("alert"), "alert").otherwise("ok"))


def period_summary(period: str, drift_row: DataFrame, perf_row: DataFrame) -> DataFrame:
    """D-4: drift and performance of one period side by side with an overall status."""
    j = drift_row.select("drift_score", F.col("dataset_drift").alias("drift_alert")).crossJoin(
        perf_row.select("n", "roc_auc", "log_loss", F.col("alert").alias("auc_alert")))
    no_data = F.col("drift_score").isNull() | F.col("roc_auc").isNull()
    return j.select(F.lit(period).alias("period"), "*",
                    F.when(F.col("drift_alert") | F.col("auc_alert"), "ALERT").when(no_data, "NO DATA").otherwise("OK")
                    .alias("status"))


# ---------------------------------------------------------------- dashboard panels
def latest_drift(history: DataFrame) -> DataFrame:
    """Drift score of the most recent period in the drift history (bands .10 / .15)."""
    one = history.agg(F.max_by(F.struct("period", "drift_score", "dataset_drift"), "period").alias("r"))
    s = F.col("r.drift_score")
    return one.select("r.period", "r.drift_score", "r.dataset_drift",
                      F.when(s > DRIFT_ALERT, "red").when(s > DRIFT_WARN, "yellow").when(s.isNotNull(), "green")
                      .alias("band"))


def _since(preds: DataFrame, now: dt.datetime, hours: int) -> DataFrame:
    return preds.where(F.col("predicted_at") > F.lit(now - dt.timedelta(hours=hours)))


def pred_volume(preds: DataFrame, now: dt.datetime) -> DataFrame:
    """G1: predictions in the last 24 hours."""
    return _since(preds, now, 24).agg(F.count(F.lit(1)).alias("n_predictions"))


def daily_churn_rate(preds: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    """Per-day share of churn labels over the last ``days`` days."""
    x = _since(preds, now, 24 * days)
    return x.groupBy(F.to_date("predicted_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("churn_label").cast("double")), 6).alias("churn_rate"))


def mean_probability(preds: DataFrame, now: dt.datetime) -> DataFrame:
    """Mean probability over the last 24 hours and its band."""
    one = _since(preds, now, 24).agg(F.round(F.avg(F.col("churn_prob").cast("double")), 6).alias("mean_prob"))
    return one.select("mean_prob", risk_band("mean_prob").alias("band"))


def latest_version(preds: DataFrame) -> DataFrame:
    """Model version of the newest prediction (versions compared as integers on ties, none being lowest)."""
    vnum = F.regexp_extract("model_version", r"(\d+)", 1).try_cast("int")
    return preds.agg(F.max_by("model_version", F.struct(F.col("predicted_at"), vnum)).alias("model_version"))


def hourly_by_source(preds: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    """Predictions per hour and source over the last ``days`` days."""
    x = _since(preds, now, 24 * days)
    return x.groupBy(F.date_trunc("hour", "predicted_at").alias("hour"), "source").agg(
        F.count(F.lit(1)).alias("n"))


def today_totals(preds: DataFrame, now: dt.datetime) -> DataFrame:
    """today's count, churn share and mean probability."""
    x = preds.where(F.to_date("predicted_at") == F.lit(now.date()))
    return x.agg(F.count(F.lit(1)).alias("n"),
                 F.round(F.avg(F.col("churn_label").cast("double")), 6).alias("churn_rate"),
                 F.round(F.avg(F.col("churn_prob").cast("double")), 6).alias("mean_prob"))


def daily_series(preds: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    """Counts for each of the last ``days`` days, empty days as 0 (calendar left-joined)."""
    spark = preds.sparkSession
    start = now.date() - dt.timedelta(days=days - 1)
    cal = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(now.date()))).alias("day"))
    counts = (preds.where(F.to_date("predicted_at").between(F.lit(start), F.lit(now.date())))
              .groupBy(F.to_date("predicted_at").alias("day")).agg(F.count(F.lit(1)).alias("n")))
    return cal.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


def recent_predictions(preds: DataFrame, n: int = 100, tie: Sequence[str] = ("msno",)) -> DataFrame:
    """K2: newest predictions first, at most 500."""
    return preds.orderBy(F.desc("predicted_at"), *[F.asc(c) for c in tie]).limit(min(n, RECENT_CAP))


# ---------------------------------------------------------------- T3 / T14
def class_weights(labels: DataFrame, label: str = "is_churn") -> DataFrame:
    """Class counts, negative/positive ratio and balanced weights n / (2 n_c)."""
    one = labels.agg(F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) == 0).alias("n_neg"))
    n = F.col("n_pos") + F.col("n_neg")
    return one.select("n_pos", "n_neg",
                      F.when(F.col("n_pos") > 0, F.col("n_neg") / F.col("n_pos")).alias("scale_pos_weight"),
                      F.when(F.col("n_pos") > 0, n / (2 * F.col("n_pos"))).alias("weight_pos"),
                      F.when(F.col("n_neg") > 0, n / (2 * F.col("n_neg"))).alias("weight_neg"))


def quality_gate(metrics: DataFrame, max_log_loss: float = MAX_LOG_LOSS, min_auc: float | None = None) -> DataFrame:
    """Pass when log loss is within the gate (and AUC above ``min_auc`` if given)."""
    ok = F.coalesce(F.col("log_loss") <= max_log_loss, F.lit(False))
    if min_auc is not None:
        ok = ok & F.coalesce(F.col("roc_auc") >= min_auc, F.lit(False))
    return metrics.withColumn("passed", ok).withColumn(
        "stage", F.when(F.col("passed"), "Staging").otherwise("None"))


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)
