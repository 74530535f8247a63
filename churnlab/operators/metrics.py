"""Ranking and classification metrics over (label, prob) DataFrames.

No metric sorts the whole input in one task. Scores are first reduced to
distinct values with positive / negative counts (map-side partial
aggregation, so a score shared by a third of the rows is one row), the
distinct scores are written in ranges of a bounded number of rows, range
totals (a small table) give exact offsets, and the running sums run inside
each range only. Results are exact, ties included; AUC uses whole decimals
up to one final division.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.functions.columns import label_at
from churnlab.operators.quantiles import VALUES_PER_RANGE, before, in_ranges
from churnlab.session import materialize

EPS = 2.220446049250313e-16  # fixed value: float64 machine epsilon used to clip probabilities
F1_EPS = 1e-9                # fixed value: smoothing term of the F1 search


def threshold_table(df: DataFrame, label: str = "label", prob: str = "prob", per_range: int = VALUES_PER_RANGE
                    ) -> DataFrame:
    """For every distinct score ``threshold`` (pred = prob >= threshold):
    tp, fp, fn, tn and the per-score counts pos / neg.

    Distinct scores lie in written ranges, greatest first; range totals (a small table) give exact offsets and the
    running sums run inside each range only.
    """
    counted = (df.where(F.col(prob).isNotNull()).groupBy(F.col(prob).cast("double").alias("threshold"))
               .agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("_n"))
               .select("threshold", "pos", (F.col("_n") - F.col("pos")).alias("neg")))
    g = in_ranges(counted, [F.desc("threshold")], per_range)
    off = before(["p", "n"], g.groupBy("part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")))
    run = Window.partitionBy("part").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    t = (g.join(F.broadcast(off), "part")
         .select("threshold", "pos", "neg", F.col("p_all").alias("P"), F.col("n_all").alias("N"),
                 (F.col("p_before") + F.sum("pos").over(run)).alias("tp"),
                 (F.col("n_before") + F.sum("neg").over(run)).alias("fp")))
    return t.select("threshold", "pos", "neg", "tp", "fp", (F.col("P") - F.col("tp")).alias("fn"),
                    (F.col("N") - F.col("fp")).alias("tn"), "P", "N")


def roc_auc(df: DataFrame, label: str = "label", prob: str = "prob", table: DataFrame | None = None) -> DataFrame:
    """M1: area under ROC with half credit for ties (Mann-Whitney), one row ``roc_auc``.

    2*P*N*AUC = sum over scores of neg * (2 * tp - pos): exact in 38-digit decimals, up to 10^18 rows of a class.
    """
    t = table if table is not None else threshold_table(df, label, prob)
    whole = lambda c: c.cast("decimal(19,0)")
    one = t.agg(F.sum(whole(F.col("neg")) * whole(2 * F.col("tp") - F.col("pos"))).alias("num"),
                F.first("P").alias("P"), F.first("N").alias("N"))
    den = (2 * whole(F.col("P")) * whole(F.col("N"))).cast("double")
    return one.select(F.when(den > 0, F.col("num").cast("double") / F.when(den > 0, den)).alias("roc_auc"))


def pr_auc(df: DataFrame, label: str = "label", prob: str = "prob", table: DataFrame | None = None,
           digits: int = 10) -> DataFrame:
    """M2: average precision = sum over descending scores of (R_n - R_{n-1}) * P_n."""
    t = table if table is not None else threshold_table(df, label, prob)
    term = F.when(F.col("pos") > 0, F.col("pos") / F.col("P") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
    one = t.agg(F.sum(term).alias("ap"), F.first("P").alias("P"))
    return one.select(F.when(F.col("P") > 0, F.round("ap", digits)).alias("pr_auc"))


def log_loss(df: DataFrame, label: str = "label", prob: str = "prob", digits: int = 10) -> DataFrame:
    """M3: mean binary cross-entropy with p clipped to [eps, 1 - eps]."""
    p = F.least(F.greatest(F.col(prob).cast("double"), F.lit(EPS)), F.lit(1 - EPS))
    y = F.col(label)
    ll = -F.when(y == 1, F.log(p)).otherwise(F.log(1 - p))
    return df.where(F.col(prob).isNotNull()).agg(F.round(F.avg(ll), digits).alias("log_loss"))


def roc_points(df: DataFrame, label: str = "label", prob: str = "prob", digits: int = 12) -> DataFrame:
    """M4: (threshold, fpr, tpr) per distinct score."""
    t = threshold_table(df, label, prob)
    return t.select("threshold",
                    F.round(F.when(F.col("N") > 0, F.col("fp") / F.col("N")), digits).alias("fpr"),
                    F.round(F.when(F.col("P") > 0, F.col("tp") / F.col("P")), digits).alias("tpr"))


def pr_points(df: DataFrame, label: str = "label", prob: str = "prob", digits: int = 12) -> DataFrame:
    """M4: (threshold, precision, recall) per distinct score."""
    t = threshold_table(df, label, prob)
    return t.select("threshold",
                    F.round(F.col("tp") / (F.col("tp") + F.col("fp")), digits).alias("precision"),
                    F.round(F.when(F.col("P") > 0, F.col("tp") / F.col("P")), digits).alias("recall"))


def best_f1_threshold(df: DataFrame, label: str = "label", prob: str = "prob", digits: int = 9) -> DataFrame:
    """M5: threshold maximising 2PR / (P + R + 1e-9); lowest threshold on ties."""
    t = threshold_table(df, label, prob)
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    rec = F.when(F.col("P") > 0, F.col("tp") / F.col("P")).otherwise(F.lit(0.0))
    f1 = 2 * prec * rec / (prec + rec + F1_EPS)
    x = t.select("threshold", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))
    best = x.agg(F.max_by(F.struct("threshold", "precision", "recall", "f1"),
                          F.struct(F.col("f1"), -F.col("threshold"))).alias("b"))
    return best.select("b.threshold", F.round("b.precision", digits).alias("precision"),
                       F.round("b.recall", digits).alias("recall"), F.round("b.f1", digits).alias("f1"))


def confusion_matrix(df: DataFrame, label: str = "label", prob: str = "prob", thr: float = 0.5) -> DataFrame:
    """M7: counts per (actual, predicted) and their share of the actual class."""
    x = df.select(F.col(label).cast("int").alias("actual"), label_at(prob, thr).alias("predicted"))
    g = x.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("actual")), 6))


def classification_report(df: DataFrame, label: str = "label", prob: str = "prob", thr: float = 0.5,
                          digits: int = 6) -> DataFrame:
    """M6: precision, recall, F1, support per class; accuracy; macro and weighted averages."""
    y, p = F.col(label), label_at(prob, thr)
    one = df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))

    def div(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / F.when(b > 0, b)).otherwise(F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    p1, r1 = div(tp, tp + fp), div(tp, tp + fn)
    p0, r0 = div(tn, tn + fn), div(tn, tn + fp)
    f1_1, f1_0 = div(2 * p1 * r1, p1 + r1), div(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    n = s1 + s0
    rows = [
        ("0", p0, r0, f1_0, s0), ("1", p1, r1, f1_1, s1),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        ("weighted avg", div(p0 * s0 + p1 * s1, n), div(r0 * s0 + r1 * s1, n), div(f1_0 * s0 + f1_1 * s1, n), n),
        ("accuracy", div(tp + tn, n), div(tp + tn, n), div(tp + tn, n), n),
    ]
    arr = F.array(*[F.struct(F.lit(c).alias("class"), F.round(a, digits).alias("precision"),
                             F.round(b, digits).alias("recall"), F.round(c2, digits).alias("f1"),
                             s.alias("support")) for c, a, b, c2, s in rows])
    return one.select(F.explode(arr).alias("r")).select("r.*")


def cv_summary(df: DataFrame, by: str = "model", metrics=("roc_auc", "pr_auc", "log_loss")) -> DataFrame:
    """M8: mean and population std of fold metrics per model, best AUC first."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return df.groupBy(by).agg(*aggs).orderBy(F.desc(f"{metrics[0]}_mean"))


def latest_prediction(preds: DataFrame, period: str | None = None, model_version: str | None = None,
                      key: str = "msno", ts: str = "predicted_at", tie: tuple = ()) -> DataFrame:
    """Most recent prediction per user (optionally one period / model version).

    ``row_number() = 1`` lets Catalyst add a partial WindowGroupLimit before
    the shuffle, so a user with a huge history is cut down map-side.
    """
    x = preds
    if period is not None:
        x = x.where(F.col("period") == period)
    if model_version is not None:
        x = x.where(F.col("model_version") == model_version)
    w = Window.partitionBy(key).orderBy(F.desc(ts), *[F.desc(c) for c in tie])
    return x.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def eval_join(preds: DataFrame, truth: DataFrame, period: str | None = None, source: str | None = "batch"
              ) -> DataFrame:
    """Scored rows joined to ground truth on (msno, period)."""
    p = preds if source is None else preds.where(F.col("source") == source)
    t = truth
    if period is not None:
        p, t = p.where(F.col("period") == period), t.where(F.col("period") == period)
    return p.join(t, ["msno", "period"], "inner")


def performance_report(preds: DataFrame, truth: DataFrame, period: str, min_auc: float = 0.85,
                       model_version: str | None = None, tie: tuple = ()) -> DataFrame:
    """M9: AUC, log loss, churn rate, n and the AUC alert for one period.

    Predictions are first reduced to the latest per user (D8); empty input
    gives NULL metrics with n = 0.
    """
    latest = latest_prediction(preds.where(F.col("source") == "batch"), period, model_version, tie=tie)
    # three passes read the joined rows: write them once
    j = materialize(eval_join(latest, truth, period, source=None).select(
        F.col("actual_churn").cast("int").alias("label"), F.col("churn_prob").cast("double").alias("prob")))
    auc = roc_auc(j)
    ll = log_loss(j)
    basics = j.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("label"), 6).alias("churn_rate"))
    out = basics.crossJoin(auc).crossJoin(ll)
    return out.select(F.lit(period).alias("period"), "n", "churn_rate", F.round("roc_auc", 10).alias("roc_auc"),
                      "log_loss", F.coalesce(F.col("roc_auc") < min_auc, F.lit(False)).alias("alert"))

