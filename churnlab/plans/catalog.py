"""Registered queries: each runs library operators over the driver-table bindings.

Every query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. Its SQL twin for DuckDB lives in ``plans/oracle.py`` under the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnlab.operators import eda, features, labels
from churnlab.plans import bindings as B
from churnlab.plans.periods import DEMO_LABEL_WINDOW as LW
from churnlab.plans.periods import DEMO_PERIOD as P
from churnlab.plans.periods import period_config

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def _tx(spark, d):
    return B.transactions(spark, d)


CONTRAST_COLS = ["n_transactions", "n_cancels", "ever_canceled", "avg_discount_pct", "avg_plan_days", "avg_price",
                 "last_is_cancel", "last_is_auto_renew", "last_plan_days", "last_price", "price_trend"]


@register("tx_user_profile")
def q_tx_user_profile(spark, d):
    return features.tx_user_profile(_tx(spark, d), as_of=P.tx_as_of, tie_cols=B.TX_TIE_COLS)


@register("churn_contrast")
def q_churn_contrast(spark, d):
    prof = features.tx_user_profile(_tx(spark, d), as_of=P.tx_as_of, tie_cols=B.TX_TIE_COLS)
    j = eda.label_join(prof, B.labels_for(spark, d, P.period))
    return eda.churn_contrast(j, CONTRAST_COLS)


# ---------------------------------------------------------------- S2 / S3
@register("date_coercion")
def q_date_coercion(spark, d):
    from churnlab.operators.features import date_coercion_profile
    return date_coercion_profile(_tx(spark, d))


@register("tx_union_count")
def q_tx_union_count(spark, d):
    from pyspark.sql import functions as F
    from churnlab.sources.readers import union_sources
    tx = _tx(spark, d)
    # Two "files": the base history and a later extract, appended as a bag.
    base = tx.where(F.col("transaction_date") < 19990101)
    later = tx.where(F.col("transaction_date") >= 19990101)
    u = union_sources(base, later)
    return u.groupBy((F.col("transaction_date") / 10000).cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("msno").alias("n_users"))


# ---------------------------------------------------------------- logs / members / expiry / recency
def _log_agg(spark, d):
    return features.log_user_agg(B.user_logs(spark, d), P.log_max_date, P.log_recent, P.log_windows)


@register("log_user_agg")
def q_log_user_agg(spark, d):
    return _log_agg(spark, d)


@register("log_features")
def q_log_features(spark, d):
    return features.log_features(_log_agg(spark, d), P.log_ref_date)


@register("multiwindow_features")
def q_multiwindow_features(spark, d):
    return features.multiwindow_features(_log_agg(spark, d))


@register("member_features")
def q_member_features(spark, d):
    return features.member_features(B.members(spark, d), P.prediction_date)


@register("expiry_features")
def q_expiry_features(spark, d):
    return features.expiry_features(_tx(spark, d), P.prediction_date, as_of=P.tx_as_of, tie_cols=B.TX_TIE_COLS)


@register("tx_recency")
def q_tx_recency(spark, d):
    return features.tx_recency(_tx(spark, d), P.tx_ref, as_of=P.tx_as_of)


# ---------------------------------------------------------------- W1-W3 labeller
@register("last_expire")
def q_last_expire(spark, d):
    return labels.last_expire(_tx(spark, d), LW.hist_start, LW.hist_end)


def _candidates(spark, d):
    from pyspark.sql import functions as F
    from churnlab.plans.periods import ymd
    return labels.last_expire(_tx(spark, d), LW.hist_start, LW.hist_end).where(
        F.col("last_expire").between(ymd(LW.target_start), ymd(LW.target_end)))


@register("renewal_gap")
def q_renewal_gap(spark, d):
    from pyspark.sql import functions as F
    from churnlab.plans.periods import ymd
    tx = _tx(spark, d)
    return labels.renewal_gap(_candidates(spark, d), tx.where(F.col("transaction_date") > ymd(LW.hist_end)))


@register("churn_labels")
def q_churn_labels(spark, d):
    return labels.churn_labels(_tx(spark, d), LW)


# ---------------------------------------------------------------- J1/J2, I1-I3, V1-V4, J8
def _raw_matrix(spark, d):
    from churnlab.operators.assemble import assemble_labelled
    return assemble_labelled(_tx(spark, d), B.user_logs(spark, d), B.members(spark, d), P,
                             B.period_start(P.prev_period), B.TX_TIE_COLS)


def _matrices(spark, d, periods):
    """v5 matrices of some months by period, from one pass over the payments."""
    from churnlab.operators.assemble import assemble_months, impute_matrix
    from churnlab.session import sized_shuffles
    cfgs = [period_config(p) for p in dict.fromkeys(periods)]
    with sized_shuffles(spark, B.table(spark, d, "lineitem").count()):
        raws = assemble_months(B.transactions(spark, d, True), B.user_logs(spark, d), B.members(spark, d), cfgs,
                               [B.period_start(c.prev_period) for c in cfgs], B.TX_TIE_COLS, True)
        return {c.period: impute_matrix(raw, "v5") for c, raw in zip(cfgs, raws)}


def feature_matrix(spark, d, feature_set="v5"):
    from churnlab.operators.assemble import impute_matrix
    return impute_matrix(_raw_matrix(spark, d), feature_set)


for _fs in ("v1", "v4", "v5"):
    register(f"feature_matrix_{_fs}")(lambda spark, d, _fs=_fs: feature_matrix(spark, d, _fs))


@register("churn_lag")
def q_churn_lag(spark, d):
    from churnlab.operators.assemble import prev_label_join
    users = B.labels_for(spark, d, P.period)
    return prev_label_join(users, B.labels_for(spark, d, P.prev_period))


@register("imputed_features")
def q_imputed_features(spark, d):
    """Exact medians used to fill each column, with the number of filled rows."""
    from pyspark.sql import functions as F
    from churnlab.operators.impute import null_report
    from churnlab.operators.quantiles import exact_quantiles
    from churnlab.schemas import FEATURE_COLS_V1
    from churnlab.session import materialize
    cols = [c for c in FEATURE_COLS_V1 if c not in ("has_member_record", "has_log_record", "n_days")]
    cols += ["days_until_expire", "days_since_last_tx"]
    raw = materialize(_raw_matrix(spark, d).select(*cols))  # read by the medians and by the counts
    med = exact_quantiles(raw, cols).select(F.col("k").alias("feature"), F.col("q").alias("median"))
    nulls = null_report(raw, cols).select(F.col("column").alias("feature"), F.col("n_null").alias("n_filled"))
    return med.join(nulls, "feature", "right")


@register("null_report")
def q_null_report(spark, d):
    from churnlab.operators.impute import null_report
    from churnlab.schemas import FEATURE_COLS_V5
    raw = _raw_matrix(spark, d)
    return null_report(raw, [c for c in FEATURE_COLS_V5 if c in raw.columns])


@register("top_nulls")
def q_top_nulls(spark, d):
    from churnlab.operators.impute import null_report
    from churnlab.schemas import FEATURE_COLS_V5
    raw = _raw_matrix(spark, d)
    return null_report(raw, [c for c in FEATURE_COLS_V5 if c in raw.columns], top=10)


@register("validation_counts")
def q_validation_counts(spark, d):
    from churnlab.operators.validate import validation_counts
    return validation_counts(feature_matrix(spark, d, "v5"))


@register("contract_violations")
def q_contract_violations(spark, d):
    from churnlab.operators.validate import contract_check
    from churnlab.schemas import FEATURE_COLS_V5
    raw = _raw_matrix(spark, d)
    return contract_check(raw.select("msno", *[c for c in FEATURE_COLS_V5 if c in raw.columns]))[2]


@register("constraint_violations")
def q_constraint_violations(spark, d):
    from pyspark.sql import functions as F
    from churnlab.operators.validate import constraint_violations
    preds = B.predictions(spark, d)
    return constraint_violations(preds, unique=("msno", "period", "model_version", "source"), checks={
        "churn_prob in [0,1]": F.col("churn_prob").between(0, 1),
        "churn_label in {0,1}": F.col("churn_label").isin(0, 1),
        "source in {api,batch}": F.col("source").isin("api", "batch"),
    })


# ---------------------------------------------------------------- EDA
from pyspark.sql import functions as _F  # noqa: E402

from churnlab.functions.columns import clip as _clip  # noqa: E402
from churnlab.schemas import FEATURE_COLS_V5 as _V5  # noqa: E402

# fixed values: bucket edges and labels of the reports
AGE_EDGES, AGE_LABELS = [0, 18, 25, 35, 45, 55, 100], ["<18", "18-25", "25-35", "35-45", "45-55", "55+"]
TENURE_EDGES, TENURE_LABELS = [0, 90, 365, 730, 1095, 1825, 99999], ["<3m", "3-12m", "1-2y", "2-3y", "3-5y", "5y+"]
RECENCY_EDGES, RECENCY_LABELS = [0, 7, 30, 60, 90, 180, 365], ["<1w", "1w-1m", "1-2m", "2-3m", "3-6m", "6m+"]
TX_COUNT_EDGES, TX_COUNT_LABELS = [0, 5, 10, 20, 50, 1_000_000], ["1-5", "6-10", "11-20", "21-50", "50+"]
MIN_GROUP = 20
SUMMARY_COLS = ["n_transactions", "avg_price", "tenure_days", "days_until_expire", "days_since_last_tx", "n_days"]
OUTCOME_COLS = ["n_transactions", "avg_price", "days_until_expire", "n_renewals"]


def _members_labelled(spark, d):
    m = features.member_features(B.members(spark, d), P.prediction_date)
    return eda.label_join(m, B.labels_for(spark, d, P.period))


def _scored_matrix(spark, d):
    """v5 matrix with a transparent recency score standing in for a model output."""
    fm = feature_matrix(spark, d, "v5")
    return fm.withColumn("prob", 1 - 1 / (1 + _F.col("days_since_last_tx") / 30.0))


register("dataset_profile")(lambda spark, d: eda.dataset_profile(_tx(spark, d), "msno", "transaction_date",
                                                                 "transactions"))
@register("price_describe")
def q_price_describe(spark, d):
    from churnlab.session import materialize
    # The moments pass and the exact-quantile pass both read the two price columns: compute the join once.
    cols = ["actual_amount_paid", "plan_list_price"]
    return eda.describe(materialize(_tx(spark, d).select(*cols)), cols)
register("plan_day_counts")(lambda spark, d: eda.value_counts(_tx(spark, d), "payment_plan_days", n=10))
register("gender_counts")(lambda spark, d: eda.value_counts(B.members(spark, d), "gender", dropna=False))
register("tx_overview")(lambda spark, d: eda.tx_overview(_tx(spark, d)))
register("rate_by_city")(lambda spark, d: eda.rate_by(_members_labelled(spark, d), "city", MIN_GROUP))
register("rate_by_registration")(lambda spark, d: eda.rate_by(_members_labelled(spark, d), "registered_via"))
register("rate_by_gender")(lambda spark, d: eda.rate_by(_members_labelled(spark, d), "gender_enc"))
register("rate_by_age")(lambda spark, d: eda.rate_by(
    _members_labelled(spark, d).withColumn("age_group", eda_cut("age", AGE_EDGES, AGE_LABELS)), "age_group"))
register("rate_by_tenure")(lambda spark, d: eda.rate_by(
    _members_labelled(spark, d).withColumn("tenure_bucket", eda_cut("tenure_days", TENURE_EDGES, TENURE_LABELS)),
    "tenure_bucket"))
register("rate_by_recency")(lambda spark, d: eda.rate_by(
    _raw_matrix(spark, d).withColumn("recency_bucket", eda_cut(
        _clip("days_since_last", None, 365), RECENCY_EDGES, RECENCY_LABELS)), "recency_bucket"))
register("rate_by_plan")(lambda spark, d: eda.rate_by(_raw_matrix(spark, d), "last_plan_days", MIN_GROUP))
register("rate_by_payment")(lambda spark, d: eda.rate_by(_raw_matrix(spark, d), "last_payment_method"))
register("top_cities")(lambda spark, d: eda.top_n(eda.rate_by(_members_labelled(spark, d), "city", MIN_GROUP),
                                                  "churn_rate", 15, key="city"))
register("crosstab_cancel")(lambda spark, d: eda.crosstab_pct(_raw_matrix(spark, d), "last_is_cancel"))
register("price_histogram")(lambda spark, d: eda.histogram(_raw_matrix(spark, d), "avg_price", 20, by="is_churn",
                                                           density=True))
register("score_distribution")(lambda spark, d: eda.score_distribution(B.scores(spark, d, "smooth"), "prob"))
register("target_correlation")(lambda spark, d: eda.target_correlation(feature_matrix(spark, d, "v5"), _V5))
register("correlations_all")(lambda spark, d: eda.correlation_matrix(feature_matrix(spark, d, "v5"), sorted(_V5)))


@register("correlation_matrix")
def q_correlation_matrix(spark, d):
    """Correlations among the 15 features that correlate best with the target, chosen from the data."""
    from churnlab.session import materialize
    fm = materialize(feature_matrix(spark, d, "v5"))
    return eda.correlation_matrix(fm, sorted(eda.top_correlated(fm, _V5, n=15)))


register("class_balance")(lambda spark, d: eda.class_balance(B.period_labels(spark, d), by="period"))
register("outcome_profile")(lambda spark, d: eda.outcome_profile(_scored_matrix(spark, d), OUTCOME_COLS))
register("missed_by_tx_bucket")(lambda spark, d: eda.missed_by_bucket(
    _scored_matrix(spark, d), "n_transactions", TX_COUNT_EDGES, TX_COUNT_LABELS))
register("play_depth_medians")(lambda spark, d: eda.column_medians(
    B.user_logs(spark, d), ["num_25", "num_50", "num_75", "num_985", "num_100", "num_unq"]))
register("feature_summary")(lambda spark, d: eda.feature_summary(feature_matrix(spark, d, "v5"), SUMMARY_COLS))
register("key_coverage")(lambda spark, d: eda.key_coverage(B.labels_for(spark, d, P.period), {
    "transactions": _tx(spark, d), "members": B.members(spark, d), "user_logs": B.user_logs(spark, d)}))
register("user_overlap")(lambda spark, d: eda.user_overlap(B.labels_for(spark, d, P.prev_period),
                                                           B.labels_for(spark, d, P.period)))
register("churn_with_without_logs")(lambda spark, d: eda.no_log_users(B.labels_for(spark, d, P.period),
                                                                      B.user_logs(spark, d)))
register("stacked_periods")(lambda spark, d: eda.stack_periods(
    *[B.labels_for(spark, d, p).withColumn("period", _F.lit(p)) for p in ("2000-10", "2000-11", "2000-12")])
    .groupBy("period").agg(_F.count(_F.lit(1)).alias("n"), _F.sum("is_churn").alias("n_churn")))
register("key_intersect")(lambda spark, d: eda.key_intersect(B.labels_for(spark, d, P.prev_period),
                                                             B.members(spark, d)))
register("key_except")(lambda spark, d: eda.key_except(B.members(spark, d), B.labels_for(spark, d, P.period)))
register("top_risk")(lambda spark, d: eda.top_n(
    B.predictions(spark, d).select("msno", "churn_prob", "model_version", "period"), "churn_prob", 20,
    key=["msno", "period", "model_version"]))
register("age_bucket")(lambda spark, d: eda.bucket_counts(_members_labelled(spark, d), "age", AGE_EDGES, AGE_LABELS))
register("tenure_bucket")(lambda spark, d: eda.bucket_counts(_members_labelled(spark, d), "tenure_days",
                                                             TENURE_EDGES, TENURE_LABELS))
register("recency_bucket")(lambda spark, d: eda.bucket_counts(_raw_matrix(spark, d), "days_since_last",
                                                              RECENCY_EDGES, RECENCY_LABELS, upper_clip=365))
register("trimmed_prices")(lambda spark, d: eda.trim_quantiles(_tx(spark, d), "actual_amount_paid", 0.01, 0.99).agg(
    _F.count(_F.lit(1)).alias("n_rows"), _F.min("actual_amount_paid").cast("double").alias("min_paid"),
    _F.max("actual_amount_paid").cast("double").alias("max_paid")))
register("winsorized_counts")(lambda spark, d: eda.value_counts(
    eda.winsorize(_raw_matrix(spark, d), "n_transactions", 0.99), "n_transactions"))


def eda_cut(c, edges, labels):
    from churnlab.functions.columns import cut
    return cut(c, edges, labels)


# ---------------------------------------------------------------- metrics
from churnlab.operators import metrics as M  # noqa: E402
from churnlab.functions import columns as FC  # noqa: E402

EVAL_PERIOD = "1998-06"
PRED_TIE = ("model_version", "l_orderkey", "l_linenumber", "churn_prob")


def _both_scores(spark, d, fn):
    parts = [fn(B.scores(spark, d, k)).select(_F.lit(k).alias("kind"), "*") for k in ("tied", "smooth")]
    return parts[0].unionByName(parts[1])


register("threshold_table")(lambda spark, d: M.threshold_table(B.scores(spark, d, "tied")).select(
    "threshold", "tp", "fp", "fn", "tn"))
register("metric_roc_auc")(lambda spark, d: _both_scores(spark, d, M.roc_auc))
register("metric_pr_auc")(lambda spark, d: _both_scores(spark, d, M.pr_auc))
register("metric_log_loss")(lambda spark, d: _both_scores(spark, d, M.log_loss))
register("roc_points")(lambda spark, d: M.roc_points(B.scores(spark, d, "tied")))
register("pr_points")(lambda spark, d: M.pr_points(B.scores(spark, d, "tied")))
register("best_f1")(lambda spark, d: _both_scores(spark, d, M.best_f1_threshold))
register("classification_report")(lambda spark, d: M.classification_report(B.scores(spark, d, "tied"), thr=0.5))
register("confusion_matrix")(lambda spark, d: M.confusion_matrix(B.scores(spark, d, "tied"), thr=0.5))
register("latest_prediction")(lambda spark, d: M.latest_prediction(
    B.predictions(spark, d), EVAL_PERIOD, tie=PRED_TIE).select(
    "msno", "churn_prob", "model_version", "period", "source", "predicted_at"))
register("eval_join")(lambda spark, d: M.eval_join(B.predictions(spark, d), B.ground_truth(spark, d), EVAL_PERIOD)
                      .groupBy("model_version").agg(_F.count(_F.lit(1)).alias("n"),
                                                    _F.sum("actual_churn").alias("n_churn")))
register("performance_report")(lambda spark, d: M.performance_report(B.predictions(spark, d),
                                                                     B.ground_truth(spark, d), EVAL_PERIOD,
                                                                     tie=PRED_TIE))
register("outcome_counts")(lambda spark, d: B.scores(spark, d, "tied").select(
    FC.confusion_label("label", FC.label_at("prob", 0.5)).alias("result")).groupBy("result").agg(
    _F.count(_F.lit(1)).alias("n")))
register("risk_bands")(lambda spark, d: B.scores(spark, d, "smooth").select(FC.risk_band("prob").alias("band"))
                       .groupBy("band").agg(_F.count(_F.lit(1)).alias("n")))


register("display_bands")(lambda spark, d: B.scores(spark, d, "smooth").select(
    FC.risk_band("prob", FC.DISPLAY_BANDS).alias("band")).groupBy("band").agg(_F.count(_F.lit(1)).alias("n")))


@register("tx_discount")
def q_tx_discount(spark, d):
    tx = _tx(spark, d)
    amount, pct = FC.discount_cols()
    return tx.select("payment_method_id", amount.alias("amt"), pct.alias("pct"),
                     FC.clip(_F.col("payment_plan_days") - 25, 0, 10).alias("clipped_days")).groupBy(
        "payment_method_id").agg(_F.count(_F.lit(1)).alias("n"), _F.sum("amt").cast("double").alias("sum_discount"),
                                 (_F.sum("pct").cast("double") / _F.count("pct")).alias("mean_discount_pct"),
                                 _F.count_if(_F.col("pct").isNull()).alias("n_no_list_price"),
                                 _F.sum("clipped_days").alias("sum_clipped_days"))


# ---------------------------------------------------------------- S8 / S10 round trips
@register("feature_store_roundtrip")
def q_feature_store_roundtrip(spark, d):
    """Upsert the period twice (idempotent) next to another period, read one back."""
    from churnlab.session import materialize
    from churnlab.sources import store
    fm = materialize(feature_matrix(spark, d, "v5"))
    path = store_root_for(spark, "features_monthly")
    import datetime as _dt
    t = _dt.datetime(2000, 12, 1)
    store.upsert_period(fm, path, P.period, t)
    store.upsert_period(fm.where(_F.col("is_churn") == 1), path, P.prev_period, t)
    store.upsert_period(fm, path, P.period, t)
    return store.read_period(spark, path, P.period).drop("computed_at")


@register("predictions_roundtrip")
def q_predictions_roundtrip(spark, d):
    from churnlab.sources import store
    import datetime as _dt
    preds = B.predictions(spark, d).where(_F.col("period") == EVAL_PERIOD).select("msno", "churn_prob", "churn_label")
    path = store_root_for(spark, "predictions")
    t = _dt.datetime(1998, 7, 1)
    store.upsert_predictions(preds, path, EVAL_PERIOD, "v2", "batch", t)
    store.upsert_predictions(preds.where(_F.col("churn_label") == 1), path, EVAL_PERIOD, "v2", "api", t)
    store.upsert_predictions(preds, path, EVAL_PERIOD, "v2", "batch", t)
    return (store.read_predictions(spark, path).where(_F.col("period") == EVAL_PERIOD)
            .groupBy("source").agg(_F.count(_F.lit(1)).alias("n"), _F.sum("churn_label").cast("long").alias("n_pos")))


@register("incremental_log_agg")
def q_incremental_log_agg(spark, d):
    """The log aggregate kept in a store over three runs: first files, later files added, nothing new."""
    from churnlab.sources.log_partials import incremental_log_agg
    root = store_root_for(spark, "incremental_logs")
    logs, cut = B.user_logs(spark, d), (P.log_recent.year * 100 + P.log_recent.month) * 100 + P.log_recent.day
    run = lambda: incremental_log_agg(
        spark, f"{root}/logs", f"{root}/store", P.log_max_date, P.log_recent, P.log_windows)
    logs.where(_F.col("date") < cut).write.parquet(f"{root}/logs/early")
    run()
    logs.where(_F.col("date") >= cut).write.parquet(f"{root}/logs/late")
    run()
    return run()


@register("ground_truth_batches")
def q_ground_truth_batches(spark, d):
    """Outcomes merged from two overlapping batches, the second one twice (a retry); no row lost or doubled."""
    from churnlab.sources import store
    gt, path = B.ground_truth(spark, d), store_root_for(spark, "ground_truth")
    early, late = gt.where(_F.col("msno") % 3 != 0), gt.where(_F.col("msno") % 2 == 0)
    rest = gt.where((_F.col("msno") % 3 == 0) & (_F.col("msno") % 2 != 0))
    for batch in (early, late, late.unionByName(rest), late):
        store.load_ground_truth(batch, path, buckets=1)
    return store.read_ground_truth(spark, path).select("msno", "period", "actual_churn")


@register("appended_predictions")
def q_appended_predictions(spark, d):
    """Predictions of two moments, the first one appended twice (a retry), counted by moment and label."""
    from churnlab.sources import store
    preds = B.predictions(spark, d).where(_F.col("period") == EVAL_PERIOD).groupBy("msno").agg(
        _F.max("churn_prob").alias("churn_prob"), _F.max("churn_label").alias("churn_label"))
    path = store_root_for(spark, "api_predictions")
    one, two = _dt.datetime(1998, 6, 20, 10), _dt.datetime(1998, 6, 20, 11)
    for at in (one, two, one):
        store.append_predictions(preds, path, "api", "v2", at, buckets=4)
    return store.read_predictions(spark, path).groupBy(_F.hour("predicted_at").alias("hour"), "churn_label").agg(
        _F.count(_F.lit(1)).alias("n"))


@register("period_as_of_commit")
def q_period_as_of_commit(spark, d):
    """A period replaced twice, read at each commit: older states stay whole."""
    from churnlab.sources import snapshots, store
    labels = B.labels_for(spark, d, P.period)
    path = store_root_for(spark, "features_versions")
    t = _dt.datetime(2000, 12, 1)
    store.upsert_period(labels, path, P.period, t)
    store.upsert_period(labels.where(_F.col("is_churn") == 0), path, P.prev_period, t)
    store.upsert_period(labels.where(_F.col("is_churn") == 1), path, P.period, t)
    commits = snapshots.SnapshotTable(spark, path).versions()
    return MON.union_all([store.read_period(spark, path, P.period, version=n).groupBy("is_churn").agg(
        _F.count(_F.lit(1)).alias("n")).select(_F.lit(n).alias("commit_no"), "is_churn", "n") for n in commits])


def store_root_for(spark, name):
    from churnlab.sources.store import store_root
    return store_root(spark, name, unique=True)


# ---------------------------------------------------------------- monitoring (D, G, K2, K3, T3, T14)
import datetime as _dt  # noqa: E402

from churnlab.operators import monitor as MON  # noqa: E402

# The month the models are trained on is the baseline of every drift report.
DRIFT_BASELINE, DRIFT_PERIOD, DRIFT_HISTORY = P.period, "2001-01", ("2000-11", "2001-01")
NOW = _dt.datetime(1998, 6, 20, 12, 0, 0)


def _baseline(spark, matrix):
    """Profile of the baseline month's feature matrix, written once; returns its place."""
    path = store_root_for(spark, "drift_baseline")
    MON.write_baseline(matrix, _V5, path)
    return path


def _drift(spark, d, period=DRIFT_PERIOD):
    """All 47 features of a month against the stored baseline profile."""
    months = _matrices(spark, d, (DRIFT_BASELINE, period))
    return MON.drift_from_baseline(months[period], _V5, _baseline(spark, months[DRIFT_BASELINE]))


def _perf(spark, d):
    return M.performance_report(B.predictions(spark, d), B.ground_truth(spark, d), EVAL_PERIOD, tie=PRED_TIE)


def _stored_drift(spark, d):
    """Drift reports of the months, appended one after the other to a report table and read from it."""
    from churnlab.sources import store
    months = _matrices(spark, d, (DRIFT_BASELINE, *DRIFT_HISTORY))
    path, baseline = store_root_for(spark, "drift_reports"), _baseline(spark, months[DRIFT_BASELINE])
    for p in DRIFT_HISTORY:
        drift = MON.drift_from_baseline(months[p], _V5, baseline)
        store.append_drift_report(MON.drift_score(drift).select(
            _F.lit(p).alias("period"), "drift_score", "dataset_drift"), path)
    return store.read_drift_reports(spark, path)


register("drift_by_column")(lambda spark, d: _drift(spark, d))
register("drift_score")(lambda spark, d: MON.drift_score(_drift(spark, d)))
register("drift_history")(lambda spark, d: _stored_drift(spark, d))
register("latest_drift")(lambda spark, d: MON.latest_drift(_stored_drift(spark, d)))
register("alerts")(lambda spark, d: MON.alerts(MON.drift_score(_drift(spark, d, EVAL_PERIOD)), _perf(spark, d)))
register("period_summary")(lambda spark, d: MON.period_summary(
    EVAL_PERIOD, MON.drift_score(_drift(spark, d, EVAL_PERIOD)), _perf(spark, d)))
register("pred_volume")(lambda spark, d: MON.pred_volume(B.predictions(spark, d), NOW))
register("daily_churn_rate")(lambda spark, d: MON.daily_churn_rate(B.predictions(spark, d), NOW))
register("mean_probability")(lambda spark, d: MON.mean_probability(B.predictions(spark, d), NOW))
register("latest_version")(lambda spark, d: MON.latest_version(B.predictions(spark, d)))
register("hourly_by_source")(lambda spark, d: MON.hourly_by_source(B.predictions(spark, d), NOW))
register("today_totals")(lambda spark, d: MON.today_totals(B.predictions(spark, d), NOW))
register("daily_series")(lambda spark, d: MON.daily_series(B.predictions(spark, d), NOW))
register("recent_predictions")(lambda spark, d: MON.recent_predictions(
    B.predictions(spark, d).where(_F.col("predicted_at") <= _F.lit(NOW)).select(
        "msno", "churn_prob", "model_version", "source", "predicted_at"), 50,
    tie=("msno", "model_version", "source", "churn_prob")))
register("class_weights")(lambda spark, d: MON.class_weights(B.labels_for(spark, d, P.period)))
register("quality_gate")(lambda spark, d: MON.quality_gate(
    _both_scores(spark, d, M.log_loss).join(_both_scores(spark, d, M.roc_auc), "kind"), min_auc=0.5))


# ---------------------------------------------------------------- MLlib (rows-only checks), sampling, streaming
from churnlab.operators import models as ML  # noqa: E402
from churnlab.sources.readers import keyed_sample  # noqa: E402

NEXT_PERIOD = "2001-01"


@register("split")
def q_split(spark, d):
    tr, te = ML.split(feature_matrix(spark, d, "v5"))
    return (tr.select(_F.lit("train").alias("part"), "is_churn").unionByName(
        te.select(_F.lit("test").alias("part"), "is_churn")).groupBy("part", "is_churn")
        .agg(_F.count(_F.lit(1)).alias("n")))
register("stratified_folds")(lambda spark, d: ML.stratified_folds(B.labels_for(spark, d, P.period), 5)
                             .groupBy("fold", "is_churn").agg(_F.count(_F.lit(1)).alias("n")))
register("log_sample")(lambda spark, d: keyed_sample(
    B.user_logs(spark, d), "msno", 0.5).groupBy("msno").agg(_F.count(_F.lit(1)).alias("n_days")))


def _fitted(tr):
    """The three models, weighted by the classes of their training part."""
    from churnlab.session import materialize
    tr = materialize(ML.with_class_weight(tr))
    return {"lr": ML.lr_pipeline(_V5).fit(tr), "gbt": ML.gbt_pipeline(_V5, max_iter=10, max_depth=4).fit(tr),
            "rf": ML.rf_pipeline(_V5, num_trees=20, max_depth=6).fit(tr)}


def _split_scored(spark, d):
    """Test part with a score column per model, all on one DataFrame."""
    from churnlab.session import materialize
    tr, te = ML.split(materialize(feature_matrix(spark, d, "v5")))
    te = te.select("msno", "is_churn", *_V5)
    for n, m in _fitted(tr).items():
        te = ML.add_score(m, te, f"p_{n}")
    return materialize(te.select("msno", "is_churn", "p_lr", "p_gbt", "p_rf"))


def _score_checks(scored, prob, ev=None):
    """What holds for any model: every row scored, scores in [0, 1], label = score >= 0.5, metrics in range."""
    p = _F.col(prob)
    one = scored.agg(_F.count(_F.lit(1)).alias("n"), _F.count_if(p.between(0, 1)).alias("n_in_range"),
                     _F.count_if(FC.label_at(prob, 0.5) == (p >= 0.5).cast("int")).alias("n_label_ok"))
    ev = ML.evaluate(scored, prob=prob) if ev is None else ev
    return one.crossJoin(ev).select("n", "n_in_range", "n_label_ok", _F.col("roc_auc").between(0, 1).alias("auc_ok"),
                                    (_F.col("log_loss") >= 0).alias("log_loss_ok"))


@register("train_eval")
def q_train_eval(spark, d):
    te = _split_scored(spark, d)
    return MON.union_all([_score_checks(te, f"p_{n}").select(_F.lit(n).alias("model"), "*")
                          for n in ("lr", "gbt", "rf")])


@register("blend_scores")
def q_blend_scores(spark, d):
    b = ML.blend(_split_scored(spark, d), ["p_lr", "p_gbt", "p_rf"])
    mean = (_F.col("p_lr") + _F.col("p_gbt") + _F.col("p_rf")) / 3
    same = b.agg(_F.count_if(_F.abs(_F.col("prob") - mean) < 1e-12).alias("n_mean_ok"))
    return _score_checks(b, "prob").crossJoin(same).select(_F.lit("blend3").alias("model"), "*")


@register("tree_importance")
def q_tree_importance(spark, d):
    """Gain importance and splits of all 47 features in boosted trees fitted on the month."""
    from churnlab.session import materialize
    fm = materialize(ML.with_class_weight(feature_matrix(spark, d, "v5")))
    return ML.tree_importance(ML.gbt_pipeline(_V5, max_iter=10, max_depth=4).fit(fm), _V5)


@register("temporal_validate")
def q_temporal_validate(spark, d):
    """Fit on the previous month and evaluate on the current one; refit on both and score the next.

    The metrics themselves come from ``ML.temporal_validate``; rows of the phase ``evaluate`` count as in range only
    if the scores' labels and metrics hold too.
    """
    from churnlab.session import materialize
    fit = lambda df: ML.gbt_pipeline(_V5, max_iter=10, max_depth=4).fit(ML.with_class_weight(df))
    months = _matrices(spark, d, (P.prev_period, P.period, NEXT_PERIOD))
    prev, cur = materialize(months[P.prev_period]), materialize(months[P.period])
    scored, metrics, upcoming = ML.temporal_validate(fit, prev, cur, months[NEXT_PERIOD])
    holds = (_F.col("n_label_ok") == _F.col("n")) & _F.col("auc_ok") & _F.col("log_loss_ok")
    evaluated = _score_checks(scored, "prob", metrics).select(
        "n", _F.when(holds, _F.col("n_in_range")).otherwise(0).alias("n_in_range"))
    after = upcoming.agg(_F.count(_F.lit(1)).alias("n"),
                         _F.count_if(_F.col("prob").between(0, 1)).alias("n_in_range"))
    return MON.union_all([part.select(_F.lit(phase).alias("phase"), _F.lit(period).alias("eval_period"), "*")
                          for phase, period, part in (("evaluate", P.period, evaluated),
                                                      ("next", NEXT_PERIOD, after))])


@register("prediction_rate_stream")
def q_prediction_rate_stream(spark, d):
    from churnlab.sources.store import store_root
    from churnlab.streaming.scoring import final_rates, prediction_rate_stream
    root = store_root(spark, "rate_stream", unique=True)
    preds = B.predictions(spark, d).select("source", _F.col("predicted_at").cast("timestamp").alias("predicted_at"))
    preds.write.parquet(f"{root}/src")
    prediction_rate_stream(spark, f"{root}/src", preds.schema, f"{root}/out", f"{root}/ckpt")
    return final_rates(spark, f"{root}/out")


@register("score_stream")
def q_score_stream(spark, d):
    """Valid rows scored, the others in the rejects; raw (not imputed) rows, so both kinds occur."""
    from churnlab.session import materialize
    from churnlab.sources.store import store_root
    from churnlab.operators.assemble import impute_matrix
    from churnlab.streaming.scoring import score_stream
    root = store_root(spark, "score_stream", unique=True)
    raw = materialize(_raw_matrix(spark, d))  # read by the fit and by the stream's source
    model = ML.lr_pipeline(_V5).fit(ML.with_class_weight(materialize(impute_matrix(raw, "v5"))))
    cancel = ((_F.col("last_is_cancel") == 1) & (_F.col("days_until_expire") > 0)).cast("int")
    feats = raw.withColumn("cancel_before_expire", cancel).select(
        "msno", *[_F.col(c).cast("double").alias(c) for c in _V5])
    feats.write.parquet(f"{root}/src")
    score_stream(spark, model, f"{root}/src", feats.schema, _V5, f"{root}/out", f"{root}/ckpt", "v1")
    ok = spark.read.schema("msno long, churn_prob float, churn_label short").parquet(f"{root}/out").select(
        "msno", _F.lit("scored").alias("status"),
        (_F.col("churn_prob").between(0, 1) & (_F.col("churn_label") == (_F.col("churn_prob") >= 0.5).cast("int")))
        .alias("ok"))
    bad = spark.read.schema("msno long, failed_rules array<string>").parquet(f"{root}/out_rejects").select(
        "msno", _F.lit("rejected").alias("status"), (_F.size("failed_rules") > 0).alias("ok"))
    return ok.unionByName(bad)


@register("tenure_years")
def q_tenure_years(spark, d):
    """P10: members per tenure in years (one decimal, half-even), with churn rate."""
    m = _members_labelled(spark, d).select(FC.tenure_years("tenure_days").alias("tenure_years"), "is_churn")
    return m.groupBy("tenure_years").agg(_F.count(_F.lit(1)).alias("n"), _F.sum("is_churn").cast("long").alias("n_churn"))
