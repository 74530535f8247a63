"""Logical schemas and the feature catalogue.

Fixed values: feature names, their order and the validation rule tables must
equal the reference's so that stored tables and trained models line up.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: feature column order (30 base, then v4, then v5 additions) ----
FEATURE_COLS_V1 = [
    "n_transactions", "n_cancels", "ever_canceled",
    "avg_discount_pct", "avg_plan_days", "avg_price",
    "n_unique_plans", "n_payment_methods",
    "last_is_cancel", "last_is_auto_renew",
    "last_plan_days", "last_price", "last_list_price",
    "price_trend", "last_payment_method",
    "city", "registered_via", "gender_enc",
    "age", "bd_valid", "tenure_days",
    "has_member_record",
    "n_days", "avg_daily_secs", "avg_daily_completed",
    "avg_daily_unq", "completion_ratio",
    "days_since_last", "listening_trend",
    "has_log_record",
]
EXPIRY_LAG_COLS = [
    "days_until_expire", "is_expired", "auto_renew_at_expire",
    "cancel_at_expire", "n_renewals", "prev_churn",
]
TX_RECENCY_COLS = ["days_since_last_tx", "had_tx_last_7d", "had_tx_last_30d", "n_tx_last_30d"]
MULTIWINDOW_COLS = [
    "n_days_7d", "secs_per_day_7d",
    "n_days_90d", "secs_per_day_90d",
    "trend_7d", "trend_7d_vs_30d",
]
FEATURE_COLS_V4 = FEATURE_COLS_V1 + EXPIRY_LAG_COLS
FEATURE_COLS_V5 = FEATURE_COLS_V4 + TX_RECENCY_COLS + ["cancel_before_expire"] + MULTIWINDOW_COLS
FEATURE_SETS = {"v1": FEATURE_COLS_V1, "v4": FEATURE_COLS_V4, "v5": FEATURE_COLS_V5}

# ---- fixed values: validation rules ----
RANGE_CHECKS = {
    "age": (0, 120),
    "completion_ratio": (0, 1),
    "avg_discount_pct": (0, 1),
}
BINARY_COLS = [
    "ever_canceled", "last_is_cancel", "last_is_auto_renew",
    "bd_valid", "has_member_record", "has_log_record",
    "is_expired", "auto_renew_at_expire", "cancel_at_expire",
    "prev_churn", "cancel_before_expire", "had_tx_last_7d", "had_tx_last_30d",
]
# Request contract bounds (column -> (lo, hi), None = open).
NON_NEGATIVE = [
    "n_transactions", "n_cancels", "avg_plan_days", "avg_price", "n_unique_plans",
    "n_payment_methods", "last_plan_days", "last_price", "last_list_price",
    "last_payment_method", "city", "registered_via", "tenure_days", "n_days",
    "avg_daily_secs", "avg_daily_completed", "avg_daily_unq", "days_since_last",
    "n_renewals", "days_since_last_tx", "n_tx_last_30d", "n_days_7d", "secs_per_day_7d",
    "n_days_90d", "secs_per_day_90d",
]
UNIT_INTERVAL = ["avg_discount_pct", "completion_ratio"]
CONTRACT_BOUNDS = {
    **{c: (0.0, None) for c in NON_NEGATIVE},
    **{c: (0.0, 1.0) for c in UNIT_INTERVAL},
    **{c: (0.0, 1.0) for c in BINARY_COLS},
    "gender_enc": (0.0, 2.0),
    "age": (0.0, 120.0),
}
# Integer-valued contract columns (binary flags, codes).
CONTRACT_INT_COLS = BINARY_COLS + ["last_payment_method", "city", "registered_via", "gender_enc"]

# ---- fixed values: gender and segment codes ----
GENDER_CODES = {"male": 0, "female": 1, "unknown": 2}
SONG_COLS = ["num_25", "num_50", "num_75", "num_985", "num_100"]
MAX_SECS = 86400

# ---- raw source schemas (CSV inputs of the real data) ----
TRANSACTIONS = T.StructType([
    T.StructField("msno", T.StringType()),
    T.StructField("payment_method_id", T.IntegerType()),
    T.StructField("payment_plan_days", T.IntegerType()),
    T.StructField("plan_list_price", T.IntegerType()),
    T.StructField("actual_amount_paid", T.IntegerType()),
    T.StructField("is_auto_renew", T.IntegerType()),
    T.StructField("transaction_date", T.IntegerType()),
    T.StructField("membership_expire_date", T.IntegerType()),
    T.StructField("is_cancel", T.IntegerType()),
])
USER_LOGS = T.StructType([
    T.StructField("msno", T.StringType()),
    T.StructField("date", T.IntegerType()),
    *[T.StructField(c, T.IntegerType()) for c in ["num_25", "num_50", "num_75", "num_985", "num_100", "num_unq"]],
    T.StructField("total_secs", T.DoubleType()),
])
MEMBERS = T.StructType([
    T.StructField("msno", T.StringType()),
    T.StructField("city", T.IntegerType()),
    T.StructField("bd", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("registered_via", T.IntegerType()),
    T.StructField("registration_init_time", T.IntegerType()),
])
LABELS = T.StructType([
    T.StructField("msno", T.StringType()),
    T.StructField("is_churn", T.IntegerType()),
])
SUBMISSION = T.StructType([
    T.StructField("msno", T.StringType()),
    T.StructField("is_churn", T.DoubleType()),
])
RAW_SCHEMAS = {
    "transactions": TRANSACTIONS, "transactions_v2": TRANSACTIONS,
    "user_logs": USER_LOGS, "user_logs_v2": USER_LOGS,
    "members_v3": MEMBERS, "members": MEMBERS,
    "train": LABELS, "train_v2": LABELS,
    "sample_submission_v2": SUBMISSION,
}
