"""Feature-matrix assembly (J1, J2, J8, P12) for the 30 / 36 / 47-column sets.

Plan: every source is first reduced to one row per user (transactions in one
fused aggregate, logs in one aggregate, members as is), then left-joined to the
labelled users on ``msno``. The per-user aggregates come out hash-partitioned
on ``msno``, so the joins mostly reuse that partitioning; AQE turns any side
that is small at run time into a broadcast (its size is measured, not assumed).
All medians for imputation are computed in one distributed pass.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.operators import features as FT
from churnlab.operators.impute import V5_CONSTANTS, V5_MEDIAN, impute
from churnlab.schemas import FEATURE_SETS
from churnlab.session import materialize

FLAG_COLS = ["has_member_record", "has_log_record"]


def prev_label_join(users: DataFrame, prev_labels: DataFrame) -> DataFrame:
    """Previous period's label as ``prev_churn`` (no previous label -> NULL, imputed 0)."""
    return users.join(prev_labels.select("msno", F.col("is_churn").alias("prev_churn")), "msno", "left")


def assemble_raw(users: DataFrame, tx: DataFrame, logs: DataFrame, members: DataFrame,
                 prev_labels: DataFrame | None, cfg, tie_cols: Sequence[str] = ()) -> DataFrame:
    """Left-joined, not yet imputed matrix with coverage flags (flags are set before imputing)."""
    return _join_sources(users, FT.transaction_features(tx, cfg, tie_cols), logs, members, prev_labels, cfg)


def assemble_labelled(tx: DataFrame, logs: DataFrame, members: DataFrame, cfg, prev_start: dt.date,
                      tie_cols: Sequence[str] = ()) -> DataFrame:
    """As ``assemble_raw``, with the labels taken from the transactions in the same scan and shuffle."""
    base = FT.labelled_transaction_features(tx, cfg, prev_start, tie_cols)
    return _join_sources(base, None, logs, members, None, cfg)


def assemble_months(tx: DataFrame, logs: DataFrame, members: DataFrame, cfgs: Sequence, prev_starts: Sequence[dt.date],
                    tie_cols: Sequence[str] = (), by_user: bool = False) -> list[DataFrame]:
    """``assemble_labelled`` for several months, in the order of ``cfgs``, from one pass over payments and logs.

    ``by_user``: a user's payments lie in one partition already.

    The months' transaction features and the daily logs are written once; each month takes its own rows of them.
    """
    base = materialize(FT.monthly_transaction_features(tx, cfgs, prev_starts, tie_cols, by_user))
    logs = materialize(logs)
    return [_join_sources(base.where(F.col("period") == cfg.period).drop("period"), None, logs, members, None, cfg)
            for cfg in cfgs]


def _join_sources(users: DataFrame, txf: DataFrame | None, logs: DataFrame, members: DataFrame,
                  prev_labels: DataFrame | None, cfg) -> DataFrame:
    memf = FT.member_features(members, cfg.prediction_date)
    agg = FT.log_user_agg(logs, cfg.log_max_date, cfg.log_recent, cfg.log_windows)
    logf = agg.select("msno", *FT.log_feature_exprs(cfg.log_ref_date), *FT.multiwindow_exprs())
    df = users if txf is None else users.join(txf, "msno", "left")
    df = df.join(memf, "msno", "left").join(logf, "msno", "left")
    if prev_labels is not None:
        df = prev_label_join(df, prev_labels)
    elif "prev_churn" in users.columns:
        pass  # the label source already carries the previous period's label
    else:
        df = df.withColumn("prev_churn", F.lit(None).cast("int"))
    return (df.withColumn("has_member_record", F.col("city").isNotNull().cast("int"))
              .withColumn("has_log_record", F.col("n_days").isNotNull().cast("int")))


def impute_matrix(raw: DataFrame, feature_set: str = "v5", fit_on: DataFrame | None = None) -> DataFrame:
    """I1 + I2 and the final flag, then the feature columns in catalogue order (as double)."""
    cols = FEATURE_SETS[feature_set]
    base_cols = FEATURE_SETS["v1"]
    median_cols = [c for c in base_cols if c not in FLAG_COLS and c != "n_days"]
    constants = {"n_days": 0}
    if feature_set != "v1":
        median_cols += [c for c in V5_MEDIAN if c in cols]
        constants.update({k: v for k, v in V5_CONSTANTS.items() if k in cols})
    keep = ["msno", "is_churn"] + [c for c in cols if c != "cancel_before_expire"]
    keep = [c for c in keep if c in raw.columns]
    # The raw matrix feeds the median pass and the fill: compute it once.
    raw = materialize(raw.select(*keep))
    df = impute(raw, median_cols, constants, fit_on=fit_on)
    if "cancel_before_expire" in cols:
        df = df.withColumn("cancel_before_expire",
                           ((F.col("last_is_cancel") == 1) & (F.col("days_until_expire") > 0)).cast("int"))
    return df.select("msno", "is_churn", *[F.col(c).cast("double").alias(c) for c in cols])


def assemble_features(users: DataFrame, tx: DataFrame, logs: DataFrame, members: DataFrame,
                      prev_labels: DataFrame | None, cfg, feature_set: str = "v5",
                      tie_cols: Sequence[str] = ()) -> DataFrame:
    """Labelled users -> imputed 30 / 36 / 47-column feature matrix."""
    raw = assemble_raw(users, tx, logs, members, prev_labels, cfg, tie_cols)
    return impute_matrix(raw, feature_set)
