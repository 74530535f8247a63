"""Imputation (I1, I2) and the null report.

Medians are exact (pandas midpoint rule) and computed in one distributed
pass for all columns (``operators.quantiles``). The single median row is
broadcast and applied with ``coalesce`` - no per-column jobs, no collect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.operators.quantiles import exact_medians_row
from churnlab.schemas import MULTIWINDOW_COLS

MEMBER_IMPUTE = ["city", "registered_via", "gender_enc", "age", "bd_valid", "tenure_days"]
LOG_ZERO = ["n_days"]
LOG_MEDIAN = ["avg_daily_secs", "avg_daily_completed", "avg_daily_unq", "completion_ratio",
              "days_since_last", "listening_trend"]
NEVER_IMPUTE = ["msno", "is_churn", "has_member_record", "has_log_record"]
# fixed values: constants of the second imputation stage
V5_CONSTANTS = {
    "is_expired": 1, "auto_renew_at_expire": 0, "cancel_at_expire": 0, "n_renewals": 0, "prev_churn": 0,
    "had_tx_last_7d": 0, "had_tx_last_30d": 0, "n_tx_last_30d": 0,
    **{c: 0 for c in MULTIWINDOW_COLS},
}
V5_MEDIAN = ["days_until_expire", "days_since_last_tx"]


def _apply(df: DataFrame, medians: DataFrame | None, median_cols: Sequence[str], constants: dict) -> DataFrame:
    m = None
    if median_cols:
        m = medians.select(*[F.col(c).alias(f"__med_{c}") for c in median_cols])
        df = df.crossJoin(F.broadcast(m))
    out = []
    for c in df.columns:
        if c.startswith("__med_"):
            continue
        if c in constants:
            out.append(F.coalesce(F.col(c).cast("double"), F.lit(float(constants[c]))).alias(c))
        elif c in median_cols:
            out.append(F.coalesce(F.col(c).cast("double"), F.col(f"__med_{c}"), F.lit(0.0)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def impute(df: DataFrame, median_cols: Sequence[str], constants: dict,
           fit_on: DataFrame | None = None) -> DataFrame:
    """Fill NULLs: ``constants`` by value, ``median_cols`` by the exact median of
    ``fit_on`` (default: ``df`` itself); a column without any value is filled with 0."""
    med_cols = [c for c in median_cols if c in df.columns and c not in constants]
    medians = exact_medians_row(fit_on if fit_on is not None else df, med_cols) if med_cols else None
    return _apply(df, medians, med_cols, {k: v for k, v in constants.items() if k in df.columns})


def impute_base(df: DataFrame, fit_on: DataFrame | None = None, extra_exclude: Sequence[str] = ()) -> DataFrame:
    """Member and log-rate columns and every other feature -> median, ``n_days`` -> 0.

    Each column's median depends only on its own non-NULL values, so the
    reference's sequential fills equal one simultaneous fill.
    """
    skip = set(NEVER_IMPUTE) | set(LOG_ZERO) | set(extra_exclude)
    med = [c for c in df.columns if c not in skip]
    return impute(df, med, {c: 0 for c in LOG_ZERO}, fit_on)


def impute_v5(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Expiry / recency medians; ``is_expired`` -> 1; flags, counts and windows -> 0."""
    return impute(df, V5_MEDIAN, V5_CONSTANTS, fit_on)


def null_report(df: DataFrame, cols: Sequence[str] | None = None, top: int | None = None) -> DataFrame:
    """NULL count and share per column (one aggregate pass, unpivoted); ``top``: the most NULLs first."""
    cols = list(cols or [c for c in df.columns])
    one = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.select("__n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in cols])).alias("r"))
    out = long.select("r.column", "r.n_null",
                      F.when(F.col("__n") > 0, F.round(F.col("r.n_null") / F.col("__n") * 100, 4)).alias("pct_null"))
    return out if top is None else out.orderBy(F.desc("n_null"), "column").limit(top)
