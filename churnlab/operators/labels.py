"""Churn labelling (W1-W3) with aggregates and one join, no UDF.

Transactions of a user are ordered by: date ascending; plan signature
(list price, plan days and payment method concatenated as text) descending;
subscriptions before cancellations; subscriptions by expiry ascending;
cancellations by expiry descending. This order is one sort key, built from
built-in expressions, so "last row" and "first row" are plain max / min
aggregates with map-side partial aggregation: a user with a huge history
never has to be gathered into one array or one sorted task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.functions.columns import desc_text_key, parse_yyyymmdd
from churnlab.plans.periods import LabelWindow, ymd
from churnlab.session import materialize

SALTS = 16  # tasks a user's groups are dealt to in the labeller's join
NO_RENEWAL_GAP = 9999  # fixed value: gap reported when no renewal follows


def plan_signature() -> Column:
    """Plan text: list price, plan days and payment method concatenated without a separator."""
    return F.concat(F.col("plan_list_price").cast("string"), F.col("payment_plan_days").cast("string"),
                    F.col("payment_method_id").cast("string"))


def order_key() -> Column:
    """Ascending sort key of the labeller's transaction order."""
    exp = F.col("membership_expire_date")
    return F.struct(
        F.col("transaction_date").alias("d"),
        desc_text_key(plan_signature()).alias("s"),
        F.col("is_cancel").alias("c"),
        F.when(F.col("is_cancel") == 1, -exp).otherwise(exp).alias("e"),
    )


def last_expire(tx: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Expiry date (yyyymmdd) on the last history transaction of each user."""
    h = tx.where((F.col("transaction_date") >= ymd(start)) & (F.col("transaction_date") <= ymd(end)))
    return h.groupBy("msno").agg(F.max_by(F.col("membership_expire_date"), order_key()).alias("last_expire"))


def renewal_groups(future: DataFrame) -> DataFrame:
    """One row per (user, date, plan text): whether it has a renewal, and its least cancel expiry."""
    keys = order_key()
    return (future.select("msno", "is_cancel", "membership_expire_date", keys["d"].alias("d"), keys["s"].alias("s"))
            .groupBy("msno", "d", "s").agg(
                F.max(F.coalesce(F.col("is_cancel") == 0, F.lit(False))).alias("renews"),
                F.min(F.when(F.col("is_cancel") == 1, F.col("membership_expire_date"))).alias("cancel_min")))


def renewal_gap(candidates: DataFrame, future: DataFrame, salts: int = SALTS) -> DataFrame:
    """Days from the (possibly cancel-shortened) expiry to the first renewal.

    Walking a user's future transactions in order, cancellations can only move
    the expiry earlier; the first non-cancel transaction ends the walk. So the
    gap is ``first_renewal_date - least(last_expire, min(expiry of cancels
    ordered before that renewal))``; no renewal -> 9999. Users without any
    future transaction are not in the output (they have no activity).

    Within one (date, plan text) subscriptions come before cancellations, so the rows of a user are first reduced to
    one per (user, date, plan text): whether it has a renewal, and its least cancel expiry. That aggregate is spread
    by all three, so a user with a third of the rows fills many tasks. The walk then needs the first group with a
    renewal (a partial aggregate) and the cancels of earlier groups; that join is dealt by (user, salt, ``salts`` of
    them), and the aggregate after it combines map-side. The groups are read twice, so they are written once.
    """
    g = materialize(renewal_groups(future))
    first = g.groupBy("msno").agg(F.min(F.when(F.col("renews"), F.struct("d", "s"))).alias("k0"))
    users = candidates.select("msno", "last_expire").join(first, "msno").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    j = g.withColumn("salt", F.pmod(F.xxhash64("d", "s"), F.lit(salts)).cast("int")).join(users, ["msno", "salt"])
    earlier = F.col("k0").isNull() | (F.struct("d", "s") < F.col("k0"))
    out = j.groupBy("msno", "last_expire", "k0").agg(F.min(F.when(earlier, F.col("cancel_min"))).alias("cancel_min"))
    shortened = F.least(F.col("last_expire"), F.coalesce(F.col("cancel_min"), F.col("last_expire")))
    gap = F.datediff(parse_yyyymmdd(F.col("k0.d"), strict=True), parse_yyyymmdd(shortened, strict=True))
    return out.select("msno", "last_expire",
                      F.when(F.col("k0").isNull(), F.lit(NO_RENEWAL_GAP)).otherwise(gap).alias("gap"))


def churn_labels(tx: DataFrame, w: LabelWindow) -> DataFrame:
    """Candidates whose last expiry falls in the target month; churn when no
    activity follows or the renewal gap is at least ``grace`` days. The payments are read once for either side."""
    cands = materialize(last_expire(tx, w.hist_start, w.hist_end).where(
        F.col("last_expire").between(ymd(w.target_start), ymd(w.target_end))))
    future = tx.where(F.col("transaction_date") > ymd(w.hist_end))
    gaps = renewal_gap(cands, future)
    j = cands.join(gaps.select("msno", "gap"), "msno", "left")
    return j.select("msno", (F.col("gap").isNull() | (F.col("gap") >= w.grace)).cast("int").alias("is_churn"))
