"""Point-in-time feature builders: one row per user from each raw source.

Transactions: A1 profile, A2 first/last attributes, A8 expiry, A9 recency are
aggregate expressions over the same ``groupBy('msno')`` and can be fused into
one shuffle (``transaction_features``). Logs: A3/A5 are conditional sums in a
single pass (hash aggregate, partial aggregation map-side), A6/A7 are
projections of that aggregate. Members: P7 is a projection.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

from churnlab.functions.columns import clip, parse_yyyymmdd, row_sum, safe_ratio
from churnlab.plans.periods import ymd
from churnlab.schemas import MAX_SECS, SONG_COLS


def _as_of(tx: DataFrame, as_of: dt.date | None) -> DataFrame:
    """Drop transactions after the cutoff (pushed to the scan as an int filter)."""
    return tx if as_of is None else tx.where(F.col("transaction_date") <= ymd(as_of))


# A user's state: how its rows become it. Merge: the states up to a row of a window as one.
States = dict[str, Column]
Merge = Callable[[Column, WindowSpec], Column]


def _parsed(tx: DataFrame, c: str) -> Column:
    return parse_yyyymmdd(c, kind=tx.schema[c].dataType)


def _states_of(tx: DataFrame, states: States, *by: str) -> DataFrame:
    return tx.groupBy(*by).agg(*[rows.alias(n) for n, rows in states.items()])


def _prepared(tx: DataFrame, tie_cols: Sequence[str]) -> DataFrame:
    """``tx`` with what several states of A1 + A2 take from a row, worked out once a row, ahead of the aggregate."""
    disc = safe_ratio(F.col("plan_list_price") - F.col("actual_amount_paid"), F.col("plan_list_price"))
    return tx.withColumns({"_order": F.struct(*_order_cols(tie_cols)), "_discount": disc.cast("decimal(18,8)")})


# ---------------------------------------------------------------- A1 + A2
# "last" attributes: output name -> source column
LAST_COLS = {
    "last_is_cancel": "is_cancel",
    "last_is_auto_renew": "is_auto_renew",
    "last_plan_days": "payment_plan_days",
    "_last_paid": "actual_amount_paid",
    "_last_list": "plan_list_price",
    "last_payment_method": "payment_method_id",
}


def _order_cols(tie_cols: Sequence[str]) -> list[Column]:
    """Total order of a user's transactions: date, then the tie-break columns."""
    return [F.col(c).alias(f"k{i}") for i, c in enumerate(("transaction_date", *tie_cols))]


def profile_states() -> States:
    """States of A1 + A2 for one ``groupBy`` of ``_prepared`` rows: one pass, no second look at any row.

    The "last" attributes are pandas ``last``: of the latest row where that column is not NULL. One greatest row holds
    them all for the rows without NULLs in them; a row with a NULL counts for its other columns one by one. So a user's
    state holds the order of three rows, not of one row a column, and rows with NULLs need no second pass.
    """
    key = F.col("_order").alias("key")
    cols = list(LAST_COLS.values())
    whole = F.lit(True)
    for c in cols:
        whole = whole & F.col(c).isNotNull()
    only = lambda c: F.when(~whole & F.col(c).isNotNull(), F.struct(key, F.col(c).alias("v")))
    return {
        "n_transactions": F.count(F.lit(1)),
        "n_cancels": F.sum("is_cancel"),
        "ever_canceled": F.max("is_cancel"),
        "_disc": F.sum("_discount"),
        "_n_disc": F.count("_discount"),
        "_days": F.sum("payment_plan_days"),
        "_n_days": F.count("payment_plan_days"),
        "_paid": F.sum("actual_amount_paid"),
        "_n_paid": F.count("actual_amount_paid"),
        # Distinct counts through sets: no Expand (which would triple the rows
        # before the aggregate); a set is bounded by the value domain
        # (plan lengths, payment methods), not by the user's row count.
        "_plans": F.collect_set("payment_plan_days"),
        "_methods": F.collect_set("payment_method_id"),
        "_row": F.max(F.when(whole, F.struct(key, *[F.col(c).alias(f"v_{c}") for c in cols]))),
        **{f"_row_{c}": F.max(only(c)) for c in cols},
        "_first": F.min(F.when(F.col("actual_amount_paid").isNotNull(),
                               F.struct(key, F.col("actual_amount_paid").alias("v")))),
    }


def _last(c: str) -> Column:
    """Date and value (``k0``, ``v``) of ``c`` on the latest row where ``c`` is not NULL (pandas ``last``)."""
    row, one = F.col("_row"), F.col(f"_row_{c}")
    later = one.isNotNull() & (row.isNull() | (one["key"] > row["key"]))
    return F.when(later, F.struct(f"_row_{c}.key.k0", f"_row_{c}.v")).when(
        row.isNotNull(), F.struct("_row.key.k0", F.col(f"_row.v_{c}").alias("v")))


def profile_post(last: Callable[[str], Column]) -> list[Column]:
    """Columns of A1 + A2; ``last`` gives the date and value of an attribute's last row."""
    mean = lambda c: F.col(c).cast("double") / F.col(f"_n{c}")
    last = {n: last(c)["v"] for n, c in LAST_COLS.items()}
    out = {
        "n_transactions": F.col("n_transactions"),
        "n_cancels": F.col("n_cancels"),
        "ever_canceled": F.col("ever_canceled"),
        "avg_discount_pct": mean("_disc"),
        "avg_plan_days": mean("_days"),
        "avg_price": mean("_paid"),
        "n_unique_plans": F.size("_plans").cast("long"),
        "n_payment_methods": F.size("_methods").cast("long"),
        "last_is_cancel": last["last_is_cancel"],
        "last_is_auto_renew": last["last_is_auto_renew"],
        "last_plan_days": last["last_plan_days"],
        "last_price": last["_last_paid"].cast("double"),
        "last_list_price": last["_last_list"].cast("double"),
        "price_trend": (last["_last_paid"] - F.col("_first.v")).cast("double"),
        "last_payment_method": last["last_payment_method"],
    }
    return [F.when(F.col("n_transactions") > 0, c).alias(n) for n, c in out.items()]


def tx_user_profile(tx: DataFrame, as_of: dt.date | None = None, tie_cols: Sequence[str] = ()) -> DataFrame:
    """A1 + A2: eight per-user aggregates plus last/first row attributes."""
    rows = _prepared(_as_of(tx, as_of), tie_cols)
    return _states_of(rows, profile_states(), "msno").select("msno", *profile_post(_last))


# ---------------------------------------------------------------- A8
def expiry_states(tx: DataFrame, tie_cols: Sequence[str] = ()) -> States:
    exp = F.col("membership_expire_date")
    # Greatest expiry; on equal expiry the first row in transaction order wins.
    row = F.struct(exp.alias("e"), (-F.col("transaction_date")).alias("d"), *[-F.col(c) for c in tie_cols],
                   F.col("is_auto_renew").alias("a"), F.col("is_cancel").alias("c"))
    return {
        "_exp": F.max(F.when(_parsed(tx, "membership_expire_date").isNotNull(), row)),
        "n_renewals": F.count_if(F.col("is_cancel") == 0),
    }


def expiry_post(ref: Column) -> list[Column]:
    """Columns of A8; NULL for a user without any valid expiry date."""
    days = F.datediff(parse_yyyymmdd("_exp.e"), ref)
    out = {
        "days_until_expire": days,
        "is_expired": (days < 0).cast("int"),
        "auto_renew_at_expire": F.col("_exp.a"),
        "cancel_at_expire": F.col("_exp.c"),
        "n_renewals": F.col("n_renewals"),
    }
    return [F.when(F.col("_exp").isNotNull(), c).alias(n) for n, c in out.items()]


def expiry_features(tx: DataFrame, ref: dt.date, as_of: dt.date | None = None,
                    tie_cols: Sequence[str] = ()) -> DataFrame:
    """Attributes of the latest-expiring transaction, renewal count.

    Users without any valid expiry date have no row (as in the reference).
    """
    agg = _states_of(_as_of(tx, as_of), expiry_states(tx, tie_cols), "msno")
    return agg.where(F.col("_exp").isNotNull()).select("msno", *expiry_post(F.lit(ref)))


# ---------------------------------------------------------------- A9
RECENCY_DAYS = (7, 30)


def recency_states(tx: DataFrame, refs: Sequence[dt.date]) -> States:
    """The last date, and how many rows the days before each of ``refs`` have (arrays, in their order)."""
    d = _parsed(tx, "transaction_date")
    since = lambda ref, n: F.count_if(d >= F.lit(ref - dt.timedelta(days=n)))
    return {"_last_tx": F.max(d), **{f"_n_tx_{n}d": F.array(*[since(ref, n) for ref in refs]) for n in RECENCY_DAYS}}


def recency_post(ref: Column, n_7d: Column, n_30d: Column) -> list[Column]:
    """Columns of A9; NULL for a user without any valid transaction date."""
    out = {
        "days_since_last_tx": F.greatest(F.datediff(ref, F.col("_last_tx")), F.lit(0)),
        "had_tx_last_7d": (n_7d > 0).cast("int"),
        "had_tx_last_30d": (n_30d > 0).cast("int"),
        "n_tx_last_30d": n_30d,
    }
    return [F.when(F.col("_last_tx").isNotNull(), c).alias(n) for n, c in out.items()]


def _recency_of_one(ref: dt.date) -> list[Column]:
    return recency_post(F.lit(ref), F.get("_n_tx_7d", F.lit(0)), F.get("_n_tx_30d", F.lit(0)))


def tx_recency(tx: DataFrame, ref: dt.date, as_of: dt.date | None = None) -> DataFrame:
    """Days since the last transaction (floored at 0), 7 / 30 day counts (no upper bound)."""
    agg = _states_of(_as_of(tx, as_of), recency_states(tx, [ref]), "msno")
    return agg.where(F.col("_last_tx").isNotNull()).select("msno", *_recency_of_one(ref))


# ---------------------------------------------------------------- fused
def _all_states(tx: DataFrame, refs: Sequence[dt.date], tie_cols: Sequence[str]) -> States:
    return {**profile_states(), **expiry_states(tx, tie_cols), **recency_states(tx, refs)}


def transaction_features(tx: DataFrame, cfg, tie_cols: Sequence[str] = ()) -> DataFrame:
    """A1 + A2 + A8 + A9 in one ``groupBy('msno')``: one scan and one shuffle of the transactions.

    Expiry / recency columns are NULL for users that have no valid expiry /
    transaction date, exactly as a left join of the separate builders gives.
    """
    rows = _prepared(_as_of(tx, cfg.tx_as_of), tie_cols)
    agg = _states_of(rows, _all_states(tx, [cfg.tx_ref], tie_cols), "msno")
    return agg.select("msno", *profile_post(_last), *expiry_post(F.lit(cfg.prediction_date)), *_recency_of_one(cfg.tx_ref))


def _segment_states(n_refs: int) -> dict[str, tuple[Column, Merge]]:
    """What the state of a whole segment must keep to be merged with those of other segments, and how.

    Rows of different segments never have the same date, so the date alone orders them: the tie columns have done
    their work inside the segments and go no further.
    """
    total = lambda c, w: F.sum(c).over(w)
    greatest = lambda c, w: F.max(c).over(w)
    values = lambda c, w: F.array_distinct(F.flatten(F.collect_list(c).over(w)))
    totals = lambda c, w: F.array(*[total(F.get(c, F.lit(i)), w) for i in range(n_refs)])
    return {
        **{n: (F.col(n), total) for n in ("n_transactions", "n_cancels", "_disc", "_n_disc", "_days", "_n_days", "_paid",
                                          "_n_paid", "n_renewals")},
        **{n: (F.col(n), greatest) for n in ("ever_canceled", "_last_tx")},
        **{n: (F.col(n), values) for n in ("_plans", "_methods")},
        **{f"_last_{c}": (_last(c), greatest) for c in LAST_COLS.values()},
        "_first": (F.when(F.col("_first").isNotNull(), F.struct("_first.key.k0", "_first.v")), lambda c, w: F.min(c).over(w)),
        "_exp": (F.when(F.col("_exp").isNotNull(), F.struct("_exp.e", "_exp.d", "_exp.a", "_exp.c")), greatest),
        **{f"_n_tx_{n}d": (F.col(f"_n_tx_{n}d"), totals) for n in RECENCY_DAYS},
    }


def labelled_transaction_features(tx: DataFrame, cfg, prev_start: dt.date, tie_cols: Sequence[str] = ()) -> DataFrame:
    """Labelled users of one month with their transaction features (see ``monthly_transaction_features``)."""
    return monthly_transaction_features(tx, [cfg], [prev_start], tie_cols).drop("period")


def monthly_transaction_features(tx: DataFrame, cfgs: Sequence, prev_starts: Sequence[dt.date],
                                 tie_cols: Sequence[str] = (), by_user: bool = False) -> DataFrame:
    """Labelled users of some months (``period``) with their transaction features, from one scan of the transactions.

    The months' cutoffs divide a user's rows into segments; each row goes into the state of its segment only, and a
    month's state is that of the segments up to its cutoff: a running total over the few segments of a user. So the
    rows are shuffled once, however many months, and a month costs one row a user.

    Labels look past the cutoff (who comes back), features must not: states of later segments count for the labels only.
    Users first seen before the month's ``label_start``; ``is_churn`` when no row follows it, ``prev_churn`` likewise
    for the month from ``prev_start`` (NULL when the user was not there yet).

    ``by_user``: a user's rows lie in one partition of ``tx`` already. Then neither they nor the states are shuffled here.
    """
    cutoffs = sorted({ymd(c.tx_as_of) for c in cfgs if c.tx_as_of is not None})
    segment = F.lit(0)
    for c in cutoffs:  # a row without date is after every cutoff
        segment = segment + F.when(F.col("transaction_date") <= c, 0).otherwise(1)
    states = _all_states(tx, [c.tx_ref for c in cfgs], tie_cols)
    dates = {"_first_date": F.min("transaction_date"), "_last_date": F.max("transaction_date")}
    short = _segment_states(len(cfgs))
    # A user has at most one state a segment.
    parts = _states_of(_prepared(tx, tie_cols).withColumn("_segment", segment), {**states, **dates}, "msno", "_segment").select(
        "msno", "_segment", *dates, *[c.alias(n) for n, (c, _) in short.items()])
    parts = parts if by_user else parts.repartition("msno")
    user = Window.partitionBy("msno")
    up = user.orderBy("_segment")
    upto = up.rowsBetween(Window.unboundedPreceding, 0)
    runs = parts.select(
        "msno", "_segment", F.min("_first_date").over(user).alias("_first_date"),
        F.max("_last_date").over(user).alias("_last_date"), F.lag("_segment").over(up).alias("_before"),
        F.lead("_segment").over(up).alias("_after"), *[merge(F.col(n), upto).alias(n) for n, (_, merge) in short.items()])
    months = F.array(*[F.struct(
        F.lit(i).alias("i"), F.lit(c.period).alias("period"),
        F.lit(len(cutoffs) if c.tx_as_of is None else cutoffs.index(ymd(c.tx_as_of))).alias("upto"),
        F.lit(ymd(c.label_start)).alias("start"), F.lit(ymd(p)).alias("prev"),
        F.lit(c.prediction_date).alias("predicted"), F.lit(c.tx_ref).alias("ref"))
        for i, (c, p) in enumerate(zip(cfgs, prev_starts, strict=True))])
    first, last = F.col("_first_date"), F.col("_last_date")
    # A month takes the run up to its cutoff; one whose cutoff lies before all of a user's rows an empty state.
    taken = lambda m: ((F.col("_after").isNull() | (m["upto"] < F.col("_after")))
                       & (F.col("_before").isNull() | (F.col("_segment") <= m["upto"])) & (first < m["start"]))
    rows = runs.select("*", F.explode(F.filter(months, taken)).alias("_m")).select(
        "msno", "_m", *dates, *[F.when(F.col("_segment") <= F.col("_m.upto"), F.col(n)).alias(n) for n in short])
    return rows.select(
        F.col("_m.period").alias("period"), "msno", (last < F.col("_m.start")).cast("int").alias("is_churn"),
        F.when(first < F.col("_m.prev"), (last < F.col("_m.prev")).cast("int")).alias("prev_churn"),
        *profile_post(lambda c: F.col(f"_last_{c}")), *expiry_post(F.col("_m.predicted")),
        *recency_post(F.col("_m.ref"), *[F.get(f"_n_tx_{n}d", F.col("_m.i")) for n in RECENCY_DAYS]))


# ---------------------------------------------------------------- logs A3 / A5
def _whole(c: Column, kind: DataType) -> tuple[Column, Callable[[Column], Column]]:
    """A column to add up, and how to turn its sum back: decimals as whole units of their last digit.

    A sum of longs is several times cheaper than one of decimals, and as exact: it takes 10^18 units, and each value is
    at most 86,400 seconds.
    """
    if not isinstance(kind, DecimalType) or kind.scale > 4:
        return c, lambda total: total
    unit = 10 ** kind.scale
    kept = f"decimal({min(38, kind.precision + 10)},{kind.scale})"
    return (c * unit).cast("long"), lambda total: (total.cast("decimal(20,0)") / unit).cast(kept)


def log_user_agg(logs: DataFrame, max_date: dt.date, recent: dt.date,
                 windows: dict | None = None, keys: Sequence[str] = ("msno",)) -> DataFrame:
    """A3 + A5: one pass over the daily logs, every window as a conditional sum.

    Rows after ``max_date`` are filtered before the aggregate (pushed into the
    parquet scan). Seconds are clipped to [0, 86400]; decimal seconds are added up as whole units.
    """
    secs, back = _whole(clip("total_secs", 0, MAX_SECS), logs.schema["total_secs"].dataType)
    x = logs.where(F.col("date") <= ymd(max_date)).select(
        *keys, "date", "num_100", "num_unq", secs.alias("secs"), row_sum(*SONG_COLS).alias("songs"))
    is_recent = F.col("date") >= ymd(recent)
    aggs = [
        F.count(F.lit(1)).alias("n_days"),
        F.sum("secs").alias("total_secs_sum"),
        F.sum("num_100").alias("num_100_sum"),
        F.sum("num_unq").alias("num_unq_sum"),
        F.sum("songs").alias("total_songs_sum"),
        F.max("date").alias("max_date"),
        F.count_if(is_recent).alias("recent_n_days"),
        F.sum(F.when(is_recent, F.col("secs")).otherwise(F.lit(0))).alias("recent_total_secs_sum"),
    ]
    for name, start in (windows or {}).items():
        inw = F.col("date") >= ymd(start)
        aggs.append(F.count_if(inw).alias(f"{name}_n_days"))
        aggs.append(F.sum(F.when(inw, F.col("secs")).otherwise(F.lit(0))).alias(f"{name}_secs_sum"))
    agg = x.groupBy(*keys).agg(*aggs)
    return agg.select(*[back(F.col(c)).alias(c) if c.endswith("secs_sum") else c for c in agg.columns])


def _dbl(c: str) -> Column:
    return F.col(c).cast("double")


# ---------------------------------------------------------------- A6
LOG_FEATURE_COLS = ["n_days", "avg_daily_secs", "avg_daily_completed", "avg_daily_unq", "completion_ratio",
                    "days_since_last", "listening_trend"]


def log_feature_exprs(ref: dt.date) -> list[Column]:
    overall = _dbl("total_secs_sum") / F.greatest(F.col("n_days"), F.lit(1))
    recent = _dbl("recent_total_secs_sum") / F.greatest(F.col("recent_n_days"), F.lit(1))
    return [
        F.col("n_days"),
        (_dbl("total_secs_sum") / F.col("n_days")).alias("avg_daily_secs"),
        (_dbl("num_100_sum") / F.col("n_days")).alias("avg_daily_completed"),
        (_dbl("num_unq_sum") / F.col("n_days")).alias("avg_daily_unq"),
        safe_ratio(_dbl("num_100_sum"), F.col("total_songs_sum")).alias("completion_ratio"),
        F.datediff(F.lit(ref), parse_yyyymmdd("max_date")).alias("days_since_last"),
        (recent - overall).alias("listening_trend"),
    ]


def log_features(agg: DataFrame, ref: dt.date) -> DataFrame:
    """Per-day averages, completion ratio, recency and trend."""
    return agg.select("msno", *log_feature_exprs(ref))


# ---------------------------------------------------------------- A7
def multiwindow_exprs(short: str = "r7d", long: str = "r90d") -> list[Column]:
    n7 = F.coalesce(F.col(f"{short}_n_days"), F.lit(0))
    n90 = F.coalesce(F.col(f"{long}_n_days"), F.lit(0))
    s7 = F.coalesce(F.col(f"{short}_secs_sum"), F.lit(0)).cast("double")
    s90 = F.coalesce(F.col(f"{long}_secs_sum"), F.lit(0)).cast("double")
    spd7 = s7 / (n7 + 1)
    overall = _dbl("total_secs_sum") / (F.col("n_days") + 1)
    recent = _dbl("recent_total_secs_sum") / (F.col("recent_n_days") + 1)
    return [
        n7.alias("n_days_7d"),
        spd7.alias("secs_per_day_7d"),
        n90.alias("n_days_90d"),
        (s90 / (n90 + 1)).alias("secs_per_day_90d"),
        (spd7 - overall).alias("trend_7d"),
        (spd7 - recent).alias("trend_7d_vs_30d"),
    ]


def multiwindow_features(agg: DataFrame, short: str = "r7d", long: str = "r90d") -> DataFrame:
    """7d / 90d rates and trends with ``n + 1`` denominators; missing windows -> 0."""
    return agg.select("msno", *multiwindow_exprs(short, long))


# ---------------------------------------------------------------- P7
MEMBER_COLS = ["city", "registered_via", "gender_enc", "age", "bd_valid", "tenure_days"]


def member_features(members: DataFrame, ref_date: dt.date) -> DataFrame:
    """Gender code (NULL -> unknown; other text -> NULL), age validity, tenure."""
    g = F.coalesce(F.col("gender"), F.lit("unknown"))
    bd_valid = F.col("bd").between(1, 99)
    return members.select(
        "msno", "city", "registered_via",
        F.when(g == "male", 0).when(g == "female", 1).when(g == "unknown", 2).alias("gender_enc"),
        F.when(bd_valid, F.col("bd").cast("double")).alias("age"),
        F.coalesce(bd_valid, F.lit(False)).cast("int").alias("bd_valid"),
        F.datediff(F.lit(ref_date), parse_yyyymmdd("registration_init_time")).alias("tenure_days"),
    )


# ---------------------------------------------------------------- S2 profile
def date_coercion_profile(tx: DataFrame, shift_days: int = 30) -> DataFrame:
    """S2 check: coerce-parse yyyymmdd values, including shifted integers that
    are not calendar dates (e.g. day 31 + 30), and count valid / NULL results."""
    raw = (F.col("membership_expire_date") + shift_days)
    d = parse_yyyymmdd(raw)
    return tx.select(d.alias("d")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("d").alias("n_valid"),
        F.count_if(F.col("d").isNull()).alias("n_coerced_null"),
        F.min("d").alias("min_date"),
        F.max("d").alias("max_date"),
    )
