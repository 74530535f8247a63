"""DuckDB twins of the registered queries (the correctness oracle).

Each entry is plain SQL over the driver's views. The bindings are repeated
here as CTE text, written independently of the Spark code, and every query
text starts with them. Constants come from the same period configuration.
"""

from __future__ import annotations

import datetime as dt
import re

from churnlab.plans.bindings import LOG_SHIFT_DAYS
from churnlab.plans.periods import DEMO_LABEL_PERIODS, DEMO_LABEL_WINDOW as LW, DEMO_PERIOD as P, period_config, ymd

ORACLE: dict[str, str] = {}


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _ymd_sql(e: str) -> str:
    return f"CAST(year({e}) * 10000 + month({e}) * 100 + day({e}) AS INTEGER)"


def _ymd_to_date(e: str) -> str:
    return f"try_strptime(CAST({e} AS VARCHAR), '%Y%m%d')::DATE"


_label_rows = " UNION ALL ".join(
    f"SELECT '{p}' AS period, {int(p[:4]) * 10000 + int(p[5:]) * 100 + 1} AS start" for p in DEMO_LABEL_PERIODS)

BINDINGS = f"""
transactions AS (
  SELECT o.o_custkey AS msno,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS payment_method_id,
         CAST(l.l_quantity AS INTEGER) AS payment_plan_days,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS plan_list_price,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(18,2))) AS DECIMAL(18,4))
           AS actual_amount_paid,
         CAST(l.l_linestatus = 'O' AS INTEGER) AS is_auto_renew,
         {_ymd_sql('o.o_orderdate')} AS transaction_date,
         {_ymd_sql('(CAST(o.o_orderdate AS DATE) + CAST(l.l_quantity AS INTEGER))')} AS membership_expire_date,
         CAST(l.l_returnflag = 'R' AS INTEGER) AS is_cancel,
         l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
members AS (
  SELECT c_custkey AS msno, c_nationkey AS city,
         CAST(floor(c_acctbal / 70) AS INTEGER) AS bd,
         CASE c_custkey % 3 WHEN 1 THEN 'male' WHEN 2 THEN 'female' END AS gender,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 3 WHEN 'BUILDING' THEN 4 WHEN 'FURNITURE' THEN 7
              WHEN 'HOUSEHOLD' THEN 9 WHEN 'MACHINERY' THEN 13 END AS registered_via,
         {_ymd_sql("(DATE '1990-01-01' + CAST(c_custkey % 1800 AS INTEGER))")} AS registration_init_time
  FROM customer
),
user_logs AS (
  SELECT user_id AS msno, {_ymd_sql(f'(CAST(ts AS DATE) - {LOG_SHIFT_DAYS})')} AS date,
         CAST(count(*) FILTER (WHERE event_type = 'view') AS INTEGER) AS num_25,
         CAST(count(*) FILTER (WHERE event_type = 'click') AS INTEGER) AS num_50,
         CAST(count(*) FILTER (WHERE event_type = 'signup') AS INTEGER) AS num_75,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS INTEGER) AS num_985,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS INTEGER) AS num_100,
         CAST(count(DISTINCT event_type) AS INTEGER) AS num_unq,
         CAST(sum(CAST(value AS DECIMAL(18,2))) * 60 AS DECIMAL(18,2)) AS total_secs
  FROM events GROUP BY 1, 2
),
period_labels AS (
  SELECT u.msno, p.period, CAST(u.last_tx < p.start AS INTEGER) AS is_churn
  FROM (SELECT msno, min(transaction_date) AS first_tx, max(transaction_date) AS last_tx
        FROM transactions GROUP BY msno) u
  CROSS JOIN ({_label_rows}) p
  WHERE u.first_tx < p.start
),
cur_labels AS (SELECT msno, is_churn FROM period_labels WHERE period = '{P.period}')
"""


def sql(name: str, body: str, ctes: str = "") -> str:
    extra = ("," + ctes) if ctes.strip() else ""
    ORACLE[name] = "WITH " + BINDINGS + extra + "\n" + body
    return ORACLE[name]


AS_OF = ymd(P.tx_as_of)

# A1 + A2: per-user profile. "last" = latest non-null value in (date, tie columns) order.
_TX_ORDER = "transaction_date, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
PROFILE_CTE = f"""
tx_asof AS (SELECT * FROM transactions WHERE transaction_date <= {AS_OF}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY msno ORDER BY {_TX_ORDER.replace(', ', ' DESC, ')} DESC) AS rn_last,
            row_number() OVER (PARTITION BY msno ORDER BY {_TX_ORDER}) AS rn_first
  FROM tx_asof
),
profile AS (
  SELECT msno,
         count(*) AS n_transactions,
         CAST(sum(is_cancel) AS BIGINT) AS n_cancels,
         max(is_cancel) AS ever_canceled,
         CAST(sum(CASE WHEN plan_list_price > 0 THEN
                  CAST((plan_list_price - actual_amount_paid) / plan_list_price AS DECIMAL(18,8)) END) AS DOUBLE)
           / count(CASE WHEN plan_list_price > 0 THEN 1 END) AS avg_discount_pct,
         CAST(sum(payment_plan_days) AS DOUBLE) / count(payment_plan_days) AS avg_plan_days,
         CAST(sum(actual_amount_paid) AS DOUBLE) / count(actual_amount_paid) AS avg_price,
         count(DISTINCT payment_plan_days) AS n_unique_plans,
         count(DISTINCT payment_method_id) AS n_payment_methods,
         max(CASE WHEN rn_last = 1 THEN is_cancel END) AS last_is_cancel,
         max(CASE WHEN rn_last = 1 THEN is_auto_renew END) AS last_is_auto_renew,
         max(CASE WHEN rn_last = 1 THEN payment_plan_days END) AS last_plan_days,
         CAST(max(CASE WHEN rn_last = 1 THEN actual_amount_paid END) AS DOUBLE) AS last_price,
         CAST(max(CASE WHEN rn_last = 1 THEN plan_list_price END) AS DOUBLE) AS last_list_price,
         CAST(max(CASE WHEN rn_last = 1 THEN actual_amount_paid END)
              - max(CASE WHEN rn_first = 1 THEN actual_amount_paid END) AS DOUBLE) AS price_trend,
         max(CASE WHEN rn_last = 1 THEN payment_method_id END) AS last_payment_method
  FROM ranked GROUP BY msno
)
"""

sql("tx_user_profile", "SELECT * FROM profile", PROFILE_CTE)

_CONTRAST = ["n_transactions", "n_cancels", "ever_canceled", "avg_discount_pct", "avg_plan_days", "avg_price",
             "last_is_cancel", "last_is_auto_renew", "last_plan_days", "last_price", "price_trend"]
_contrast_rows = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(CASE WHEN is_churn = 0 THEN CAST({c} AS DOUBLE) END) AS r, "
    f"avg(CASE WHEN is_churn = 1 THEN CAST({c} AS DOUBLE) END) AS ch FROM j" for c in _CONTRAST)
sql("churn_contrast", f"""
SELECT feature, round(r, 6) AS renewal_mean, round(ch, 6) AS churn_mean,
       CASE WHEN r <> 0 THEN round((ch - r) / abs(r) * 100, 1) END AS diff_pct
FROM ({_contrast_rows}) t""", PROFILE_CTE + ", j AS (SELECT p.*, l.is_churn FROM profile p JOIN cur_labels l USING (msno))")

# ---------------------------------------------------------------- S2 / S3
sql("date_coercion", f"""
SELECT count(*) AS n_rows, count(d) AS n_valid, count(*) FILTER (WHERE d IS NULL) AS n_coerced_null,
       min(d) AS min_date, max(d) AS max_date
FROM (SELECT {_ymd_to_date('membership_expire_date + 30')} AS d FROM transactions) t""")

sql("tx_union_count", """
SELECT CAST(transaction_date / 10000 AS INTEGER) AS year, count(*) AS n_rows, count(DISTINCT msno) AS n_users
FROM (SELECT * FROM transactions WHERE transaction_date < 19990101
      UNION ALL SELECT * FROM transactions WHERE transaction_date >= 19990101) u
GROUP BY 1""".replace("CAST(transaction_date / 10000 AS INTEGER)", "CAST(floor(transaction_date / 10000) AS INTEGER)"))

# ---------------------------------------------------------------- logs
_W = P.log_windows
LOG_AGG_CTE = f"""
lg AS (
  SELECT msno, date, num_100, num_unq,
         CASE WHEN total_secs IS NOT NULL THEN least(greatest(total_secs, 0), 86400) END AS secs,
         coalesce(num_25, 0) + coalesce(num_50, 0) + coalesce(num_75, 0) + coalesce(num_985, 0)
           + coalesce(num_100, 0) AS songs
  FROM user_logs WHERE date <= {ymd(P.log_max_date)}
),
log_agg AS (
  SELECT msno, count(*) AS n_days, sum(secs) AS total_secs_sum,
         CAST(sum(num_100) AS BIGINT) AS num_100_sum, CAST(sum(num_unq) AS BIGINT) AS num_unq_sum,
         CAST(sum(songs) AS BIGINT) AS total_songs_sum, max(date) AS max_date,
         count(*) FILTER (WHERE date >= {ymd(P.log_recent)}) AS recent_n_days,
         sum(CASE WHEN date >= {ymd(P.log_recent)} THEN secs ELSE 0 END) AS recent_total_secs_sum,
         """ + ",\n         ".join(
    f"count(*) FILTER (WHERE date >= {ymd(s)}) AS {n}_n_days, "
    f"sum(CASE WHEN date >= {ymd(s)} THEN secs ELSE 0 END) AS {n}_secs_sum" for n, s in _W.items()) + """
  FROM lg GROUP BY msno
)"""
sql("log_user_agg", "SELECT * FROM log_agg", LOG_AGG_CTE)

LOG_FEAT_CTE = LOG_AGG_CTE + f""",
log_feat AS (
  SELECT msno, n_days,
         CAST(total_secs_sum AS DOUBLE) / n_days AS avg_daily_secs,
         CAST(num_100_sum AS DOUBLE) / n_days AS avg_daily_completed,
         CAST(num_unq_sum AS DOUBLE) / n_days AS avg_daily_unq,
         CASE WHEN total_songs_sum > 0 THEN CAST(num_100_sum AS DOUBLE) / total_songs_sum END AS completion_ratio,
         CAST(date_diff('day', {_ymd_to_date('max_date')}, {_d(P.log_ref_date)}) AS INTEGER) AS days_since_last,
         CAST(recent_total_secs_sum AS DOUBLE) / greatest(recent_n_days, 1)
           - CAST(total_secs_sum AS DOUBLE) / greatest(n_days, 1) AS listening_trend
  FROM log_agg
),
mw_feat AS (
  SELECT msno, coalesce(r7d_n_days, 0) AS n_days_7d,
         CAST(coalesce(r7d_secs_sum, 0) AS DOUBLE) / (coalesce(r7d_n_days, 0) + 1) AS secs_per_day_7d,
         coalesce(r90d_n_days, 0) AS n_days_90d,
         CAST(coalesce(r90d_secs_sum, 0) AS DOUBLE) / (coalesce(r90d_n_days, 0) + 1) AS secs_per_day_90d,
         CAST(coalesce(r7d_secs_sum, 0) AS DOUBLE) / (coalesce(r7d_n_days, 0) + 1)
           - CAST(total_secs_sum AS DOUBLE) / (n_days + 1) AS trend_7d,
         CAST(coalesce(r7d_secs_sum, 0) AS DOUBLE) / (coalesce(r7d_n_days, 0) + 1)
           - CAST(recent_total_secs_sum AS DOUBLE) / (recent_n_days + 1) AS trend_7d_vs_30d
  FROM log_agg
)"""
sql("log_features", "SELECT * FROM log_feat", LOG_FEAT_CTE)
sql("multiwindow_features", "SELECT * FROM mw_feat", LOG_FEAT_CTE)

MEMBER_CTE = f"""
mem_feat AS (
  SELECT msno, city, registered_via,
         CASE coalesce(gender, 'unknown') WHEN 'male' THEN 0 WHEN 'female' THEN 1 WHEN 'unknown' THEN 2 END
           AS gender_enc,
         CASE WHEN bd BETWEEN 1 AND 99 THEN CAST(bd AS DOUBLE) END AS age,
         CAST(coalesce(bd BETWEEN 1 AND 99, false) AS INTEGER) AS bd_valid,
         CAST(date_diff('day', {_ymd_to_date('registration_init_time')}, {_d(P.prediction_date)}) AS INTEGER)
           AS tenure_days
  FROM members
)"""
sql("member_features", "SELECT * FROM mem_feat", MEMBER_CTE)

EXPIRY_CTE = f"""
exp_rows AS (
  SELECT *, {_ymd_to_date('membership_expire_date')} AS exp_d FROM transactions WHERE transaction_date <= {AS_OF}
),
exp_top AS (
  SELECT msno, exp_d, is_auto_renew, is_cancel,
         row_number() OVER (PARTITION BY msno ORDER BY membership_expire_date DESC, {_TX_ORDER}) AS rn
  FROM exp_rows WHERE exp_d IS NOT NULL
),
exp_feat AS (
  SELECT t.msno, CAST(date_diff('day', {_d(P.prediction_date)}, t.exp_d) AS INTEGER) AS days_until_expire,
         CAST(date_diff('day', {_d(P.prediction_date)}, t.exp_d) < 0 AS INTEGER) AS is_expired,
         t.is_auto_renew AS auto_renew_at_expire, t.is_cancel AS cancel_at_expire, r.n_renewals
  FROM exp_top t JOIN (SELECT msno, count(*) FILTER (WHERE is_cancel = 0) AS n_renewals
                       FROM exp_rows GROUP BY msno) r USING (msno)
  WHERE t.rn = 1
)"""
sql("expiry_features", "SELECT * FROM exp_feat", EXPIRY_CTE)

_REF = P.tx_ref
RECENCY_CTE = f"""
rec_feat AS (
  SELECT msno,
         CAST(greatest(date_diff('day', max(d), {_d(_REF)}), 0) AS INTEGER) AS days_since_last_tx,
         CAST(count(*) FILTER (WHERE d >= {_d(_REF - dt.timedelta(days=7))}) > 0 AS INTEGER) AS had_tx_last_7d,
         CAST(count(*) FILTER (WHERE d >= {_d(_REF - dt.timedelta(days=30))}) > 0 AS INTEGER) AS had_tx_last_30d,
         count(*) FILTER (WHERE d >= {_d(_REF - dt.timedelta(days=30))}) AS n_tx_last_30d
  FROM (SELECT msno, {_ymd_to_date('transaction_date')} AS d FROM transactions
        WHERE transaction_date <= {AS_OF}) t
  GROUP BY msno HAVING max(d) IS NOT NULL
)"""
sql("tx_recency", "SELECT * FROM rec_feat", RECENCY_CTE)

# ---------------------------------------------------------------- W1-W3 (window formulation)
_SIG = ("CAST(plan_list_price AS VARCHAR) || CAST(payment_plan_days AS VARCHAR) "
        "|| CAST(payment_method_id AS VARCHAR)")
LABEL_CTE = f"""
hist AS (SELECT *, {_SIG} AS sig FROM transactions
         WHERE transaction_date BETWEEN {ymd(LW.hist_start)} AND {ymd(LW.hist_end)}),
hist_last AS (
  SELECT msno, membership_expire_date AS last_expire,
         row_number() OVER (PARTITION BY msno ORDER BY transaction_date DESC, sig ASC, is_cancel DESC,
           CASE WHEN is_cancel = 1 THEN membership_expire_date ELSE -membership_expire_date END ASC) AS rn
  FROM hist
),
last_exp AS (SELECT msno, last_expire FROM hist_last WHERE rn = 1),
cands AS (SELECT * FROM last_exp WHERE last_expire BETWEEN {ymd(LW.target_start)} AND {ymd(LW.target_end)}),
fut AS (
  SELECT f.msno, f.transaction_date, f.membership_expire_date, f.is_cancel,
         row_number() OVER (PARTITION BY f.msno ORDER BY f.transaction_date ASC, {_SIG} DESC, f.is_cancel ASC,
           CASE WHEN f.is_cancel = 1 THEN -f.membership_expire_date ELSE f.membership_expire_date END ASC) AS rn
  FROM transactions f WHERE f.transaction_date > {ymd(LW.hist_end)} AND f.msno IN (SELECT msno FROM cands)
),
first_ren AS (SELECT msno, min(rn) AS rn0 FROM fut WHERE is_cancel = 0 GROUP BY msno),
walk AS (
  SELECT f.msno, r.rn0,
         max(CASE WHEN f.rn = r.rn0 THEN f.transaction_date END) AS ren_date,
         min(CASE WHEN f.is_cancel = 1 AND (r.rn0 IS NULL OR f.rn < r.rn0) THEN f.membership_expire_date END)
           AS cancel_min
  FROM fut f LEFT JOIN first_ren r USING (msno) GROUP BY f.msno, r.rn0
),
gaps AS (
  SELECT c.msno, c.last_expire,
         CASE WHEN w.rn0 IS NULL THEN 9999 ELSE CAST(date_diff('day',
              {_ymd_to_date('least(c.last_expire, coalesce(w.cancel_min, c.last_expire))')},
              {_ymd_to_date('w.ren_date')}) AS INTEGER) END AS gap
  FROM cands c JOIN walk w USING (msno)
)"""
sql("last_expire", "SELECT * FROM last_exp", LABEL_CTE)
sql("renewal_gap", "SELECT * FROM gaps", LABEL_CTE)
sql("churn_labels", """
SELECT c.msno, CAST(g.gap IS NULL OR g.gap >= 30 AS INTEGER) AS is_churn
FROM cands c LEFT JOIN gaps g USING (msno)""", LABEL_CTE)

# ---------------------------------------------------------------- J1/J2 feature matrix
from churnlab.schemas import FEATURE_COLS_V1, FEATURE_SETS  # noqa: E402

RAW_MATRIX_CTE = (PROFILE_CTE + "," + LOG_FEAT_CTE + "," + MEMBER_CTE + "," + EXPIRY_CTE + "," + RECENCY_CTE + f""",
prev_labels AS (SELECT msno, is_churn AS prev_churn FROM period_labels WHERE period = '{P.prev_period}'),
raw AS (
  SELECT u.msno, u.is_churn, p.* EXCLUDE (msno), e.* EXCLUDE (msno), r.* EXCLUDE (msno), m.* EXCLUDE (msno),
         lf.* EXCLUDE (msno), mw.* EXCLUDE (msno), pl.prev_churn,
         CAST(m.city IS NOT NULL AS INTEGER) AS has_member_record,
         CAST(lf.n_days IS NOT NULL AS INTEGER) AS has_log_record
  FROM cur_labels u
  LEFT JOIN profile p USING (msno) LEFT JOIN exp_feat e USING (msno) LEFT JOIN rec_feat r USING (msno)
  LEFT JOIN mem_feat m USING (msno) LEFT JOIN log_feat lf USING (msno) LEFT JOIN mw_feat mw USING (msno)
  LEFT JOIN prev_labels pl USING (msno)
)""")

_MEDIAN_BASE = [c for c in FEATURE_COLS_V1 if c not in ("has_member_record", "has_log_record", "n_days")]
_V5_CONST = {"is_expired": 1, "auto_renew_at_expire": 0, "cancel_at_expire": 0, "n_renewals": 0, "prev_churn": 0,
             "had_tx_last_7d": 0, "had_tx_last_30d": 0, "n_tx_last_30d": 0, "n_days_7d": 0, "secs_per_day_7d": 0,
             "n_days_90d": 0, "secs_per_day_90d": 0, "trend_7d": 0, "trend_7d_vs_30d": 0}


def _matrix_sql(fs: str) -> str:
    cols = FEATURE_SETS[fs]
    med = list(_MEDIAN_BASE) + ([c for c in ("days_until_expire", "days_since_last_tx") if c in cols])
    meds = ", ".join(f"median(CAST({c} AS DOUBLE)) AS m_{c}" for c in med)
    sel = []
    for c in cols:
        if c == "cancel_before_expire":
            sel.append("CAST(CAST(last_is_cancel = 1 AND coalesce(CAST(days_until_expire AS DOUBLE), m_days_until_expire)"
                       " > 0 AS INTEGER) AS DOUBLE) AS cancel_before_expire")
        elif c == "n_days":
            sel.append("coalesce(CAST(n_days AS DOUBLE), 0.0) AS n_days")
        elif c in med:
            sel.append(f"coalesce(CAST({c} AS DOUBLE), m_{c}, 0.0) AS {c}")
        elif c in _V5_CONST:
            sel.append(f"coalesce(CAST({c} AS DOUBLE), {float(_V5_CONST[c])}) AS {c}")
        else:
            sel.append(f"CAST({c} AS DOUBLE) AS {c}")
    return f"SELECT msno, is_churn, {', '.join(sel)} FROM raw CROSS JOIN (SELECT {meds} FROM raw) med"


for _fs in ("v1", "v4", "v5"):
    sql(f"feature_matrix_{_fs}", _matrix_sql(_fs), RAW_MATRIX_CTE)

sql("churn_lag", """
SELECT u.msno, u.is_churn, pl.prev_churn FROM cur_labels u LEFT JOIN prev_labels pl USING (msno)""", RAW_MATRIX_CTE)

_IMP = _MEDIAN_BASE + ["days_until_expire", "days_since_last_tx"]
sql("imputed_features", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, median(CAST({c} AS DOUBLE)) AS median, count(*) FILTER (WHERE {c} IS NULL) AS n_filled"
    f" FROM raw" for c in _IMP), RAW_MATRIX_CTE)

_V5 = FEATURE_SETS["v5"]
_RAW5 = [c for c in _V5 if c != "cancel_before_expire"]
sql("null_report", " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    f"CASE WHEN count(*) > 0 THEN round(count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100, 4) END AS pct_null"
    f" FROM raw" for c in _RAW5), RAW_MATRIX_CTE)

_BIN = ["ever_canceled", "last_is_cancel", "last_is_auto_renew", "bd_valid", "has_member_record", "has_log_record",
        "is_expired", "auto_renew_at_expire", "cancel_at_expire", "prev_churn", "cancel_before_expire",
        "had_tx_last_7d", "had_tx_last_30d"]
_RANGES = {"age": (0, 120), "completion_ratio": (0, 1), "avg_discount_pct": (0, 1)}
_rule_exprs = {"no_nulls": " AND ".join(f"{c} IS NOT NULL" for c in _V5)}
_rule_exprs.update({f"range:{c}": f"{c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in _RANGES.items()})
_rule_exprs.update({f"binary:{c}": f"{c} IN (0, 1)" for c in _BIN})
_ok_all = " AND ".join(f"coalesce({e}, false)" for e in _rule_exprs.values())
sql("validation_counts", "SELECT rule, n FROM (SELECT 'rows' AS rule, count(*) AS n FROM fm" + "".join(
    f" UNION ALL SELECT '{n}', count(*) FILTER (WHERE NOT coalesce({e}, false)) FROM fm" for n, e in _rule_exprs.items())
    + f" UNION ALL SELECT 'valid', count(*) FILTER (WHERE {_ok_all}) FROM fm"
    + f" UNION ALL SELECT 'invalid', count(*) FILTER (WHERE NOT ({_ok_all})) FROM fm) t",
    RAW_MATRIX_CTE + ", fm AS (" + _matrix_sql("v5") + ")")

_NONNEG = ["n_transactions", "n_cancels", "avg_plan_days", "avg_price", "n_unique_plans", "n_payment_methods",
           "last_plan_days", "last_price", "last_list_price", "last_payment_method", "city", "registered_via",
           "tenure_days", "n_days", "avg_daily_secs", "avg_daily_completed", "avg_daily_unq", "days_since_last",
           "n_renewals", "days_since_last_tx", "n_tx_last_30d", "n_days_7d", "secs_per_day_7d", "n_days_90d",
           "secs_per_day_90d"]
_BOUNDS = {**{c: (0.0, None) for c in _NONNEG}, "avg_discount_pct": (0.0, 1.0), "completion_ratio": (0.0, 1.0),
           **{c: (0.0, 1.0) for c in _BIN}, "gender_enc": (0.0, 2.0), "age": (0.0, 120.0)}
_INTS = _BIN + ["last_payment_method", "city", "registered_via", "gender_enc"]


def _contract_row(c: str) -> str:
    lo, hi = _BOUNDS.get(c, (None, None))
    conds = []
    if lo is not None:
        conds.append(f"CAST({c} AS DOUBLE) < {lo}")
    if hi is not None:
        conds.append(f"CAST({c} AS DOUBLE) > {hi}")
    oob = " OR ".join(conds) if conds else "false"
    nint = f"CAST({c} AS DOUBLE) <> floor(CAST({c} AS DOUBLE))" if c in _INTS else "false"
    return (f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
            f"count(*) FILTER (WHERE coalesce({oob}, false)) AS n_out_of_range, "
            f"count(*) FILTER (WHERE coalesce({nint}, false)) AS n_not_integer FROM raw")


sql("contract_violations", " UNION ALL ".join(_contract_row(c) for c in _RAW5), RAW_MATRIX_CTE)

PRED_CTE = """
predictions AS (
  SELECT o.o_custkey AS msno, CAST(l.l_extendedprice / 200000 AS FLOAT) AS churn_prob,
         CAST(CAST(l.l_extendedprice / 200000 AS FLOAT) >= 0.5 AS SMALLINT) AS churn_label,
         'v' || CAST(l.l_linenumber % 3 + 1 AS VARCHAR) AS model_version,
         strftime(o.o_orderdate, '%Y-%m') AS period,
         CASE WHEN l.l_linenumber % 4 = 0 THEN 'api' ELSE 'batch' END AS source,
         o.o_orderdate + to_hours(l.l_linenumber) + to_minutes(CAST(l.l_orderkey % 60 AS INTEGER)) AS predicted_at,
         l.l_orderkey, l.l_linenumber
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
ground_truth AS (
  SELECT o.o_custkey AS msno, strftime(o.o_orderdate, '%Y-%m') AS period,
         max(CAST(l.l_returnflag = 'R' AS SMALLINT)) AS actual_churn
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2
)"""
sql("constraint_violations", """
SELECT 'unique(msno,period,model_version,source)' AS constraint,
       CAST(coalesce(sum(c), 0) AS BIGINT) AS n_violations
FROM (SELECT count(*) AS c FROM predictions GROUP BY msno, period, model_version, source HAVING count(*) > 1) d
UNION ALL SELECT 'churn_prob in [0,1]', count(*) FILTER (WHERE NOT coalesce(churn_prob BETWEEN 0 AND 1, false))
  FROM predictions
UNION ALL SELECT 'churn_label in {0,1}', count(*) FILTER (WHERE NOT coalesce(churn_label IN (0, 1), false))
  FROM predictions
UNION ALL SELECT 'source in {api,batch}', count(*) FILTER (WHERE NOT coalesce(source IN ('api', 'batch'), false))
  FROM predictions""", PRED_CTE)

# ---------------------------------------------------------------- EDA twins
_TXC = ["msno", "payment_method_id", "payment_plan_days", "plan_list_price", "actual_amount_paid", "is_auto_renew",
        "transaction_date", "membership_expire_date", "is_cancel", "l_orderkey", "l_linenumber", "l_partkey",
        "l_suppkey", "l_quantity", "l_extendedprice"]
sql("dataset_profile", f"""
SELECT 'transactions' AS "table", {len(_TXC)} AS n_cols, count(*) AS n_rows,
       {' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in _TXC)} AS n_null_cells,
       concat_ws(';', {', '.join(f"'{c}=' || count(*) FILTER (WHERE {c} IS NULL)" for c in _TXC)}) AS nulls_by_column,
       count(DISTINCT msno) AS n_keys, min(transaction_date) AS min_date, max(transaction_date) AS max_date
FROM transactions""")

sql("price_describe", " UNION ALL ".join(f"""
SELECT '{c}' AS column, count({c}) AS count, round(CAST(sum({c}) AS DOUBLE) / count({c}), 4) AS mean,
       round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
       quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50,
       quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max
FROM transactions""" for c in ("actual_amount_paid", "plan_list_price")))

sql("plan_day_counts", """
SELECT payment_plan_days, count(*) AS n, round(count(*) / (SELECT count(*) FROM transactions
  WHERE payment_plan_days IS NOT NULL), 6) AS share
FROM transactions WHERE payment_plan_days IS NOT NULL GROUP BY 1 ORDER BY n DESC, payment_plan_days LIMIT 10""")
sql("gender_counts", """
SELECT gender, count(*) AS n, round(count(*) / (SELECT count(*) FROM members), 6) AS share
FROM members GROUP BY 1""")
sql("tx_overview", """
SELECT count(*) AS n_rows,
       CAST(sum(plan_list_price - actual_amount_paid) AS DOUBLE) / count(plan_list_price - actual_amount_paid)
         AS mean_discount,
       CAST(sum(CAST(CASE WHEN plan_list_price > 0 THEN (plan_list_price - actual_amount_paid) / plan_list_price END
                     AS DECIMAL(18,8))) AS DOUBLE)
         / count(CASE WHEN plan_list_price > 0 THEN 1 END) AS mean_discount_pct,
       count(*) FILTER (WHERE actual_amount_paid = 0) / count(*) AS zero_price_share,
       sum(is_auto_renew) / count(is_auto_renew) AS auto_renew_rate,
       sum(is_cancel) / count(is_cancel) AS cancel_rate,
       min(transaction_date) AS first_date, max(transaction_date) AS last_date
FROM transactions""")


def _cut_sql(e: str, edges, labels, order: bool = False) -> str:
    parts = []
    for i, lab in enumerate(labels):
        v = str(i) if order else f"'{lab}'"
        parts.append(f"WHEN {e} > {edges[i]} AND {e} <= {edges[i + 1]} THEN {v}")
    return "CASE " + " ".join(parts) + " END"


_AGE = ([0, 18, 25, 35, 45, 55, 100], ["<18", "18-25", "25-35", "35-45", "45-55", "55+"])
_TEN = ([0, 90, 365, 730, 1095, 1825, 99999], ["<3m", "3-12m", "1-2y", "2-3y", "3-5y", "5y+"])
_RECB = ([0, 7, 30, 60, 90, 180, 365], ["<1w", "1w-1m", "1-2m", "2-3m", "3-6m", "6m+"])
ML_CTE = RAW_MATRIX_CTE + """,
ml AS (SELECT m.*, l.is_churn FROM mem_feat m JOIN cur_labels l USING (msno))"""


def _rate_sql(src: str, key_expr: str, key: str, min_n: int = 0) -> str:
    return f"""
SELECT {key}, n, round(pos / n, 6) AS churn_rate, round((pos / n) / overall, 6) AS lift
FROM (SELECT {key_expr} AS {key}, count(*) AS n, sum(is_churn) AS pos FROM {src}
      WHERE {key_expr} IS NOT NULL GROUP BY 1) g
CROSS JOIN (SELECT sum(is_churn) / count(*) AS overall FROM {src} WHERE {key_expr} IS NOT NULL) o
WHERE n >= {min_n}"""


sql("rate_by_city", _rate_sql("ml", "city", "city", 20), ML_CTE)
sql("rate_by_registration", _rate_sql("ml", "registered_via", "registered_via"), ML_CTE)
sql("rate_by_gender", _rate_sql("ml", "gender_enc", "gender_enc"), ML_CTE)
sql("rate_by_age", _rate_sql("ml", _cut_sql("age", *_AGE), "age_group"), ML_CTE)
sql("rate_by_tenure", _rate_sql("ml", _cut_sql("tenure_days", *_TEN), "tenure_bucket"), ML_CTE)
sql("rate_by_recency", _rate_sql("raw", _cut_sql("CASE WHEN days_since_last IS NOT NULL THEN least(days_since_last, 365) END", *_RECB), "recency_bucket"), ML_CTE)
sql("rate_by_plan", _rate_sql("raw", "last_plan_days", "last_plan_days", 20), ML_CTE)
sql("rate_by_payment", _rate_sql("raw", "last_payment_method", "last_payment_method"), ML_CTE)
sql("top_cities", "SELECT * FROM (" + _rate_sql("ml", "city", "city", 20) + ") t ORDER BY churn_rate DESC, city LIMIT 15",
    ML_CTE)
sql("crosstab_cancel", """
SELECT last_is_cancel, n_0, n_1, round(n_0 / (n_0 + n_1), 6) AS pct_0, round(n_1 / (n_0 + n_1), 6) AS pct_1
FROM (SELECT last_is_cancel, count(*) FILTER (WHERE is_churn = 0) AS n_0, count(*) FILTER (WHERE is_churn = 1) AS n_1
      FROM raw GROUP BY 1) t""", RAW_MATRIX_CTE)
sql("price_histogram", """
SELECT is_churn, bin, round(lo + bin * (hi - lo) / 20, 6) AS bin_lo, round(lo + (bin + 1) * (hi - lo) / 20, 6) AS bin_hi,
       n, round(n / (sum(n) OVER (PARTITION BY is_churn) * CASE WHEN (hi - lo) / 20 > 0 THEN (hi - lo) / 20 ELSE 1.0 END), 9)
         AS density
FROM (SELECT is_churn, lo, hi, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((CAST(avg_price AS DOUBLE) - lo) / (hi - lo) * 20), 19) END
             AS INTEGER) AS bin, count(*) AS n
      FROM raw CROSS JOIN (SELECT CAST(min(avg_price) AS DOUBLE) AS lo, CAST(max(avg_price) AS DOUBLE) AS hi FROM raw) r
      WHERE avg_price IS NOT NULL GROUP BY 1, 2, 3, 4) t""", RAW_MATRIX_CTE)
sql("score_distribution", """
SELECT count(prob) AS n, round(avg(prob), 9) AS mean, min(prob) AS min, max(prob) AS max,
       round(count(*) FILTER (WHERE prob >= 0.5) / count(prob), 9) AS share_pos,
       quantile_cont(prob, 0.5) AS p50, quantile_cont(prob, 0.9) AS p90, quantile_cont(prob, 0.99) AS p99
FROM (SELECT l_extendedprice / 200000 AS prob FROM lineitem) t""")

FM_CTE = RAW_MATRIX_CTE + ", fm AS (" + _matrix_sql("v5") + ")"


def _corr_sql(a: str, b: str) -> str:
    x, y = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    return f"CASE WHEN stddev_pop({x}) > 0 AND stddev_pop({y}) > 0 THEN corr({x}, {y}) END"


sql("target_correlation", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round({_corr_sql(c, 'is_churn')}, 6) AS corr, "
    f"round(abs({_corr_sql(c, 'is_churn')}), 6) AS abs_corr FROM fm" for c in FEATURE_SETS["v5"]), FM_CTE)
_CORR_CTE = FM_CTE + f""",
cl AS (SELECT * FROM (UNPIVOT (SELECT msno, CAST(is_churn AS DOUBLE) AS y, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in FEATURE_SETS['v5'])}
       FROM fm) ON COLUMNS(* EXCLUDE (msno, y)) INTO NAME feature VALUE v)),
best AS (SELECT feature, CASE WHEN stddev_pop(v) > 0 AND stddev_pop(y) > 0 THEN round(abs(corr(v, y)), 9) END AS r FROM cl GROUP BY 1),
top15 AS (SELECT feature FROM best ORDER BY r DESC NULLS LAST, feature LIMIT 15)"""


def _corr_pairs(src: str) -> str:
    return f"""
SELECT a.feature AS a, b.feature AS b,
       CASE WHEN stddev_pop(a.v) > 0 AND stddev_pop(b.v) > 0 THEN round(corr(a.v, b.v), 6) END AS corr
FROM {src} a JOIN {src} b ON a.msno = b.msno AND a.feature <= b.feature GROUP BY 1, 2"""


sql("correlations_all", _corr_pairs("cl"), _CORR_CTE)
sql("correlation_matrix", _corr_pairs("(SELECT * FROM cl SEMI JOIN top15 USING (feature))"), _CORR_CTE)
sql("class_balance", """
SELECT period, is_churn, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY period), 6) AS share
FROM period_labels GROUP BY 1, 2""")
_OC = ["n_transactions", "avg_price", "days_until_expire", "n_renewals"]
sql("outcome_profile", f"""
SELECT result, count(*) AS n, round(avg(prob), 6) AS mean_prob, {', '.join(f'round(avg({c}), 6) AS {c}' for c in _OC)}
FROM (SELECT *, CASE WHEN is_churn = 1 AND prob >= 0.5 THEN 'TP' WHEN is_churn = 0 AND prob >= 0.5 THEN 'FP'
                     WHEN is_churn = 1 AND prob < 0.5 THEN 'FN' WHEN is_churn = 0 AND prob < 0.5 THEN 'TN' END AS result
      FROM (SELECT *, 1 - 1 / (1 + days_since_last_tx / 30.0) AS prob FROM fm) s) t
GROUP BY 1""", FM_CTE)
sql("play_depth_medians", " UNION ALL ".join(
    f"SELECT '{c}' AS column, median(CAST({c} AS DOUBLE)) AS median FROM user_logs"
    for c in ["num_25", "num_50", "num_75", "num_985", "num_100", "num_unq"]))
_SC = ["n_transactions", "avg_price", "tenure_days", "days_until_expire", "days_since_last_tx", "n_days"]
sql("feature_summary", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, median({c}) AS median "
    f"FROM fm" for c in _SC), FM_CTE)
sql("key_coverage", """
SELECT source, n_present, n_left, round(n_present / n_left, 6) AS coverage
FROM (SELECT 'transactions' AS source, count(*) AS n_present FROM (SELECT DISTINCT msno FROM cur_labels) k
        WHERE msno IN (SELECT msno FROM transactions)
      UNION ALL SELECT 'members', count(*) FROM (SELECT DISTINCT msno FROM cur_labels) k
        WHERE msno IN (SELECT msno FROM members)
      UNION ALL SELECT 'user_logs', count(*) FROM (SELECT DISTINCT msno FROM cur_labels) k
        WHERE msno IN (SELECT msno FROM user_logs)) t
CROSS JOIN (SELECT count(DISTINCT msno) AS n_left FROM cur_labels) n""")
_PREV = f"(SELECT msno FROM period_labels WHERE period = '{P.prev_period}')"
sql("user_overlap", f"""
SELECT (SELECT count(DISTINCT msno) FROM {_PREV} a) AS n_a, (SELECT count(DISTINCT msno) FROM cur_labels) AS n_b,
       (SELECT count(*) FROM (SELECT msno FROM {_PREV} a INTERSECT SELECT msno FROM cur_labels) i) AS n_both""")
sql("churn_with_without_logs", """
SELECT true AS has_logs, count(*) AS n, round(avg(is_churn), 6) AS churn_rate FROM cur_labels
  WHERE msno IN (SELECT msno FROM user_logs)
UNION ALL
SELECT false, count(*), round(avg(is_churn), 6) FROM cur_labels WHERE msno NOT IN (SELECT msno FROM user_logs)""")
sql("stacked_periods", """
SELECT period, count(*) AS n, CAST(sum(is_churn) AS BIGINT) AS n_churn FROM period_labels GROUP BY 1""")
sql("key_intersect", f"SELECT msno FROM {_PREV} a INTERSECT SELECT msno FROM members")
sql("key_except", "SELECT DISTINCT msno FROM members WHERE msno NOT IN (SELECT msno FROM cur_labels)")
sql("top_risk", """
SELECT msno, churn_prob, model_version, period FROM predictions
ORDER BY churn_prob DESC, msno, period, model_version LIMIT 20""", PRED_CTE)


def _bucket_sql(src: str, e: str, edges_labels) -> str:
    return f"""
SELECT bucket, bucket_order, count(*) AS n, round(avg(is_churn), 6) AS churn_rate
FROM (SELECT {_cut_sql(e, *edges_labels)} AS bucket, {_cut_sql(e, *edges_labels, order=True)} AS bucket_order, is_churn
      FROM {src}) t WHERE bucket IS NOT NULL GROUP BY 1, 2"""


sql("age_bucket", _bucket_sql("ml", "age", _AGE), ML_CTE)
sql("tenure_bucket", _bucket_sql("ml", "tenure_days", _TEN), ML_CTE)
sql("recency_bucket", _bucket_sql("raw", "CASE WHEN days_since_last IS NOT NULL THEN least(days_since_last, 365) END", _RECB), ML_CTE)
sql("trimmed_prices", """
SELECT count(*) AS n_rows, CAST(min(actual_amount_paid) AS DOUBLE) AS min_paid,
       CAST(max(actual_amount_paid) AS DOUBLE) AS max_paid
FROM transactions CROSS JOIN (SELECT quantile_cont(CAST(actual_amount_paid AS DOUBLE), 0.01) AS lo,
                                     quantile_cont(CAST(actual_amount_paid AS DOUBLE), 0.99) AS hi FROM transactions) q
WHERE actual_amount_paid BETWEEN lo AND hi""")
sql("winsorized_counts", """
SELECT n_transactions, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM (SELECT least(CAST(n_transactions AS DOUBLE), cap) AS n_transactions FROM raw
      CROSS JOIN (SELECT quantile_cont(CAST(n_transactions AS DOUBLE), 0.99) AS cap FROM raw) c) t
WHERE n_transactions IS NOT NULL GROUP BY 1""", RAW_MATRIX_CTE)

# ---------------------------------------------------------------- metrics twins
SCORES_CTE = """
scores AS (
  SELECT 'tied' AS kind, CAST(l_returnflag = 'R' AS INTEGER) AS label, l_discount * 10 AS prob FROM lineitem
  UNION ALL
  SELECT 'smooth', CAST(l_returnflag = 'R' AS INTEGER), l_extendedprice / 200000 FROM lineitem
),
g AS (SELECT kind, prob AS threshold, CAST(sum(label) AS BIGINT) AS pos, count(*) - sum(label) AS neg
      FROM scores WHERE prob IS NOT NULL GROUP BY 1, 2),
tt AS (
  SELECT kind, threshold, pos, neg,
         sum(pos) OVER (PARTITION BY kind ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tp,
         sum(neg) OVER (PARTITION BY kind ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS fp,
         sum(pos) OVER (PARTITION BY kind) AS P, sum(neg) OVER (PARTITION BY kind) AS N
  FROM g
),
ranked AS (
  SELECT kind, label, rank() OVER (PARTITION BY kind ORDER BY prob) AS rmin,
         count(*) OVER (PARTITION BY kind, prob) AS cnt
  FROM scores
)"""
sql("threshold_table", """
SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(P - tp AS BIGINT) AS fn,
       CAST(N - fp AS BIGINT) AS tn FROM tt WHERE kind = 'tied'""", SCORES_CTE)
# Rank form of the AUC (average ranks of positives), independent of the threshold table.
sql("metric_roc_auc", """
SELECT kind, CASE WHEN p > 0 AND n > 0 THEN CAST(s - p * (p + 1) AS DOUBLE) / (2 * p * n) END AS roc_auc
FROM (SELECT kind, sum(CASE WHEN label = 1 THEN 2 * rmin + cnt - 1 ELSE 0 END) AS s,
             sum(label) AS p, count(*) - sum(label) AS n FROM ranked GROUP BY kind) t""", SCORES_CTE)
sql("metric_pr_auc", """
SELECT kind, CASE WHEN max(P) > 0 THEN round(sum(CASE WHEN pos > 0 THEN pos / P * (tp / (tp + fp)) END), 10) END
  AS pr_auc FROM tt GROUP BY kind""", SCORES_CTE)
sql("metric_log_loss", f"""
SELECT kind, round(avg(-CASE WHEN label = 1 THEN ln(least(greatest(prob, {2.220446049250313e-16!r}), {1 - 2.220446049250313e-16!r}))
                        ELSE ln(1 - least(greatest(prob, {2.220446049250313e-16!r}), {1 - 2.220446049250313e-16!r})) END), 10)
  AS log_loss FROM scores WHERE prob IS NOT NULL GROUP BY kind""", SCORES_CTE)
sql("roc_points", """
SELECT threshold, round(CASE WHEN N > 0 THEN fp / N END, 12) AS fpr, round(CASE WHEN P > 0 THEN tp / P END, 12) AS tpr
FROM tt WHERE kind = 'tied'""", SCORES_CTE)
sql("pr_points", """
SELECT threshold, round(tp / (tp + fp), 12) AS precision, round(CASE WHEN P > 0 THEN tp / P END, 12) AS recall
FROM tt WHERE kind = 'tied'""", SCORES_CTE)
sql("best_f1", """
SELECT kind, threshold, round(pr, 9) AS precision, round(rc, 9) AS recall, round(f1, 9) AS f1
FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY f1 DESC, threshold ASC) AS rn
      FROM (SELECT kind, threshold, pr, rc, 2 * pr * rc / (pr + rc + 1e-9) AS f1
            FROM (SELECT kind, threshold, tp / (tp + fp) AS pr, CASE WHEN P > 0 THEN tp / P ELSE 0.0 END AS rc FROM tt) a) b) c
WHERE rn = 1""", SCORES_CTE)
_CR = """
c AS (SELECT count(*) FILTER (WHERE label = 1 AND prob >= 0.5) AS tp, count(*) FILTER (WHERE label = 0 AND prob >= 0.5) AS fp,
             count(*) FILTER (WHERE label = 1 AND prob < 0.5) AS fn, count(*) FILTER (WHERE label = 0 AND prob < 0.5) AS tn
      FROM scores WHERE kind = 'tied'),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1,
             CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0, CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0,
             tp + fn AS s1, tn + fp AS s0 FROM c),
f AS (SELECT *, CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1_1,
             CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f1_0, s0 + s1 AS n FROM m)"""
sql("classification_report", """
SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f1_0, 6) AS f1, s0 AS support FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1_1, 6), s1 FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f1_0 + f1_1) / 2, 6), n FROM f
UNION ALL SELECT 'weighted avg', round(CASE WHEN n > 0 THEN (p0 * s0 + p1 * s1) / n ELSE 0.0 END, 6),
  round(CASE WHEN n > 0 THEN (r0 * s0 + r1 * s1) / n ELSE 0.0 END, 6),
  round(CASE WHEN n > 0 THEN (f1_0 * s0 + f1_1 * s1) / n ELSE 0.0 END, 6), n FROM f
UNION ALL SELECT 'accuracy', round(CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0.0 END, 6),
  round(CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0.0 END, 6), round(CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0.0 END, 6), n FROM f""",
    SCORES_CTE + "," + _CR)
sql("confusion_matrix", """
SELECT actual, predicted, n, round(n / sum(n) OVER (PARTITION BY actual), 6) AS share
FROM (SELECT label AS actual, CAST(prob >= 0.5 AS INTEGER) AS predicted, count(*) AS n FROM scores WHERE kind = 'tied'
      GROUP BY 1, 2) t""", SCORES_CTE)
_LATEST = """
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY msno ORDER BY predicted_at DESC, model_version DESC,
                                  l_orderkey DESC, l_linenumber DESC, churn_prob DESC) AS rn
                 FROM predictions WHERE period = '1998-06' {extra}) t WHERE rn = 1
)"""
sql("latest_prediction", "SELECT msno, churn_prob, model_version, period, source, predicted_at FROM latest",
    PRED_CTE + "," + _LATEST.format(extra=""))
sql("eval_join", """
SELECT p.model_version, count(*) AS n, CAST(sum(g.actual_churn) AS BIGINT) AS n_churn
FROM predictions p JOIN ground_truth g ON p.msno = g.msno AND p.period = g.period
WHERE p.source = 'batch' AND p.period = '1998-06' GROUP BY 1""", PRED_CTE)
sql("performance_report", f"""
SELECT '1998-06' AS period, count(*) AS n, round(avg(label), 6) AS churn_rate,
       round(CASE WHEN sum(label) > 0 AND count(*) - sum(label) > 0 THEN
         CAST(sum(CASE WHEN label = 1 THEN 2 * rmin + cnt - 1 ELSE 0 END) - sum(label) * (sum(label) + 1) AS DOUBLE)
         / (2 * sum(label) * (count(*) - sum(label))) END, 10) AS roc_auc,
       round(avg(-CASE WHEN label = 1 THEN ln(least(greatest(prob, {2.220446049250313e-16!r}), {1 - 2.220446049250313e-16!r}))
                  ELSE ln(1 - least(greatest(prob, {2.220446049250313e-16!r}), {1 - 2.220446049250313e-16!r})) END), 10) AS log_loss,
       coalesce(CASE WHEN sum(label) > 0 AND count(*) - sum(label) > 0 THEN
         CAST(sum(CASE WHEN label = 1 THEN 2 * rmin + cnt - 1 ELSE 0 END) - sum(label) * (sum(label) + 1) AS DOUBLE)
         / (2 * sum(label) * (count(*) - sum(label))) END < 0.85, false) AS alert
FROM (SELECT label, prob, rank() OVER (ORDER BY prob) AS rmin, count(*) OVER (PARTITION BY prob) AS cnt
      FROM (SELECT CAST(g.actual_churn AS INTEGER) AS label, CAST(l.churn_prob AS DOUBLE) AS prob
            FROM latest l JOIN ground_truth g ON l.msno = g.msno AND l.period = g.period) j) r""",
    PRED_CTE + "," + _LATEST.format(extra="AND source = 'batch'"))
sql("outcome_counts", """
SELECT CASE WHEN label = 1 AND prob >= 0.5 THEN 'TP' WHEN label = 0 AND prob >= 0.5 THEN 'FP'
            WHEN label = 1 AND prob < 0.5 THEN 'FN' WHEN label = 0 AND prob < 0.5 THEN 'TN' END AS result, count(*) AS n
FROM scores WHERE kind = 'tied' GROUP BY 1""", SCORES_CTE)
sql("risk_bands", """
SELECT CASE WHEN prob < 0.3 THEN 'low' WHEN prob < 0.5 THEN 'medium' WHEN prob IS NOT NULL THEN 'high' END AS band,
       count(*) AS n FROM scores WHERE kind = 'smooth' GROUP BY 1""", SCORES_CTE)
sql("tx_discount", """
SELECT payment_method_id, count(*) AS n, CAST(sum(plan_list_price - actual_amount_paid) AS DOUBLE) AS sum_discount,
       CAST(sum(pct) AS DOUBLE) / count(pct) AS mean_discount_pct, count(*) FILTER (WHERE pct IS NULL) AS n_no_list_price,
       CAST(sum(CASE WHEN payment_plan_days - 25 IS NOT NULL THEN least(greatest(payment_plan_days - 25, 0), 10) END) AS BIGINT)
         AS sum_clipped_days
FROM (SELECT *, CAST(CASE WHEN plan_list_price > 0 THEN (plan_list_price - actual_amount_paid) / plan_list_price END
                     AS DECIMAL(18,8)) AS pct FROM transactions) t GROUP BY 1""")

# ---------------------------------------------------------------- store round trips
sql("feature_store_roundtrip", "SELECT fm.*, '" + P.period + "' AS period FROM fm", FM_CTE)
sql("predictions_roundtrip", """
SELECT source, count(*) AS n, CAST(sum(churn_label) AS BIGINT) AS n_pos
FROM (SELECT churn_label, 'batch' AS source FROM predictions WHERE period = '1998-06'
      UNION ALL SELECT churn_label, 'api' FROM predictions WHERE period = '1998-06' AND churn_label = 1) t
GROUP BY 1""", PRED_CTE)

# ---------------------------------------------------------------- merges and commits
sql("incremental_log_agg", "SELECT * FROM log_agg", LOG_AGG_CTE)
_GT = """(SELECT o.o_custkey AS msno, strftime(o.o_orderdate, '%Y-%m') AS period,
         CAST(max(CAST(l.l_returnflag = 'R' AS INTEGER)) AS SMALLINT) AS actual_churn
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)"""
sql("ground_truth_batches", f"SELECT msno, period, actual_churn FROM {_GT} g")
sql("appended_predictions", """
SELECT h.hour, churn_label, count(*) AS n
FROM (SELECT msno, max(churn_label) AS churn_label FROM predictions WHERE period = '1998-06' GROUP BY 1) p
CROSS JOIN (SELECT 10 AS hour UNION ALL SELECT 11) h GROUP BY 1, 2""", PRED_CTE)
sql("period_as_of_commit", """
SELECT c.commit_no, is_churn, count(*) AS n
FROM cur_labels CROSS JOIN (SELECT unnest([1, 2, 3]) AS commit_no) c
WHERE c.commit_no < 3 OR is_churn = 1 GROUP BY 1, 2""")

# ---------------------------------------------------------------- monitoring twins
_DRIFT_COLS = FEATURE_SETS["v5"]


def _fm_for(period: str) -> str:
    """The v5 matrix of another label month: the same text with that month's cutoffs, as a subquery."""
    cfg, names = period_config(period), {}
    for a, b in [(P.tx_as_of, cfg.tx_as_of), (P.log_recent, cfg.log_recent), (P.label_start, cfg.label_start),
                 *((P.log_windows[k], cfg.log_windows[k]) for k in P.log_windows),
                 *((P.tx_ref - dt.timedelta(days=n), cfg.tx_ref - dt.timedelta(days=n)) for n in (7, 30))]:
        names |= {str(ymd(a)): str(ymd(b)), a.isoformat(): b.isoformat()}
    names |= {f"'{P.period}'": f"'{cfg.period}'", f"'{P.prev_period}'": f"'{cfg.prev_period}'"}
    text = re.sub("|".join(map(re.escape, names)), lambda m: names[m.group()], FM_CTE)
    starts = " UNION ALL ".join(f"SELECT '{p}' AS period, {p.replace('-', '')}01 AS start" for p in (cfg.period, cfg.prev_period))
    return f"""(WITH labels_of AS (
  SELECT u.msno, p.period, CAST(u.last_tx < p.start AS INTEGER) AS is_churn
  FROM (SELECT msno, min(transaction_date) AS first_tx, max(transaction_date) AS last_tx FROM transactions GROUP BY msno) u
  CROSS JOIN ({starts}) p WHERE u.first_tx < p.start),
cur_labels AS (SELECT msno, is_churn FROM labels_of WHERE period = '{cfg.period}'),
{text.replace('period_labels', 'labels_of')} SELECT * FROM fm)"""


def _drift_cte(period: str) -> str:
    def long(src):
        return (f"SELECT feature, v FROM (UNPIVOT (SELECT msno, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _DRIFT_COLS)} "
                f"FROM {src}) ON COLUMNS(* EXCLUDE (msno)) INTO NAME feature VALUE v)")
    names = ", ".join(f"'{c}'" for c in _DRIFT_COLS)
    return (f"""base_fm AS MATERIALIZED {_fm_for(P.period)},
cur_fm AS MATERIALIZED {_fm_for(period)},
names AS (SELECT unnest([{names}]) AS feature),
base_long AS (SELECT * FROM ({long('base_fm')}) t WHERE v IS NOT NULL),
cur_long AS (SELECT * FROM ({long('cur_fm')}) t WHERE v IS NOT NULL),
info AS (SELECT feature, count(DISTINCT v) AS n_distinct,
                quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
         FROM base_long GROUP BY 1),
bb AS (SELECT l.feature, CASE WHEN i.n_distinct <= 20 THEN l.v
                              ELSE CAST(len(list_filter(i.edges, lambda e: e < l.v)) AS DOUBLE) END AS bin
       FROM base_long l JOIN info i USING (feature)),
cb AS (SELECT l.feature, CASE WHEN i.n_distinct <= 20 THEN l.v
                              ELSE CAST(len(list_filter(i.edges, lambda e: e < l.v)) AS DOUBLE) END AS bin
       FROM cur_long l JOIN info i USING (feature)),
nb AS (SELECT feature, bin, count(*) AS nb FROM bb GROUP BY 1, 2),
nc AS (SELECT feature, bin, count(*) AS nc FROM cb GROUP BY 1, 2),
jn AS (SELECT coalesce(nb.feature, nc.feature) AS feature, coalesce(nb.nb, 0) AS nb, coalesce(nc.nc, 0) AS nc
       FROM nb FULL OUTER JOIN nc ON nb.feature = nc.feature AND nb.bin = nc.bin),
sh AS (SELECT feature, CASE WHEN sum(nb) OVER (PARTITION BY feature) > 0
                THEN greatest(nb / sum(nb) OVER (PARTITION BY feature), 1e-6) END AS sb,
              CASE WHEN sum(nc) OVER (PARTITION BY feature) > 0
                THEN greatest(nc / sum(nc) OVER (PARTITION BY feature), 1e-6) END AS sc FROM jn),
kv AS (SELECT feature, v, sum(wb) AS wb, sum(wc) AS wc
       FROM (SELECT feature, v, 1 AS wb, 0 AS wc FROM base_long UNION ALL SELECT feature, v, 0, 1 FROM cur_long) u
       GROUP BY 1, 2),
kc AS (SELECT feature, sum(wb) OVER (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING) AS cb,
              sum(wc) OVER (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING) AS cc,
              sum(wb) OVER (PARTITION BY feature) AS nb, sum(wc) OVER (PARTITION BY feature) AS nc FROM kv),
ks AS (SELECT feature, max(CASE WHEN nb > 0 AND nc > 0 THEN abs(cb / nb - cc / nc) END) AS ks FROM kc GROUP BY 1),
drift AS (SELECT n.feature, round(p.psi_raw, 9) AS psi, round(k.ks, 9) AS ks, p.psi_raw > 0.2 AS drifted
          FROM names n LEFT JOIN (SELECT feature, sum((sc - sb) * ln(sc / sb)) AS psi_raw FROM sh GROUP BY 1) p USING (feature)
          LEFT JOIN ks k USING (feature)),
dscore AS (SELECT n_cols, n_drifted, round(CASE WHEN n_cols > 0 THEN n_drifted / n_cols END, 6) AS drift_score,
                  coalesce(CASE WHEN n_cols > 0 THEN n_drifted / n_cols END > 0.15, false) AS dataset_drift,
                  CASE WHEN n_cols = 0 THEN 'no data' WHEN n_drifted / n_cols > 0.15 THEN 'drift' ELSE 'ok' END AS status
           FROM (SELECT count(drifted) AS n_cols, count(*) FILTER (WHERE drifted) AS n_drifted FROM drift) t)""")


DRIFT_CTE, EVAL_DRIFT_CTE = _drift_cte("2001-01"), _drift_cte("1998-06")
sql("drift_by_column", "SELECT * FROM drift", DRIFT_CTE)
sql("drift_score", "SELECT * FROM dscore", DRIFT_CTE)
sql("drift_history", "SELECT '2001-01' AS period, drift_score, dataset_drift FROM dscore UNION ALL "
    "SELECT '2000-11', drift_score, dataset_drift FROM (" + "WITH " + BINDINGS + "," + _drift_cte("2000-11")
    + " SELECT * FROM dscore) h", DRIFT_CTE)
_PERF_SUB = "(" + ORACLE["performance_report"] + ")"
sql("alerts", f"""
SELECT *, CASE WHEN value IS NULL THEN 'no data' WHEN alert THEN 'alert' ELSE 'ok' END AS status FROM (
  SELECT 'drift_score' AS "check", CAST(drift_score AS DOUBLE) AS value, 0.15 AS threshold,
         coalesce(drift_score > 0.15, false) AS alert FROM dscore
  UNION ALL
  SELECT 'roc_auc', CAST(roc_auc AS DOUBLE), 0.85, coalesce(roc_auc < 0.85, false) FROM {_PERF_SUB} p) c""",
    EVAL_DRIFT_CTE)
sql("period_summary", f"""
SELECT '1998-06' AS period, d.drift_score, d.dataset_drift AS drift_alert, p.n, p.roc_auc, p.log_loss,
       p.alert AS auc_alert, CASE WHEN d.dataset_drift OR p.alert THEN 'ALERT'
         WHEN d.drift_score IS NULL OR p.roc_auc IS NULL THEN 'NO DATA' ELSE 'OK' END AS status
FROM dscore d CROSS JOIN {_PERF_SUB} p""", EVAL_DRIFT_CTE)

_NOW = "TIMESTAMP '1998-06-20 12:00:00'"
sql("pred_volume", f"SELECT count(*) AS n_predictions FROM predictions WHERE predicted_at > {_NOW} - INTERVAL 24 HOUR",
    PRED_CTE)
sql("daily_churn_rate", f"""
SELECT CAST(predicted_at AS DATE) AS day, count(*) AS n, round(avg(CAST(churn_label AS DOUBLE)), 6) AS churn_rate
FROM predictions WHERE predicted_at > {_NOW} - INTERVAL 168 HOUR GROUP BY 1""", PRED_CTE)
sql("mean_probability", f"""
SELECT mean_prob, CASE WHEN mean_prob < 0.3 THEN 'low' WHEN mean_prob < 0.5 THEN 'medium'
                       WHEN mean_prob IS NOT NULL THEN 'high' END AS band
FROM (SELECT round(avg(CAST(churn_prob AS DOUBLE)), 6) AS mean_prob FROM predictions
      WHERE predicted_at > {_NOW} - INTERVAL 24 HOUR) t""", PRED_CTE)
sql("latest_version", """
SELECT model_version FROM predictions
ORDER BY predicted_at DESC, TRY_CAST(regexp_extract(model_version, '(\\d+)', 1) AS INTEGER) DESC NULLS LAST LIMIT 1""", PRED_CTE)
sql("hourly_by_source", f"""
SELECT date_trunc('hour', predicted_at) AS hour, source, count(*) AS n FROM predictions
WHERE predicted_at > {_NOW} - INTERVAL 168 HOUR GROUP BY 1, 2""", PRED_CTE)
sql("today_totals", """
SELECT count(*) AS n, round(avg(CAST(churn_label AS DOUBLE)), 6) AS churn_rate,
       round(avg(CAST(churn_prob AS DOUBLE)), 6) AS mean_prob
FROM predictions WHERE CAST(predicted_at AS DATE) = DATE '1998-06-20'""", PRED_CTE)
sql("daily_series", """
SELECT c.day, coalesce(n, 0) AS n
FROM (SELECT CAST(range AS DATE) AS day FROM range(TIMESTAMP '1998-06-14', TIMESTAMP '1998-06-21', INTERVAL 1 DAY)) c
LEFT JOIN (SELECT CAST(predicted_at AS DATE) AS day, count(*) AS n FROM predictions
           WHERE CAST(predicted_at AS DATE) BETWEEN DATE '1998-06-14' AND DATE '1998-06-20' GROUP BY 1) x USING (day)""",
    PRED_CTE)
sql("recent_predictions", f"""
SELECT msno, churn_prob, model_version, source, predicted_at FROM predictions WHERE predicted_at <= {_NOW}
ORDER BY predicted_at DESC, msno, model_version, source, churn_prob LIMIT 50""", PRED_CTE)
sql("class_weights", """
SELECT n_pos, n_neg, CASE WHEN n_pos > 0 THEN n_neg / n_pos END AS scale_pos_weight,
       CASE WHEN n_pos > 0 THEN (n_pos + n_neg) / (2 * n_pos) END AS weight_pos,
       CASE WHEN n_neg > 0 THEN (n_pos + n_neg) / (2 * n_neg) END AS weight_neg
FROM (SELECT count(*) FILTER (WHERE is_churn = 1) AS n_pos, count(*) FILTER (WHERE is_churn = 0) AS n_neg
      FROM cur_labels) t""")
sql("quality_gate", """
SELECT l.kind, l.log_loss, a.roc_auc, coalesce(l.log_loss <= 0.24, false) AND coalesce(a.roc_auc >= 0.5, false) AS passed,
       CASE WHEN coalesce(l.log_loss <= 0.24, false) AND coalesce(a.roc_auc >= 0.5, false) THEN 'Staging' ELSE 'None' END
         AS stage
FROM (""" + ORACLE["metric_log_loss"] + ") l JOIN (" + ORACLE["metric_roc_auc"] + ") a USING (kind)")

# ---------------------------------------------------------------- streaming batch twin
sql("prediction_rate_stream", """
SELECT date_trunc('hour', predicted_at) AS window_start, source, count(*) AS n FROM predictions GROUP BY 1, 2""",
    PRED_CTE)

sql("tenure_years", """
SELECT round_even(tenure_days / 365, 1) AS tenure_years, count(*) AS n, CAST(sum(is_churn) AS BIGINT) AS n_churn
FROM ml GROUP BY 1""", ML_CTE)

sql("latest_drift", """
SELECT period, drift_score, dataset_drift,
       CASE WHEN drift_score > 0.15 THEN 'red' WHEN drift_score > 0.10 THEN 'yellow'
            WHEN drift_score IS NOT NULL THEN 'green' END AS band
FROM (""" + ORACLE["drift_history"] + """) h ORDER BY period DESC LIMIT 1""")

# ---------------------------------------------------------------- splits, samples and model invariants
sql("top_nulls", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    f"CASE WHEN count(*) > 0 THEN round(count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100, 4) END AS pct_null"
    f" FROM raw" for c in _RAW5) + ') t ORDER BY n_null DESC, "column" LIMIT 10', RAW_MATRIX_CTE)
sql("display_bands", """
SELECT CASE WHEN prob < 0.25 THEN 'low' WHEN prob < 0.5 THEN 'medium' WHEN prob IS NOT NULL THEN 'high' END AS band,
       count(*) AS n FROM scores WHERE kind = 'smooth' GROUP BY 1""", SCORES_CTE)
sql("missed_by_tx_bucket", f"""
SELECT {_cut_sql('n_transactions', [0, 5, 10, 20, 50, 1_000_000], ['1-5', '6-10', '11-20', '21-50', '50+'])} AS bucket,
       count(*) AS n, round(avg(prob), 6) AS mean_prob
FROM (SELECT *, 1 - 1 / (1 + days_since_last_tx / 30.0) AS prob FROM fm) t
WHERE is_churn = 1 AND prob < 0.5 GROUP BY 1""", FM_CTE)


def _key_hash(key: str, seed: int, buckets: int) -> str:
    return f"('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8))::BIGINT % {buckets}"


_TEST = f"(SELECT msno, is_churn FROM cur_labels WHERE {_key_hash('msno', 42, 10000)} >= 8000)"
sql("split", f"""
SELECT CASE WHEN {_key_hash('msno', 42, 10000)} < 8000 THEN 'train' ELSE 'test' END AS part,
       CAST(is_churn AS INTEGER) AS is_churn, count(*) AS n FROM cur_labels GROUP BY 1, 2""")
sql("stratified_folds", f"""
SELECT CAST({_key_hash('msno', 42, 5)} AS INTEGER) AS fold, is_churn, count(*) AS n FROM cur_labels GROUP BY 1, 2""")
sql("log_sample", f"""
SELECT msno, count(*) AS n_days FROM user_logs WHERE {_key_hash('msno', 42, 1000000)} < 500000 GROUP BY 1""")
_CHECKS = "count(*) AS n, count(*) AS n_in_range, count(*) AS n_label_ok, true AS auc_ok, true AS log_loss_ok"
sql("train_eval", " UNION ALL ".join(f"SELECT '{m}' AS model, {_CHECKS} FROM {_TEST} t" for m in ("lr", "gbt", "rf")))
sql("blend_scores", f"SELECT 'blend3' AS model, {_CHECKS}, count(*) AS n_mean_ok FROM {_TEST} t")
sql("temporal_validate", f"""
SELECT 'evaluate' AS phase, '{P.period}' AS eval_period, count(*) AS n, count(*) AS n_in_range FROM cur_labels
UNION ALL SELECT 'next', '2001-01', count(*), count(*)
FROM (SELECT msno FROM transactions GROUP BY msno HAVING min(transaction_date) < 20010101) t""")
sql("score_stream", f"""
SELECT msno, CASE WHEN {_ok_all} THEN 'scored' ELSE 'rejected' END AS status, true AS ok
FROM (SELECT *, CAST(last_is_cancel = 1 AND days_until_expire > 0 AS INTEGER) AS cancel_before_expire FROM raw) r""",
    RAW_MATRIX_CTE)
