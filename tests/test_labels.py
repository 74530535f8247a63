"""Labeller (W1-W3) against hand cases and a row-by-row walk of the same rules."""

import datetime as dt
import random

from churnlab.operators.labels import churn_labels, last_expire, renewal_gap
from churnlab.plans.periods import LabelWindow

SCHEMA = ("msno string, payment_method_id int, payment_plan_days int, plan_list_price int, actual_amount_paid int, "
          "is_auto_renew int, transaction_date int, membership_expire_date int, is_cancel int")
W = LabelWindow(dt.date(2017, 1, 1), dt.date(2017, 1, 31), dt.date(2017, 2, 1), dt.date(2017, 2, 28), 30)


def tx(msno, date, expire, cancel=0, price=149, days=30, method=41):
    return (msno, method, days, price, price, 1, date, expire, cancel)


def labels(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.msno: r.is_churn for r in churn_labels(df, W).collect()}


def test_hand_cases(spark):
    rows = [
        tx("no_future", 20170110, 20170210),
        tx("gap29", 20170110, 20170210), tx("gap29", 20170311, 20170410),
        tx("gap30", 20170110, 20170210), tx("gap30", 20170312, 20170412),
        # cancel moves the expiry earlier: renewal 13 days after the old expiry but 35 after the new one
        tx("cancel_early", 20170110, 20170225), tx("cancel_early", 20170201, 20170203, cancel=1),
        tx("cancel_early", 20170310, 20170410),
        # cancel whose expiry is later than the current one has no effect
        tx("cancel_late", 20170110, 20170210), tx("cancel_late", 20170201, 20170220, cancel=1),
        tx("cancel_late", 20170315, 20170415),
        # only cancellations after the history window -> gap 9999 -> churn
        tx("only_cancel", 20170110, 20170210), tx("only_cancel", 20170205, 20170206, cancel=1),
        tx("outside", 20170110, 20170320),  # expiry outside the target month: not a candidate
    ]
    got = labels(spark, rows)
    assert got == {"no_future": 1, "gap29": 0, "gap30": 1, "cancel_early": 1, "cancel_late": 1, "only_cancel": 1}


def test_same_day_order(spark):
    # Same day, same plan: subscription before cancellation -> the cancel is last.
    rows = [tx("a", 20170115, 20170215), tx("a", 20170115, 20170205, cancel=1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert last_expire(df, W.hist_start, W.hist_end).first().last_expire == 20170205
    # Same day, different plan text: higher text first, so the lower text ("149..." < "99...") is last.
    rows = [tx("b", 20170115, 20170215, price=99), tx("b", 20170115, 20170220, price=149)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert last_expire(df, W.hist_start, W.hist_end).first().last_expire == 20170220


def _key(r):
    sig = f"{r[3]}{r[2]}{r[1]}"
    return (r[6], tuple(-ord(c) for c in sig) + (1,), r[8], -r[7] if r[8] == 1 else r[7])


def _walk(rows):
    """Row-by-row reference walk (sorting + loop), used as the brute-force oracle."""
    def d(x):
        return dt.date(x // 10000, x // 100 % 100, x % 100)
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = {}
    for u, rs in by.items():
        hist = sorted([r for r in rs if 20170101 <= r[6] <= 20170131], key=_key)
        if not hist:
            continue
        last = hist[-1][7]
        if not (20170201 <= last <= 20170228):
            continue
        fut = sorted([r for r in rs if r[6] > 20170131], key=_key)
        if not fut:
            out[u] = 1
            continue
        cur, gap = d(last), 9999
        for r in fut:
            if r[8] == 1:
                cur = min(cur, d(r[7]))
            else:
                gap = (d(r[6]) - cur).days
                break
        out[u] = int(gap >= 30)
    return out


def test_against_row_walk(spark):
    rnd = random.Random(11)
    rows = []
    for u in range(150):
        for _ in range(rnd.randint(1, 7)):
            day = dt.date(2017, 1, 1) + dt.timedelta(days=rnd.randint(0, 89))
            plan = rnd.choice([7, 30, 31])
            exp = day + dt.timedelta(days=plan + rnd.randint(-3, 3))
            ymd = lambda x: x.year * 10000 + x.month * 100 + x.day
            rows.append((f"u{u}", rnd.choice([36, 41]), plan, rnd.choice([99, 149, 129]), 0, 1, ymd(day), ymd(exp),
                         int(rnd.random() < 0.25)))
    assert labels(spark, rows) == _walk(rows)


def test_renewal_gap_no_future_rows_absent(spark):
    df = spark.createDataFrame([tx("x", 20170110, 20170210)], SCHEMA)
    cands = last_expire(df, W.hist_start, W.hist_end)
    assert renewal_gap(cands, df.where("transaction_date > 20170131")).count() == 0
