"""Hot keys and plan shapes: a third of all rows on one key must give exact results,
and the heavy operators must not gather a key or a column into one window task."""

import datetime as dt
import random

import numpy as np

from churnlab.operators import features as FT
from churnlab.operators import metrics as M
from churnlab.operators.labels import churn_labels, renewal_groups
from churnlab.operators.quantiles import exact_quantiles
from churnlab.plans.periods import LabelWindow

TX = ("msno string, payment_method_id int, payment_plan_days int, plan_list_price int, actual_amount_paid int, "
      "is_auto_renew int, transaction_date int, membership_expire_date int, is_cancel int, seq long")


def _ymd(d):
    return d.year * 10000 + d.month * 100 + d.day


def _hot_tx(n_users=60, hot_share=1 / 3, n=3000, seed=9):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        u = "hot" if rnd.random() < hot_share else f"u{rnd.randrange(n_users)}"
        day = dt.date(2017, 1, 1) + dt.timedelta(days=rnd.randint(0, 89))
        plan = rnd.choice([7, 30])
        rows.append((u, rnd.choice([36, 41]), plan, rnd.choice([99, 149]), rnd.choice([0, 99, 149]), rnd.randint(0, 1),
                     _ymd(day), _ymd(day + dt.timedelta(days=plan)), int(rnd.random() < 0.2), i))
    return rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_profile_hot_key_exact(spark):
    rows = _hot_tx()
    df = spark.createDataFrame(rows, TX)
    got = {r.msno: r for r in FT.tx_user_profile(df, tie_cols=("seq",)).collect()}
    hot = sorted([r for r in rows if r[0] == "hot"], key=lambda r: (r[6], r[9]))
    assert got["hot"].n_transactions == len(hot)
    assert got["hot"].last_plan_days == hot[-1][2] and got["hot"].price_trend == hot[-1][4] - hot[0][4]
    assert got["hot"].n_unique_plans == len({r[2] for r in hot})
    assert "Window" not in _plan(FT.tx_user_profile(df, tie_cols=("seq",)))


def test_labeller_hot_key_no_window(spark):
    df = spark.createDataFrame(_hot_tx(), TX).drop("seq")
    w = LabelWindow(dt.date(2017, 1, 1), dt.date(2017, 1, 31), dt.date(2017, 2, 1), dt.date(2017, 2, 28))
    out = churn_labels(df, w)
    assert out.count() >= 1
    plan = _plan(out)
    assert "Window" not in plan and "collect_list" not in plan
    # raw rows are dealt by (user, date, plan text) and written once, the reduced ones by (user, salt)
    groups = _plan(renewal_groups(df))
    assert "Window" not in groups and any("hashpartitioning(msno" in ln and "s#" in ln for ln in groups.splitlines())
    assert "salt#" in plan and "Scan parquet" in plan and "ExistingRDD" not in plan  # no payment is read a second time


def test_matrix_reads_the_fact_table_once(spark):
    from churnlab.plans.catalog import _raw_matrix, _tx
    from churnlab.plans import bindings as B
    d = "/root/testdata/sf0.001"
    scans = lambda df: _plan(df).count("sf0.001/lineitem.parquet")
    assert scans(_raw_matrix(spark, d)) == 1
    assert scans(FT.tx_user_profile(_tx(spark, d), tie_cols=B.TX_TIE_COLS)) == 1


def test_features_ignore_rows_after_the_cutoff(spark):
    from churnlab.plans.periods import period_config
    cfg = period_config("2017-03")
    assert max(cfg.tx_as_of, cfg.log_max_date, cfg.prediction_date, cfg.tx_ref) < cfg.label_start
    before = [r for r in _hot_tx() if r[6] <= 20170228]
    after = [(r[0], 99, 400, 9999, 9999, 1, 20170301 + i % 28, 20990101, 1, 10**6 + i) for i, r in enumerate(before)]
    prev = dt.date(2017, 2, 1)
    a, b = ({r.msno: r.asDict() for r in FT.labelled_transaction_features(
        spark.createDataFrame(rows, TX), cfg, prev, ("seq",)).collect()} for rows in (before, before + after))
    assert {r["is_churn"] for r in a.values()} == {1} and {r["is_churn"] for r in b.values()} == {0}
    drop = lambda r: {k: v for k, v in r.items() if k not in ("is_churn", "prev_churn")}
    assert {u: drop(r) for u, r in a.items()} == {u: drop(r) for u, r in b.items()}
    late = FT.transaction_features(spark.createDataFrame(before + after, TX), cfg, ("seq",))
    assert {r.msno: r.asDict() for r in late.collect()} == {u: drop(r) for u, r in a.items()}


def test_months_together_by_plain_loops_with_nulls(spark):
    """Several months from one scan: every attribute of a user by a loop over the rows up to the month's cutoff."""
    from churnlab.plans.periods import period_config
    rnd = random.Random(5)
    hole = lambda v: None if rnd.random() < 0.3 else v
    rows = [(r[0], *map(hole, r[1:6]), r[6], hole(r[7]), hole(r[8]), r[9]) for r in _hot_tx(n=600)]
    rows += [("odd", None, 30, 99, 50, 1, 20170131, 20170231, 0, 9000), ("odd", 36, None, 0, 7, 0, 20170101, 20170230, None, 9001)]
    cfgs = [period_config(p) for p in ("2017-03", "2017-02")]
    tx = spark.createDataFrame(rows, TX)
    got = FT.monthly_transaction_features(tx, cfgs, [dt.date(2017, 2, 1), dt.date(2017, 1, 1)], ("seq",))
    assert _plan(got).count("Scan ExistingRDD") == 1
    got = {(r.period, r.msno): r for r in got.collect()}
    names = TX.replace(",", "").split()[::2]
    for cfg, start in zip(cfgs, (20170301, 20170201)):
        users = {r[0] for r in rows if r[6] < start}
        assert {u for p, u in got if p == cfg.period} == users
        for u in users:
            mine = [dict(zip(names, r)) for r in rows if r[0] == u]
            g, seen = got[cfg.period, u], sorted((r for r in mine if r["transaction_date"] < start), key=lambda r: (r["transaction_date"], r["seq"]))
            having = lambda c: [r for r in seen if r[c] is not None]
            last = lambda c: having(c)[-1][c] if having(c) else None
            assert g.is_churn == int(max(r["transaction_date"] for r in mine) < start) and g.n_transactions == len(seen)
            assert (g.last_is_cancel, g.last_plan_days, g.last_price, g.last_list_price, g.last_payment_method, g.last_is_auto_renew) == tuple(
                last(c) for c in ("is_cancel", "payment_plan_days", "actual_amount_paid", "plan_list_price", "payment_method_id", "is_auto_renew"))
            paid = [r["actual_amount_paid"] for r in having("actual_amount_paid")]
            assert g.price_trend == (paid[-1] - paid[0] if paid else None)
            assert g.avg_price == (sum(paid) / len(paid) if paid else None)
            assert g.n_unique_plans == len({r["payment_plan_days"] for r in having("payment_plan_days")})
            ends = [r for r in having("membership_expire_date") if r["membership_expire_date"] % 10000 not in (230, 231)]
            if not ends:
                assert g.days_until_expire is g.n_renewals is None
            else:
                e = max(ends, key=lambda r: (r["membership_expire_date"], -r["transaction_date"], -r["seq"]))
                day = dt.datetime.strptime(str(e["membership_expire_date"]), "%Y%m%d").date()
                assert g.days_until_expire == (day - cfg.prediction_date).days and g.cancel_at_expire == e["is_cancel"]
                assert g.n_renewals == sum(r["is_cancel"] == 0 for r in seen)
            assert g.n_tx_last_30d == sum(r["transaction_date"] >= _ymd(cfg.tx_ref - dt.timedelta(days=30)) for r in seen)


def test_state_of_a_user_holds_three_orders(spark):
    """One greatest and one least row hold the attributes; no order is kept for every column (states are shuffled)."""
    plan = _plan(FT.tx_user_profile(spark.createDataFrame(_hot_tx(n=10), TX), tie_cols=("seq",)))
    assert "max_by" not in plan and "min_by" not in plan


def test_months_take_running_states_without_a_second_aggregate(spark):
    """The states of a user are merged by a running window; the months make no rows that are grouped again."""
    from churnlab.plans.periods import period_config
    cfgs = [period_config(p) for p in ("2017-02", "2017-03")]
    tx = spark.createDataFrame(_hot_tx(n=50), TX)
    plan = _plan(FT.monthly_transaction_features(tx, cfgs, [c.tx_as_of.replace(day=1) for c in cfgs], ("seq",)))
    lines = plan.splitlines()
    at = lambda word: [i for i, ln in enumerate(lines) if word in ln]
    assert max(at("Generate explode")) < min(at("Window ")) < min(at("Aggregate("))  # the root comes first
    again = next(ln for ln in lines if "REPARTITION_BY_COL" in ln)
    narrow = lines[lines.index(again) + 1]
    assert narrow.strip(" :+-*()0123456789").startswith("Project") and "_row AS" not in narrow  # no tie column goes on


def test_payments_are_dealt_by_user_once(spark):
    """plain columns are dealt by user; neither the rows nor the users' states are shuffled after that."""
    from churnlab.plans import bindings as B
    from churnlab.plans.periods import period_config
    d = "/root/testdata/sf0.001"
    cfgs = [period_config(p) for p in ("2000-12", "2001-01")]
    starts = [c.tx_as_of.replace(day=1) for c in cfgs]
    got = FT.monthly_transaction_features(B.transactions(spark, d, True), cfgs, starts, B.TX_TIE_COLS, by_user=True)
    lines = _plan(got).splitlines()
    dealt = [i for i, ln in enumerate(lines) if "hashpartitioning(o_custkey" in ln]
    assert len(dealt) == 1 and "hashpartitioning(msno" not in _plan(got)
    assert min(i for i, ln in enumerate(lines) if "Join" in ln) > dealt[0] > max(
        i for i, ln in enumerate(lines) if "Aggregate(" in ln)
    rows = "\n".join(lines[dealt[0] + 1:])
    assert "decimal" not in rows and "membership_expire_date" not in rows  # what follows from the columns comes later
    plain = FT.monthly_transaction_features(B.transactions(spark, d), cfgs, starts, B.TX_TIE_COLS)
    text = lambda df: sorted(map(str, df.collect()))
    assert text(got) == text(plain)


def test_values_of_a_row_are_worked_out_once(spark):
    """the aggregate of the payments takes the order and the discount of a row as they are."""
    plan = _plan(FT.tx_user_profile(spark.createDataFrame(_hot_tx(n=10), TX), tie_cols=("seq",)))
    partial = [ln for ln in plan.splitlines() if "partial_sum" in ln]
    assert partial and all("/" not in ln.split("Aggregate(", 1)[1] and "_discount" in ln for ln in partial)
    assert "AS _discount" in plan and "AS _order" in plan


def test_ks_writes_the_values_once(spark, monkeypatch):
    """values of both samples are written once, in ranges; ties and ranges of few rows give the exact statistic."""
    from churnlab.operators import monitor as MON
    from churnlab.operators import quantiles as Q
    rnd = random.Random(4)
    a, b = ([float(rnd.randrange(k)) for _ in range(300)] for k in (40, 55))
    weights = lambda xs, n: spark.createDataFrame(
        [("x", v, xs.count(v)) for v in set(xs)], f"feature string, v double, {n} long")
    real, calls = Q.materialize, []
    monkeypatch.setattr(Q, "materialize", lambda df: (calls.append(df), real(df))[1])
    want = max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in a + b)
    for per_range in (7, 250_000):
        ks = MON.ks_by_column(weights(a, "wb"), weights(b, "wc"), per_range).collect()
        assert [r.feature for r in ks] == ["x"] and abs(ks[0].ks - want) < 1e-12
    assert len(calls) == 2


def test_shuffles_are_sized_by_rows(spark, monkeypatch):
    """The months' shuffles have a partition for a bounded number of rows, whatever the session's number is."""
    from churnlab import session
    from churnlab.operators import assemble
    from churnlab.plans import catalog
    key, adv = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    kept = spark.conf.get(key), spark.conf.get(adv)
    with session.sized_shuffles(spark, 1001, per_task=100):
        assert spark.conf.get(key) == "11"
    with session.sized_shuffles(spark, 0):
        assert spark.conf.get(key) == kept[0]
    seen = []

    def failing(*a):
        seen.append((spark.conf.get(key), spark.conf.get(adv)))
        raise ValueError
    monkeypatch.setattr(assemble, "assemble_months", failing)
    monkeypatch.setattr(session.sized_shuffles.__wrapped__, "__defaults__", (500,))
    d = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{d}/lineitem.parquet").count()
    for q in ("drift_history", "temporal_validate", "drift_by_column", "period_summary"):
        try:
            catalog.QUERIES[q](spark, d)
        except ValueError:
            pass
    assert seen == [(str(-(-n // 500)), session.BYTES_PER_TASK)] * 4
    assert (spark.conf.get(key), spark.conf.get(adv)) == kept


def test_queries_make_the_matrix_once(spark, monkeypatch):
    """Months of a drift report and parts of a query share one pass over the payments."""
    from churnlab.plans import bindings as B
    from churnlab.plans import catalog
    real, calls = B.transactions, []
    monkeypatch.setattr(B, "transactions", lambda *a: (calls.append(a), real(*a))[1])
    d = "/root/testdata/sf0.001"
    catalog.QUERIES["drift_by_column"](spark, d)
    assert len(calls) == 1
    filled = catalog.QUERIES["imputed_features"](spark, d)
    assert len(calls) == 2 and "lineitem.parquet" not in _plan(filled)


def test_quantiles_hot_value_exact(spark):
    rnd = random.Random(2)
    vals = [7.0] * 2000 + [rnd.random() * 50 for _ in range(4000)]     # one value holds a third of the rows
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    q = {r.p: r.q for r in exact_quantiles(df, ["x"], (0.2, 0.5, 0.9)).collect()}
    for p in (0.2, 0.5, 0.9):
        assert abs(q[p] - float(np.quantile(vals, p))) < 1e-12
    cut = {r.p: r.q for r in exact_quantiles(df, ["x"], (0.2, 0.5, 0.9), per_range=250).collect()}
    assert cut == q
    plan = _plan(exact_quantiles(df, ["x"], (0.5,), per_range=250))
    # the running-sum window over values is partitioned by (column, range), never by the column alone
    running = [ln for ln in plan.splitlines() if "Window [" in ln and "v#" in ln]
    assert running and all("part#" in ln for ln in running)


def test_auc_hot_score_exact(spark):
    rnd = random.Random(4)
    rows = [(int(rnd.random() < 0.4), 0.5) for _ in range(1500)] + \
           [(int(rnd.random() < 0.4), rnd.random()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "label int, prob double")
    pos = sorted(p for y, p in rows if y == 1)
    neg = np.array(sorted(p for y, p in rows if y == 0))
    s = sum(np.searchsorted(neg, p, "left") + 0.5 * (np.searchsorted(neg, p, "right") - np.searchsorted(neg, p, "left"))
            for p in pos)
    assert abs(M.roc_auc(df).first().roc_auc - s / (len(pos) * len(neg))) < 1e-12


def test_log_agg_is_hash_aggregate_with_pushed_cutoff(spark, tmp_path):
    schema = ("msno string, date int, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, num_unq int, "
              "total_secs double, junk string")
    rows = [("u", 20170101 + i % 28, 1, 1, 1, 1, 1, 1, 10.0, "x") for i in range(50)]
    path = str(tmp_path / "logs")
    spark.createDataFrame(rows, schema).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    agg = FT.log_user_agg(spark.read.parquet(path), dt.date(2017, 1, 20), dt.date(2017, 1, 10),
                          {"r7d": dt.date(2017, 1, 14)})
    plan = _plan(agg)
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert "LessThanOrEqual(date,20170120)" in plan.replace(" ", "")
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "junk" not in read_schema and "total_secs" in read_schema          # column pruning


def test_latest_prediction_uses_group_limit(spark):
    rows = [("hot" if i % 3 == 0 else f"u{i % 50}", i / 3000, "v1", "2017-03", dt.datetime(2017, 3, 1) +
             dt.timedelta(minutes=i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "msno string, churn_prob double, model_version string, period string, "
                                     "predicted_at timestamp")
    out = M.latest_prediction(df, "2017-03")
    assert "WindowGroupLimit" in _plan(out)
    assert {r.msno: r.churn_prob for r in out.collect()}["hot"] == 2997 / 3000
