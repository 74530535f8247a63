import datetime as dt

from churnlab.operators import features as FT

TX = ("msno string, payment_method_id int, payment_plan_days int, plan_list_price int, actual_amount_paid int, "
      "is_auto_renew int, transaction_date int, membership_expire_date int, is_cancel int")


def test_profile_last_non_null_and_discount(spark):
    rows = [("u", 36, 30, 100, 90, 1, 20170101, 20170131, 0),
            ("u", None, 30, 0, 0, 0, 20170201, 20170303, 1),      # list price 0 -> no discount value
            ("u", 41, 7, 200, 150, None, 20170115, 20170122, 0)]
    p = FT.tx_user_profile(spark.createDataFrame(rows, TX)).first()
    assert p.n_transactions == 3 and p.n_cancels == 1 and p.ever_canceled == 1
    assert abs(p.avg_discount_pct - (0.1 + 0.25) / 2) < 1e-12
    assert p.last_is_cancel == 1 and p.last_plan_days == 30
    assert p.last_payment_method == 41          # latest non-null method
    assert p.last_is_auto_renew == 0            # NULL on the 01-15 row skipped, latest non-null is 02-01
    assert p.price_trend == 0 - 90 and p.n_unique_plans == 2 and p.n_payment_methods == 2


def test_as_of_filter_and_expiry(spark):
    rows = [("u", 36, 30, 100, 100, 1, 20170101, 20170131, 0),
            ("u", 36, 30, 100, 100, 0, 20170110, 20170131, 1),     # tie on expiry: first row wins
            ("u", 36, 30, 100, 100, 1, 20170401, 20170501, 0)]     # after the cutoff
    df = spark.createDataFrame(rows, TX)
    e = FT.expiry_features(df, dt.date(2017, 3, 31), as_of=dt.date(2017, 3, 31)).first()
    assert e.days_until_expire == -59 and e.is_expired == 1
    assert e.auto_renew_at_expire == 1 and e.cancel_at_expire == 0 and e.n_renewals == 1


def test_recency_window_edges(spark):
    rows = [("u", 36, 30, 100, 100, 1, d, 20170501, 0) for d in (20170324, 20170301, 20170228)]
    r = FT.tx_recency(spark.createDataFrame(rows, TX), dt.date(2017, 3, 31)).first()
    assert r.days_since_last_tx == 7 and r.had_tx_last_7d == 1 and r.n_tx_last_30d == 2


def test_log_agg_clip_cutoff_and_windows(spark):
    schema = ("msno string, date int, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, num_unq int, "
              "total_secs double")
    rows = [("u", 20170228, 1, 0, 0, 0, 3, 4, 9.22e15), ("u", 20170130, 0, 0, 0, 0, 0, 0, -9.22e15),
            ("u", 20170301, 1, 1, 1, 1, 1, 1, 100.0)]                    # after the cutoff
    agg = FT.log_user_agg(spark.createDataFrame(rows, schema), dt.date(2017, 2, 28), dt.date(2017, 1, 30),
                          {"r7d": dt.date(2017, 2, 21)}).first()
    assert agg.n_days == 2 and agg.total_secs_sum == 86400.0 and agg.recent_n_days == 2 and agg.r7d_n_days == 1
    f = FT.log_features(FT.log_user_agg(spark.createDataFrame(rows, schema), dt.date(2017, 2, 28),
                                        dt.date(2017, 1, 30)), dt.date(2017, 2, 28)).first()
    assert f.completion_ratio == 0.75 and f.days_since_last == 0 and f.avg_daily_secs == 43200.0


def test_member_features_edges(spark):
    schema = "msno string, city int, bd int, gender string, registered_via int, registration_init_time int"
    rows = [("a", 1, 0, None, 4, 20160228), ("b", 1, 1, "male", 4, 20160228), ("c", 1, 99, "female", 4, 20160228),
            ("d", 1, 100, "other", 4, 20160231)]
    got = {r.msno: r for r in FT.member_features(spark.createDataFrame(rows, schema), dt.date(2017, 2, 28)).collect()}
    assert got["a"].gender_enc == 2 and got["a"].bd_valid == 0 and got["a"].age is None
    assert got["b"].gender_enc == 0 and got["b"].age == 1.0 and got["c"].bd_valid == 1
    assert got["d"].gender_enc is None and got["d"].bd_valid == 0 and got["d"].tenure_days is None
    assert got["a"].tenure_days == 366


def test_imputing_in_two_steps_equals_one(spark):
    from churnlab.operators.impute import V5_CONSTANTS, V5_MEDIAN, impute, impute_base, impute_v5
    rows = [(1, 10.0, None, None, None), (2, None, 5, 1, 3), (3, 30.0, 7, None, 9), (4, None, None, 0, None)]
    df = spark.createDataFrame(rows, "msno long, avg_price double, n_days int, is_expired int, days_until_expire int")
    base = impute_base(df, extra_exclude=("is_expired", "days_until_expire"))
    two = {r.msno: (r.avg_price, r.n_days, r.is_expired, r.days_until_expire) for r in impute_v5(base).collect()}
    assert two == {1: (10.0, 0, 1, 6.0), 2: (20.0, 5, 1, 3), 3: (30.0, 7, 1, 9), 4: (20.0, 0, 0, 6.0)}
    constants = {"n_days": 0} | {k: v for k, v in V5_CONSTANTS.items() if k in df.columns}
    one = impute(df, ["avg_price", *[c for c in V5_MEDIAN if c in df.columns]], constants)
    assert {r.msno: (r.avg_price, r.n_days, r.is_expired, r.days_until_expire) for r in one.collect()} == two
