"""Validation rules and the request contract as DataFrame checks."""

from conftest import records_df

from churnlab.operators.validate import contract_check, validate_features


def _split(spark, recs):
    v, i = validate_features(records_df(spark, recs))
    return v.count(), i.count()


def test_clean_record_valid(spark, base_record):
    assert _split(spark, [base_record]) == (1, 0)


def test_ratio_and_age_out_of_range(spark, base_record):
    for col, val in [("completion_ratio", 1.5), ("completion_ratio", -0.3), ("age", 200.0), ("age", -5.0)]:
        r = dict(base_record, **{col: val})
        assert _split(spark, [r]) == (0, 1), (col, val)


def test_null_and_binary(spark, base_record):
    assert _split(spark, [dict(base_record, days_since_last=None)]) == (0, 1)
    assert _split(spark, [dict(base_record, is_expired=2)]) == (0, 1)


def test_mixed_rows(spark, base_record):
    assert _split(spark, [base_record, dict(base_record, age=200.0)]) == (1, 1)


def test_failed_rule_names(spark, base_record):
    _, inv = validate_features(records_df(spark, [dict(base_record, is_expired=2, age=-5.0)]))
    assert sorted(inv.first().failed_rules) == ["binary:is_expired", "range:age"]


def test_contract_gender_extra_column(spark, base_record):
    df = records_df(spark, [dict(base_record, gender_enc=5)])
    missing, unknown, viol = contract_check(df.withColumn("unknown_field", df.age))
    assert missing == [] and unknown == ["unknown_field"]
    v = {r.column: r for r in viol.collect()}
    assert v["gender_enc"].n_out_of_range == 1 and v["age"].n_out_of_range == 0


def test_records_on_and_beyond_every_bound(spark, base_record):
    from churnlab.operators.validate import CONTRACT_BOUNDS
    on, beyond = dict(base_record), dict(base_record)
    for c, (lo, hi) in CONTRACT_BOUNDS.items():
        on[c] = hi if hi is not None else lo
        beyond[c] = hi + 1 if hi is not None else lo - 1
    v = {r.column: r.n_out_of_range for r in contract_check(records_df(spark, [on, beyond]))[2].collect()}
    assert all(v[c] == 1 for c in CONTRACT_BOUNDS) and _split(spark, [on, beyond]) == (1, 1)


def test_missing_columns_fail_before_jobs(spark, base_record):
    import pytest

    from churnlab.operators.validate import missing_columns
    df = records_df(spark, [base_record]).drop("age")
    with pytest.raises(ValueError, match="age"):
        missing_columns(df)


def test_constraint_violations(spark):
    from pyspark.sql import functions as F

    from churnlab.operators.validate import constraint_violations
    df = spark.createDataFrame([("a", "2017-03", 0.2), ("a", "2017-03", 1.2), ("b", "2017-03", None)],
                               "msno string, period string, p double")
    got = {r.constraint: r.n_violations for r in
           constraint_violations(df, unique=("msno", "period"), checks={"p in [0,1]": F.col("p").between(0, 1)})
           .collect()}
    assert got == {"unique(msno,period)": 2, "p in [0,1]": 2}
