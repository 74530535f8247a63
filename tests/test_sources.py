from pyspark.sql import functions as F

from churnlab.sources import readers


def test_csv_with_declared_schema_and_union(spark, tmp_path):
    base = tmp_path / "raw"
    base.mkdir()
    header = ("msno,payment_method_id,payment_plan_days,plan_list_price,actual_amount_paid,is_auto_renew,"
              "transaction_date,membership_expire_date,is_cancel\n")
    (base / "transactions.csv").write_text(header + "a,41,30,149,149,1,20170101,20170131,0\n"
                                           "b,36,30,0,0,0,20170102,19700100,1\n")
    (base / "transactions_v2.csv").write_text(header + "a,41,30,149,129,1,20170301,20170331,0\n")
    tx = readers.load_transactions(spark, str(base))
    assert dict(tx.dtypes)["transaction_date"] == "int" and dict(tx.dtypes)["msno"] == "string"
    assert tx.count() == 3 and tx.where(F.col("msno") == "a").count() == 2


def test_samples(spark):
    df = spark.range(1000).withColumnRenamed("id", "msno")
    assert [r.msno for r in readers.sample_rows(df, n=3, by=["msno"]).collect()] == [0, 1, 2]
    s1 = {r.msno for r in readers.keyed_sample(df, "msno", 0.3).collect()}
    s2 = {r.msno for r in readers.keyed_sample(df.repartition(7), "msno", 0.3).collect()}
    assert s1 == s2 and 200 < len(s1) < 400
    assert 200 < readers.sample_rows(df, frac=0.3, seed=1).count() < 400


def test_log_files_are_united(spark, tmp_path):
    head = "msno,date,num_25,num_50,num_75,num_985,num_100,num_unq,total_secs\n"
    (tmp_path / "user_logs.csv").write_text(head + "a,20170101,1,0,0,0,5,6,1200.5\n")
    (tmp_path / "user_logs_v2.csv").write_text(head + "a,20170301,0,0,0,0,2,2,300.0\n")
    logs = readers.load_logs(spark, str(tmp_path))
    assert dict(logs.dtypes)["total_secs"] == "double"
    assert sorted(r.date for r in logs.collect()) == [20170101, 20170301]
