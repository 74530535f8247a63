"""Views of the driver's TPC-H-like tables shaped like the churn sources.

The churn data itself is not available, so every registered query runs its
operators over these views. Each view is a plain projection / join /
aggregation of the given tables, so its work grows with them.

Money is exact: list price as decimal(18,2), paid amount as decimal(18,4);
listening seconds as decimal(18,2). Sums stay exact and final averages divide
once, so results do not depend on summation order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.functions.columns import date_to_yyyymmdd
from churnlab.plans.periods import DEMO_LABEL_PERIODS

# fixed values: market segment -> registration channel code
SEGMENT_CODES = {"AUTOMOBILE": 3, "BUILDING": 4, "FURNITURE": 7, "HOUSEHOLD": 9, "MACHINERY": 13}
# fixed values: registration day 0 and its spread
REGISTRATION_BASE = dt.date(1990, 1, 1)
REGISTRATION_SPREAD_DAYS = 1800
# The event table lies in January 2024; its days are moved back so that 2024-01-25 becomes 2000-11-30.
LOG_SHIFT_DAYS = (dt.date(2024, 1, 25) - dt.date(2000, 11, 30)).days
# Tie-break columns that give transactions a total order after the date.
TX_TIE_COLS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, by_user: bool = False) -> DataFrame:
    """One payment row per line item; the customer is the subscriber.

    ``by_user``: a subscriber's rows lie in one partition. The plain columns are dealt, what follows from them (half of
    a row) is worked out after that.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    if by_user:
        j = j.drop("o_orderkey").repartition("o_custkey")
    list_price = F.col("l_extendedprice").cast("decimal(18,2)")
    plan_days = F.col("l_quantity").cast("int")
    return j.select(
        F.col("o_custkey").alias("msno"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_method_id"),
        plan_days.alias("payment_plan_days"),
        list_price.alias("plan_list_price"),
        (list_price * (F.lit(1) - F.col("l_discount").cast("decimal(18,2)"))).cast("decimal(18,4)")
        .alias("actual_amount_paid"),
        (F.col("l_linestatus") == "O").cast("int").alias("is_auto_renew"),
        date_to_yyyymmdd("o_orderdate").alias("transaction_date"),
        date_to_yyyymmdd(F.date_add(F.to_date("o_orderdate"), plan_days)).alias("membership_expire_date"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_cancel"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    seg = None
    for name, code in SEGMENT_CODES.items():
        seg = F.when(F.col("c_mktsegment") == name, code) if seg is None else seg.when(
            F.col("c_mktsegment") == name, code)
    k3 = F.pmod(F.col("c_custkey"), F.lit(3))
    return c.select(
        F.col("c_custkey").alias("msno"),
        F.col("c_nationkey").alias("city"),
        F.floor(F.col("c_acctbal") / 70).cast("int").alias("bd"),
        F.when(k3 == 1, "male").when(k3 == 2, "female").alias("gender"),
        seg.cast("int").alias("registered_via"),
        date_to_yyyymmdd(F.date_add(F.lit(REGISTRATION_BASE),
                                    F.pmod(F.col("c_custkey"), F.lit(REGISTRATION_SPREAD_DAYS)).cast("int")))
        .alias("registration_init_time"),
    )


def user_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily listening rows: one row per (user, day) of ``events``, moved into the months of the payments."""
    e = table(spark, sf_dir, "events").select(
        "user_id", F.date_sub(F.to_date("ts"), LOG_SHIFT_DAYS).alias("ts"), "event_type", "value")
    t = F.col("event_type")
    return (e.groupBy(F.col("user_id").alias("msno"), date_to_yyyymmdd("ts").alias("date"))
            .agg(F.count_if(t == "view").cast("int").alias("num_25"),
                 F.count_if(t == "click").cast("int").alias("num_50"),
                 F.count_if(t == "signup").cast("int").alias("num_75"),
                 F.count_if(t == "error").cast("int").alias("num_985"),
                 F.count_if(t == "purchase").cast("int").alias("num_100"),
                 # distinct event types via a set: bounded by the type domain, no Expand / extra shuffle
                 F.size(F.collect_set(t)).cast("int").alias("num_unq"),
                 (F.sum(F.col("value").cast("decimal(18,2)")) * 60).cast("decimal(18,2)").alias("total_secs")))


def period_start(p: str) -> dt.date:
    y, m = p.split("-")
    return dt.date(int(y), int(m), 1)


def period_labels(spark: SparkSession, sf_dir: str, periods=DEMO_LABEL_PERIODS) -> DataFrame:
    """Dense monthly labels: users seen before the month churn when they never come back.

    One aggregate per user, then one row per requested period (a fixed, small list).
    """
    tx = transactions(spark, sf_dir)
    per_user = tx.groupBy("msno").agg(F.min("transaction_date").alias("first_tx"),
                                      F.max("transaction_date").alias("last_tx"))
    starts = F.array(*[F.struct(F.lit(p).alias("period"),
                                F.lit(int(period_start(p).strftime("%Y%m%d"))).alias("start"))
                       for p in periods])
    x = per_user.select("msno", "first_tx", "last_tx", F.explode(starts).alias("p"))
    return (x.where(F.col("first_tx") < F.col("p.start"))
            .select("msno", F.col("p.period").alias("period"),
                    (F.col("last_tx") < F.col("p.start")).cast("int").alias("is_churn")))


def labels_for(spark: SparkSession, sf_dir: str, period: str) -> DataFrame:
    return period_labels(spark, sf_dir).where(F.col("period") == period).select("msno", "is_churn")


def scores(spark: SparkSession, sf_dir: str, kind: str = "tied") -> DataFrame:
    """(label, prob) pairs for ranking metrics.

    ``tied``: 11 distinct probabilities 0.0..1.0 (heavy ties, both ends);
    ``smooth``: near-continuous probabilities.
    """
    li = table(spark, sf_dir, "lineitem")
    prob = F.col("l_discount") * 10 if kind == "tied" else F.col("l_extendedprice") / 200000
    return li.select((F.col("l_returnflag") == "R").cast("int").alias("label"), prob.alias("prob"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows as the prediction table holds them (several versions and sources per user)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    prob = (F.col("l_extendedprice") / 200000).cast("float")
    return j.select(
        F.col("o_custkey").alias("msno"),
        prob.alias("churn_prob"),
        (prob >= 0.5).cast("short").alias("churn_label"),
        F.concat(F.lit("v"), (F.pmod(F.col("l_linenumber"), F.lit(3)) + 1).cast("string")).alias("model_version"),
        F.date_format("o_orderdate", "yyyy-MM").alias("period"),
        F.when(F.pmod(F.col("l_linenumber"), F.lit(4)) == 0, "api").otherwise("batch").alias("source"),
        (F.col("o_orderdate") + F.make_interval(
            hours=F.col("l_linenumber"), mins=F.pmod(F.col("l_orderkey"), F.lit(60)).cast("int")))
        .alias("predicted_at"),
        "l_orderkey", "l_linenumber",
    )


def ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual outcome per (user, month): churned when the user's month has a return line."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return (j.groupBy(F.col("o_custkey").alias("msno"), F.date_format("o_orderdate", "yyyy-MM").alias("period"))
            .agg(F.max((F.col("l_returnflag") == "R").cast("short")).alias("actual_churn")))
