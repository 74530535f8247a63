"""What tasks really read, from Spark's event log: no task of the labeller gets a hot user, one read of the fact table."""

import json
import os
import subprocess
import sys
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import datetime as dt, random, sys
sys.path.insert(0, {root!r})
from churnlab.session import get_spark
spark = get_spark("local[2]", 16, extra={{
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + {log!r}, "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}})
{body}
spark.stop()
"""

LABELLER = """
from churnlab.operators.labels import churn_labels
from churnlab.plans.periods import LabelWindow
rnd = random.Random(1)
ymd = lambda d: d.year * 10000 + d.month * 100 + d.day
rows = []
for i in range(30000):
    day = dt.date(2017, 1, 1) + dt.timedelta(days=rnd.randint(0, 119))
    user = "hot" if i % 3 == 0 else f"u{rnd.randrange(4000)}"
    rows.append((user, rnd.randrange(40), rnd.choice([7, 30, 31, 90]), rnd.randrange(100, 200), 0, 1, ymd(day),
                 20170215 if day < dt.date(2017, 2, 1) else ymd(day + dt.timedelta(days=30)), 1 if i % 4 else 0))
tx = spark.createDataFrame(rows, "msno string, payment_method_id int, payment_plan_days int, plan_list_price int, "
    "actual_amount_paid int, is_auto_renew int, transaction_date int, membership_expire_date int, is_cancel int")
w = LabelWindow(dt.date(2017, 1, 1), dt.date(2017, 1, 31), dt.date(2017, 2, 1), dt.date(2017, 2, 28))
assert churn_labels(tx, w).where("msno = 'hot'").count() == 1
churn_labels(tx, w).write.format("noop").mode("overwrite").save()
"""

MATRIX = """
from churnlab.plans.catalog import _raw_matrix
_raw_matrix(spark, "/root/testdata/sf0.01").write.format("noop").mode("overwrite").save()
"""


def tasks(tmp_path, body):
    """Event log of a run: per stage the shuffle records read by each task, and input records of all tasks."""
    log = str(tmp_path / "events")
    os.makedirs(log)
    subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, log=log, body=body)], check=True, timeout=600,
                   capture_output=True)
    read, rows_in = defaultdict(list), defaultdict(int)
    for name in os.listdir(log):
        for line in open(os.path.join(log, name)):
            e = json.loads(line)
            if e["Event"] == "SparkListenerTaskEnd":
                m = e["Task Metrics"]
                read[e["Stage ID"]].append(m["Shuffle Read Metrics"]["Total Records Read"])
                rows_in[e["Stage ID"]] += m["Input Metrics"]["Records Read"]
    return read, rows_in


def test_no_task_of_the_labeller_reads_the_hot_user(tmp_path):
    read, _ = tasks(tmp_path, LABELLER)
    large = {k: v for k, v in read.items() if sum(v) >= 10_000}
    assert large and all(max(v) < sum(v) / 5 for v in large.values()), {k: (max(v), sum(v)) for k, v in large.items()}


def test_matrix_reads_lineitem_once(tmp_path):
    import pyarrow.parquet as pq
    _, rows_in = tasks(tmp_path, MATRIX)
    sizes = {t: pq.ParquetFile(f"/root/testdata/sf0.01/{t}.parquet").metadata.num_rows
             for t in ("lineitem", "orders", "events", "customer")}
    assert sum(rows_in.values()) == sum(sizes.values())
