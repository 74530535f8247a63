"""Table sinks (S6-S15): partitioned parquet tables written idempotently.

A "store" is a folder of partitioned parquet datasets. Re-running a job for one period replaces exactly that period,
in one commit (``sources/snapshots.py``): readers see the old rows or the new ones, a failed job changes nothing, and
older commits stay readable. Paths must be on shared storage; the default root is under the cluster's
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.session import ensure_checkpoint_dir
from churnlab.sources.snapshots import BUCKETS, SnapshotTable, newest


def store_root(spark: SparkSession, name: str, unique: bool = False) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/churnlab_store/{name}" + (f"-{uuid.uuid4().hex[:12]}" if unique else "")


# S6
def write_features(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# S7
def materialize_log_agg(spark: SparkSession, logs: DataFrame, max_date: dt.date, recent: dt.date,
                        windows: dict, root: str, version: str | None = None) -> DataFrame:
    """Reuse a persisted log aggregate when one exists for exactly these cutoffs and this input.

    ``version`` names the input (an extract's id); without one it is its row count and the sum of its rows' hashes
    (repeated rows add up, where an exclusive-or would cancel them), so changed logs never meet an aggregate of older ones.
    """
    from pyspark.errors import AnalysisException

    from churnlab.operators.features import log_user_agg
    if version is None:
        h = F.sum(F.xxhash64(*sorted(logs.columns)).cast("decimal(38,0)"))
        n, h = logs.agg(F.count(F.lit(1)), F.coalesce(h, F.lit(0))).first()
        version = f"{n}-{int(h) % 2**128:032x}"
    tag = "_".join([max_date.strftime("%Y%m%d"), recent.strftime("%Y%m%d")]
                   + [f"{k}-{v.strftime('%Y%m%d')}" for k, v in sorted(windows.items())] + [version])
    path = f"{root.rstrip('/')}/log_agg_{tag}"
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # not there yet
        log_user_agg(logs, max_date, recent, windows).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)


# S8 / S9
def upsert_period(df: DataFrame, path: str, period: str, computed_at: dt.datetime | None = None) -> None:
    """Replace one period of the feature store in one commit, stamping period and computed_at."""
    ts = F.lit(computed_at) if computed_at else F.current_timestamp()
    SnapshotTable(df.sparkSession, path).replace(
        df.withColumn("computed_at", ts).withColumn("period", F.lit(period)), ["period"], {"period": period})


def read_period(spark: SparkSession, path: str, period: str, cols: Sequence[str] | None = None,
                ordered: bool = False, version: int | None = None) -> DataFrame:
    """Features of one period (of an older commit with ``version``): partition and column pruning."""
    df = SnapshotTable(spark, path).read(version).where(F.col("period") == period)
    if cols:
        df = df.select(*cols)
    return df.orderBy("msno") if ordered else df


# S10 / S11
PREDICTION_PARTS = ["period", "model_version", "source"]


def _prediction_rows(df: DataFrame, period: str, version: str, source: str, at: dt.datetime | None) -> DataFrame:
    ts = F.lit(at) if at else F.current_timestamp()
    return (df.withColumn("predicted_at", ts).withColumn("period", F.lit(period))
            .withColumn("model_version", F.lit(version)).withColumn("source", F.lit(source)))


def upsert_predictions(df: DataFrame, path: str, period: str, version: str, source: str = "batch",
                       predicted_at: dt.datetime | None = None) -> None:
    """Replace (period, model_version, source) in one commit: API rows of the same period survive."""
    SnapshotTable(df.sparkSession, path).replace(
        _prediction_rows(df, period, version, source, predicted_at), PREDICTION_PARTS,
        dict(zip(PREDICTION_PARTS, (period, version, source))))


def read_predictions(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return SnapshotTable(spark, path).read(version).drop("bucket")


def append_predictions(df: DataFrame, path: str, source: str, version: str, now: dt.datetime,
                       buckets: int = BUCKETS) -> None:
    """Add the predictions of a moment; adding them again (a retried job) changes nothing."""
    rows = _prediction_rows(df, now.strftime("%Y-%m"), version, source, now)
    SnapshotTable(df.sparkSession, path).merge(rows, ["msno", "predicted_at"], PREDICTION_PARTS, newest("churn_prob"),
                                                buckets)


# S12 / S13
def export_scores(df: DataFrame, path: str, fmt: str = "csv", prob: str = "churn_prob") -> None:
    """Submission CSV (msno, is_churn = probability) or a scores parquet."""
    if fmt == "csv":
        df.select("msno", F.col(prob).alias("is_churn")).write.mode("overwrite").option("header", True).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


# S14
def append_drift_report(df: DataFrame, path: str) -> None:
    df.withColumn("created_at", F.current_timestamp()).write.mode("append").parquet(path)


def read_drift_reports(spark: SparkSession, path: str) -> DataFrame:
    """The newest report of each period."""
    r = spark.read.parquet(path)
    cols = [c for c in r.columns if c not in ("period", "created_at")]
    return r.groupBy("period").agg(F.max_by(F.struct(*cols), "created_at").alias("r")).select("period", "r.*")


# An append-only table of version events; the newest event of a version is its state.
def append_versions(df: DataFrame, path: str) -> None:
    df.withColumn("changed_at", F.current_timestamp()).write.mode("append").parquet(path)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    r = spark.read.parquet(path)
    cols = [c for c in r.columns if c not in ("name", "version", "changed_at")]
    return r.groupBy("name", "version").agg(F.max_by(F.struct(*cols), "changed_at").alias("r")).select(
        "name", "version", "r.*")


def load_ground_truth(df: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Merge a batch of outcomes, unique on (msno, period): of repeated rows a churn wins, other users stay.

    Batches may come in any number and order and more than once; ``loaded_at`` is that of the first row of a user.
    """
    def one(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        return rows.groupBy(*keys).agg(F.max("actual_churn").alias("actual_churn"), F.min("loaded_at").alias("loaded_at"))
    SnapshotTable(df.sparkSession, path).merge(
        df.select("msno", "period", "actual_churn").withColumn("loaded_at", F.current_timestamp()), ["msno", "period"],
        ["period"], one, buckets)


def read_ground_truth(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return SnapshotTable(spark, path).read(version).select("msno", "period", "actual_churn", "loaded_at")


# S15
def save_model(model, path: str, features: Sequence[str]) -> None:
    model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(list(features)),)], "features string").coalesce(1).write.mode(
        "overwrite").text(f"{path}_features")


def load_model(path: str, features: Sequence[str] | None = None):
    from pyspark.ml import PipelineModel
    spark = SparkSession.getActiveSession()
    stored = json.loads(spark.read.text(f"{path}_features").first()[0])
    if features is not None and list(features) != stored:
        raise ValueError("feature list of the stored model differs from the requested one")
    return PipelineModel.load(path), stored
