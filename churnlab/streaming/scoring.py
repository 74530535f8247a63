"""Structured Streaming jobs.

Both sinks are ``foreachBatch`` writers that overwrite the partition of their
own batch id, so a retried micro-batch replaces its earlier output instead of
duplicating it (exactly-once results on a replayable file source).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnlab.functions.columns import label_at
from churnlab.operators.validate import feature_rules, with_rule_results


def _batch_writer(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))
    return write


def _source(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None) -> DataFrame:
    """Parquet files as they arrive; a throttle only where the caller asks for one."""
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else r).parquet(path)


def prediction_rate_stream(spark: SparkSession, source_dir: str, schema: StructType, out_path: str,
                           checkpoint: str, window: str = "1 hour", watermark: str = "2 days",
                           files_per_trigger: int | None = None):
    """R2: live per-window prediction counts by source (panels G2 / G6).

    Update mode with a watermark keeps state bounded; each batch writes its
    updated windows; ``final_rates`` keeps the newest count per window.
    """
    s = (_source(spark, source_dir, schema, files_per_trigger)
         .withWatermark("predicted_at", watermark)
         .groupBy(F.window("predicted_at", window).alias("w"), "source").agg(F.count(F.lit(1)).alias("n"))
         .select(F.col("w.start").alias("window_start"), "source", "n"))
    q = (s.writeStream.outputMode("update").foreachBatch(_batch_writer(out_path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def final_rates(spark: SparkSession, out_path: str) -> DataFrame:
    """Latest emitted count per (window, source)."""
    r = spark.read.parquet(out_path)
    return r.groupBy("window_start", "source").agg(F.max_by("n", "batch_id").alias("n"))


def score_stream(spark: SparkSession, model, source_dir: str, schema: StructType, features, out_path: str,
                 checkpoint: str, version: str, files_per_trigger: int | None = None, rejects_path: str | None = None):
    """Validate, score, label at 0.5, round to 6 dp and append with source 'api'.

    Rows that break a rule go to ``rejects_path`` (default: beside the output) with ``failed_rules``; valid and
    rejected rows together are the input. A retried batch replaces both of its parts.
    """
    from pyspark.ml.functions import vector_to_array
    rejects_path = rejects_path or f"{out_path.rstrip('/')}_rejects"
    write_scores, write_rejects = _batch_writer(out_path), _batch_writer(rejects_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = with_rule_results(batch, feature_rules(features))
        prob = F.round(vector_to_array("probability")[1], 6)
        write_scores(model.transform(checked.where("is_valid")).select(
            "msno", prob.cast("float").alias("churn_prob"), label_at(prob, 0.5).cast("short").alias("churn_label"),
            F.lit(version).alias("model_version"), F.lit("api").alias("source"),
            F.date_format(F.current_timestamp(), "yyyy-MM").alias("period"),
            F.current_timestamp().alias("predicted_at")), batch_id)
        write_rejects(checked.where(~F.col("is_valid")).drop("is_valid"), batch_id)
    q = (_source(spark, source_dir, schema, files_per_trigger).writeStream.outputMode("append").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
