"""Shared helpers of the training-data operators: Arrow batch limits, scratch tables, row keys."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab import session

#: An Arrow batch handed to a Python worker holds at most this many rows and about this many bytes, so the
#: memory of a task does not depend on the length of the documents.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def ship(spark: SparkSession) -> None:
    """Give the executors this package as a zip (what ``--py-files`` does), once a Spark context."""
    import churnlab
    sc = spark.sparkContext
    if getattr(sc, "_churnlab_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(churnlab.__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="churnlab-py-"), "churnlab.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.dirname(os.path.abspath(churnlab.__file__))):
            for name in (n for n in names if n.endswith(".py")):
                z.write(file := os.path.join(folder, name), os.path.relpath(file, top))
    sc.addPyFile(path)
    sc._churnlab_shipped = True


def configure(spark: SparkSession) -> SparkSession:
    """Ship the package, set the Arrow batch limits and UTC; every operator calls this first."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    session.ensure_checkpoint_dir(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for a written table below the cluster's shared checkpoint folder."""
    return session.scratch_path(spark, f"churnlab_llm/{name}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` once into the shared folder and read it back (survives lost executors)."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one record batch; batches without rows are skipped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and (out := fn(b)) is not None and out.num_rows:
                yield out
    return df.mapInArrow(run, schema)


def filter_batches(df: DataFrame, keep: Callable[[pa.RecordBatch], list]) -> DataFrame:
    """Rows of ``df``, all columns as they are, for which ``keep`` (a list of booleans a batch) holds; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and (out := b.filter(pa.array(keep(b), pa.bool_()))).num_rows:
                yield out
    return df.mapInArrow(run, df.schema)


def cells(tiles: int, per: int, least: int) -> int:
    """Shards or blocks of a grid for so many tiles: ``per`` tiles each, but ``least`` of them where there are as many tiles."""
    return max(1, -(-tiles // per), min(tiles, least))


def text_key(text: Column) -> Column:
    """With ``doc_id`` the key of a document row: rows that repeat an id with another text stay apart."""
    return F.xxhash64(text)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a row without an id gets null."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def semi_by_row(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text) is / is not in ``keys`` (doc_id, text_key), nulls being equal.

    ``how`` is ``left_semi`` or ``left_anti``. AQE broadcasts ``keys`` only below the session's threshold.
    """
    k = keys.select(F.col("doc_id").alias("_k_id"), F.col("text_key").alias("_k_text"))
    d = docs.withColumn("_row_key", text_key(F.col("text")))
    cond = d["doc_id"].eqNullSafe(k["_k_id"]) & (d["_row_key"] == k["_k_text"])
    return d.join(k, cond, how).drop("_row_key")


class Numbers(dict):
    """Numbers strings in the order they are first looked up; ``fresh`` lists those numbered since it was emptied."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.fresh.append(key)
        return n
