"""Session helper: the settings every job in this library assumes."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on. ANSI stays on (Spark 4 default), so every
# risky cast / division in the library is guarded explicitly.
_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Suggested settings for a large cluster (pass as ``extra`` or via spark-submit). AQE starts from many
# shuffle partitions and coalesces them to ~256 MB; skewed join partitions are split at run time;
# broadcast decisions use measured sizes; scans split files into 256 MB tasks.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "churnlab", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; tests pass
    ``local[*]`` and a small shuffle-partition count.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(k, _CONF[k])
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named in ``spark.checkpoint.dir`` is used as is. Only when it is
    unset (local runs, tests) a scratch folder is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. HDFS / object store) "
                               "before running churnlab jobs on a cluster")
        d = tempfile.mkdtemp(prefix="churnlab-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


ROWS_PER_TASK = 500_000  # rows that a task of a sized shuffle sorts and aggregates
BYTES_PER_TASK = "16m"   # shuffled bytes up to which AQE brings its small partitions together


@contextmanager
def sized_shuffles(spark: SparkSession, rows: int, per_task: int = ROWS_PER_TASK) -> Iterator[None]:
    """Within it, shuffles have a partition for every ``per_task`` of ``rows``, and never fewer than the session's.

    A fixed number of partitions, or AQE's larger ones, make tasks whose sorts spill: rows in a sort take several times
    their shuffled bytes, and AQE never divides the partitions of an aggregate. For plans that are run within it
    (``materialize``).
    """
    size, bytes_ = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    kept = {k: spark.conf.get(k) for k in (size, bytes_)}
    spark.conf.set(size, str(max(int(kept[size]), -(-rows // per_task))))
    spark.conf.set(bytes_, BYTES_PER_TASK)
    try:
        yield
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def materialize(df):
    """Cut lineage: write ``df`` as a parquet table in the shared checkpoint folder and read it back.

    Used where one intermediate feeds several branches (e.g. a feature matrix
    feeding its own median computation and the fill), so the upstream scans,
    joins and aggregates run once. A written table (not ``localCheckpoint``)
    survives the loss of the executor that computed it; unlike an RDD
    checkpoint it is computed once (no second pass to save it), stored
    columnar, and read back with column pruning and filter pushdown.
    """
    path = scratch_path(df.sparkSession, "churnlab_materialized")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, remembered for ``remove_scratch``."""
    _SCRATCH.append(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}")
    return _SCRATCH[-1]


def remove_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables written by this process; for after the results that read them are used."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _SCRATCH:
        path = hadoop.Path(_SCRATCH.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed
