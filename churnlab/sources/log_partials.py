"""The log aggregate kept up to date from new files only.

A store holds one mergeable partial row per (user, input file) for given cutoffs, and a manifest of the files it
covers (path, length, modification time). A run lists the input (metadata only), aggregates the files that are not
covered yet in one job, commits their partials together with the manifest rows (one commit of a ``SnapshotTable``), and
merges all partials whose file still is as listed: counts and sums add up, dates take their maximum. Files that
vanished or changed drop out, since their old partials no longer match the listing. A failed run commits nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.operators.features import log_user_agg
from churnlab.sources.snapshots import SnapshotTable

MAX_COLS = ("max_date",)


def listing(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, file, length, modified) of the input files below ``path``; no file is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(
        path)
    return found.select("path", F.col("_metadata.file_path").alias("file"), "length",
                        F.col("modificationTime").alias("modified"))


def merge_partials(partials: DataFrame, keys: Sequence[str] = ("msno",)) -> DataFrame:
    """A4: partial aggregates of equal keys made one; every column but the keys and ``MAX_COLS`` adds up."""
    cols = [c for c in partials.columns if c not in keys]
    same = {c: partials.schema[c].dataType for c in cols}
    return partials.groupBy(*keys).agg(*[
        F.max(c).alias(c) if c in MAX_COLS else F.sum(c).cast(same[c]).alias(c) for c in cols])


def _tag(max_date: dt.date, recent: dt.date, windows: dict) -> str:
    return "_".join([f"{max_date:%Y%m%d}", f"{recent:%Y%m%d}"] + [f"{k}-{v:%Y%m%d}" for k, v in sorted(windows.items())])


def incremental_log_agg(spark: SparkSession, logs_path: str, root: str, max_date: dt.date, recent: dt.date, windows: dict,
                        read: Callable[[SparkSession, list[str]], DataFrame] | None = None,
                        report: dict | None = None) -> DataFrame:
    """``log_user_agg`` of all files below ``logs_path``, reading only those the store at ``root`` does not cover.

    ``read(spark, files)`` reads some files (Parquet by default). ``report`` gets ``new`` and ``covered``, the numbers of
    files read by this run and used from the store. Without any input file the result has no rows.
    """
    read = read or (lambda s, files: s.read.parquet(*files))
    table = SnapshotTable(spark, f"{root.rstrip('/')}/{_tag(max_date, recent, windows)}")
    now = listing(spark, logs_path)
    identity = ["file", "length", "modified"]
    have = table.read() if table.versions() else None
    covered = None if have is None else have.where("is_manifest").select(*identity)
    fresh = now if covered is None else now.join(covered, identity, "left_anti")
    new = [r["path"] for r in fresh.select("path").collect()]  # names of files, not rows
    if new:
        logs = read(spark, new).withColumn("file", F.col("_metadata.file_path"))
        part = _per_file(logs, max_date, recent, windows).join(F.broadcast(fresh.drop("path")), "file").withColumn(
            "is_manifest", F.lit(False))
        mark = fresh.drop("path").withColumn("is_manifest", F.lit(True))
        batch = F.lit(str(len(table.versions()) + 1))
        table.replace(part.unionByName(mark, allowMissingColumns=True).withColumn("batch", batch), ["batch"])
        have = table.read()
    if report is not None:
        report.update(new=len(new), covered=now.count() - len(new))
    if have is None:
        return log_user_agg(spark.createDataFrame([], LOG_SCHEMA), max_date, recent, windows)
    live = have.where(~F.col("is_manifest")).join(F.broadcast(now), identity, "left_semi")
    return merge_partials(live.drop(*identity, "is_manifest", "batch"))


LOG_SCHEMA = ("msno long, date int, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, num_unq int, "
              "total_secs double")


def _per_file(logs: DataFrame, max_date: dt.date, recent: dt.date, windows: dict) -> DataFrame:
    """The log aggregate per (user, file): the same expressions with the file as a further key."""
    return log_user_agg(logs, max_date, recent, windows, keys=("msno", "file"))
