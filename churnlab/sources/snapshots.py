"""Versioned partitions with a commit pointer: replacing or merging rows of a Parquet table without a bad moment.

A write never touches files that a reader may use. New partitions go to a folder of their own below ``data``, and one
small file below ``_commits``, created under the next number only if no other writer has taken it, says which folder
holds each partition. Readers take the newest whole commit, so they see the state before a write or the one after it; a
job that fails before its commit leaves the old state, and older commits stay readable until ``expire`` drops them.

Two writers of different partitions both succeed (the later one commits on top of the other). Two merges of the same
partition do not lose rows: the second one merges again with what the first has committed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

COMMITS, DATA = "_commits", "data"
#: Buckets of a merged table's partitions by hash of the key; a merge rewrites only those its rows fall in.
BUCKETS = 32


class SnapshotTable:
    """A partitioned Parquet table at ``path`` (shared storage) with commits numbered from 1."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._hadoop, self._jvm = jvm.org.apache.hadoop.fs.Path, jvm
        self._fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ commits
    def versions(self) -> list[int]:
        """Numbers of the whole commits, oldest first."""
        return [n for n in self._numbers() if self._commit(n) is not None]

    def _numbers(self) -> list[int]:
        folder = self._hadoop(f"{self.path}/{COMMITS}")
        if not self._fs.exists(folder):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(folder))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _file(self, n: int):
        return self._hadoop(f"{self.path}/{COMMITS}/{n:012d}.json")

    def _commit(self, n: int) -> dict | None:
        """A commit's content; None if it is missing or its writer died while writing it."""
        out = self._jvm.java.io.ByteArrayOutputStream()
        try:
            self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(self._fs.open(self._file(n)), out, 65536, True)
            return json.loads(out.toString("UTF-8"))
        except Exception as e:
            if isinstance(e, json.JSONDecodeError) or "FileNotFound" in str(e):
                return None
            raise

    def _latest(self) -> dict:
        for n in reversed(self._numbers()):
            if (found := self._commit(n)) is not None:
                return found
        return {"live": {}, "schema": None, "parts": []}

    def _try_commit(self, live: Mapping[str, str], schema: StructType, parts: Sequence[str]) -> bool:
        """Publish ``live`` under the next number; False if another writer took it first."""
        body = json.dumps({"live": dict(live), "schema": schema.jsonValue(), "parts": list(parts)})
        numbers = self._numbers()
        try:
            out = self._fs.create(self._file(numbers[-1] + 1 if numbers else 1), False)
        except Exception as e:
            if "AlreadyExists" in str(e) or "already exists" in str(e):
                return False
            raise
        out.write(bytearray(body.encode()))
        out.close()
        return True

    # ------------------------------------------------------------ reading
    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a commit (the newest by default), partition columns last."""
        commit = self._latest() if version is None else self._commit(version)
        if commit is None:
            raise ValueError(f"no commit {version} in {self.path}")
        if commit["schema"] is None:
            raise ValueError(f"nothing was written to {self.path} yet")
        return self._rows(commit, commit["live"])

    def _rows(self, commit: dict, live: Mapping[str, str]) -> DataFrame:
        schema = StructType.fromJson(commit["schema"])
        if not live:
            return self.spark.createDataFrame([], schema)
        with_folder = StructType([*schema.fields, StructField("version", StringType())])
        paths = sorted(f"{self.path}/{DATA}/{folder}/{part}" for part, folder in live.items())
        return self.spark.read.schema(with_folder).option("basePath", f"{self.path}/{DATA}").parquet(*paths).select(
            *schema.names)

    # ------------------------------------------------------------ writing
    def _write(self, df: DataFrame, parts: Sequence[str]) -> tuple[str, list[str]]:
        """Write ``df`` into a new folder: (folder, its partitions such as ``period=2017-02``)."""
        folder = f"version={uuid.uuid4().hex}"
        top = f"{self.path}/{DATA}/{folder}"
        df.write.partitionBy(*parts).parquet(top)
        found = self._fs.globStatus(self._hadoop(top + "/*=*" * len(parts))) or []
        depth = len(parts)
        return folder, ["/".join(s.getPath().toUri().getPath().rstrip("/").split("/")[-depth:]) for s in found]

    def _ordered(self, df: DataFrame, parts: Sequence[str]) -> DataFrame:
        return df.select(*[c for c in df.columns if c not in parts], *parts)

    def replace(self, df: DataFrame, parts: Sequence[str], scope: Mapping[str, str] | None = None) -> None:
        """Replace the partitions of ``df``, and all partitions below ``scope`` (leading columns -> values).

        With a scope an empty ``df`` empties it.
        """
        df = self._ordered(df, parts)
        folder, made = self._write(df, parts)
        prefix = "/".join(f"{c}={self._escaped(v)}" for c, v in (scope or {}).items())
        while True:
            old = self._latest()["live"]
            kept = {p: f for p, f in old.items() if not prefix or not (p + "/").startswith(prefix + "/")}
            if self._try_commit(kept | dict.fromkeys(made, folder), _nullable(df.schema), parts):
                return

    def merge(self, df: DataFrame, keys: Sequence[str], parts: Sequence[str],
              pick: Callable[[DataFrame, Sequence[str]], DataFrame], buckets: int = BUCKETS) -> None:
        """Add the rows of ``df``; rows of equal ``keys``, old and new ones, are made one by ``pick(rows, keys)``.

        The table is partitioned by ``parts`` and ``bucket`` (hash of the keys); only partitions that new rows fall in
        are read and written.
        """
        parts = [*parts, "bucket"]
        new = self._ordered(df.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")), parts).hint(
            "rebalance", *parts)  # few files a partition; AQE splits a large one
        staged, touched = self._write(new, parts)  # computed once, whatever number of tries
        try:
            if not touched:
                return
            rows = self._rows({"schema": _nullable(new.schema).jsonValue(), "parts": parts}, dict.fromkeys(touched, staged))
            while True:
                base = self._latest()
                own = {p: f for p, f in base["live"].items() if p in set(touched)}
                both = rows if not own else rows.unionByName(self._rows(base, own), allowMissingColumns=True)
                one = self._ordered(pick(both, [*keys, *(p for p in parts if p not in keys)]), parts).hint(
                    "rebalance", *parts)
                folder, made = self._write(one, parts)
                while True:
                    now = self._latest()
                    if {p: f for p, f in now["live"].items() if p in own or p in set(touched)} != own:
                        break  # another writer changed these partitions: merge again
                    if self._try_commit(now["live"] | dict.fromkeys(made, folder), _nullable(one.schema), parts):
                        return
        finally:
            self._fs.delete(self._hadoop(f"{self.path}/{DATA}/{staged}"), True)

    def expire(self, keep: int = 1) -> int:
        """Drop all but the ``keep`` newest commits and the folders none of them needs; returns dropped folders.

        For a quiet moment: a running writer's folder is not in a commit yet.
        """
        if keep < 1:
            raise ValueError("keep one commit at least")
        versions = self.versions()
        for n in versions[:-keep]:
            self._fs.delete(self._file(n), False)
        used = {f for n in versions[-keep:] for f in self._commit(n)["live"].values()}
        top = self._hadoop(f"{self.path}/{DATA}")
        folders = [s.getPath() for s in self._fs.listStatus(top)] if self._fs.exists(top) else []
        dropped = [p for p in folders if p.getName() not in used]
        for p in dropped:
            self._fs.delete(p, True)
        return len(dropped)

    def _escaped(self, value: object) -> str:
        return self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))


def newest(order: str) -> Callable[[DataFrame, Sequence[str]], DataFrame]:
    """For ``merge``: of equal keys the row with the greatest ``order`` (ties: the greatest row)."""
    def pick(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys]
        best = F.max(F.struct(order, *[c for c in rest if c != order])).alias("r")
        return rows.groupBy(*keys).agg(best).select(*keys, "r.*")
    return pick


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema])
