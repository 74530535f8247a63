"""Sources (S1-S5): explicit-schema readers, source unions, sampling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from churnlab.functions.columns import key_hash
from churnlab.schemas import RAW_SCHEMAS


def read_table(spark: SparkSession, base: str, name: str, fmt: str | None = None) -> DataFrame:
    """Read one raw table with its declared schema (never inferred).

    CSV files are read with a header row; parquet / other formats use the
    file's own schema. ``name`` picks the declared schema for CSV.
    """
    path = f"{base.rstrip('/')}/{name}"
    fmt = fmt or ("csv" if name.endswith(".csv") else "parquet")
    if fmt == "csv":
        key = name[:-4] if name.endswith(".csv") else name
        return spark.read.schema(RAW_SCHEMAS[key]).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return spark.read.format(fmt).load(path)


def union_sources(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name (base file + later extract)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def load_transactions(spark: SparkSession, base: str, names=("transactions.csv", "transactions_v2.csv")) -> DataFrame:
    return union_sources(*[read_table(spark, base, n) for n in names])


def load_logs(spark: SparkSession, base: str, names=("user_logs.csv", "user_logs_v2.csv")) -> DataFrame:
    """One scan per file; Spark splits the files into tasks itself."""
    return union_sources(*[read_table(spark, base, n) for n in names])


def sample_rows(df: DataFrame, n: int | None = None, frac: float | None = None, seed: int = 42,
                by: Sequence[str] = ()) -> DataFrame:
    """Seeded fraction sample (distributed), or the ``n`` rows first in the order of ``by`` (a top n)."""
    if frac is not None:
        return df.sample(withReplacement=False, fraction=frac, seed=seed)
    if n is not None:
        if not by:
            raise ValueError("a row count needs an order")
        return df.orderBy(*by).limit(n)
    return df


def keyed_sample(df: DataFrame, key: str, frac: float, seed: int = 42) -> DataFrame:
    """Deterministic, layout-independent sample on a key hash."""
    buckets = 1_000_000
    return df.where(key_hash(key, seed, buckets) < int(frac * buckets))
