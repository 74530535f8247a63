"""Validation (V1-V4): rules become boolean columns, never row loops.

Every rule is evaluated with ``coalesce(rule, false)`` so a NULL comparison
counts as a failure, and the names of failed rules are kept in an array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.schemas import BINARY_COLS, CONTRACT_BOUNDS, CONTRACT_INT_COLS, FEATURE_COLS_V5, RANGE_CHECKS


def feature_rules(cols: Sequence[str] = FEATURE_COLS_V5) -> dict[str, Column]:
    rules: dict[str, Column] = {}
    present = set(cols)
    rules["no_nulls"] = F.lit(True)
    for c in cols:
        rules["no_nulls"] = rules["no_nulls"] & F.col(c).isNotNull()
    for c, (lo, hi) in RANGE_CHECKS.items():
        if c in present:
            rules[f"range:{c}"] = F.col(c).between(lo, hi)
    for c in BINARY_COLS:
        if c in present:
            rules[f"binary:{c}"] = F.col(c).isin(0, 1)
    return rules


def with_rule_results(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``is_valid`` (all rules true) and ``failed_rules`` (names of the failing rules).

    Plain boolean / string expressions (``concat_ws`` skips NULLs), so the
    check stays in generated code; rule names contain no comma.
    """
    ok_all = None
    for r in rules.values():
        ok = F.coalesce(r, F.lit(False))
        ok_all = ok if ok_all is None else (ok_all & ok)
    names = F.concat_ws(",", *[F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()])
    failed = F.when(ok_all, F.array().cast("array<string>")).otherwise(F.split(names, ","))
    return df.withColumn("is_valid", ok_all).withColumn("failed_rules", failed)


def validate_features(df: DataFrame, cols: Sequence[str] = FEATURE_COLS_V5) -> tuple[DataFrame, DataFrame]:
    """V1: (valid, invalid) split; invalid rows carry ``failed_rules``."""
    checked = with_rule_results(df, feature_rules(cols))
    return (checked.where("is_valid").drop("failed_rules", "is_valid"),
            checked.where(~F.col("is_valid")))


def validation_counts(df: DataFrame, cols: Sequence[str] = FEATURE_COLS_V5) -> DataFrame:
    """Per-rule failure counts plus totals, in one aggregate pass."""
    rules = feature_rules(cols)
    aggs = [F.count(F.lit(1)).alias("rows")]
    ok_all = F.lit(True)
    for n, r in rules.items():
        ok = F.coalesce(r, F.lit(False))
        ok_all = ok_all & ok
        aggs.append(F.count_if(~ok).alias(n))
    aggs.append(F.count_if(ok_all).alias("valid"))
    aggs.append(F.count_if(~ok_all).alias("invalid"))
    names = ["rows", *rules.keys(), "valid", "invalid"]
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("n"))
                                          for n in names])).alias("r")).select("r.rule", "r.n")


def contract_check(df: DataFrame, required: Sequence[str] = FEATURE_COLS_V5,
                   key: str = "msno") -> tuple[list[str], list[str], DataFrame]:
    """V2 + V3: the request contract applied to a DataFrame.

    Returns (missing columns, unknown columns, per-column violation counts).
    Missing / unknown columns are a schema check (no job). Violations: NULL,
    outside bounds, non-integer value in an integer field.
    """
    present = [c for c in df.columns if c != key]
    missing = [c for c in required if c not in df.columns]
    unknown = [c for c in present if c not in required]
    cols = [c for c in required if c in df.columns]
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        lo, hi = CONTRACT_BOUNDS.get(c, (None, None))
        oob = F.lit(False)
        if lo is not None:
            oob = oob | (x < lo)
        if hi is not None:
            oob = oob | (x > hi)
        aggs += [F.count_if(x.isNull()).alias(f"{c}__null"), F.count_if(F.coalesce(oob, F.lit(False))).alias(f"{c}__oob"),
                 F.count_if(F.coalesce(x != F.floor(x), F.lit(False)) if c in CONTRACT_INT_COLS else F.lit(False))
                 .alias(f"{c}__int")]
    one = df.agg(*aggs)
    out = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__null").alias("n_null"),
                                                  F.col(f"{c}__oob").alias("n_out_of_range"),
                                                  F.col(f"{c}__int").alias("n_not_integer")) for c in cols]))
                     .alias("r")).select("r.*")
    return missing, unknown, out


def missing_columns(df: DataFrame, required: Sequence[str] = FEATURE_COLS_V5) -> None:
    """V3: fail before any job when required feature columns are absent."""
    miss = [c for c in required if c not in df.columns]
    if miss:
        raise ValueError(f"missing feature columns: {miss}")


def constraint_violations(df: DataFrame, unique: Sequence[str] = (), checks: dict[str, Column] | None = None
                          ) -> DataFrame:
    """V4: table constraints -> (constraint, n_violations).

    Uniqueness: rows in key groups of size > 1 (one aggregate on the key, then
    a sum). Checks: rows where the predicate is not true.
    """
    from functools import reduce
    parts = []
    spark_df = df
    if unique:
        dup = spark_df.groupBy(*unique).agg(F.count(F.lit(1)).alias("c")).where("c > 1").agg(
            F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("n_violations"))
        parts.append(dup.select(F.lit("unique(" + ",".join(unique) + ")").alias("constraint"), "n_violations"))
    if checks:
        one = spark_df.agg(*[F.count_if(~F.coalesce(p, F.lit(False))).alias(n) for n, p in checks.items()])
        parts.append(one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("constraint"),
                                                               F.col(f"`{n}`").alias("n_violations"))
                                                      for n in checks])).alias("r")).select("r.*"))
    return reduce(lambda a, b: a.unionByName(b), parts)
