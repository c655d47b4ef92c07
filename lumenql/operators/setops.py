"""Keyed set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _aligned(left: DataFrame, right: DataFrame) -> DataFrame:
    """The right side with the left side's column names; sides match by position, as in SQL."""
    if len(left.columns) != len(right.columns):
        raise ValueError(f"sides have {len(left.columns)} and {len(right.columns)} columns")
    return right.toDF(*left.columns)


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.union(_aligned(left, right))


def union_keyed(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key, the left side's first; among equals the smallest row by its columns."""
    both = left.withColumn("__side", F.lit(0)).union(_aligned(left, right).withColumn("__side", F.lit(1)))
    keys = keys or left.columns
    if set(keys) == set(left.columns):
        return both.drop("__side").distinct()
    # The smallest (side, row) of each key is an aggregate with a partial step, so a frequent key does not meet in one task.
    rest = [c for c in left.columns if c not in keys]
    best = both.groupBy(*map(_quoted, keys)).agg(F.min(F.struct("__side", *map(_quoted, rest))).alias("__best"))
    return best.select(*[F.col(_quoted(c)) if c in keys else F.col("__best")[c].alias(c) for c in left.columns])


def except_keyed(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return _against(left, right, keys, "left_anti")


def intersect_keyed(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return _against(left, right, keys, "left_semi")


def _quoted(name: str) -> str:
    return f"`{name}`"


def _against(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    other = _aligned(left, right)
    keys = keys or left.columns
    named = other.select(*[F.col(_quoted(k)).alias(f"__k{i}") for i, k in enumerate(keys)])
    condition = [F.col(_quoted(k)).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return left.join(named, condition, how)
