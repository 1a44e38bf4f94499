"""Declared constraints as a report: not null, unique key, 0/1 flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def _unpivoted(counts: DataFrame, table: str, rule: str, columns: list[str]) -> DataFrame:
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(
        f"'{table}' AS table_name", f"'{rule}' AS rule", f"stack({len(columns)}, {pairs}) AS (column_name, violations)"
    )


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _unpivoted(counts, table, "not_null", columns)


def zero_or_one(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(~F.col(c).isin(0, 1)).alias(c) for c in columns])
    return _unpivoted(counts, table, "zero_or_one", columns)


def unique_key(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    repeated = df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.agg(F.count("*").alias("violations")).selectExpr(
        f"'{table}' AS table_name", "'unique_key' AS rule", f"'{', '.join(key)}' AS column_name", "violations"
    )


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
