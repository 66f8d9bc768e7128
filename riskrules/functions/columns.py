"""Choosing and naming columns at plan-build time; no data is read except by the detectors."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_suffix(df: DataFrame, suffix: str) -> list[str]:
    return [c for c in df.columns if c.endswith(suffix)]


def containing(df: DataFrame, *parts: str) -> list[str]:
    return [c for c in df.columns if any(p in c for p in parts)]


def numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def without(columns: Sequence[str], dropped: Sequence[str]) -> list[str]:
    gone = set(dropped)
    return [c for c in columns if c not in gone]


def strip_suffix(df: DataFrame, suffix: str) -> DataFrame:
    names = with_suffix(df, suffix)
    return df.withColumnsRenamed({c: c[: -len(suffix)] for c in names})


def rename_by(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    return df.withColumnsRenamed({c: rule(c) for c in df.columns})


def constant_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: its number of distinct values is one or not. A single pass."""
    one = df.agg(
        *[F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(c) for c in columns],
    )
    return _long(one, columns, "is_constant")


def infinite_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: whether it holds an infinity. A single pass."""
    endless = [F.coalesce(F.max(F.abs(F.col(c)) == F.lit(float("inf"))), F.lit(False)).alias(c) for c in columns]
    return _long(df.agg(*endless), columns, "is_infinite")


def _long(one_row: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias(value)) for c in columns])
    return one_row.select(F.inline(pairs))
