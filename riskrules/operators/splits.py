"""Splitting and sampling tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def block_and_rest(df: DataFrame, block: str, value: int) -> tuple[DataFrame, DataFrame]:
    """Rows of one block and all other rows that have a block."""
    return df.filter(F.col(block) == value), df.filter(F.col(block) != value)


def before_and_from(df: DataFrame, time: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """Rows before a cutoff and rows from it on."""
    limit = F.lit(cutoff).cast("timestamp")
    return df.filter(F.col(time) < limit), df.filter(F.col(time) >= limit)


def recent_or_old(df: DataFrame, time: str, as_of: str, days: int = 60, side: str = "recent") -> DataFrame:
    """Rows less than ``days`` complete days old; ``side='old'`` keeps the others instead."""
    age = F.timestamp_diff("DAY", F.col(time), F.lit(as_of).cast("timestamp"))
    return df.filter(age < days if side == "recent" else age >= days)


def drawn(key: Column, seed: int) -> Column:
    """A hexadecimal number that hangs on seed and key alone, not on how rows are laid out."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))


def in_test_share(key: Column, share: float, seed: int = 42) -> Column:
    """True for a fixed pseudo-random share of keys; the same key always falls on the same side."""
    return F.substring(drawn(key, seed), 1, 8) < f"{min(int(share * 2**32), 2**32 - 1):08x}"


def random_split(df: DataFrame, key: str, share: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test); deterministic, and rows of a key stay together."""
    test = in_test_share(F.col(key), share, seed)
    return df.filter(~test), df.filter(test)


def random_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows at random, the same for a seed however the rows are laid out.

    Each task keeps its best ``n``, so nothing is sorted as a whole.
    """
    return df.orderBy(drawn(F.col(key), seed), key).limit(n)
