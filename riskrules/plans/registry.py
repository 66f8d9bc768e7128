"""The query registry and helpers for stating a result twice."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrules.functions.measures import rounded
from riskrules.plans.roles_sql import ROLES
from riskrules.sources.roles import EventRoles


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Callable[[EventRoles], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(EventRoles(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(*covers: str, oracle: str | None = None):
    """Register a function of the roles; ``oracle`` continues the ``WITH`` list of the roles."""
    def register(build: Callable[[EventRoles], DataFrame]):
        name = build.__name__
        if name in REGISTRY:
            raise ValueError(f"two queries named {name}")
        REGISTRY[name] = Query(name, covers, build, None if oracle is None else f"WITH {ROLES}{oracle}")
        return build

    return register


def rd(column: Column | str, digits: int = 6) -> Column:
    return rounded(F.col(column) if isinstance(column, str) else column, digits)


def rds(names: list[str] | tuple[str, ...], digits: int = 6) -> list[Column]:
    return [rd(n, digits).alias(n) for n in names]


def when_text(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def sql_rd(expression: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"CAST(round(CAST(({expression}) AS DECIMAL(30,8)), {digits}) AS DOUBLE)"


def sql_rds(names: list[str] | tuple[str, ...], digits: int = 6) -> str:
    return ", ".join(f"{sql_rd(n, digits)} AS {n}" for n in names)


def sql_time(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"
