"""Named query plans over the test tables, each with its DuckDB oracle.

A plan is a function ``(spark, sf_dir) -> DataFrame``.  ``register`` keeps
it together with the ANSI SQL that computes the same result on the raw
parquet tables (``None`` for operators SQL cannot express, such as ALS).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PlanFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Plan:
    name: str
    fn: PlanFn
    oracle: str | None
    ids: tuple[str, ...]


PLANS: dict[str, Plan] = {}


def register(name: str, oracle: str | None, ids: tuple[str, ...] = ()):
    def deco(fn: PlanFn) -> PlanFn:
        if name in PLANS:
            raise ValueError(f"plan {name!r} registered twice")
        PLANS[name] = Plan(name, fn, oracle, ids)
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column so results hash equal across engines."""
    cols = [F.round(F.col(c), digits).alias(c) if t in ("double", "float") else F.col(c)
            for c, t in df.dtypes]
    return df.select(*cols)
