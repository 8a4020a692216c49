"""Quantile sketches that merge (approximate form of AGG6, DRF1, JON3).

One KLL sketch per day and column is stored; any range of days is answered by
merging its sketches, without the rows.  A sketch of size ``k`` holds a few
times k numbers whatever the number of rows, and the rank of an answer is off
by at most :func:`rank_error` of all rows (99 % confidence for one answer).

The exact forms (:mod:`reelsight.operators.common`) stay the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 1024


def rank_error(k: int = K) -> float:
    """Error of a KLL sketch's ranks as a share of the rows."""
    return 2.446 / k ** 0.9433


def daily_sketches(df: DataFrame, day: Column, columns: Sequence[str], k: int = K) -> DataFrame:
    """(day, column, n, sketch) for each day and column with values; null and
    NaN left out, rows without a day skipped.  One scan; sketches are built
    within tasks and merged by day."""
    long = (df.select(day.alias("day"), *[F.col(c).cast("double").alias(c) for c in columns])
              .unpivot(["day"], list(columns), "column", "value"))
    return (long.where(F.col("day").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value"))
                .groupBy("day", "column").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", k).alias("sketch")))


def merged(sketches: DataFrame, first: str, last: str) -> DataFrame:
    """(column, n, sketch) over the days from ``first`` to ``last``."""
    return (sketches.where(F.col("day").between(first, last)).groupBy("column")
                    .agg(F.sum("n").cast("long").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")))


def quantiles(sketches: DataFrame, levels: Sequence[float]) -> DataFrame:
    """(column, n, level, value): the approximate quantiles of each sketch."""
    asked = F.array(*[F.lit(float(q)) for q in levels])
    each = sketches.select("column", "n", F.arrays_zip(asked.alias("level"), F.kll_sketch_get_quantile_double("sketch", asked).alias("value")).alias("q"))
    return each.select("column", "n", F.explode("q").alias("q")).select("column", "n", "q.level", "q.value")


def bin_edges(sketches: DataFrame, bins: int) -> DataFrame:
    """(column, edges): the distinct quantiles at the bounds of ``bins``
    equal bins, as drift bins use them (DRF1); fewer than two give one bin
    around the value."""
    levels = [i / bins for i in range(bins + 1)]
    got = quantiles(sketches, levels).groupBy("column").agg(F.sort_array(F.collect_set("value")).alias("e"))
    return got.select("column", F.when(F.size("e") > 1, F.col("e")).otherwise(
        F.array(F.get("e", F.lit(0)) - 0.5, F.get("e", F.lit(0)) + 0.5)).alias("edges"))
