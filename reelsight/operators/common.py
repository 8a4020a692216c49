"""Distributed building blocks used by several operators.

``global_rank`` numbers the rows of a DataFrame 1..N in a total order, and
``global_cumsum`` adds up a column in that order, without a single-partition
window.  The range-sorted rows are written once, each with
``(partition << 33) + position``; the per-partition counts or sums (a table
with one row per partition) and the rows themselves are both read from those
files.  So the offsets always belong to the partitions of the rows, whatever
columns a branch prunes, and whether or not Spark reuses an exchange or
recomputes a lost task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsight.session import materialize

_LOW33 = (1 << 33) - 1


def placed(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """The rows in ``order``, written with their place ``_mid``."""
    return materialize(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()), "placed")


def _offsets(placed: DataFrame, amount: Column) -> DataFrame:
    """Per partition, the sum of ``amount`` over the partitions before it.
    One row per partition: a single ordered window over it is cheap."""
    sums = placed.groupBy(F.shiftright("_mid", 33).alias("_pid")).agg(F.sum(amount).alias("_s"))
    before = F.sum("_s").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    return F.broadcast(sums.select("_pid", F.coalesce(before, F.lit(0)).alias("_off")))


def global_rank(df: DataFrame, order: Sequence[Column | str], out: str = "rank") -> DataFrame:
    """Add ``out`` = 1-based row number of each row in ``order``.

    ``order`` must be a total order (end it with a unique key) for the
    numbers to be reproducible.
    """
    s = placed(df, order)
    return (s.join(_offsets(s, F.lit(1)), F.shiftright("_mid", 33) == F.col("_pid"))
             .withColumn(out, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOW33)) + F.lit(1))
             .drop("_mid", "_pid", "_off"))


def dense_index(df: DataFrame, col: str, out: str) -> DataFrame:
    """Mapping ``(col, out)`` with ``out`` = 0..N-1 over the sorted distinct
    values of ``col`` (the reference's contiguous id maps)."""
    ids = df.select(col).where(F.col(col).isNotNull()).distinct()
    return global_rank(ids, [F.col(col).asc()], "_r").select(col, (F.col("_r") - 1).alias(out))


def global_cumsum(df: DataFrame, order: list, value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` in a total ``order``: sums of the
    partitions before, and a window inside each partition."""
    s = placed(df, order)
    within = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    return (s.withColumn("_pid", F.shiftright("_mid", 33)).join(_offsets(s, F.col(value)), "_pid")
             .withColumn(out, F.col("_off") + F.coalesce(F.sum(value).over(within), F.lit(0)))
             .drop("_mid", "_pid", "_off"))


def exact_quantiles(df: DataFrame, columns: Sequence[str], qs: Sequence[float]) -> dict[str, list[float] | None]:
    """Exact linear-interpolation quantiles (the values of ``percentile``) of
    each column, null and NaN left out; None for a column without values.

    One scan counts the rows of each (column, value); the counts are added up
    in order, and the rows that hold the wanted ranks are picked.  Neither a
    value map nor a column is gathered in one task.  One row per column
    reaches the driver."""
    if not columns:
        return {}
    rows = (df.select(*[F.col(c).cast("double").alias(c) for c in columns])
              .unpivot([], list(columns), "column", "value"))
    return {c: None for c in columns} | _value_quantiles(rows, qs)


def group_quantiles(df: DataFrame, by: str, col: str, qs: Sequence[float]) -> dict[str, list[float]]:
    """:func:`exact_quantiles` of ``col`` for each value of ``by`` (as text).
    For a column of few values: one row per group reaches the driver."""
    rows = df.select(F.col(by).cast("string").alias("column"), F.col(col).cast("double").alias("value"))
    return _value_quantiles(rows.where(F.col("column").isNotNull()), qs)


def _value_quantiles(rows: DataFrame, qs: Sequence[float]) -> dict[str, list[float]]:
    """Quantiles of ``value`` for each ``column`` that has values."""
    rows = rows.where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = rows.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    c = materialize(global_cumsum(counts, [F.col("column"), F.col("value")], "n", "upto"), "quantiles")
    spans = {r["column"]: (r["start"], r["n"]) for r in
             c.groupBy("column").agg(F.min("upto").alias("start"), F.sum("n").alias("n")).collect()}
    ranks = {k: [(q * (n - 1), int(q * (n - 1) // 1)) for q in qs] for k, (_, n) in spans.items()}
    wanted = {k: sorted({r + d for _, r in v for d in (0, 1)}) for k, v in ranks.items()}
    found: dict[str, dict[int, float]] = {}
    if spans:
        hit = F.lit(False)
        for k, want in wanted.items():
            start = spans[k][0]
            at = F.lit(False)
            for r in want:
                at = at | ((F.col("upto") <= F.lit(start + r)) & (F.lit(start + r) < F.col("upto") + F.col("n")))
            hit = hit | ((F.col("column") == k) & at)
        for row in c.where(hit).collect():  # at most two rows for each level and column
            lo = row["upto"] - spans[row["column"]][0]
            found.setdefault(row["column"], {}).update(
                {r: row["value"] for r in wanted[row["column"]] if lo <= r < lo + row["n"]})
    out: dict[str, list[float]] = {}
    for k, places in ranks.items():
        vals = []
        for pos, r0 in places:
            r1 = min(r0 + 1, spans[k][1] - 1)
            v0, v1 = found[k][r0], found[k][r1]
            # same interpolation as Spark's percentile
            vals.append(v0 if pos == r0 or v0 == v1 else (r1 - pos) * v0 + (pos - r0) * v1)
        out[k] = vals
    return out
