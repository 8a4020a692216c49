"""Cleaning and column normalisation (PRJ1-PRJ6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsight.functions.exprs import clip, to_double_or

KEYS = ("user_id", "item_id", "timestamp")


def normalize_time(df: DataFrame) -> DataFrame:
    """``ts`` -> ``timestamp`` when ``timestamp`` is absent (PRJ2)."""
    if "timestamp" not in df.columns and "ts" in df.columns:
        return df.withColumnRenamed("ts", "timestamp")
    return df


# Column aliases, first present alias wins (PRJ3).
COLUMN_ALIASES = {
    "user_id": ("userId", "userid"),
    "movie_id": ("movieId", "item_id", "movieid"),
    "rating": ("Rating",),
    "timestamp": ("ts", "Timestamp"),
}


def normalize_cols(df: DataFrame, aliases: dict[str, Sequence[str]] = COLUMN_ALIASES) -> DataFrame:
    """Rename known column variants to snake_case names (plan-only)."""
    renames = {}
    for target, variants in aliases.items():
        if target in df.columns:
            continue
        for v in variants:
            if v in df.columns:
                renames[v] = target
                break
    return df.withColumnsRenamed(renames) if renames else df


def lower_columns(df: DataFrame) -> DataFrame:
    """Strip and lower-case header names (done in the plan, not the data)."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def basic_clean(df: DataFrame, order_cols: Sequence[str] = (), clip_ids: bool = False) -> DataFrame:
    """Types, null and duplicate removal, rating bounds (PRJ1).

    * ratings: numeric coercion, unparsable -> 0.0, clipped to [0, 5];
    * ids: numeric coercion; with ``clip_ids=True`` also missing -> 0 and
      clipped to [0, 5] like the reference (which leaves at most 6 users);
      by default unparsable ids are dropped instead;
    * rows without user, item or timestamp are dropped;
    * duplicates on (user, item, timestamp) keep the **last** row in input
      order, given by ``order_cols`` (a unique key of the input);
    * ids and timestamp are truncated to integers.

    Dedupe is a window partitioned by the full triple, so a hot user spreads
    over items and times; ``row_number() = 1`` lets Spark apply a partial
    group limit before the shuffle.
    """
    out = normalize_time(df)
    cols = set(out.columns)
    ids = [c for c in ("user_id", "item_id") if c in cols]
    for c in ids:
        if clip_ids:
            out = out.withColumn(c, clip(to_double_or(c, 0.0), 0.0, 5.0))
        else:
            out = out.withColumn(c, F.col(c).try_cast("double"))
    if "rating" in cols:
        out = out.withColumn("rating", clip(to_double_or("rating", 0.0), 0.0, 5.0))
    if "timestamp" in cols:
        out = out.withColumn("timestamp", F.col("timestamp").try_cast("double"))
    subset = [c for c in KEYS if c in cols]
    if subset:
        out = out.dropna(subset=subset)
        if order_cols:
            w = Window.partitionBy(*subset).orderBy(*[F.col(c).desc() for c in order_cols])
            out = out.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
        else:
            out = out.dropDuplicates(subset)
    for c in subset:
        out = out.withColumn(c, F.col(c).cast("bigint"))
    return out


def default_rating(df: DataFrame, value: float = 1.0) -> DataFrame:
    """Missing ``rating`` column -> constant (PRJ4)."""
    if "rating" in df.columns:
        return df
    return df.withColumn("rating", F.lit(float(value)))


def binarize(df: DataFrame, threshold: float = 3.5, op: str = ">=", col: str = "rating",
             out: str = "positive") -> DataFrame:
    """Implicit positive flag: ``rating > thr`` (training) or ``>= thr``
    (truth) (PRJ5)."""
    c = F.col(col)
    flag = c > threshold if op == ">" else c >= threshold
    return df.withColumn(out, flag)


def recency(df: DataFrame, col: str = "timestamp", out: str = "recency") -> DataFrame:
    """Min-max scaled time, 0..1; constant column -> 0.0 (PRJ6).

    Global min/max come from one scalar subquery (a 1-row aggregate)."""
    t = F.col(col).cast("double")
    stats = df.select(F.struct(F.min(t).alias("lo"), F.max(t).alias("hi"))).scalar()
    lo, hi = stats.getField("lo"), stats.getField("hi")
    return df.withColumn(out, F.when(hi == lo, F.lit(0.0)).otherwise((t - lo) / (hi - lo)))
