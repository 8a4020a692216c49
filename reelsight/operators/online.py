"""Online evaluation: did a user watch a recommended item within a horizon.

Interval joins are the core here.  A response at time ``t`` succeeds when the
same user watched one of its items at a time in ``[t, t + h]`` (both ends
inclusive).  Instead of a user-level join followed by a time filter (a cross
product per user, fatal for a hot user), watches are pre-aggregated per
``(user, item, time bucket of width h)`` and each response is matched to
exactly one bucket row:

* the window ``[t, t+h]`` touches bucket ``b = floor(t/h)`` and bucket ``b+1``;
* a watch in ``b`` lies in the window iff ``max(ts in b) >= t``;
* a watch in ``b+1`` lies in the window iff ``min(ts in b+1) <= t + h``.

Each watch therefore contributes to its own bucket (as "max here") and to the
previous one (as "min next").  The aggregation is partial (map-side), the
join key is unique on the watch side, so no key produces a cross product.
Timestamps are integer epoch seconds, as in the reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsight.operators.common import exact_quantiles, group_quantiles


def _width(horizon_s: int) -> int:
    return max(int(horizon_s), 1)


def with_request_id(responses: DataFrame, key_cols: Sequence[str] | None = None) -> DataFrame:
    """Add ``request_id`` when the log has none.

    With ``key_cols`` the id is a hash of those columns (stable under
    recomputation); otherwise a partition-ordered row id.
    """
    if "request_id" in responses.columns:
        return responses
    if key_cols:
        return responses.withColumn("request_id", F.xxhash64(*key_cols))
    return responses.withColumn("request_id", F.monotonically_increasing_id())


def _bucket(ts: Column, width: int) -> Column:
    return F.floor(ts / F.lit(width)).cast("bigint")


def watch_window_index(watches: DataFrame, horizon_s: int, keys: Sequence[str]) -> DataFrame:
    """Per ``(keys, bucket)``: latest watch in the bucket, earliest in the next.

    ``keys`` is ``("user_id", "movie_id")`` for item hits or ``("user_id",)``
    for "any watch".  Rows with a null key or time are ignored.
    """
    w = _width(horizon_s)
    clean = watches.select(*keys, F.col("ts").cast("bigint").alias("ts")).dropna()
    b = _bucket(F.col("ts"), w)
    none = F.lit(None).cast("bigint")
    # one scan: each watch is "latest here" for its bucket and "earliest next" for the one before
    both = clean.select(*keys, F.explode(F.array(
        F.struct(b.alias("bucket"), F.col("ts").alias("max_here"), none.alias("min_next")),
        F.struct((b - 1).alias("bucket"), none.alias("max_here"), F.col("ts").alias("min_next")))).alias("_e"))
    return (both.select(*keys, "_e.*")
                .groupBy(*keys, "bucket")
                .agg(F.max("max_here").alias("max_here"), F.min("min_next").alias("min_next")))


def _in_window(t: Column, horizon_s: int) -> Column:
    return ((F.col("max_here").isNotNull() & (F.col("max_here") >= t))
            | (F.col("min_next").isNotNull() & (F.col("min_next") <= t + F.lit(int(horizon_s)))))


def first_hits(responses: DataFrame, watches: DataFrame, horizon_s: int) -> DataFrame:
    """``(request_id, first_hit)``: 1-based list position of the first item
    the user watched within the horizon; only responses with a hit."""
    w = _width(horizon_s)
    idx = watch_window_index(watches, horizon_s, ("user_id", "movie_id"))
    exploded = (responses
                .select("request_id", "user_id", F.col("ts").cast("bigint").alias("t"),
                        F.posexplode("movie_ids").alias("pos", "movie_id"))
                .where(F.col("t").isNotNull() & F.col("movie_id").isNotNull())
                .withColumn("bucket", _bucket(F.col("t"), w)))
    hits = (exploded.join(idx, ["user_id", "movie_id", "bucket"], "inner")
                    .where(_in_window(F.col("t"), horizon_s)))
    return hits.groupBy("request_id").agg((F.min("pos") + 1).alias("first_hit"))


def response_success(responses: DataFrame, watches: DataFrame, horizon_s: int) -> DataFrame:
    """Every response with ``success`` (0/1) and ``first_hit`` (null if none).

    Responses without a watch stay with ``success = 0`` (left outer)."""
    hits = first_hits(responses, watches, horizon_s)
    return (responses.join(hits, "request_id", "left")
                     .withColumn("success", F.when(F.col("first_hit").isNotNull(), 1).otherwise(0)))


def latency_percentiles(df: DataFrame, col: str = "latency_ms") -> list[Column]:
    """p50 / p95 as constants (linear interpolation; nulls skipped)."""
    p = exact_quantiles(df, [col], [0.5, 0.95])[col] or [None, None]
    return [F.lit(v).cast("double").alias(n) for n, v in zip(("latency_p50", "latency_p95"), p)]


def latency_by_group(df: DataFrame, by: str, col: str = "latency_ms") -> DataFrame:
    """(by, latency_p50, latency_p95) for each value of a column of few
    values."""
    got = group_quantiles(df, by, col, [0.5, 0.95])
    rows = [(k, *v) for k, v in got.items()]
    known = df.sparkSession.createDataFrame(rows, "_k string, latency_p50 double, latency_p95 double")
    groups = df.select(by).distinct()
    return groups.join(known, groups[by].cast("string") == known["_k"], "left").drop("_k")


def success_at_k_cols(k_values: Sequence[int]) -> list[Column]:
    return [F.avg(F.when(F.col("first_hit") <= k, 1.0).otherwise(0.0)).alias(f"success_at_{k}")
            for k in k_values if k > 0]


def online_summary(responses: DataFrame, watches: DataFrame, horizon_s: int,
                   k_values: Sequence[int] = (5, 10, 20)) -> DataFrame:
    """One row: horizon, response count, success rate over all responses,
    success@k for each k > 0, latency p50 / p95."""
    scored = response_success(responses, watches, horizon_s)
    aggs = [F.count(F.lit(1)).alias("total_responses"),
            F.avg(F.col("success").cast("double")).alias("success_rate"),
            *success_at_k_cols(k_values)]
    late = latency_percentiles(responses) if "latency_ms" in responses.columns else []
    return scored.agg(*aggs).select(F.lit(int(horizon_s)).cast("bigint").alias("horizon_s"), "*", *late)


def success_at_k(responses: DataFrame, watches: DataFrame, horizon_s: int,
                 k_values: Sequence[int] = (5, 10, 20)) -> DataFrame:
    """Long form ``(k, success_rate)``: one join and one aggregate for all k
    (first-hit position); no responses give no rows."""
    ks = [k for k in k_values if k > 0]
    one = response_success(responses, watches, horizon_s).agg(*success_at_k_cols(ks))
    return (one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"success_at_{k}").alias("success_rate"))
                                           for k in ks])).alias("r"))
               .select("r.k", "r.success_rate").where(F.col("success_rate").isNotNull()))


def proxy_kpi_parts(responses: DataFrame, watches: DataFrame, horizon_s: int) -> DataFrame:
    """One row ``(requests_with_watch, requests_with_hit)``.

    Denominator: requests with a non-empty list whose user has any watch
    (non-null item) in ``[t, t+h]``.  Numerator: those where a watched item
    is in the list."""
    w = _width(horizon_s)
    watches = watches.where(F.col("movie_id").isNotNull())
    r = (responses.where(F.col("ts").isNotNull() & (F.size("movie_ids") > 0))
                  .select("request_id", "user_id", F.col("ts").cast("bigint").alias("t")))
    any_idx = watch_window_index(watches, horizon_s, ("user_id",))
    active = (r.withColumn("bucket", _bucket(F.col("t"), w))
               .join(any_idx, ["user_id", "bucket"], "inner")
               .where(_in_window(F.col("t"), horizon_s))
               .select("request_id"))
    hits = first_hits(responses.where(F.col("ts").isNotNull()), watches, horizon_s).select("request_id")
    tagged = (active.select(F.lit(1).alias("w"), F.lit(0).alias("h"))
                    .unionByName(hits.select(F.lit(0).alias("w"), F.lit(1).alias("h"))))
    return tagged.agg(F.coalesce(F.sum("w"), F.lit(0)).cast("bigint").alias("requests_with_watch"),
                      F.coalesce(F.sum("h"), F.lit(0)).cast("bigint").alias("requests_with_hit"))


def proxy_kpi(responses: DataFrame, watches: DataFrame, horizon_s: int = 600) -> DataFrame:
    """Share of requests with a watch in the window whose watch was a
    recommended item; 0.0 when no request had a watch."""
    parts = proxy_kpi_parts(responses, watches, horizon_s)
    return parts.select(
        F.lit(int(horizon_s)).cast("bigint").alias("horizon_s"), "requests_with_watch", "requests_with_hit",
        F.coalesce(F.try_divide(F.col("requests_with_hit").cast("double"), F.col("requests_with_watch")),
                   F.lit(0.0)).alias("proxy_kpi"))
