"""Service-log monitoring: request rate, error-rate / latency alerts and
heartbeat gaps (MON1-MON4, AGG17).

Alert rules are evaluated once per minute over 5-minute sliding windows; a
rule "fires" when its condition holds for consecutive evaluations spanning
at least the ``for`` duration.  Runs of consecutive minutes are found with
the gaps-and-islands trick on a distributed row number, so no window spans
the whole log in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsight.operators.common import global_rank

# Latency histogram bucket bounds in seconds (+Inf last) and
# the alert limits and durations of the rules.
LATENCY_BUCKETS = (0.01, 0.025, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 5.0)
ERROR_RATE_LIMIT = 0.05
P95_LIMIT_S = 0.5
FOR_S = 600
HEARTBEAT_STALE_S = 300
HEARTBEAT_FOR_S = 300
WINDOW, SLIDE = "5 minutes", "1 minute"


def sliding_windows(log: DataFrame, time_col: str = "event_time", window: str = WINDOW,
                    slide: str = SLIDE, by: Sequence[str] = ()) -> DataFrame:
    """Requests, 5xx errors, error rate and requests/s per sliding window
    (MON1), for each value of ``by``; ``window_start`` in epoch seconds.

    A batch is first counted per slide (all its rows share their windows),
    so only one row per slide is repeated for each window; a stream is
    counted per window at once."""
    secs = _seconds(window)
    one, bad = F.count(F.lit(1)), F.sum(F.when(F.col("status") >= 500, 1).otherwise(0))
    if not log.isStreaming:
        per = log.where(F.col(time_col).isNotNull()).groupBy(F.window(F.col(time_col), slide).alias("w"), *by).agg(
            one.alias("n"), bad.alias("e"))
        log, time_col = per.select(F.col("w.start").alias("_t"), "n", "e", *by), "_t"
        one, bad = F.sum("n"), F.sum("e")
    w = F.window(F.col(time_col), window, slide)
    return (log.groupBy(w.alias("w"), *by)
               .agg(one.alias("requests"), bad.alias("errors"))
               .select(*by, F.unix_timestamp("w.start").alias("window_start"), "requests", "errors",
                       (F.col("errors") / F.col("requests")).alias("error_rate"),
                       (F.col("requests") / F.lit(float(secs))).alias("rps")))


def _seconds(spec: str) -> int:
    n, unit = spec.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def runs(flagged: DataFrame, step_s: int = 60, time_col: str = "window_start",
         min_duration_s: int = FOR_S) -> DataFrame:
    """Consecutive evaluations (``step_s`` apart) where the condition held;
    a run fires when it lasts at least ``min_duration_s`` (MON2/MON3)."""
    r = global_rank(flagged.select(time_col).distinct(), [F.col(time_col).asc()], "_r")
    isl = r.withColumn("_g", F.floor(F.col(time_col) / step_s) - F.col("_r"))
    out = (isl.groupBy("_g").agg(F.min(time_col).alias("run_start"), F.max(time_col).alias("run_end"),
                                 F.count(F.lit(1)).alias("evaluations"))
              .withColumn("duration_s", F.col("run_end") - F.col("run_start"))
              .withColumn("fires", F.col("duration_s") >= min_duration_s)
              .withColumn("fired_at", F.when(F.col("fires"), F.col("run_start") + min_duration_s))
              .drop("_g"))
    return out


def error_rate_alerts(log: DataFrame, limit: float = ERROR_RATE_LIMIT, for_s: int = FOR_S) -> DataFrame:
    """HighErrorRate: 5-minute error rate above ``limit`` for ``for_s`` (MON2)."""
    w = sliding_windows(log)
    return runs(w.where(F.col("error_rate") > limit), 60, "window_start", for_s)


def bucket_index(latency_s: Column, bounds: Sequence[float] = LATENCY_BUCKETS) -> Column:
    """Index of the first ``le`` bound >= latency; ``len(bounds)`` = +Inf.
    A literal CASE chain, so it compiles with the rest of the stage."""
    expr = F.when(latency_s <= F.lit(bounds[0]), F.lit(0))
    for i, b in enumerate(bounds[1:], start=1):
        expr = expr.when(latency_s <= F.lit(b), F.lit(i))
    return expr.otherwise(F.lit(len(bounds)))


def _cumulative(counts: Column) -> Column:
    return F.transform(counts, lambda c, i: F.aggregate(F.slice(counts, 1, i + 1), F.lit(0).cast("bigint"),
                                                       lambda a, x: a + x))


def latency_histogram(log: DataFrame, latency_ms: str = "latency_ms",
                      bounds: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """Cumulative request counts per ``le`` bucket (AGG17): one aggregate
    with a conditional count per bucket, then a running sum over the (fixed
    size) bucket array."""
    idx = bucket_index(F.col(latency_ms) / 1000.0, bounds)
    n = len(bounds) + 1
    counts = log.where(F.col(latency_ms).isNotNull()).agg(
        F.array(*[F.sum(F.when(idx == i, 1).otherwise(0)).cast("bigint") for i in range(n)]).alias("c"))
    labels = F.array(*[F.lit(str(b)) for b in bounds], F.lit("+Inf"))
    return (counts.select(F.posexplode(F.arrays_zip(labels.alias("le"), _cumulative(F.col("c")).alias("cum"))))
                  .select(F.col("pos").cast("int").alias("bucket"), F.col("col.le").alias("le"),
                          F.col("col.cum").alias("cumulative")))


def p95_from_buckets(counts: list[Column], total: Column, q: float = 0.95,
                     bounds: Sequence[float] = LATENCY_BUCKETS) -> Column:
    """Quantile estimate from per-bucket counts (one column per bucket,
    +Inf last), linear inside the bucket like ``histogram_quantile``; a
    quantile in +Inf gives the highest finite bound.  Running sums and the
    bucket search are plain column arithmetic and CASE chains."""
    cum, acc = [], None
    for c in counts:
        acc = c if acc is None else acc + c
        cum.append(acc)
    rank = F.lit(q) * total
    est = F.lit(float(bounds[-1]))
    for i in range(len(bounds) - 1, -1, -1):
        lower = F.lit(0.0) if i == 0 else F.lit(float(bounds[i - 1]))
        prev = F.lit(0) if i == 0 else cum[i - 1]
        here = lower + (F.lit(float(bounds[i])) - lower) * (rank - prev) / counts[i]
        est = F.when(cum[i] >= rank, here).otherwise(est)
    return F.when(total == 0, F.lit(None).cast("double")).otherwise(est)


def window_p95(log: DataFrame, latency_ms: str = "latency_ms", time_col: str = "event_time",
               bounds: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """Per sliding window: bucket counts and the histogram p95 (seconds)."""
    n = len(bounds) + 1
    rows = (log.where(F.col(latency_ms).isNotNull())
               .select(time_col, bucket_index(F.col(latency_ms) / 1000.0, bounds).alias("_b")))
    slide = (rows.groupBy(F.window(F.col(time_col), SLIDE).alias("s"))  # once per slide, then per window
                 .agg(*[F.count(F.when(F.col("_b") == i, 1)).alias(f"_b{i}") for i in range(n)],
                      F.count(F.lit(1)).alias("requests"))
                 .withColumn("_t", F.col("s.start")))
    per = (slide.groupBy(F.window("_t", WINDOW, SLIDE).alias("w"))
                .agg(*[F.sum(f"_b{i}").alias(f"_b{i}") for i in range(n)], F.sum("requests").alias("requests")))
    counts = [F.col(f"_b{i}") for i in range(len(bounds) + 1)]
    return per.select(F.unix_timestamp("w.start").alias("window_start"), "requests",
                      p95_from_buckets(counts, F.col("requests"), 0.95, bounds).alias("p95_s"))


#: Columns of a pane: requests, errors, and the requests of each latency bucket.
PANE = ("requests", "errors", *[f"b{i}" for i in range(len(LATENCY_BUCKETS) + 1)])


def pane_counts(latency_ms: str = "latency_ms") -> list[Column]:
    """The aggregates of a pane."""
    idx = bucket_index(F.col(latency_ms) / 1000.0)
    there = F.col(latency_ms).isNotNull()
    return [F.count(F.lit(1)).alias("requests"), F.count(F.when(F.col("status") >= 500, 1)).alias("errors"),
            *[F.count(F.when(there & (idx == i), 1)).alias(c) for i, c in enumerate(PANE[2:])]]


def window_stats(windows: DataFrame, w: str, by: Sequence[str] = ()) -> DataFrame:
    """Rates and the histogram p95 from the summed panes of each window;
    ``timed`` counts the requests with a latency."""
    counts = [F.col(c) for c in PANE[2:]]
    timed = sum(counts[1:], counts[0])
    return windows.select(*by, F.unix_timestamp(f"{w}.start").alias("window_start"), "requests", "errors",
                          (F.col("errors") / F.col("requests")).alias("error_rate"),
                          (F.col("requests") / F.lit(float(_seconds(WINDOW)))).alias("rps"), timed.alias("timed"),
                          p95_from_buckets(counts, timed).alias("p95_s"))


def latency_alerts(log: DataFrame, limit_s: float = P95_LIMIT_S, for_s: int = FOR_S) -> DataFrame:
    """HighLatencyP95: histogram p95 above ``limit_s`` for ``for_s`` (MON3)."""
    w = window_p95(log)
    return runs(w.where(F.col("p95_s") > limit_s), 60, "window_start", for_s)


def heartbeat_gaps(log: DataFrame, ts: str = "ts", stale_s: int = HEARTBEAT_STALE_S,
                   for_s: int = HEARTBEAT_FOR_S) -> DataFrame:
    """ServiceDown: gaps between consecutive heartbeats longer than
    ``stale_s``; the alert fires when the gap exceeds ``stale_s + for_s``
    (MON4).  Heartbeats are first reduced to distinct seconds, then
    numbered in order; the previous one is found by an equi join on
    ``rank - 1`` instead of a global ``lag``."""
    beats = log.select(F.col(ts).cast("bigint").alias("t")).where(F.col("t").isNotNull()).distinct()
    r = global_rank(beats, [F.col("t").asc()], "_r")
    prev = r.select((F.col("_r") + 1).alias("_r"), F.col("t").alias("prev_t"))
    g = r.join(prev, "_r").withColumn("gap_s", F.col("t") - F.col("prev_t"))
    return (g.where(F.col("gap_s") > stale_s)
             .select("prev_t", "t", "gap_s", (F.col("gap_s") > stale_s + for_s).alias("fires"),
                     F.when(F.col("gap_s") > stale_s + for_s, F.col("prev_t") + stale_s + for_s).alias("fired_at")))
