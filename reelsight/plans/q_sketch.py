"""Plans over stored daily quantile sketches (AGG6, DRF1, JON3)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from reelsight.operators import sketches as sk
from reelsight.plans.registry import register
from reelsight.session import scratch_path
from reelsight.sources import testdata as td

LEVELS = (0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
DAYS = ("2024-01-05", "2024-01-20")


def stored(spark, sf):
    """Sketches of the request log's latencies, written once a day."""
    path = scratch_path(spark, f"sketches-{uuid.uuid4().hex[:12]}")
    log = td.request_log(spark, sf)
    day = F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd")
    sk.daily_sketches(log, day, ["latency_ms"]).write.parquet(path)
    return spark.read.parquet(path)


@register("sketch_quantiles", f"""
WITH d AS (SELECT value FROM events WHERE value IS NOT NULL
           AND CAST(CAST(to_timestamp(floor(epoch(ts))) AT TIME ZONE 'UTC' AS DATE) AS VARCHAR) BETWEEN '{DAYS[0]}' AND '{DAYS[1]}'),
l AS (SELECT unnest({list(LEVELS)}) AS level)
SELECT 'latency_ms' AS "column", level, (SELECT count(*) FROM d) AS n, true AS within FROM l""", ids=("AGG6", "DRF1", "JON3"))
def q_sketch_quantiles(spark, sf):
    """Quantiles of a range of days from its sketches: their true ranks,
    counted over the rows, are within the stated error."""
    got = sk.quantiles(sk.merged(stored(spark, sf), *DAYS), LEVELS)
    day = F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd")
    rows = td.request_log(spark, sf).where(day.between(*DAYS) & F.col("latency_ms").isNotNull()).select("latency_ms")
    asked = [(r["level"], r["value"]) for r in got.select("level", "value").collect()]  # one row a level
    counts = rows.agg(*[F.count(F.when(F.col("latency_ms") <= v, 1)).alias(f"le{i}") for i, (_, v) in enumerate(asked)],
                      *[F.count(F.when(F.col("latency_ms") < v, 1)).alias(f"lt{i}") for i, (_, v) in enumerate(asked)])
    c, off = counts.first(), sk.rank_error()
    hit = F.lit(False)
    for i, (q, _) in enumerate(asked):
        hit = F.when(F.col("level") == q, (c[f"lt{i}"] / F.col("n") <= q + off) & (c[f"le{i}"] / F.col("n") >= q - off)).otherwise(hit)
    return got.select("column", "level", "n", hit.alias("within"))


@register("sketch_days", """
SELECT CAST(CAST(to_timestamp(floor(epoch(ts))) AT TIME ZONE 'UTC' AS DATE) AS VARCHAR) AS day, count(value) AS n
FROM events WHERE value IS NOT NULL GROUP BY 1""", ids=("AGG6",))
def q_sketch_days(spark, sf):
    """What each day's stored sketch says it has seen."""
    return stored(spark, sf).select("day", F.kll_sketch_get_n_double("sketch").alias("n"))
