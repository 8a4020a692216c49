"""Online-evaluation plans (JON10-12, AGG6-8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelsight.operators import online
from reelsight.plans.oracle_views import with_views
from reelsight.plans.registry import register, rounded
from reelsight.sources import testdata as td

DAY = 86400
WEEK = 7 * DAY

# Oracle for "first hit per request": a plain range join, the definition.
_HIT_SQL = """
hit AS (
  SELECT ri.request_id, min(ri.pos) AS first_hit
  FROM resp_items ri JOIN watches w
    ON w.user_id = ri.user_id AND w.movie_id = ri.movie_id
   AND w.ts BETWEEN ri.ts AND ri.ts + {h}
  GROUP BY ri.request_id)"""


@register("online_summary", with_views(f"""
WITH {_HIT_SQL.format(h=DAY).strip()}
SELECT CAST({DAY} AS BIGINT) AS horizon_s, count(*) AS total_responses,
       round(avg(CASE WHEN h.first_hit IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS success_rate,
       round(avg(CASE WHEN h.first_hit <= 5 THEN 1.0 ELSE 0.0 END), 6) AS success_at_5,
       round(avg(CASE WHEN h.first_hit <= 10 THEN 1.0 ELSE 0.0 END), 6) AS success_at_10,
       round(avg(CASE WHEN h.first_hit <= 20 THEN 1.0 ELSE 0.0 END), 6) AS success_at_20,
       round(quantile_cont(r.latency_ms, 0.5), 6) AS latency_p50,
       round(quantile_cont(r.latency_ms, 0.95), 6) AS latency_p95
FROM responses r LEFT JOIN hit h ON r.request_id = h.request_id""", "resp_items", "watches"),
    ids=("JON10", "AGG6", "AGG7", "AGG8"))
def q_online_summary(spark, sf):
    return rounded(online.online_summary(td.responses(spark, sf), td.watches(spark, sf), DAY))


@register("response_success", with_views(f"""
WITH {_HIT_SQL.format(h=WEEK).strip()}
SELECT r.request_id, r.user_id, r.ts, h.first_hit,
       CASE WHEN h.first_hit IS NOT NULL THEN 1 ELSE 0 END AS success
FROM responses r LEFT JOIN hit h ON r.request_id = h.request_id""", "resp_items", "watches"),
    ids=("JON10", "EXP8"))
def q_response_success(spark, sf):
    s = online.response_success(td.responses(spark, sf), td.watches(spark, sf), WEEK)
    return s.select("request_id", "user_id", "ts", F.col("first_hit").cast("bigint").alias("first_hit"),
                    "success")


@register("success_at_k", with_views(f"""
WITH {_HIT_SQL.format(h=WEEK).strip()}, ks AS (SELECT unnest([5, 10, 20]) AS k)
SELECT ks.k, round(avg(CASE WHEN h.first_hit <= ks.k THEN 1.0 ELSE 0.0 END), 6) AS success_rate
FROM responses r LEFT JOIN hit h ON r.request_id = h.request_id CROSS JOIN ks
GROUP BY ks.k""", "resp_items", "watches"), ids=("AGG8",))
def q_success_at_k(spark, sf):
    out = online.success_at_k(td.responses(spark, sf), td.watches(spark, sf), WEEK, (5, 10, 20))
    return rounded(out.select(F.col("k").cast("int").alias("k"), "success_rate"))


@register("latency_percentiles", """
SELECT event_type,
       round(quantile_cont(value, 0.5), 6) AS latency_p50,
       round(quantile_cont(value, 0.95), 6) AS latency_p95
FROM events GROUP BY event_type""", ids=("AGG6",))
def q_latency_percentiles(spark, sf):
    return rounded(online.latency_by_group(td.request_log(spark, sf), "event_type"))


_PROXY_SQL = """
WITH active AS (
  SELECT DISTINCT r.request_id FROM responses r JOIN watches w
    ON w.user_id = r.user_id AND w.movie_id IS NOT NULL AND w.ts BETWEEN r.ts AND r.ts + {h}),
hit AS (
  SELECT DISTINCT ri.request_id FROM resp_items ri JOIN watches w
    ON w.user_id = ri.user_id AND w.movie_id = ri.movie_id AND w.ts BETWEEN ri.ts AND ri.ts + {h})
SELECT CAST({h} AS BIGINT) AS horizon_s,
       (SELECT count(*) FROM active) AS requests_with_watch,
       (SELECT count(*) FROM hit) AS requests_with_hit,
       round(coalesce((SELECT count(*) FROM hit) / nullif((SELECT count(*) FROM active), 0), 0.0), 6) AS proxy_kpi"""


@register("proxy_kpi", with_views(_PROXY_SQL.format(h=3600), "resp_items", "watches"), ids=("JON11", "JON12"))
def q_proxy_kpi(spark, sf):
    return rounded(online.proxy_kpi(td.responses(spark, sf), td.watches(spark, sf), 3600))


@register("proxy_kpi_week", with_views(_PROXY_SQL.format(h=WEEK), "resp_items", "watches"), ids=("JON11",))
def q_proxy_kpi_week(spark, sf):
    return rounded(online.proxy_kpi(td.responses(spark, sf), td.watches(spark, sf), WEEK))
