"""Monitoring (MON1-4, AGG17) and registry (REG1-4, PRJ12-13) plans.

The service log is the ``events`` table (``error`` events are HTTP 500).
The registry is derived from the same log: one model version per day of
responses, ``v0.1``, ``v0.2``, ... (so text order differs from numeric order
after ``v0.9``), created at the day's last response, with that day's online
hit rate and NDCG at 1 day as metrics and an artifact when the day had at
least one successful response.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from reelsight.operators import monitoring, online, registry
from reelsight.operators.common import global_rank
from reelsight.plans.oracle_views import add_view, with_views
from reelsight.plans.q_online import _HIT_SQL, DAY
from reelsight.plans.registry import register, rounded
from reelsight.sources import testdata as td

# ---------------------------------------------------------------- views --
add_view("mon_win", """
    SELECT CAST(floor(epoch(ts) / 60) * 60 - 60 * k AS BIGINT) AS window_start, event_type, value
    FROM events CROSS JOIN (SELECT unnest(range(0, 5)) AS k) g""")
add_view("mon_rate", """
    SELECT window_start, count(*) AS requests,
           CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS errors,
           sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) / count(*) AS error_rate,
           count(*) / 300.0 AS rps
    FROM mon_win GROUP BY window_start""", ("mon_win",))


def _runs_sql(flagged: str) -> str:
    return f"""
    WITH f AS ({flagged}),
    isl AS (SELECT window_start, floor(window_start / 60) - row_number() OVER (ORDER BY window_start) AS g FROM f)
    SELECT min(window_start) AS run_start, max(window_start) AS run_end, count(*) AS evaluations,
           max(window_start) - min(window_start) AS duration_s,
           max(window_start) - min(window_start) >= 600 AS fires,
           CASE WHEN max(window_start) - min(window_start) >= 600 THEN min(window_start) + 600 END AS fired_at
    FROM isl GROUP BY g"""


_BOUNDS = monitoring.LATENCY_BUCKETS
_BUCKET_CASE = "CASE " + " ".join(f"WHEN value / 1000.0 <= {b!r} THEN {i}" for i, b in enumerate(_BOUNDS)) + \
    f" ELSE {len(_BOUNDS)} END"
_BOUNDS_ROWS = ", ".join(f"({i}, {(_BOUNDS[i - 1] if i else 0.0)!r}, {b!r})" for i, b in enumerate(_BOUNDS))
add_view("mon_p95", f"""
    WITH e AS (SELECT window_start, {_BUCKET_CASE} AS b FROM mon_win WHERE value IS NOT NULL),
    c AS (SELECT window_start, b, count(*) AS n FROM e GROUP BY window_start, b),
    g AS (SELECT w.window_start, t.b FROM (SELECT DISTINCT window_start FROM c) w
          CROSS JOIN (SELECT unnest(range(0, {len(_BOUNDS) + 1})) AS b) t),
    f AS (SELECT g.window_start, g.b, coalesce(c.n, 0) AS n FROM g LEFT JOIN c
            ON c.window_start = g.window_start AND c.b = g.b),
    cu AS (SELECT *, sum(n) OVER (PARTITION BY window_start ORDER BY b ROWS UNBOUNDED PRECEDING) AS cum,
                  sum(n) OVER (PARTITION BY window_start) AS tot FROM f),
    pick AS (SELECT window_start, tot, min(b) FILTER (WHERE cum >= 0.95 * tot) AS bsel
             FROM cu GROUP BY window_start, tot),
    bounds AS (SELECT * FROM (VALUES {_BOUNDS_ROWS}) t(b, lo, hi))
    SELECT p.window_start, CAST(p.tot AS BIGINT) AS requests,
           CASE WHEN p.bsel >= {len(_BOUNDS)} THEN {float(_BOUNDS[-1])!r}
                ELSE bd.lo + (bd.hi - bd.lo) * (0.95 * p.tot - (cu.cum - cu.n)) / cu.n END AS p95_s
    FROM pick p JOIN cu ON cu.window_start = p.window_start AND cu.b = p.bsel
    LEFT JOIN bounds bd ON bd.b = p.bsel""", ("mon_win",))


def log(spark, sf):
    return td.request_log(spark, sf)


@register("request_rate", with_views("""
SELECT window_start, requests, errors, round(error_rate, 6) AS error_rate, round(rps, 6) AS rps FROM mon_rate""",
    "mon_rate"), ids=("MON1",))
def q_request_rate(spark, sf):
    return rounded(monitoring.sliding_windows(log(spark, sf)))


@register("alert_error_rate", with_views(_runs_sql("SELECT window_start FROM mon_rate WHERE error_rate > 0.05"),
                                         "mon_rate"), ids=("MON2",))
def q_alert_error_rate(spark, sf):
    return monitoring.error_rate_alerts(log(spark, sf))


@register("latency_histogram", f"""
WITH c AS (SELECT {_BUCKET_CASE} AS b, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1),
g AS (SELECT unnest(range(0, {len(_BOUNDS) + 1})) AS b),
lab AS (SELECT unnest({[str(b) for b in _BOUNDS] + ['+Inf']}) AS le, unnest(range(0, {len(_BOUNDS) + 1})) AS b)
SELECT CAST(g.b AS INTEGER) AS bucket, lab.le,
       CAST(sum(coalesce(c.n, 0)) OVER (ORDER BY g.b ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative
FROM g LEFT JOIN c ON c.b = g.b JOIN lab ON lab.b = g.b""", ids=("AGG17",))
def q_latency_histogram(spark, sf):
    return monitoring.latency_histogram(log(spark, sf))


@register("requests_by_status", """
SELECT CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, count(*) AS requests
FROM events GROUP BY 1""", ids=("AGG17",))
def q_requests_by_status(spark, sf):
    return log(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("requests"))


@register("latency_p95_windows", with_views("SELECT window_start, requests, round(p95_s, 6) AS p95_s FROM mon_p95",
                                            "mon_p95"), ids=("MON3",))
def q_latency_p95_windows(spark, sf):
    return rounded(monitoring.window_p95(log(spark, sf)))


@register("alert_latency_p95", with_views(_runs_sql("SELECT window_start FROM mon_p95 WHERE p95_s > 0.5"),
                                          "mon_p95"), ids=("MON3",))
def q_alert_latency_p95(spark, sf):
    return monitoring.latency_alerts(log(spark, sf))


@register("alert_gap", """
WITH b AS (SELECT DISTINCT CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events),
g AS (SELECT lag(t) OVER (ORDER BY t) AS prev_t, t FROM b)
SELECT prev_t, t, t - prev_t AS gap_s, t - prev_t > 600 AS fires,
       CASE WHEN t - prev_t > 600 THEN prev_t + 600 END AS fired_at
FROM g WHERE t - prev_t > 300""", ids=("MON4",))
def q_alert_gap(spark, sf):
    return monitoring.heartbeat_gaps(log(spark, sf))


# -------------------------------------------------------------- registry --
add_view("reg", f"""
    WITH {_HIT_SQL.format(h=DAY).strip()},
    lab AS (SELECT r.ts, CASE WHEN h.first_hit IS NOT NULL THEN 1 ELSE 0 END AS success,
                   coalesce(1.0 / log2(h.first_hit + 1), 0.0) AS gain
            FROM responses r LEFT JOIN hit h ON h.request_id = r.request_id),
    d AS (SELECT CAST(to_timestamp(ts) AS DATE) AS day, avg(success) AS hr, avg(gain) AS ndcg,
                 sum(success) AS n_succ, max(ts) AS t FROM lab GROUP BY 1)
    SELECT 'v0.' || row_number() OVER (ORDER BY day) AS version, t,
           strftime(to_timestamp(t), '%Y-%m-%dT%H:%M:%S') ||
             CASE WHEN row_number() OVER (ORDER BY day) % 2 = 0 THEN 'Z' ELSE '' END AS created_at,
           CASE WHEN n_succ > 0 THEN 'model.joblib' END AS artifact, hr, ndcg,
           CAST(split_part(('v0.' || row_number() OVER (ORDER BY day)), '.', 2) AS INTEGER) AS minor
    FROM d""", ("resp_items", "responses", "watches"))


def registry_table(spark, sf):
    """The derived registry ``(version, created_at, artifact, metrics, t)``."""
    lab = online.response_success(td.responses(spark, sf), td.watches(spark, sf), DAY)
    per = (lab.groupBy(F.to_date(F.timestamp_seconds("ts")).alias("day"))
              .agg(F.avg("success").alias("hr"),
                   F.avg(F.coalesce(1.0 / F.log2(F.col("first_hit") + 1), F.lit(0.0))).alias("ndcg"),
                   F.sum("success").alias("n_succ"), F.max("ts").alias("t")))
    ranked = global_rank(per, [F.col("day").asc()], "_i")
    iso = F.date_format(F.timestamp_seconds("t"), "yyyy-MM-dd'T'HH:mm:ss")
    return ranked.select(
        F.concat(F.lit("v0."), F.col("_i").cast("string")).alias("version"), "t",
        F.concat(iso, F.when(F.col("_i") % 2 == 0, F.lit("Z")).otherwise(F.lit(""))).alias("created_at"),
        F.when(F.col("n_succ") > 0, F.lit("model.joblib")).alias("artifact"),
        F.create_map(F.lit("hr@20"), F.col("hr"), F.lit("ndcg@20"), F.col("ndcg")).alias("metrics"))


@register("registry_next_version", with_views("""
SELECT (SELECT version FROM reg ORDER BY minor DESC LIMIT 1) AS latest, max(version) AS text_latest,
       'v0.' || (max(minor) + 1) AS next_version FROM reg""", "reg"), ids=("REG1",))
def q_registry_next_version(spark, sf):
    return registry.next_version(registry_table(spark, sf))


@register("registry_latest_artifact", with_views("""
SELECT version, artifact FROM reg WHERE artifact IS NOT NULL ORDER BY minor DESC LIMIT 1""", "reg"),
    ids=("REG2",))
def q_registry_latest_artifact(spark, sf):
    return registry.latest_with_artifact(registry_table(spark, sf))


@register("registry_info", with_views("""
SELECT version, artifact, round(hr, 6) AS hr_at_20, round(ndcg, 6) AS ndcg_at_20,
       round(greatest(0.0, (SELECT max(floor(epoch(ts))) FROM events) - t), 6) AS age_s
FROM reg ORDER BY minor DESC LIMIT 1""", "reg"), ids=("REG3",))
def q_registry_info(spark, sf):
    now = td.request_log(spark, sf).select(F.max("ts").cast("double")).scalar()
    return rounded(registry.active_info(registry_table(spark, sf), now))


@register("model_age", with_views("""
SELECT version, round(CAST(t AS DOUBLE), 6) AS created_epoch,
       round(greatest(0.0, (SELECT max(floor(epoch(ts))) FROM events) - t), 6) AS age_s FROM reg""", "reg"),
    ids=("PRJ13",))
def q_model_age(spark, sf):
    now = td.request_log(spark, sf).select(F.max("ts").cast("double")).scalar()
    r = registry_table(spark, sf)
    return rounded(r.select("version", registry.parse_created_at("created_at").alias("created_epoch"),
                            registry.model_age("created_at", now).alias("age_s")))


@register("active_version_asof", with_views("""
SELECT r.request_id, r.ts, a.version
FROM request_log r ASOF LEFT JOIN (SELECT version, t FROM reg) a ON r.ts >= a.t""", "request_log", "reg"),
    ids=("REG4",))
def q_active_version_asof(spark, sf):
    acts = registry_table(spark, sf).select("version", F.col("t").alias("activated_at"))
    req = td.request_log(spark, sf).select("request_id", "ts")
    return registry.active_version_asof(req, acts)


@register("registry_scan", with_views("""
SELECT version AS model_version, created_at, artifact FROM reg""", "reg"), ids=("PRJ12",))
def q_registry_scan(spark, sf):
    r = registry_table(spark, sf)
    minor = F.split(F.col("version"), r"\.")[1].cast("int")
    as_json = F.to_json(F.struct(F.col("version").alias("model_version"), "created_at", "artifact"))
    as_lines = F.concat_ws("\n", F.lit("# registry metadata"),
                           F.concat(F.lit("model_version: "), F.col("version")),
                           F.concat(F.lit("created_at: \""), F.col("created_at"), F.lit("\"")),
                           F.concat(F.lit("artifact: "), F.coalesce(F.col("artifact"), F.lit("null"))))
    text = F.when(minor % 2 == 0, as_json).otherwise(as_lines)
    m = registry.parse_metadata_text(text)
    return r.select(m["model_version"].alias("model_version"), m["created_at"].alias("created_at"),
                    m["artifact"].alias("artifact"))
