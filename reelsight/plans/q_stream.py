"""Streaming plans (STR1-STR7), each checked against its batch twin.

The input table is staged as a sequence of time-ordered file chunks (about
eight, whatever the data size) so the stream sees several micro-batches.
What is still open at the end of the input is read from the state that the
stopped stream holds; no marker rows end it.  Every run gets fresh checkpoint
and output folders under the session's shared checkpoint folder.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsight.operators import online
from reelsight.plans import q_io, q_online
from reelsight.plans.oracle_views import add_view, with_views
from reelsight.plans.registry import PLANS, register, rounded
from reelsight.session import materialize, scratch_path
from reelsight.sources import segments
from reelsight.sources import testdata as td
from reelsight.streaming import pipelines as sp

CHUNKS = 8


def _run_dir(spark, name):
    return scratch_path(spark, f"stream-{name}-{uuid.uuid4().hex[:12]}")


def stage_chunks(df: DataFrame, path: str, ts: str = "ts") -> str:
    """Write ``df`` as time-ordered chunks, one write per chunk (so file
    times follow event time).  Returns the delay within which the files of a
    chunk, in one batch or in two, may mix times."""
    span = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()  # two scalars
    lo, hi = int(span["lo"] or 0), int(span["hi"] or 0)
    width = max(1, (hi - lo) // CHUNKS + 1)
    for i in range(CHUNKS):
        a, b = lo + i * width, lo + (i + 1) * width
        df.where((F.col(ts) >= a) & (F.col(ts) < b)).write.mode("append").parquet(path)
    return f"{max(width, 86400)} seconds"


def read_chunks(spark, path: str, schema) -> DataFrame:
    """The stream of a staged table in about ``CHUNKS`` batches: a chunk has a
    file for each task that wrote to it, more in a larger table, and a batch
    takes as many files as a chunk has on average."""
    files = len(spark.read.schema(schema).parquet(path).inputFiles())
    return sp.read_stream(spark, path, schema, max_files_per_trigger=max(1, -(-files // CHUNKS)))


def _with_time(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", F.timestamp_seconds("ts"))


@register("stream_success", with_views(f"""
WITH {q_online._HIT_SQL.format(h=q_online.DAY).strip()}
SELECT r.request_id, CASE WHEN h.first_hit IS NOT NULL THEN 1 ELSE 0 END AS success
FROM responses r LEFT JOIN hit h ON r.request_id = h.request_id""", "resp_items", "watches"), ids=("STR4", "JON10"))
def q_stream_success(spark, sf):
    run = _run_dir(spark, "success")
    resp = td.responses(spark, sf)
    wat = td.watches(spark, sf)
    delay = max(stage_chunks(resp, f"{run}/in/responses"), stage_chunks(wat, f"{run}/in/watches"),
                key=lambda d: int(d.split()[0]))
    r = _with_time(read_chunks(spark, f"{run}/in/responses", resp.schema))
    w = _with_time(read_chunks(spark, f"{run}/in/watches", wat.schema))
    out = sp.success_stream(r, w, q_online.DAY, delay)
    sp.run_available(out.writeStream.format("parquet").option("path", f"{run}/out")
                     .option("checkpointLocation", f"{run}/ckpt"))
    # hits are out at once; responses still waiting for one have none so far
    hits = spark.read.parquet(f"{run}/out").where("hit").select("request_id").distinct().withColumn("hit", F.lit(1))
    return resp.select("request_id").join(hits, "request_id", "left").select(
        "request_id", F.coalesce("hit", F.lit(0)).alias("success"))


@register("stream_success_at_k", PLANS["success_at_k"].oracle, ids=("STR4", "AGG8"))
def q_stream_success_at_k(spark, sf):
    """Success at k from one row per response."""
    run = _run_dir(spark, "first-hit")
    resp, wat = td.responses(spark, sf), td.watches(spark, sf)
    delay = max(stage_chunks(resp, f"{run}/in/responses"), stage_chunks(wat, f"{run}/in/watches"),
                key=lambda d: int(d.split()[0]))
    r = _with_time(read_chunks(spark, f"{run}/in/responses", resp.schema))
    w = _with_time(read_chunks(spark, f"{run}/in/watches", wat.schema))
    sp.run_available(sp.first_hit_stream(r, w, q_online.WEEK, delay).writeStream.format("parquet")
                     .option("path", f"{run}/out").option("checkpointLocation", f"{run}/ckpt"))
    known = spark.read.parquet(f"{run}/out").unionByName(sp.open_first_hits(spark, f"{run}/ckpt"))
    # responses that wait for their first match are in neither
    first = resp.select("request_id").join(known, "request_id", "left")
    ks = (5, 10, 20)
    one = first.agg(*online.success_at_k_cols(ks))
    return rounded(one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"success_at_{k}").alias("success_rate"))
                                                  for k in ks])).alias("r")).select("r.k", "r.success_rate"))


@register("stream_exposure", PLANS["top5_exposure_daily"].oracle, ids=("STR5", "AGG10"))
def q_stream_exposure(spark, sf):
    """The last share of each day, kept up to date by every batch."""
    run = _run_dir(spark, "exposure")
    wat = td.watches(spark, sf)
    delay = stage_chunks(wat, f"{run}/in")
    s = _with_time(read_chunks(spark, f"{run}/in", wat.schema))
    sp.run_available(sp.write_top_share(s, f"{run}/out", f"{run}/ckpt", delay))
    return rounded(sp.latest(spark.read.parquet(f"{run}/out/shares"), ("day",)))


@register("stream_request_rate", PLANS["request_rate"].oracle, ids=("STR6", "MON1"))
def q_stream_request_rate(spark, sf):
    return rounded(_window_stream(spark, sf)[0].drop("timed", "p95_s"))


@register("stream_latency", PLANS["latency_p95_windows"].oracle, ids=("STR6", "MON3"))
def q_stream_latency(spark, sf):
    """Latency windows of the live panes."""
    w = _window_stream(spark, sf)[0].where("timed > 0")
    return rounded(w.select("window_start", F.col("timed").alias("requests"), "p95_s"))


def _window_stream(spark, sf, by=()):
    """All windows: those that have closed, and what the stopped stream still
    holds of the others."""
    run = _run_dir(spark, "rate")
    log = td.request_log(spark, sf).drop("event_time").withColumn("service", F.expr(SERVICE))
    delay = stage_chunks(log, f"{run}/in")
    s = _with_time(read_chunks(spark, f"{run}/in", log.schema))
    sp.run_available(sp.window_stream(s, delay, by).writeStream.format("parquet").option("path", f"{run}/out")
                     .option("checkpointLocation", f"{run}/ckpt"))
    return spark.read.parquet(f"{run}/out").unionByName(sp.open_windows(spark, f"{run}/ckpt", by)), run


#: The log's requests belong to four services.
SERVICE = "concat('svc-', pmod(user_id, 4))"
add_view("mon_rate_svc", """
    SELECT 'svc-' || (user_id % 4) AS service, CAST(floor(epoch(ts) / 60) * 60 - 60 * k AS BIGINT) AS window_start,
           avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS error_rate
    FROM events CROSS JOIN (SELECT unnest(range(0, 5)) AS k) g GROUP BY ALL""")


@register("stream_alert", with_views("""
WITH f AS (SELECT service, window_start FROM mon_rate_svc WHERE error_rate > 0.05),
isl AS (SELECT *, floor(window_start / 60) - row_number() OVER (PARTITION BY service ORDER BY window_start) AS g FROM f),
r AS (SELECT service, min(window_start) AS run_start, max(window_start) AS run_end FROM isl GROUP BY service, g)
SELECT service, run_start, run_start + 600 AS fired_at FROM r WHERE run_end - run_start >= 600""", "mon_rate_svc"),
    ids=("STR7", "MON2"))
def q_stream_alert(spark, sf):
    """Alerts for each service: those the stream has fired, and those in the
    windows that still wait for the watermark when the input ends."""
    w, run = _window_stream(spark, sf, by=("service",))
    flagged = materialize(w.where(F.col("error_rate") > 0.05).select("service", "window_start"), "flagged")
    return alerts_of(spark, flagged, run, ts="window_start")


def alerts_of(spark, flagged, run: str, ts: str):
    """Flagged windows fed in chunks of the column ``ts``, a chunk a batch."""
    delay = stage_chunks(flagged, f"{run}/flagged", ts=ts)
    s = read_chunks(spark, f"{run}/flagged", flagged.schema)
    alerts = sp.alert_stream(s, delay=f"{2 * int(delay.split()[0])} seconds")
    sp.run_available(alerts.writeStream.format("parquet").option("path", f"{run}/alerts")
                     .option("checkpointLocation", f"{run}/ckpt-alerts"))
    fired = spark.read.schema(sp.ALERT_OUT).parquet(f"{run}/alerts")
    return fired.unionByName(sp.open_alerts(spark, f"{run}/ckpt-alerts")).select("service", "run_start", "fired_at")


add_view("topic_log", """
    SELECT watch_id, CAST(user_id % 6 AS INTEGER) AS _kafka_partition,
           row_number() OVER (PARTITION BY user_id % 6 ORDER BY ts, watch_id) - 1 AS _kafka_offset FROM watches""", ("watches",))


def _dedup(spark, sf):
    """The topic log delivered in chunks, then every tenth message again."""
    run = _run_dir(spark, "dedup")
    log = materialize(td.topic_log(spark, sf), "topic-log")
    # the last messages of a chunk come first, so offsets arrive out of order
    late = F.col("ts") - F.when(F.col("watch_id") % 3 == 0, 2 * 86400).otherwise(0)
    stage_chunks(log.withColumn("at", late), f"{run}/in", ts="at")
    log.where(F.col("watch_id") % 10 == 0).withColumn("at", F.col("ts")).write.mode("append").parquet(f"{run}/in")
    s = read_chunks(spark, f"{run}/in", log.withColumn("at", late).schema).drop("at")
    sp.run_available(sp.dedupe_stream(s).writeStream.format("parquet").option("path", f"{run}/out")
                     .option("checkpointLocation", f"{run}/ckpt"))
    return run


@register("stream_dedup", with_views("SELECT watch_id, _kafka_partition, _kafka_offset FROM topic_log", "topic_log"),
          ids=("STR3", "SRC7"))
def q_stream_dedup(spark, sf):
    return spark.read.parquet(f"{_dedup(spark, sf)}/out").select("watch_id", "_kafka_partition", "_kafka_offset")


@register("stream_dedup_state", with_views("""
SELECT _kafka_partition, CAST(1 AS INTEGER) AS ranges, max(_kafka_offset) + 1 AS upto FROM topic_log GROUP BY _kafka_partition""",
    "topic_log"), ids=("STR3",))
def q_stream_dedup_state(spark, sf):
    """What the stream keeps: one range of offsets for each partition."""
    held = sp.open_state(spark, f"{_dedup(spark, sf)}/ckpt", "applyInPandasWithState")[0]
    ranges = F.col("value.groupState")
    return held.select("key._kafka_partition", F.size(ranges["starts"]).alias("ranges"), F.array_max(ranges["ends"]).alias("upto"))


def _topic(spark, sf):
    """The topic log as segments, the first half and then the rest."""
    path = f"{_run_dir(spark, 'topic')}/segments"
    log = materialize(td.topic_log(spark, sf).withColumn("dt", F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd")), "topic-log")
    middle = log.agg(F.avg("ts")).first()[0]
    return path, log, [log.where(F.col("ts") < middle), log.where(F.col("ts") >= middle)]


_TOPIC = "watch_id long, _kafka_partition int, _kafka_offset long"


@register("stream_topic", with_views("SELECT watch_id, _kafka_partition, _kafka_offset FROM topic_log", "topic_log"), ids=("SRC6", "STR3"))
def q_stream_topic(spark, sf):
    """A stream by offsets that stops after the first half of the topic and
    goes on from its checkpoint when the rest is there."""
    path, log, halves = _topic(spark, sf)
    out = f"{path.removesuffix('/segments')}/out"
    for part in halves:
        segments.write_segments(part, path, size=1000)
        s = segments.read_topic(spark, path, _TOPIC, stream=True)
        sp.run_available(s.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/ckpt"))
    return spark.read.schema(_TOPIC).parquet(f"{out}/rows")


@register("topic_bounds", with_views("""
SELECT watch_id, _kafka_partition, _kafka_offset FROM topic_log
WHERE _kafka_offset >= 2 * _kafka_partition AND _kafka_offset < 10 + 5 * _kafka_partition""", "topic_log"), ids=("SRC5", "SRC6"))
def q_topic_bounds(spark, sf):
    """A batch between given offsets of each partition."""
    path, log, _ = _topic(spark, sf)
    segments.write_segments(log, path, size=1000)
    return segments.read_topic(spark, path, _TOPIC, startingOffsets=json.dumps({p: 2 * p for p in range(6)}),
                               endingOffsets=json.dumps({p: 10 + 5 * p for p in range(6)}))


@register("stream_ingest", with_views("SELECT watch_id, watch_id % 10 <> 1 AS ok FROM watches", "watches"),
          ids=("STR1", "STR2", "SRC6", "SNK1", "VAL3"))
def q_stream_ingest(spark, sf):
    run = _run_dir(spark, "ingest")
    msgs = q_io._watch_messages(spark, sf).join(td.watches(spark, sf).select("watch_id", "ts"), "watch_id")
    stage_chunks(msgs, f"{run}/in")
    s = read_chunks(spark, f"{run}/in", msgs.schema)
    s = s.withColumn("date", F.to_date(F.timestamp_seconds("ts")))
    sp.run_available(sp.ingest(s, f"{run}/out", f"{run}/ckpt", key="watch_id", date_col="date"))
    good = spark.read.parquet(f"{run}/out/good/parquet").select("watch_id", F.lit(True).alias("ok"))
    bad = spark.read.parquet(f"{run}/out/quarantine").select("watch_id", F.lit(False).alias("ok"))
    return good.unionByName(bad)
