"""Structured Streaming versions of the operators (STR1-STR7).

Sources are any streaming DataFrame (Kafka where the connector is present,
files otherwise); sinks are exactly-once file sinks or ``foreachBatch``.
Every stateful step has a watermark so its state stays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from reelsight.operators import monitoring
from reelsight.sources import sinks, wire


def read_stream(spark, path: str, schema: T.StructType | str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """File stream with an explicit schema; ``max_files_per_trigger`` is the
    rate limit (STR2; ``maxOffsetsPerTrigger`` for Kafka)."""
    r = spark.readStream.schema(schema).format(fmt).options(**options)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def kafka_stream(spark, servers: str, topics: str, starting: str = "earliest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Topic subscription from the earliest offset (SRC6); the checkpoint of
    the query that consumes it records progress (commit after processing)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topics).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(F.col("topic"), F.col("partition").alias("_kafka_partition"),
                           F.col("offset").alias("_kafka_offset"), F.col("timestamp").alias("_kafka_ts"),
                           F.col("key"), F.col("value"))


def run_available(stream_writer):
    """Process everything available now, however long it takes; an error of
    the query is raised here."""
    q = stream_writer.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def latest(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last change of each key, open windows included."""
    cols = [c for c in changes.columns if c not in (*keys, "batch_id")]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*cols), "batch_id").alias("_r"))
    return last.select(*keys, "_r.*")


def ingest(messages: DataFrame, out_dir: str, checkpoint: str, key: str | None = None,
           date_col: str | None = None):
    """Ingest -> decode/validate -> good and quarantine sinks (STR1).

    Each micro-batch writes good messages partitioned by topic and date
    (SNK1) and quarantined ones with their errors; both are also partitioned
    by the batch id and written with dynamic partition overwrite, so a
    replayed batch replaces its own output instead of duplicating it.
    ``date_col`` names the event's date: with it a replay meets its own
    folder also on a later day; without it the date is that of processing,
    and replays are only safe within a day."""
    parsed = wire.parse_events(messages, key=key)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("batch_id", F.lit(batch_id)).persist()
        date = F.col(date_col) if date_col else None
        good = batch.where("ok").drop("errors", "value")
        bad = batch.where(~F.col("ok")).drop("value")
        sinks.write_batch(good, f"{out_dir}/good", "events", ("parquet",), date=date, mode="overwrite",
                          extra_partitions=("batch_id",))
        (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").parquet(f"{out_dir}/quarantine"))
        batch.unpersist()

    return parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


RANGES = T.StructType([T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType()))])


def add_offsets(starts, ends, offsets):
    """The disjoint ranges [start, end) in order, with some new offsets;
    ranges that touch become one."""
    import numpy as np

    lo = np.concatenate([starts, offsets])
    hi = np.concatenate([ends, offsets + 1])
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], hi[order]
    first = np.ones(len(lo), bool)
    first[1:] = lo[1:] != hi[:-1]
    return lo[first], hi[np.append(first[1:], True)] if len(hi) else hi


def _first_deliveries(offset: str):
    def fn(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import numpy as np

        starts, ends = (np.array(x, dtype=np.int64) for x in (state.get if state.exists else ([], [])))
        for b in batches:
            at = b[offset].to_numpy(dtype=np.int64)
            i = np.searchsorted(starts, at, "right") - 1
            known = (i >= 0) & (at < ends[i]) if len(starts) else np.zeros(len(at), bool)
            new = ~known & ~b[offset].duplicated().to_numpy()
            starts, ends = add_offsets(starts, ends, np.sort(at[new]))
            if new.any():
                yield b[new]
        state.update((starts.tolist(), ends.tolist()))
    return fn


def dedupe_stream(events: DataFrame, keys: Sequence[str] = ("_kafka_topic", "_kafka_partition"),
                  offset: str = "_kafka_offset") -> DataFrame:
    """Replay-safe ingest (STR3): the first delivery of each topic coordinate,
    however late a replay comes.

    The state of a topic partition is the set of offsets delivered so far, as
    ranges: one range for offsets without a gap, two more numbers for each gap.
    So state grows with partitions and gaps, not with messages, and needs no
    watermark.  A partition's messages of a batch are one group, as they are
    one sequence in the topic.  Messages without an offset are left out."""
    return (events.where(F.col(offset).isNotNull()).groupBy(*keys)
                  .applyInPandasWithState(_first_deliveries(offset), events.schema, RANGES, "append", GroupStateTimeout.NoTimeout))


def open_state(spark, checkpoint: str, operator: str) -> list[DataFrame]:
    """(key, value) of what a stopped query still holds, one table for each
    stateful operator of that name: the groups whose time has not passed."""
    ops = spark.read.format("state-metadata").load(checkpoint).where(F.col("operatorName") == operator)
    ids = sorted(r["operatorId"] for r in ops.select("operatorId").distinct().collect())  # the operators of one query
    return [spark.read.format("statestore").option("operatorId", i).load(checkpoint).select("key", "value") for i in ids]


def success_stream(responses: DataFrame, watches: DataFrame, horizon_s: int, delay: str = "1 day") -> DataFrame:
    """Live response -> watch matches (STR4): stream-stream left outer join on
    (user, item) with the time range in the join condition.  Output: rows
    (request_id, event_time, pos, hit) for each list position.  Unmatched rows
    are emitted once the watermark passes ``t + horizon``."""
    r = (responses.select("request_id", F.col("user_id").alias("r_user"), "event_time",
                          F.posexplode("movie_ids").alias("pos", "r_movie"))
                  .withWatermark("event_time", delay))
    w = (watches.select(F.col("user_id").alias("w_user"), F.col("movie_id").alias("w_movie"),
                        F.col("event_time").alias("w_time"), "watch_id")
                .withWatermark("w_time", delay))
    cond = ((F.col("r_user") == F.col("w_user")) & (F.col("r_movie") == F.col("w_movie"))
            & (F.col("w_time") >= F.col("event_time"))
            & (F.col("w_time") <= F.col("event_time") + F.expr(f"INTERVAL {int(horizon_s)} SECONDS")))
    return (r.join(w, cond, "leftOuter")
             .select("request_id", "event_time", "pos", F.col("watch_id").isNotNull().alias("hit")))


def first_hit_stream(responses: DataFrame, watches: DataFrame, horizon_s: int, delay: str = "1 day") -> DataFrame:
    """(request_id, first_hit): one row per response, emitted once, when its
    horizon has passed (STR4, AGG8); ``first_hit`` is the first list position
    (from 1) that was watched, null if none.

    The matches of a response are a group of its own second; the group closes
    with the watermark behind the join."""
    rows = success_stream(responses, watches, horizon_s, delay)
    own = rows.groupBy(F.window("event_time", "1 second").alias("w"), "request_id")
    return own.agg(F.min(F.when(F.col("hit"), F.col("pos") + 1)).alias("first_hit")).select("request_id", "first_hit")


def open_first_hits(spark, checkpoint: str) -> DataFrame:
    """(request_id, first_hit) of the responses whose horizon was still open
    when the query stopped and that have a match or an expired position."""
    held = open_state(spark, checkpoint, "stateStoreSave")[0]
    return held.select("key.request_id", F.col("value").cast("struct<first_hit:int>")["first_hit"].alias("first_hit"))


def exposure_stream(watches: DataFrame, delay: str = "1 day") -> DataFrame:
    """Daily watch counts per item (STR5)."""
    return (watches.withWatermark("event_time", delay)
                   .groupBy(F.window("event_time", "1 day").alias("w"), "movie_id")
                   .agg(F.count(F.lit(1)).alias("watches"))
                   .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "movie_id", "watches"))


def _write_part(df: DataFrame, path: str, batch_id: int, by: Sequence[str] = ()) -> None:
    """The part of one batch; a replayed batch replaces its own."""
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*by, "batch_id").parquet(path))


def _parts_before(spark, path: str, batch_id: int, schema: str) -> DataFrame:
    """The parts of earlier batches; none before the first."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], f"{schema}, batch_id int")
    return spark.read.schema(f"{schema}, batch_id int").parquet(path).where(F.col("batch_id") < batch_id)


def top_share(levels: DataFrame, share: float = 0.05) -> DataFrame:
    """Top-share exposure of each day from (day, level, n): n items were
    watched ``level`` times.  The levels of a day are far fewer than its
    items; the most watched items are read off without ranking any."""
    w = Window.partitionBy("day")
    before = F.coalesce(F.sum("n").over(w.orderBy(F.col("level").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = F.greatest(F.lit(1), F.floor(F.sum("n").over(w) * F.lit(share)))
    taken = F.greatest(F.lit(0), F.least(F.col("n"), wanted - before))
    return (levels.where("n > 0").withColumn("top", F.col("level") * taken).groupBy("day")
                  .agg(F.sum(F.col("level") * F.col("n")).cast("long").alias("total_watches"), F.sum("n").cast("long").alias("distinct_items"),
                       F.sum("top").cast("long").alias("top_watches"))
                  .withColumn("exposure", F.col("top_watches") / F.col("total_watches")))


def write_top_share(watches: DataFrame, out_dir: str, checkpoint: str, delay: str = "1 day", share: float = 0.05):
    """Live top-share exposure (STR5): after each batch, the share of every
    day it touched, under ``out_dir/shares``.

    Three tables grow by one part for each batch, and a replayed batch
    replaces its own: the new count of every item that changed (``counts``),
    the change in how many items of a day have a count (``levels``: plus one at
    the new count, minus one at the old), and the shares, read off the levels
    of the touched days."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.where(F.col("movie_id").isNotNull()).persist()
        old = _parts_before(spark, f"{out_dir}/counts", batch_id, "day string, movie_id long, watches long").join(
            new.select("day", "movie_id"), ["day", "movie_id"], "left_semi").groupBy("day", "movie_id").agg(
            F.max_by("watches", "batch_id").alias("watches"))
        moves = new.select("day", F.col("watches").alias("level"), F.lit(1).cast("long").alias("n")).unionByName(
            old.select("day", F.col("watches").alias("level"), F.lit(-1).cast("long").alias("n")))
        moves = moves.groupBy("day", "level").agg(F.sum("n").alias("n")).where("n <> 0").persist()
        touched = new.select("day").distinct()
        past = _parts_before(spark, f"{out_dir}/levels", batch_id, "day string, level long, n long")
        levels = (past.select("day", "level", "n").unionByName(moves).join(touched, "day", "left_semi")
                      .groupBy("day", "level").agg(F.sum("n").alias("n")))
        _write_part(top_share(levels, share), f"{out_dir}/shares", batch_id)
        _write_part(moves, f"{out_dir}/levels", batch_id, ("day",))
        _write_part(new, f"{out_dir}/counts", batch_id, ("day",))
        moves.unpersist()
        new.unpersist()

    return (exposure_stream(watches, delay).writeStream.outputMode("update").foreachBatch(write)
                .option("checkpointLocation", checkpoint))


def pane_stream(log: DataFrame, delay: str = "10 minutes", by: Sequence[str] = ()) -> DataFrame:
    """Requests, errors and latency bucket counts for each slide: every row
    enters one pane."""
    t = log.withWatermark("event_time", delay)
    return t.groupBy(F.window("event_time", monitoring.SLIDE).alias("w"), *by).agg(*monitoring.pane_counts())


def window_stream(log: DataFrame, delay: str = "10 minutes", by: Sequence[str] = ()) -> DataFrame:
    """Live sliding windows (STR6): requests, errors, rates and the histogram
    p95 of the latencies, for each value of ``by``; emitted when the watermark
    passes the window, late rows dropped.

    Two aggregates in a chain: rows into panes, and closed panes into the
    windows that hold them, so only a pane's one row is repeated."""
    panes = pane_stream(log, delay, by)
    sums = [F.sum(c).alias(c) for c in monitoring.PANE]
    return monitoring.window_stats(panes.groupBy(F.window("w", monitoring.WINDOW, monitoring.SLIDE).alias("v"), *by).agg(*sums), "v", by)


def open_windows(spark, checkpoint: str, by: Sequence[str] = ()) -> DataFrame:
    """The windows of :func:`window_stream` that were still open when the
    query stopped, with what had come by then: the sums of their closed panes
    and the panes that are open themselves."""
    kind = "struct<" + ", ".join(f"{c}:bigint" for c in monitoring.PANE) + ">"
    parts = None
    for held in open_state(spark, checkpoint, "stateStoreSave"):
        times = held.select(F.col("key").cast("struct<w:struct<start:timestamp,end:timestamp>" + "".join(
            f", {c}:string" for c in by) + ">").alias("k"), F.col("value").cast(kind).alias("v"))
        rows = times.select("k.w", *[f"k.{c}" for c in by], "v.*")
        parts = rows if parts is None else parts.unionByName(rows)
    seconds = F.unix_timestamp("w.end") - F.unix_timestamp("w.start")
    closed = parts.where(seconds > 60)
    panes = parts.where(seconds == 60).withColumn("t", F.col("w.start")).drop("w")
    spread = panes.select(F.window("t", monitoring.WINDOW, monitoring.SLIDE).alias("w"), *by, *monitoring.PANE)
    every = closed.select(F.struct("w.start", "w.end").alias("w"), *by, *monitoring.PANE).unionByName(
        spread.withColumn("w", F.struct("w.start", "w.end")))
    return monitoring.window_stats(every.groupBy("w", *by).agg(*[F.sum(c).alias(c) for c in monitoring.PANE]), "w", by)


ALERT_STATE = T.StructType([T.StructField("pending", T.ArrayType(T.LongType())), T.StructField("run_start", T.LongType()),
                            T.StructField("last", T.LongType()), T.StructField("fired", T.BooleanType())])
ALERT_OUT = T.StructType([T.StructField("service", T.StringType()), T.StructField("run_start", T.LongType()),
                          T.StructField("fired_at", T.LongType())])


def _follow(windows: list[int], run_start: int | None, last: int | None, fired: bool, step_s: int, for_s: int):
    """Runs over further windows in time order: (run_start, last, fired)
    after them, and the (run_start, fired_at) of alerts on the way."""
    out = []
    for t in windows:
        if last is not None and t <= last:
            continue
        if last is None or t != last + step_s:
            run_start, fired = t, False
        last = t
        if not fired and t - run_start >= for_s:
            out.append((run_start, run_start + for_s))
            fired = True
    return (run_start, last, fired), out


def _track_runs(step_s: int, for_s: int):
    def fn(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pending, *run = state.get if state.exists else ([], None, None, False)
        waiting = set(pending or ())
        for b in batches:
            waiting.update(int(x) for x in b["window_start"])
        done = state.getCurrentWatermarkMs() // 1000  # no earlier window can come any more
        run, out = _follow(sorted(x for x in waiting if x < done), *run, step_s, for_s)
        rest = sorted(x for x in waiting if x >= done)
        state.update((rest, *run))
        if rest:  # come back when the watermark has passed the first of them
            state.setTimeoutTimestamp(max(rest[0] * 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame([(key[0], *x) for x in out], columns=["service", "run_start", "fired_at"])
    return fn


def open_alerts(spark, checkpoint: str, step_s: int = 60, for_s: int = monitoring.FOR_S) -> DataFrame:
    """The alerts in the windows that still wait for the watermark in the
    state of a stopped :func:`alert_stream`, one small row for each service."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            none = lambda x: None if pd.isna(x) else int(x)
            rows = [(r.service, *x) for r in b.itertuples()
                    for x in _follow(sorted(r.pending), none(r.run_start), none(r.last), bool(r.fired), step_s, for_s)[1]]
            yield pd.DataFrame(rows, columns=["service", "run_start", "fired_at"])

    held = open_state(spark, checkpoint, "applyInPandasWithState")[0]
    return held.select("key.service", "value.groupState.*").mapInPandas(run, ALERT_OUT)


def alert_stream(flagged_windows: DataFrame, service: str = "service", step_s: int = 60,
                 for_s: int = monitoring.FOR_S, delay: str = "10 minutes") -> DataFrame:
    """Sustained-condition alert (STR7): for each value of the ``service``
    column, runs of consecutive flagged evaluation windows; an alert is
    emitted once when a run reaches ``for_s``.

    Windows may arrive in any order and in any batches: they wait in the
    state until the watermark (``delay`` behind the latest window) has passed
    them, and are then followed in time order.  The state of a service is its
    windows within the delay and three numbers."""
    timed = flagged_windows.withColumn("_t", F.timestamp_seconds("window_start")).withWatermark("_t", delay)
    return (timed.select(F.col(service).alias("service"), "window_start", "_t")
            .groupBy("service")
            .applyInPandasWithState(_track_runs(step_s, for_s), ALERT_OUT, ALERT_STATE, "append",
                                    GroupStateTimeout.EventTimeTimeout))
