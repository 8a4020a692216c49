"""Streams batch by batch, and their state."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF001
from reelsight.operators import exposure, monitoring, online
from reelsight.plans import q_stream
from reelsight.sources import testdata as td
from reelsight.streaming import pipelines as sp


def test_ranges_of_offsets():
    rng = np.random.default_rng(2)
    starts = ends = np.empty(0, np.int64)
    left = rng.permutation(500)
    held = set()
    while len(left):
        n = int(rng.integers(1, 40))
        new, left = np.sort(left[:n]), left[n:]
        starts, ends = sp.add_offsets(starts, ends, new)
        held |= set(new.tolist())
        assert [x for a, b in zip(starts, ends) for x in range(a, b)] == sorted(held)
        assert all(a > b for a, b in zip(starts[1:], ends[:-1]))  # ranges that touch are one
    assert list(starts) == [0] and list(ends) == [500]
    assert [len(x) for x in sp.add_offsets(starts, ends, np.empty(0, np.int64))] == [1, 1]


def test_share_after_each_batch(spark, tmp_path):
    wat = q_stream._with_time(td.watches(spark, SF001))
    files = str(tmp_path / "in")
    wat.repartition(3).write.parquet(files)  # batches mix all times
    s = sp.read_stream(spark, files, wat.schema, max_files_per_trigger=1)
    sp.run_available(sp.write_top_share(s, str(tmp_path / "out"), str(tmp_path / "ckpt"), "60 days"))
    told = [r.asDict() for r in spark.read.parquet(str(tmp_path / "out/shares")).collect()]
    assert {r["batch_id"] for r in told} == {0, 1, 2}
    log = spark.read.json(str(tmp_path / "ckpt/sources/0/*")).where("path is not null").select("path", "batchId").collect()
    day = F.date_format("event_time", "yyyy-MM-dd")
    for n in range(3):
        sofar = spark.read.parquet(*[r["path"] for r in log if r["batchId"] <= n])
        want = {r["day"]: r.asDict() for r in exposure.top_share_exposure_daily(sofar, day).collect()}
        got = [r for r in told if r["batch_id"] == n]
        assert got and all({k: r[k] for k in want[r["day"]]} == want[r["day"]] for r in got)


def test_each_response_once(spark, tmp_path):
    resp, wat = td.responses(spark, SF001), td.watches(spark, SF001)
    delay = max(q_stream.stage_chunks(resp, str(tmp_path / "r")), q_stream.stage_chunks(wat, str(tmp_path / "w")),
                key=lambda d: int(d.split()[0]))
    r = q_stream._with_time(sp.read_stream(spark, str(tmp_path / "r"), resp.schema, max_files_per_trigger=1))
    w = q_stream._with_time(sp.read_stream(spark, str(tmp_path / "w"), wat.schema, max_files_per_trigger=1))
    sp.run_available(sp.first_hit_stream(r, w, 86400, delay).writeStream.format("parquet").option("path", str(tmp_path / "out"))
                     .option("checkpointLocation", str(tmp_path / "ckpt")))
    closed = {r["request_id"]: r["first_hit"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(closed)  # once
    open_ = {r["request_id"]: r["first_hit"] for r in sp.open_first_hits(spark, str(tmp_path / "ckpt")).collect()}
    assert closed and not set(closed) & set(open_)
    want = {r["request_id"]: r["first_hit"] for r in online.response_success(resp, wat, 86400).collect()}
    assert all(want[i] == h for i, h in {**closed, **open_}.items())
    assert all(h is None for i, h in want.items() if i not in closed and i not in open_)


def test_a_row_enters_one_pane(spark):
    log = td.request_log(spark, SF001)
    panes = log.groupBy(F.window("event_time", monitoring.SLIDE).alias("w")).agg(*monitoring.pane_counts())
    assert panes.agg(F.sum("requests")).first()[0] == log.count()
    assert panes.agg(F.sum(sum(F.col(c) for c in monitoring.PANE[2:]))).first()[0] == log.where("latency_ms is not null").count()


def test_alerts_of_late_windows(spark, tmp_path):
    """Windows in batches that hold the odd minutes of the span before."""
    rng = np.random.default_rng(8)
    rows = [(s, 60 * m) for s in ("a", "b") for m in range(1000, 21_000) if rng.random() < 0.9]
    flagged = spark.createDataFrame(rows, "service string, window_start long")
    late = flagged.withColumn("at", F.col("window_start") + F.when(F.col("window_start") % 120 == 60, 100_000).otherwise(0))
    got = {tuple(r) for r in q_stream.alerts_of(spark, late, str(tmp_path), "at").collect()}
    want = set()
    for s in ("a", "b"):
        mine = flagged.where(F.col("service") == s)
        want |= {(s, r["run_start"], r["fired_at"]) for r in monitoring.runs(mine).where("fires").collect()}
    assert got == want and want


def test_a_chunk_of_many_files_is_one_batch(spark, tmp_path):
    rows = spark.range(2000).select(F.concat(F.lit("svc-"), F.col("id") % 2).alias("service"), (F.col("id") * 60).alias("window_start"))
    got = {tuple(r) for r in q_stream.alerts_of(spark, rows.repartition(6), str(tmp_path), "window_start").collect()}
    assert len(list((tmp_path / "flagged").glob("*.parquet"))) > 3 * q_stream.CHUNKS
    assert len(list((tmp_path / "ckpt-alerts/commits").glob("[0-9]*"))) <= q_stream.CHUNKS + 2
    assert got == set()  # every second window of a service is missing: no run
