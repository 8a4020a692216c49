"""Replays in a stream whose chunks come as several files."""

from conftest import SF001

from reelsight.plans import PLANS
from reelsight.sources import testdata as td


def test_every_watch_comes_back_once(spark):
    want = sorted(r.watch_id for r in td.watches(spark, SF001).select("watch_id").collect())
    keys = {"spark.sql.shuffle.partitions": "4", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        got = [r.watch_id for r in PLANS["stream_dedup"].fn(spark, SF001).select("watch_id").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(got) == want
