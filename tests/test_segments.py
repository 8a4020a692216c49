"""A topic kept as segments: bounds, and a stream that stops and goes on."""

import json

from pyspark.sql import functions as F

from reelsight.sources import segments as sg
from reelsight.streaming import pipelines as sp

SCHEMA = "dt string, _kafka_topic string, _kafka_partition int, _kafka_offset long, value string"


def messages(spark, lo, hi, partitions=3):
    rows = [(f"2024-01-{1 + o // 40:02d}", "watch", p, o, f"m{p}-{o}") for p in range(partitions) for o in range(lo, hi - 10 * p)]
    return spark.createDataFrame(rows, SCHEMA)


def keys(df):
    return sorted((r["_kafka_partition"], r["_kafka_offset"], r["value"], r["dt"]) for r in df.collect())


def test_bounds_of_a_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    all_ = messages(spark, 0, 100)
    sg.write_segments(all_, path, size=16)
    assert keys(sg.read_topic(spark, path, SCHEMA)) == keys(all_)
    got = sg.read_topic(spark, path, SCHEMA, startingOffsets=json.dumps({"0": 20, "1": 89}), endingOffsets=json.dumps({"0": 33, "2": 5}))
    want = all_.where("(_kafka_partition = 0 and _kafka_offset between 20 and 32) or (_kafka_partition = 1 and _kafka_offset >= 89) "
                      "or (_kafka_partition = 2 and _kafka_offset < 5)")
    assert keys(got) == keys(want)
    some = sg.read_topic(spark, path, "value string, _kafka_offset long")  # other columns, another order
    assert some.columns == ["value", "_kafka_offset"] and some.count() == all_.count()
    assert sg.read_topic(spark, str(tmp_path / "none"), SCHEMA).count() == 0


def run(spark, path, out, **options):
    s = sg.read_topic(spark, path, SCHEMA, stream=True, **options)
    return sp.run_available(s.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/ckpt"))


def test_a_stopped_stream_goes_on(spark, tmp_path):
    path, out = str(tmp_path / "t"), str(tmp_path / "out")
    sg.write_segments(messages(spark, 0, 60), path, size=16)
    run(spark, path, out)
    assert keys(spark.read.schema(SCHEMA).parquet(f"{out}/rows")) == keys(messages(spark, 0, 60))
    run(spark, path, out)  # nothing new
    more = messages(spark, 60, 130).unionByName(messages(spark, 50, 60).where("_kafka_partition = 1")).unionByName(
        messages(spark, 40, 60).where("_kafka_partition = 2"))
    have = messages(spark, 0, 60)
    new = more.join(have, ["_kafka_partition", "_kafka_offset"], "left_anti").select(*have.columns)
    sg.write_segments(new, path, size=16)  # further files in open segments, and new ones
    run(spark, path, out)
    got = keys(spark.read.schema(SCHEMA).parquet(f"{out}/rows"))
    assert got == keys(have.unionByName(new)) and len(set(got)) == len(got)


def test_a_stream_from_given_offsets(spark, tmp_path):
    path, out = str(tmp_path / "t"), str(tmp_path / "out")
    sg.write_segments(messages(spark, 0, 60), path, size=16)
    run(spark, path, out, startingOffsets=json.dumps({"0": 55, "1": 40, "2": 1000}))
    got = spark.read.schema(SCHEMA).parquet(f"{out}/rows")
    assert [(r["_kafka_partition"], r["n"]) for r in got.groupBy("_kafka_partition").agg(F.count("*").alias("n")).orderBy(
        "_kafka_partition").collect()] == [(0, 5), (1, 10)]
