"""Recommendation-shaped views over the generated parquet tables.

The test tables are a TPC-H-like star schema plus an ``events`` log.  These
views give them the shapes the operators expect (interactions, responses,
watches, a service log, ...).  Each view is a lazy DataFrame: Catalyst prunes
the columns and pushes the filters of whatever query uses it into the
parquet scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsight.operators.common import global_rank
from reelsight.session import ensure_defaults

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Columns that give ``interactions`` a unique, engine-independent row order
# (``l_orderkey, l_linenumber`` alone are not unique in the test data).
INTERACTION_ORDER = ("l_orderkey", "l_linenumber", "item_id", "l_suppkey", "ts")

LIST_LEN = 20  # items per logged recommendation response


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_defaults(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def rated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items' part of :func:`interactions`: all but the user."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("item_id"), (F.col("l_quantity") / F.lit(10.0)).alias("rating"),
        F.unix_timestamp("l_shipdate").alias("ts"), "l_orderkey", "l_linenumber", "l_suppkey")


def order_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, user_id): the orders' part of :func:`interactions`."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                                 F.col("o_custkey").alias("user_id"))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id, rating, ts) from lineitem joined to its order."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .select(F.col("o_custkey").alias("user_id"),
                      F.col("l_partkey").alias("item_id"),
                      (F.col("l_quantity") / F.lit(10.0)).alias("rating"),
                      F.unix_timestamp("l_shipdate").alias("ts"),
                      "l_orderkey", "l_linenumber", "l_suppkey"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _k_of(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logged recommendation responses: ``view`` events, a 20-item list each."""
    e = _events(spark, sf_dir).filter(F.col("event_type") == "view")
    k0 = _k_of()
    return e.select(F.col("event_id").alias("request_id"), "user_id",
                    F.unix_timestamp("ts").alias("ts"),
                    F.col("value").alias("latency_ms"),
                    F.sequence(k0, k0 + F.lit(LIST_LEN - 1)).alias("movie_ids"))


def watches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watch events: ``click`` events, the item is ``props.k``."""
    e = _events(spark, sf_dir).filter(F.col("event_type") == "click")
    return e.select(F.col("event_id").alias("watch_id"), "user_id",
                    F.unix_timestamp("ts").alias("ts"),
                    _k_of().alias("movie_id"))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service log: every event is a request; ``error`` events are HTTP 500."""
    e = _events(spark, sf_dir)
    return e.select(F.col("event_id").alias("request_id"), "user_id",
                    F.unix_timestamp("ts").alias("ts"),
                    F.col("ts").cast("timestamp").alias("event_time"),
                    F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status"),
                    F.col("value").alias("latency_ms"),
                    "event_type")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions as untyped text with bad ratings and missing times."""
    i = interactions(spark, sf_dir)
    return i.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("item_id").cast("string").alias("item_id"),
        F.when(F.col("l_linenumber") == 7, F.lit("bad"))
         .otherwise(F.col("rating").cast("string")).alias("rating"),
        F.when(F.pmod(F.col("l_suppkey"), F.lit(50)) == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("ts")).alias("timestamp"),
        *INTERACTION_ORDER[:2], "l_suppkey", F.col("item_id").alias("item_key"), F.col("ts").alias("ts_key"))


def raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watch events as JSON lines (``value`` text): every 5th wrapped in
    ``payload``, every 10th truncated to malformed; ``ts`` in epoch ms."""
    w = watches(spark, sf_dir)
    body = F.concat(F.lit('{"user_id": '), F.col("user_id").cast("string"),
                    F.lit(', "movie_id": '), F.col("movie_id").cast("string"),
                    F.lit(', "ts": '), (F.col("ts") * 1000).cast("string"), F.lit("}"))
    wrapped = F.when(F.pmod(F.col("watch_id"), F.lit(5)) == 0,
                     F.concat(F.lit('{"payload": '), body, F.lit("}"))).otherwise(body)
    value = F.when(F.pmod(F.col("watch_id"), F.lit(10)) == 3,
                   F.substring(wrapped, 1, 12)).otherwise(wrapped)
    return w.select("watch_id", value.alias("value"))


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event bytes: even ids framed (magic 0, 4-byte schema id, body)."""
    e = _events(spark, sf_dir)
    body = F.encode(F.col("props"), "UTF-8")
    framed = F.concat(F.unhex(F.lit("00")),
                      F.unhex(F.lpad(F.hex(F.pmod(F.col("event_id"), F.lit(7))), 8, "0")), body)
    return e.select("event_id", "event_type",
                    F.when(F.pmod(F.col("event_id"), F.lit(2)) == 0, framed).otherwise(body).alias("value"))


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watches with topic coordinates, every 10th message delivered twice."""
    w = watches(spark, sf_dir).select(
        "watch_id", "user_id", "movie_id", "ts",
        F.lit("watch").alias("_kafka_topic"),
        F.pmod(F.col("user_id"), F.lit(6)).cast("int").alias("_kafka_partition"),
        F.col("watch_id").alias("_kafka_offset"))
    return w.unionByName(w.filter(F.pmod(F.col("watch_id"), F.lit(10)) == 0))


def topic_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watches as six topic partitions hold them: offsets from 0 without a
    gap in each, in the order of time."""
    w = watches(spark, sf_dir).select(
        "watch_id", "user_id", "movie_id", "ts", F.lit("watch").alias("_kafka_topic"),
        F.pmod(F.col("user_id"), F.lit(6)).cast("int").alias("_kafka_partition"))
    r = global_rank(w, [F.col("_kafka_partition"), F.col("ts"), F.col("watch_id")], "_r")
    first = r.groupBy("_kafka_partition").agg(F.min("_r").alias("_first"))
    return r.join(first, "_kafka_partition").withColumn("_kafka_offset", F.col("_r") - F.col("_first")).drop("_r", "_first")


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("item"), F.col("embedding").alias("features"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary labels with a score: document quality vs. document length."""
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(docs, "doc_id").select(
        "doc_id", F.col("quality").alias("y_true"), F.col("n_chars").cast("double").alias("y_score"))
