"""Source, sink, decode/validation and scalar-expression plans (SRC1-9,
SNK1-3, VAL1-8, PRJ7-11).

File-based plans first write a derived copy of a test table in the layout
the reader expects (CSV with odd headers, ``::`` text, JSON lines, a
partitioned folder) under the session's shared checkpoint folder, then read
it back with the operator under test.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsight.functions.exprs import coerce_ts, floor_minute, items_text, parse_movie_ids
from reelsight.operators import clean, online, quality
from reelsight.plans.oracle_views import with_views
from reelsight.plans.registry import register, rounded
from reelsight.session import scratch_path
from reelsight.sources import readers, sinks, testdata as td, wire
from reelsight.sources.schemas import RATE_EVENT, WATCH_EVENT


def _scratch(spark, sf, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


# ---------------------------------------------------------------- sources --

@register("src_ratings", with_views("""
SELECT user_id, item_id, rating, ts AS "timestamp" FROM interactions""", "interactions"), ids=("SRC1", "SRC9", "VAL8"))
def q_src_ratings(spark, sf):
    path = _scratch(spark, sf, "ratings-csv")
    i = td.interactions(spark, sf)
    (i.select(F.col("user_id").alias("UserId"), F.col("item_id").alias("movieId"), F.col("rating").alias("Rating"),
              F.col("ts").alias("TIMESTAMP"))
      .write.mode("overwrite").option("header", True).csv(path))
    return readers.read_ratings_csv(spark, path)


@register("src_events", with_views("""
SELECT user_id, item_id, rating, ts AS "timestamp" FROM interactions""", "interactions"), ids=("SRC2",))
def q_src_events(spark, sf):
    i = td.interactions(spark, sf)
    text = F.to_json(F.struct(F.col("user_id").alias("userId"), F.col("item_id").alias("movieId"),
                              F.col("rating").alias("rating"), F.col("ts").alias("timestamp")))
    batch = i.select(text.alias("value")).select(
        F.from_json("value", "userId bigint, movieId bigint, rating double, timestamp bigint").alias("e")).select("e.*")
    return readers.events_to_interactions(batch)


@register("union_by_name", with_views("""
SELECT user_id, item_id, CASE WHEN l_linenumber % 5 IN (0, 1, 3) THEN rating END AS rating,
       CASE WHEN l_linenumber % 5 IN (1, 2, 4) THEN ts END AS ts,
       CASE WHEN l_linenumber % 5 = 4 THEN l_linenumber END AS line
FROM interactions""", "interactions"), ids=("SRC3", "JON14"))
def q_union_by_name(spark, sf):
    base = _scratch(spark, sf, "mixed")
    i = td.interactions(spark, sf)
    kind = F.col("l_linenumber") % 5
    # three CSV headers, of other names and orders, and two Parquet schemas
    csv = {0: [F.col("user_id").alias(" User_ID "), F.col("item_id").alias("Item_Id"), F.col("rating").alias("RATING")],
           1: [F.col("ts"), F.col("rating"), F.col("user_id").alias("USER_ID"), F.col("item_id")],
           2: [F.col("item_id").alias("ITEM_ID"), F.col("ts").alias("TS"), F.col("user_id")]}
    for n, cols in csv.items():
        i.where(kind == n).select(*cols).write.mode("overwrite").option("header", True).csv(f"{base}/csv/part{n}")
    i.where(kind == 3).select("user_id", "item_id", "rating").write.mode("overwrite").parquet(base + "/parquet/nested/a")
    (i.where(kind == 4).select("item_id", F.col("user_id").alias("User_Id"), "ts", F.col("l_linenumber").alias("line"))
      .write.mode("overwrite").parquet(base + "/parquet/nested/b"))
    t = readers.load_table(spark, [base + "/csv", base + "/parquet"])
    return t.select(F.col("line").cast("bigint").alias("line"), F.col("user_id").cast("bigint").alias("user_id"), F.col("item_id").cast("bigint").alias("item_id"),
                    F.col("rating").cast("double").alias("rating"), F.col("ts").cast("bigint").alias("ts"))


@register("jsonl_events", with_views("""
SELECT user_id, movie_id, CAST(CAST(to_timestamp(ts) AS DATE) AS VARCHAR) AS day
FROM watches WHERE watch_id % 10 <> 3""", "watches"), ids=("SRC4", "PRJ9"))
def q_jsonl_events(spark, sf):
    path = _scratch(spark, sf, "loop-log")
    td.raw_json(spark, sf).select("value").write.mode("overwrite").text(path)
    e = readers.read_jsonl_events(spark, path)
    return e.select("user_id", "movie_id", F.col("day").cast("string").alias("day"))


@register("export_raw_fallback", with_views("""
SELECT watch_id, watch_id % 10 = 3 AS is_raw FROM watches ORDER BY watch_id LIMIT 2000""", "watches"),
    ids=("SRC5",))
def q_export_raw_fallback(spark, sf):
    out = readers.export_raw_fallback(td.raw_json(spark, sf), max_messages=2000, order=["watch_id"])
    return out.select("watch_id", "is_raw")


@register("snapshot_dedup", with_views("""
SELECT DISTINCT watch_id, CAST(user_id % 6 AS INTEGER) AS _kafka_partition, watch_id AS _kafka_offset,
       CAST(CAST(to_timestamp(ts) AS DATE) AS VARCHAR) AS dt
FROM watches""", "watches"), ids=("SRC7", "STR3"))
def q_snapshot_dedup(spark, sf):
    path = _scratch(spark, sf, "snapshots")
    r = td.replayed(spark, sf).withColumn("dt", F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd"))
    r.write.mode("overwrite").partitionBy("dt").option("header", True).csv(path)
    s = readers.read_snapshots(spark, path)
    return s.select(F.col("watch_id").cast("bigint").alias("watch_id"),
                    F.col("_kafka_partition").cast("int").alias("_kafka_partition"),
                    F.col("_kafka_offset").cast("bigint").alias("_kafka_offset"),
                    F.col("dt").cast("string").alias("dt"))


_AGE_CODES = sorted(readers.AGE_GROUPS)


@register("src_dat", f"""
SELECT c_custkey AS user_id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       list_extract({_AGE_CODES}, c_nationkey % 7 + 1) AS age, c_nationkey % 21 AS occupation,
       list_extract({[readers.AGE_GROUPS[a] for a in _AGE_CODES]}, c_nationkey % 7 + 1) AS age_group
FROM customer""", ids=("SRC8",))
def q_src_dat(spark, sf):
    path = _scratch(spark, sf, "users-dat")
    c = td.table(spark, sf, "customer")
    ages = F.array(*[F.lit(a) for a in _AGE_CODES])
    line = F.concat_ws("::", F.col("c_custkey").cast("string"),
                       F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M"),
                       F.element_at(ages, (F.col("c_nationkey") % 7 + 1).cast("int")).cast("string"),
                       (F.col("c_nationkey") % 21).cast("string"), F.lit("00000"))
    c.select(line.alias("value")).write.mode("overwrite").text(path)
    u = readers.read_dat(spark, path, "users")
    return u.select("user_id", "gender", "age", "occupation", "age_group")


# ------------------------------------------------------------------ sinks --

@register("sink_partitioned", with_views("""
SELECT watch_id, user_id, movie_id, ts, 'watch' AS topic, CAST(CAST(to_timestamp(ts) AS DATE) AS VARCHAR) AS date
FROM watches""", "watches"), ids=("SNK1",))
def q_sink_partitioned(spark, sf):
    out = _scratch(spark, sf, "sink")
    w = td.watches(spark, sf)
    paths = sinks.write_batch(w, out, "watch", ("parquet",), date=F.timestamp_seconds("ts"), mode="overwrite")
    back = spark.read.parquet(paths["parquet"])
    return back.select("watch_id", "user_id", "movie_id", "ts", F.col("topic").cast("string").alias("topic"),
                       F.col("date").cast("string").alias("date"))


@register("sink_topic_json", with_views("""
SELECT CAST(user_id AS VARCHAR) AS key, watch_id, movie_id FROM watches""", "watches"), ids=("SNK2",))
def q_sink_topic_json(spark, sf):
    path = _scratch(spark, sf, "topic")
    sinks.write_topic_files(sinks.to_topic_records(td.watches(spark, sf)), path)
    back = spark.read.schema("key string, value string").json(path)
    v = F.from_json("value", "watch_id bigint, movie_id bigint")
    return back.select("key", v["watch_id"].alias("watch_id"), v["movie_id"].alias("movie_id"))


# ---------------------------------------------------------- decode / check --

@register("wire_split", """
SELECT event_id, event_id % 2 = 0 AS framed, CASE WHEN event_id % 2 = 0 THEN event_id % 7 END AS schema_id,
       props AS body FROM events""", ids=("VAL1",))
def q_wire_split(spark, sf):
    framed, sid, body = wire.wire_split("value")
    return td.wire(spark, sf).select("event_id", framed.alias("framed"), sid.alias("schema_id"),
                                     F.decode(body, "UTF-8").alias("body"))


WATCH_SCHEMA_ID = 444


def _watch_messages(spark, sf):
    """Watch events as topic messages: even ids framed (body carries
    ``timestamp``), odd ids plain JSON with ``ts``; every 10th movie id is
    sent as text (a contract violation)."""
    w = td.watches(spark, sf)
    iso = F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd'T'HH:mm:ss")
    movie = F.when(F.col("watch_id") % 10 == 1, F.concat(F.lit('"m'), F.col("movie_id").cast("string"), F.lit('"'))) \
             .otherwise(F.col("movie_id").cast("string"))
    head = F.concat(F.lit('{"event": "watch", "user_id": '), F.col("user_id").cast("string"),
                    F.lit(', "movie_id": '), movie, F.lit(', "platform": null, '))
    framed_body = F.concat(head, F.lit('"timestamp": "'), iso, F.lit('"}'))
    plain_body = F.concat(head, F.lit('"ts": "'), iso, F.lit('"}'))
    frame = F.unhex(F.lit("00" + format(WATCH_SCHEMA_ID, "08x")))
    value = F.when(F.col("watch_id") % 2 == 0, F.concat(frame, F.encode(framed_body, "UTF-8"))) \
             .otherwise(F.encode(plain_body, "UTF-8"))
    return w.select("watch_id", F.lit("reco.watch").alias("topic"), value.alias("value"))


@register("parse_events", with_views(f"""
SELECT watch_id, watch_id % 2 = 0 AS framed,
       CAST(CASE WHEN watch_id % 2 = 0 THEN {WATCH_SCHEMA_ID} END AS BIGINT) AS schema_id,
       'reco.watch-value' AS subject, watch_id % 10 <> 1 AS ok,
       CASE WHEN watch_id % 10 = 1 THEN 1 ELSE 0 END AS n_errors,
       strftime(to_timestamp(ts), '%Y-%m-%dT%H:%M:%S') AS "timestamp"
FROM watches""", "watches"), ids=("VAL3", "VAL4", "VAL7"))
def q_parse_events(spark, sf):
    p = wire.parse_events(_watch_messages(spark, sf), key="watch_id")
    return p.select("watch_id", "framed", "schema_id", "subject", "ok", F.size("errors").alias("n_errors"),
                    F.get_json_object("json", "$.timestamp").alias("timestamp"))


@register("normalize_timestamp", with_views("""
SELECT watch_id, CASE watch_id % 4 WHEN 0 THEN 'T' || CAST(ts AS VARCHAR) WHEN 1 THEN 'S' || CAST(ts AS VARCHAR)
                      WHEN 2 THEN 'M' || CAST(ts AS VARCHAR) ELSE CAST(ts AS VARCHAR) END AS "timestamp"
FROM watches""", "watches"), ids=("VAL4",))
def q_normalize_timestamp(spark, sf):
    w = td.watches(spark, sf)
    t = F.col("ts").cast("string")
    text = (F.when(F.col("watch_id") % 4 == 0, F.concat(F.lit('{"timestamp": "T'), t, F.lit('", "ts": 1}')))
             .when(F.col("watch_id") % 4 == 1, F.concat(F.lit('{"ts": "S'), t, F.lit('"}')))
             .when(F.col("watch_id") % 4 == 2, F.concat(F.lit('{"ts": 0, "time": "M'), t, F.lit('"}')))
             .otherwise(F.concat(F.lit('{"ts": "", "event_time": '), t, F.lit("}"))))
    n = wire.normalize_timestamp(text)
    return w.select("watch_id", F.get_json_object(n, "$.timestamp").alias("timestamp"))


def _rate_messages(spark, sf):
    d = td.dirty(spark, sf)
    rating = F.when(F.col("rating").try_cast("double").isNull(),
                    F.concat(F.lit('"'), F.col("rating"), F.lit('"'))).otherwise(F.col("rating"))
    ts = F.when(F.col("timestamp").isNull(), F.lit("null")).otherwise(
        F.concat(F.lit('"'), F.col("timestamp").cast("string"), F.lit('"')))
    text = F.concat(F.lit('{"event": "rate", "user_id": '), F.col("user_id"), F.lit(', "movie_id": '),
                    F.col("item_id"), F.lit(', "rating": '), rating, F.lit(', "timestamp": '), ts, F.lit("}"))
    return d.select("l_orderkey", "l_linenumber", text.alias("json"))


@register("validate_records", with_views("""
SELECT count(*) = 0 OR bool_and(l_linenumber <> 7 AND NOT (l_suppkey % 50 = 0)) AS ok, count(*) AS records,
       CAST(sum(CASE WHEN l_linenumber = 7 OR l_suppkey % 50 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS invalid,
       CAST(sum((CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) + (CASE WHEN l_suppkey % 50 = 0 THEN 1 ELSE 0 END))
            AS BIGINT) AS errors
FROM interactions""", "interactions"), ids=("VAL5",))
def q_validate_records(spark, sf):
    v = quality.validate_json(_rate_messages(spark, sf), "json", RATE_EVENT, "l_orderkey")
    return quality.validation_summary(v)


@register("assert_valid", with_views("SELECT l_orderkey, l_linenumber FROM interactions", "interactions"), ids=("VAL6",))
def q_assert_valid(spark, sf):
    i = td.interactions(spark, sf)
    text = F.to_json(F.struct(F.lit("rate").alias("event"), "user_id", F.col("item_id").alias("movie_id"), "rating",
                              F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp")))
    v = quality.validate_json(i.select("l_orderkey", "l_linenumber", text.alias("json")), "json", RATE_EVENT)
    return quality.assert_valid(v).select("l_orderkey", "l_linenumber")


_TOPICS = {"click": "reco.watch", "view": "reco.reco_responses", "signup": "reco.signup"}


@register("topic_subject", """
SELECT DISTINCT CASE event_type WHEN 'click' THEN 'reco.watch' WHEN 'view' THEN 'reco.reco_responses'
                WHEN 'signup' THEN 'reco.signup' ELSE 'reco.' || event_type END AS topic,
       CASE event_type WHEN 'click' THEN 'reco.watch-value' WHEN 'view' THEN 'reco.reco_responses-value'
            ELSE (CASE event_type WHEN 'signup' THEN 'reco.signup' ELSE 'reco.' || event_type END)
                 || '-value' END AS subject
FROM events""", ids=("VAL7",))
def q_topic_subject(spark, sf):
    e = td.table(spark, sf, "events")
    m = F.create_map(*[x for k, v in _TOPICS.items() for x in (F.lit(k), F.lit(v))])
    topic = F.coalesce(m[F.col("event_type")], F.concat(F.lit("reco."), F.col("event_type")))
    return e.select(topic.alias("topic")).distinct().select("topic", wire.subject_for_topic("topic").alias("subject"))


# ------------------------------------------------------------- expressions --

def _id_texts(spark, sf):
    r = td.responses(spark, sf)
    ids = F.col("movie_ids")
    v = F.col("request_id") % 5
    text = (F.when(v == 0, F.to_json(ids))
             .when(v == 1, F.to_json(F.struct(ids.alias("movie_ids"))))
             .when(v == 2, F.concat(F.lit("["), F.concat_ws(";", ids[0].cast("string"), F.concat_ws(
                 "|", ids[1].cast("string"), F.concat_ws(" ", ids[2].cast("string"), ids[3].cast("string")))),
                 F.lit("]")))
             .when(v == 3, F.concat(F.lit('"'), ids[0].cast("string"), F.lit('"')))
             .otherwise(F.lit("")))
    return r.select("request_id", text.alias("text"))


@register("parse_movie_ids", with_views("""
SELECT request_id, CASE request_id % 5 WHEN 0 THEN array_to_string(movie_ids, ',')
                                       WHEN 1 THEN array_to_string(movie_ids, ',')
                                       WHEN 2 THEN array_to_string(movie_ids[1:4], ',')
                                       WHEN 3 THEN CAST(k0 AS VARCHAR) ELSE '' END AS ids
FROM responses""", "responses"), ids=("PRJ7",))
def q_parse_movie_ids(spark, sf):
    t = _id_texts(spark, sf)
    return t.select("request_id", items_text(parse_movie_ids("text")).alias("ids"))


@register("coerce_ts", with_views("""
SELECT watch_id, CASE WHEN watch_id % 9 = 0 THEN NULL ELSE CAST(ts AS DOUBLE) END AS epoch FROM watches""",
    "watches"), ids=("PRJ8", "G5"))
def q_coerce_ts(spark, sf):
    w = td.watches(spark, sf)
    iso = F.when(F.col("watch_id") % 9 == 0, F.lit("not a time")).otherwise(
        F.concat(F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    return rounded(w.select("watch_id", coerce_ts(iso).alias("epoch")))


@register("floor_minute", with_views("""
SELECT request_id, ts - ts % 60 AS minute FROM responses""", "responses"), ids=("PRJ10",))
def q_floor_minute(spark, sf):
    return td.responses(spark, sf).select("request_id", floor_minute("ts").alias("minute"))


@register("items_text", with_views("""
SELECT request_id, array_to_string(movie_ids, ',') AS items FROM responses""", "responses"), ids=("PRJ11",))
def q_items_text(spark, sf):
    return td.responses(spark, sf).select("request_id", items_text("movie_ids").alias("items"))


# ---------------------------------------------- optional and derived inputs --

@register("src_dat_ratings", with_views("""
SELECT user_id, item_id, rating, ts AS "timestamp" FROM interactions""", "interactions"), ids=("SRC8",))
def q_src_dat_ratings(spark, sf):
    path = _scratch(spark, sf, "ratings-dat")
    i = td.interactions(spark, sf)
    i.select(F.concat_ws("::", *[F.col(c).cast("string") for c in ("user_id", "item_id", "rating", "ts")]).alias("value")
             ).write.mode("overwrite").text(path)
    return readers.read_dat(spark, path, "ratings")


@register("src_dat_movies", """
SELECT p_partkey AS item_id, p_name || ' (' || p_size || ')' AS title, p_brand || ',' || p_type AS genres FROM part""",
          ids=("SRC8",))
def q_src_dat_movies(spark, sf):
    path = _scratch(spark, sf, "movies-dat")
    p = td.table(spark, sf, "part")
    title = F.concat("p_name", F.lit(" ("), F.col("p_size").cast("string"), F.lit(")"))
    p.select(F.concat_ws("::", F.col("p_partkey").cast("string"), title, F.concat_ws("|", "p_brand", "p_type")).alias("value")
             ).write.mode("overwrite").text(path)
    return readers.read_dat(spark, path, "movies").select("item_id", "title", F.concat_ws(",", "genres").alias("genres"))


@register("optional_movies", """
SELECT p_partkey AS item_id, p_name AS title, true AS present FROM part""", ids=("SRC9",))
def q_optional_movies(spark, sf):
    """The movies table where there is one, none of it where there is not."""
    path = _scratch(spark, sf, "movies-csv")
    td.table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title")
                                       ).write.mode("overwrite").option("header", True).csv(path)
    schema = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("title", T.StringType())])
    there = readers.read_optional(spark, path, schema, header=True).withColumn("present", F.lit(True))
    gone = readers.read_optional(spark, path + "-none", schema, header=True).withColumn("present", F.lit(False))
    return there.unionByName(gone)


@register("generated_request_id", with_views("""
SELECT count(*) AS requests, count(DISTINCT (user_id, ts, movie_ids[1])) AS ids FROM responses""", "responses"), ids=("JON12",))
def q_generated_request_id(spark, sf):
    """Requests without an id get one from their content."""
    r = td.responses(spark, sf).withColumn("first", F.col("movie_ids")[0]).select("user_id", "ts", "first", "latency_ms")
    w = online.with_request_id(r, ["user_id", "ts", "first"])
    return w.agg(F.count(F.lit(1)).alias("requests"), F.countDistinct("request_id").alias("ids"))


@register("default_rating", with_views("""
SELECT user_id, item_id, CAST(1.0 AS DOUBLE) AS rating FROM interactions""", "interactions"), ids=("PRJ4",))
def q_default_rating(spark, sf):
    return clean.default_rating(td.interactions(spark, sf).select("user_id", "item_id"))


@register("missing_columns", """
SELECT 'ratings missing required columns: [''timestamp'']' AS error, count(*) AS "rows" FROM lineitem""", ids=("VAL8",))
def q_missing_columns(spark, sf):
    """The gate names the columns that an input lacks."""
    li = td.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
    try:
        quality.require_columns(li, ("user_id", "item_id", "timestamp"), "ratings")
        said = None
    except ValueError as e:
        said = str(e)
    return li.agg(F.lit(said).alias("error"), F.count(F.lit(1)).alias("rows"))
