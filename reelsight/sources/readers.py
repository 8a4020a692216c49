"""Readers for the reference's inputs (SRC1-SRC5, SRC7-SRC9).

Every reader returns a lazy DataFrame with an explicit schema where the
format allows it; column renames happen in the plan, never in the data.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsight.functions.exprs import event_day
from reelsight.operators.quality import require_columns
from reelsight.session import materialize
from reelsight.sources.files import files, first_lines

RATING_COLUMNS = ("user_id", "item_id", "rating", "timestamp")
# Case-insensitive header aliases of ratings files.
RATING_ALIASES = {"userid": "user_id", "movieid": "item_id", "rating": "rating", "timestamp": "timestamp",
                  "user_id": "user_id", "item_id": "item_id"}


def canonical_ratings(df: DataFrame, required: Sequence[str] = RATING_COLUMNS, what: str = "input") -> DataFrame:
    """Rename userId/movieId/rating/timestamp (any case) and check the
    required columns (SRC1/SRC2/SRC9)."""
    renames = {}
    for c in df.columns:
        target = RATING_ALIASES.get(c.strip().lower())
        if target and target not in df.columns and target not in renames.values():
            renames[c] = target
    out = df.withColumnsRenamed(renames) if renames else df
    return require_columns(out, required, what)


def read_ratings_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Ratings CSV with header; all four columns required (SRC1, SRC9).

    Without ``infer`` the columns are read as text and cast after the rename
    (user/item/timestamp to bigint, rating to double), so no inference pass
    scans the data."""
    df = spark.read.option("header", True).option("inferSchema", infer).csv(path)
    out = canonical_ratings(df, RATING_COLUMNS, f"CSV {path}")
    if infer:
        return out
    return out.select(*[F.col(c).try_cast("double" if c == "rating" else "bigint").alias(c)
                        if c in RATING_COLUMNS else F.col(c) for c in out.columns])


def read_optional(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
                  **options) -> DataFrame:
    """An optional table: a missing path gives an empty frame of ``schema``
    (SRC9's movies file)."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).options(**options).format(fmt).load(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def events_to_interactions(events: DataFrame) -> DataFrame:
    """Decoded event batch -> canonical interactions; rating optional,
    user/item/timestamp required (SRC2).  Works on streams too."""
    return canonical_ratings(events, ("user_id", "item_id", "timestamp"), "event batch")


def _csv_frames(spark: SparkSession, path: str) -> list[DataFrame]:
    """One frame for each distinct header among the CSV files under ``path``.
    Tasks read the first line of each file and no more; the driver gets a
    row for each file name, as Spark's reader wants them."""
    heads = materialize(first_lines(files(spark, path, "*.csv")).where("line <> ''"), "headers")
    kinds = [r["line"] for r in heads.select("line").distinct().orderBy("line").collect()]
    return [spark.read.option("header", True).csv([r["path"] for r in heads.where(F.col("line") == k).select("path").orderBy("path").toLocalIterator()])
            for k in kinds]


def _by_lower_name(df: DataFrame) -> DataFrame:
    """Columns stripped and lower-cased; those that then share a name are
    one column, the first non-null value."""
    same: dict[str, list[str]] = {}
    for c in df.columns:
        same.setdefault(c.strip().lower(), []).append(c)
    return df.select(*[F.coalesce(*[F.col(f"`{c}`") for c in cs]).alias(n) for n, cs in same.items()])


def load_table(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """CSV and Parquet files under ``paths`` (files or folders, recursive),
    each with its own columns, headers stripped and lower-cased, concatenated
    by name with missing columns null (SRC3, JON14).  A missing path is an
    error."""
    frames: list[DataFrame] = []
    for p in paths:
        if not _exists(spark, p):
            raise FileNotFoundError(p)
        frames += [_by_lower_name(f) for f in _csv_frames(spark, p)]
        try:
            frames.append(_by_lower_name(spark.read.option("recursiveFileLookup", True).option("mergeSchema", True)
                                         .option("pathGlobFilter", "*.parquet").parquet(p)))
        except AnalysisException as e:  # no Parquet file under p
            if "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
    if not frames:
        return spark.createDataFrame([], T.StructType([]))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# JSON-lines watch log: fields read as text so numbers and strings both fit.
_LOOP_SCHEMA = "movie_id string, ts string, user_id string, payload struct<movie_id:string, ts:string, user_id:string>"


def parse_jsonl_events(lines: DataFrame, value: str = "value", movie: str = "movie_id", ts: str = "ts") -> DataFrame:
    """JSON lines -> ``(user_id, movie_id, ts_raw, day)`` (SRC4).

    Blank and malformed lines are skipped; an object with ``payload`` is read
    from the payload; rows without a movie are dropped; ``day`` comes from
    epoch milliseconds or ISO text (PRJ9), null when unparsable."""
    text = F.trim(F.col(value))
    ok = (text != "") & F.try_parse_json(text).isNotNull()
    obj = F.from_json(text, _LOOP_SCHEMA)
    has_payload = F.get_json_object(text, "$.payload").isNotNull()
    pick = lambda f: F.when(has_payload, obj["payload"][f]).otherwise(obj[f])
    parsed = lines.where(ok).select(pick("user_id").alias("user_id"), pick(movie).alias("movie_id"),
                                    pick(ts).alias("ts_raw"))
    numeric = F.col("ts_raw").rlike(r"^-?[0-9]+(\.[0-9]+)?$")
    day = F.when(numeric, event_day(F.col("ts_raw").cast("double"), "millis")) \
           .otherwise(event_day(F.col("ts_raw"), "iso"))
    return (parsed.where(F.col("movie_id").isNotNull())
                  .select(F.col("user_id").try_cast("bigint").alias("user_id"),
                          F.coalesce(F.col("movie_id").try_cast("bigint"), F.col("movie_id").try_cast("double")
                                     .cast("bigint")).alias("movie_id"),
                          "ts_raw", day.alias("day")))


def read_jsonl_events(spark: SparkSession, path: str) -> DataFrame:
    return parse_jsonl_events(spark.read.text(path))


def export_raw_fallback(messages: DataFrame, value: str = "value", max_messages: int = 2000,
                        order: Sequence[str] = ()) -> DataFrame:
    """Bounded export of a topic (SRC5): at most ``max_messages`` messages
    (the export's purpose, not a shortcut), each kept as its JSON object or,
    when unparsable, as ``{"raw": value}``."""
    m = messages.orderBy(*order).limit(max_messages) if order else messages.limit(max_messages)
    v = F.col(value).cast("string")
    parsed = F.try_parse_json(v)
    line = F.when(parsed.isNotNull(), F.to_json(parsed)).otherwise(F.to_json(F.struct(v.alias("raw"))))
    return m.select("*", parsed.isNull().alias("is_raw"), line.alias("line"))


def read_snapshots(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Date-partitioned topic snapshots (``dt=``) with topic coordinates,
    replays removed (SRC7)."""
    df = spark.read.option("header", True).format(fmt).load(path)
    return dedupe_replays(df)


def dedupe_replays(df: DataFrame) -> DataFrame:
    """One row per (topic, partition, offset) (SRC7, STR3)."""
    return df.dropDuplicates(["_kafka_topic", "_kafka_partition", "_kafka_offset"])


# MovieLens demographic codes.
AGE_GROUPS = {1: "Under 18", 18: "18-24", 25: "25-34", 35: "35-44", 45: "45-49", 50: "50-55", 56: "56+"}
OCCUPATIONS = {0: "other or not specified", 1: "academic/educator", 2: "artist", 3: "clerical/admin",
               4: "college/grad student", 5: "customer service", 6: "doctor/health care",
               7: "executive/managerial", 8: "farmer", 9: "homemaker", 10: "K-12 student", 11: "lawyer",
               12: "programmer", 13: "retired", 14: "sales/marketing", 15: "scientist", 16: "self-employed",
               17: "technician/engineer", 18: "tradesman/craftsman", 19: "unemployed", 20: "writer"}


def read_dat(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """``::``-separated MovieLens files (SRC8): ``ratings``, ``users`` or
    ``movies``; genres become an array, demographic codes get labels."""
    schemas = {
        "ratings": "user_id bigint, item_id bigint, rating double, timestamp bigint",
        "users": "user_id bigint, gender string, age int, occupation int, zip string",
        "movies": "item_id bigint, title string, genres string",
    }
    df = spark.read.schema(schemas[kind]).option("sep", "::").option("encoding", "ISO-8859-1").csv(path)
    if kind == "movies":
        return df.withColumn("genres", F.split("genres", r"\|"))
    if kind == "users":
        ages = F.create_map(*[x for k, v in AGE_GROUPS.items() for x in (F.lit(k), F.lit(v))])
        occ = F.create_map(*[x for k, v in OCCUPATIONS.items() for x in (F.lit(k), F.lit(v))])
        return df.withColumn("age_group", ages[F.col("age")]).withColumn("occupation_name", occ[F.col("occupation")])
    return df
