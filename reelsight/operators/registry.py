"""Model registry as a table (REG1-REG4, PRJ12, PRJ13).

A registry is a DataFrame ``(version, created_at, artifact, metrics)`` with
``version`` like ``v0.7``, ``created_at`` ISO-8601 text, ``artifact`` the
artifact name or null, ``metrics`` a ``map<string, double>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsight.operators.common import placed


def version_parts(df: DataFrame, col: str = "version") -> DataFrame:
    """Split ``vMAJOR.MINOR`` into integers (unparsable -> null)."""
    parts = F.split(F.regexp_replace(F.col(col), "^v", ""), r"\.")
    return (df.withColumn("major", parts[0].try_cast("int"))
              .withColumn("minor", F.element_at(parts, 2).try_cast("int")))


def next_version(registry: DataFrame) -> DataFrame:
    """Newest version (numeric order) and the next minor version; ``v1.0``
    on an empty registry (REG1).  ``text_latest`` shows what a text sort
    would pick (``v0.9`` after ``v0.10``)."""
    v = version_parts(registry).where(F.col("major").isNotNull() & F.col("minor").isNotNull())
    agg = v.agg(F.max_by("version", F.struct("major", "minor")).alias("latest"),
                F.max_by(F.struct("major", "minor"), F.struct("major", "minor")).alias("mm"),
                F.max("version").alias("text_latest"))
    return agg.select("latest", "text_latest",
                      F.when(F.col("latest").isNull(), F.lit("v1.0"))
                       .otherwise(F.format_string("v%d.%d", F.col("mm.major"), F.col("mm.minor") + 1))
                       .alias("next_version"))


def latest_with_artifact(registry: DataFrame) -> DataFrame:
    """Newest version that has an artifact, the one to carry forward (REG2)."""
    v = version_parts(registry).where(F.col("artifact").isNotNull())
    return v.agg(F.max_by("version", F.struct("major", "minor")).alias("version"),
                 F.max_by("artifact", F.struct("major", "minor")).alias("artifact"))


def parse_created_at(col: Column | str) -> Column:
    """ISO text -> epoch seconds (double); naive times are UTC, ``Z`` and
    offsets honoured, bad text -> null (PRJ13)."""
    c = F.col(col) if isinstance(col, str) else col
    s = F.regexp_replace(F.trim(c), "Z$", "+00:00")
    ts = F.coalesce(F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX")),
                    F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")),
                    F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS]")))
    return F.unix_micros(ts) / F.lit(1_000_000.0)


def model_age(created_at: Column | str, now: Column) -> Column:
    """``max(0, now - created_at)``; unparsable -> 0 like the reference."""
    t = parse_created_at(created_at)
    return F.when(t.isNull(), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), now - t))


def active_info(registry: DataFrame, now: Column) -> DataFrame:
    """Active (newest) model: version, artifact, hr@20 and ndcg@20 when
    present, age in seconds (REG3)."""
    v = version_parts(registry)
    pick = v.agg(F.max_by(F.struct("version", "artifact", "created_at", "metrics"),
                          F.struct("major", "minor")).alias("m")).select("m.*")
    return pick.select("version", "artifact",
                       F.element_at("metrics", F.lit("hr@20")).alias("hr_at_20"),
                       F.element_at("metrics", F.lit("ndcg@20")).alias("ndcg_at_20"),
                       model_age("created_at", now).alias("age_s"))


def active_version_asof(requests: DataFrame, activations: DataFrame, ts: str = "ts",
                        at: str = "activated_at") -> DataFrame:
    """For each request, the version activated last at or before its time
    (REG4); null before the first activation and for a request without time.
    Of versions activated at one time the last by name counts.

    Activations and requests are range-sorted together by time and written
    once.  Each partition carries its last version on within itself; what
    holds at its start comes from a table with one row per partition."""
    cols = requests.columns
    a = activations.select(F.col(at).cast("bigint").alias("_t"), F.lit(0).alias("_kind"), F.col("version").alias("_v"))
    q = requests.where(F.col(ts).isNotNull()).withColumns(
        {"_t": F.col(ts).cast("bigint"), "_kind": F.lit(1), "_v": F.lit(None).cast("string")})
    s = placed(q.unionByName(a.where("_t is not null"), allowMissingColumns=True),
               [F.col("_t").asc(), F.col("_kind").asc(), F.col("_v").asc()]).withColumn("_pid", F.shiftright("_mid", 33))
    last = s.groupBy("_pid").agg(F.max_by("_v", F.when(F.col("_kind") == 0, F.col("_mid"))).alias("_last"))
    start = last.select("_pid", F.last("_last", ignorenulls=True).over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)).alias("_start"))
    here = F.last("_v", ignorenulls=True).over(
        Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0))
    known = (s.withColumn("_here", here).where(F.col("_kind") == 1).join(F.broadcast(start), "_pid")
              .select(*cols, F.coalesce("_here", "_start").alias("version")))
    return known.unionByName(requests.where(F.col(ts).isNull()).select(*cols, F.lit(None).cast("string").alias("version")))


def parse_metadata_text(text: Column | str) -> Column:
    """Lenient metadata parse (PRJ12): a JSON object, else ``key: value``
    lines (YAML-like); ``null``/``none``/``~``/empty values become null.
    Returns ``map<string, string>``."""
    t = F.col(text) if isinstance(text, str) else text
    js = F.from_json(t, "map<string,string>")
    lines = F.filter(F.split(t, r"\r?\n"), lambda s: s.contains(":") & ~F.trim(s).startswith("#"))
    kv = F.transform(lines, lambda s: F.struct(
        F.trim(F.substring_index(s, ":", 1)).alias("key"),
        F.trim(F.regexp_extract(s, r"^[^:]*:(.*)$", 1)).alias("value")))
    kv = F.transform(kv, lambda e: F.struct(e["key"].alias("key"), F.when(
        F.lower(F.regexp_replace(e["value"], "^[\"']|[\"']$", "")).isin("null", "none", "~", ""),
        F.lit(None).cast("string")).otherwise(F.regexp_replace(e["value"], "^[\"']|[\"']$", "")).alias("value")))
    kv = F.filter(kv, lambda e: e["key"] != "")
    from_lines = F.map_from_entries(kv)
    return F.when(F.trim(t).startswith("{") & js.isNotNull(), js).otherwise(from_lines)
