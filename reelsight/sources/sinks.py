"""Sinks (SNK1-SNK4): partitioned batch files, topic-style key/value
records, metric reports and registry publication.

Output locations are URIs; object stores are just another scheme.  Writes
are whole-job commits (Spark's file commit protocol), so a lost executor
re-runs its tasks without leaving partial files behind.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsight.sources.files import artifact_digest


def write_batch(df: DataFrame, out_dir: str, topic: str, formats: Sequence[str] = ("parquet", "csv"),
                date: Column | None = None, mode: str = "append",
                extra_partitions: Sequence[str] = ()) -> dict[str, str]:
    """Write a batch under ``out_dir/<fmt>/topic=<topic>/date=YYYY-MM-DD/``
    for every format (SNK1).  ``date`` defaults to the processing date (UTC)
    like the reference; an empty batch writes nothing.  With
    ``mode="overwrite"`` only the partitions present in the batch are
    replaced (dynamic partition overwrite), so re-running a batch is
    idempotent.  Returns ``{format: path}``."""
    if df.isEmpty():
        return {}
    d = date if date is not None else F.current_date()
    out = df.withColumn("topic", F.lit(topic)).withColumn("date", F.date_format(d, "yyyy-MM-dd"))
    paths = {}
    for fmt in formats:
        path = os.path.join(out_dir, fmt)
        w = (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
                .partitionBy("topic", "date", *extra_partitions))
        if fmt == "csv":
            w = w.option("header", True)
        w.format(fmt).save(path)
        paths[fmt] = path
    return paths


def to_topic_records(df: DataFrame, key: str = "user_id") -> DataFrame:
    """``(key, value)`` records: key = the user id as text, value = the
    row as JSON (SNK2).  Feed to ``write.format('kafka')`` where the
    connector exists, or to :func:`write_topic_files`."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def write_topic_files(records: DataFrame, path: str, mode: str = "overwrite") -> str:
    records.write.mode(mode).json(path)
    return path


def report_json(overall: DataFrame, by_bucket: DataFrame | None = None) -> DataFrame:
    """Nested JSON report of an offline evaluation (SNK3): one row with
    ``overall`` (one entry per k) and ``subpopulations``."""
    o = overall.select(F.struct(*overall.columns).alias("r")).agg(F.sort_array(F.collect_list("r")).alias("overall"))
    if by_bucket is None:
        return o.select(F.to_json(F.struct("overall")).alias("report"))
    b = by_bucket.select(F.struct(*by_bucket.columns).alias("r")).agg(
        F.sort_array(F.collect_list("r")).alias("subpopulations"))
    return o.select(F.to_json(F.struct("overall", b.select("subpopulations").scalar().alias("subpopulations")))
                    .alias("report"))


def publish_metadata(spark, registry_dir: str, version: str, artifact_dir: str, metrics: dict[str, float],
                     extra: dict[str, str] | None = None) -> DataFrame:
    """Append one registry row for a published artifact (SNK4): version,
    created_at (UTC ISO), artifact path, a digest over the artifact files
    and the metrics map.  Returns the row."""
    digest = spark.createDataFrame([(artifact_digest(spark, artifact_dir),)], "sha256 string")
    meta = {"version": version, "artifact": artifact_dir, **(extra or {})}
    m = F.create_map(*[x for k, v in metrics.items() for x in (F.lit(k), F.lit(float(v)))])
    row = digest.select(*[F.lit(v).alias(k) for k, v in meta.items()],
                        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
                        "sha256", m.alias("metrics"))
    entry = spark.createDataFrame(row.collect(), row.schema)  # the one row that is stored is the one returned
    entry.write.mode("append").parquet(registry_dir)
    return entry
