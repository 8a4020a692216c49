"""Session construction and cluster-level settings.

On a cluster the session is built by the platform; :func:`get_session` only
fills in what is unset.  Local tests get a small ``local[*]`` session.
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a query depends on for correct or scalable results.  They are only
# applied where the session does not already carry a value.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(app_name: str = "reelsight", master: str | None = None,
                shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on (UTC dates) and enable AQE.

    The time zone is always pinned to UTC: day boundaries and ISO parsing in
    the operators are defined in UTC, as in the reference.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for key, value in SESSION_DEFAULTS.items():
        if key == "spark.sql.session.timeZone":
            continue
        try:
            if spark.conf.get(key, None) is None:
                spark.conf.set(key, value)
        except Exception:  # pragma: no cover - conf not modifiable at runtime
            pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder and register it with the context.

    The cluster names the folder in ``spark.checkpoint.dir``.  Only a local
    session may do without: it gets a private temporary folder.  On any other
    master a machine-local folder would scatter the files over the executors,
    so a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="reelsight-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table of this application, under the
    shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "tables", spark.sparkContext.applicationId, name)


def materialize(df, tag: str):
    """Write ``df`` once as a parquet table under the shared checkpoint
    folder and return a DataFrame reading it back.

    Used for intermediates that several later branches read (a split, a
    re-indexed table): each is computed exactly once, later plans start from
    files instead of repeating the upstream joins, and a lost executor only
    re-reads files.  Every call writes a new folder; :func:`release` removes
    them."""
    spark = df.sparkSession
    path = scratch_path(spark, f"mat-{tag}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Remove all intermediate tables that this application has written.

    To be called when the results that were read from them are written or
    collected."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, ""))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def swept(spark: SparkSession, seconds: float = 10):
    """While the block runs, and at its end, the driver collects its garbage.

    Spark removes the files of a shuffle when the driver has collected the
    objects of its RDD, by itself only every 30 minutes or as its heap fills
    up.  An iterative fit leaves all its shuffles on the disks until then."""
    over, gc = threading.Event(), spark.sparkContext._jvm.System.gc

    def sweep():
        while not over.wait(seconds):
            gc()

    thread = threading.Thread(target=sweep, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()
        gc()
