"""Files as rows: first lines and digests, read by the executors in bounded
pieces (SRC3, SNK4).

Spark lists the files; their bytes are read by tasks through Arrow's file
systems (local paths, HDFS, S3, GCS).  No file and no list of files is gathered
in one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsight.operators.common import global_rank
from reelsight.session import materialize

#: Bytes hashed at a time, digests hashed together, and the longest first line.
PIECE, FAN, LONGEST_LINE = 64 << 20, 1024, 1 << 20


def opened(path: str):
    """An open file of any store that Arrow knows."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem().open_input_file(re.sub("^file:(//)?", "", path))
    store, at = fs.FileSystem.from_uri(quote(path, safe="/:@+,=~"))
    return store.open_input_file(at)


def files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, length) of all files under ``path``, empty ones left out; their
    bytes are not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    return r.load(path).select("path", "length")


def first_lines(listed: DataFrame, longest: int = LONGEST_LINE) -> DataFrame:
    """(path, line): the first line of each file, UTF-8, without its end and a
    byte-order mark; at most ``longest`` bytes of a file are read."""
    def run(batches: Iterator):
        import pyarrow as pa

        for b in batches:
            got = []
            for p in b.column(0).to_pylist():
                with opened(p) as f:
                    line = b""
                    while b"\n" not in line and len(line) < longest:
                        more = f.read(min(8192, longest - len(line)))
                        if not more:
                            break
                        line += more
                got.append(line.split(b"\n")[0].rstrip(b"\r").decode("utf-8-sig", "replace"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.string())], names=["path", "line"])

    # small files share a task when they are listed; here each is one row, dealt evenly
    return listed.select("path").repartition(F.col("path")).mapInArrow(run, "path string, line string")


def _piece_digests(listed: DataFrame, piece: int) -> DataFrame:
    """(path, i, h, n): SHA-256 of each of the n pieces of each file."""
    def run(batches: Iterator):
        import hashlib

        import pyarrow as pa

        for b in batches:
            got = []
            for p, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h, left = hashlib.sha256(), piece
                with opened(p) as f:
                    f.seek(i * piece)
                    while left and (part := f.read(min(left, 1 << 20))):
                        h.update(part)
                        left -= len(part)
                got.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.string())], names=["path", "i", "n", "h"])

    last = F.greatest(F.lit(0), F.ceil(F.col("length") / piece) - 1)
    pieces = listed.select("path", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("i"), (last + 1).cast("long").alias("n"))
    return pieces.repartition("path", "i").mapInArrow(run, "path string, i long, n long, h string")


def up_the_tree(leaves: DataFrame, by: list[str], fan: int = FAN) -> DataFrame:
    """(by, h): the hash tree over (by, i, h, n), i from 0 to n - 1: every node is
    the SHA-256 of up to ``fan`` digests below it in order, so no group holds
    more, whatever the number of leaves."""
    node = F.sha2(F.concat_ws(",", F.transform(F.sort_array(F.collect_list(F.struct("i", "h"))), lambda x: x["h"])), 256)
    level, roots = leaves, None
    while True:
        level = materialize(level.groupBy(*by, F.floor(F.col("i") / fan).alias("up"), F.ceil(F.col("n") / fan).alias("left")).agg(
            node.alias("h")).select(*by, F.col("up").alias("i"), "h", F.col("left").alias("n")), "digests")
        done = level.where("n = 1").select(*by, "h")
        roots = done if roots is None else roots.unionByName(done)
        level = level.where("n > 1")
        if level.isEmpty():
            return roots


def file_digests(spark: SparkSession, path: str, piece: int = PIECE, fan: int = FAN) -> DataFrame:
    """(path, length, sha256) of every file under ``path``: the hash tree
    over its pieces, files of any size."""
    listed = materialize(files(spark, path), "files")
    return listed.join(up_the_tree(_piece_digests(listed, piece), ["path"], fan), "path").select(
        "path", "length", F.col("h").alias("sha256"))


def artifact_digest(spark: SparkSession, path: str, piece: int = PIECE, fan: int = FAN) -> str | None:
    """One digest for all files under ``path``: the hash tree over their
    names below ``path``, lengths and digests, in the order of names.  The same
    artifact elsewhere has the same digest; None if there is no file."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    root = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString().rstrip("/")
    at = F.substring(F.col("path"), F.lit(len(root) + 2), F.length("path"))
    named = file_digests(spark, path, piece, fan).select(at.alias("at"), F.concat_ws(":", at, "length", "sha256").alias("h"))
    placed = materialize(global_rank(named, [F.col("at")], "r").select(F.lit(1).alias("one"), (F.col("r") - 1).alias("i"), "h"), "digests")
    got = up_the_tree(placed.withColumn("n", F.lit(placed.count())), ["one"], fan).first()
    return got["h"] if got else None
