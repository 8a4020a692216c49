"""A topic kept in files, read with offsets (SRC5, SRC6).

Layout: ``<path>/dt=<day>/_kafka_partition=<p>/segment=<first offset>/*.parquet``,
as :func:`write_segments` makes it.  A segment holds the offsets from its
number up to the next segment's; a partition's offsets grow with the days.

:class:`TopicSource` is a data source of Spark's Python API over it, named
``topic_segments``, for batches and streams.  The offset of a stream is the next
offset of every topic partition; it is kept in the query's checkpoint, so a
query that stops and starts again goes on where its last batch ended.  New
offsets are found from folder names and the footers of the newest segments, by
the driver; the messages are read by tasks, one for each partition and segment,
as Arrow batches.

Options: ``path``; ``startingOffsets`` (``earliest``, or JSON {partition:
first offset}); ``endingOffsets`` (``latest``, or JSON {partition: offset after
the last}, batches only); ``maxOffsetsPerTrigger`` for each batch of a stream.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "topic_segments"
OFFSET, PARTITION = "_kafka_offset", "_kafka_partition"
_FOLDER = re.compile(rf"dt=([^/]+)/{PARTITION}=(\d+)/segment=(\d+)/[^/]+\.parquet$")


def write_segments(messages: DataFrame, path: str, day: str = "dt", size: int = 100_000, mode: str = "append") -> None:
    """Messages with topic coordinates and a ``day`` column as segments of at
    most ``size`` offsets.  Each folder is written by one task."""
    first = F.floor(F.col(OFFSET) / size) * size
    rows = messages.withColumn("segment", first.cast("long")).withColumnRenamed(day, "dt")
    (rows.repartition("dt", PARTITION, "segment").sortWithinPartitions("dt", PARTITION, "segment", OFFSET)
         .write.mode(mode).partitionBy("dt", PARTITION, "segment").parquet(path))


def _open(path: str):
    """(file system, path in it); local paths and the stores Arrow knows."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), re.sub("^file:(//)?", "", path)
    return fs.FileSystem.from_uri(quote(path, safe="/:@+,=~"))


def segments(path: str) -> dict[int, list[tuple[int, str]]]:
    """(first offset, file) of every topic partition, in order."""
    from pyarrow import fs

    store, root = _open(path)
    out: dict[int, list[tuple[int, str]]] = {}
    for f in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        m = _FOLDER.search(f.path)
        if m and f.is_file:
            out.setdefault(int(m[2]), []).append((int(m[3]), f.path))
    return {p: sorted(files) for p, files in sorted(out.items())}


def _after_last(store, files: list[tuple[int, str]]) -> int:
    """The offset after the last one, from the footers of the last segment."""
    from pyarrow import parquet

    last = -1
    for first, f in files:
        if first == files[-1][0]:
            meta = parquet.read_metadata(f, filesystem=store)
            at = meta.schema.names.index(OFFSET)
            last = max([last, *(meta.row_group(i).column(at).statistics.max for i in range(meta.num_row_groups))])
    return last + 1


class Segment(InputPartition):
    def __init__(self, partition: int, lo: int, hi: int, files: list[str]):
        self.partition, self.lo, self.hi, self.files = partition, lo, hi, files


class _Reading:
    """What batches and streams share."""

    def __init__(self, options: dict, schema):
        self.options = {k.lower(): v for k, v in options.items()}
        self.path, self.fields = self.options["path"], schema

    def wanted(self, name: str, word: str) -> dict[int, int]:
        said = self.options.get(name.lower(), word)
        return {} if said == word else {int(k): int(v) for k, v in json.loads(said).items()}

    def available(self) -> dict[int, int]:
        store, _ = _open(self.path)
        return {p: _after_last(store, files) for p, files in segments(self.path).items()}

    def planned(self, start: dict[int, int], end: dict[int, int]) -> list[Segment]:
        out = []
        for p, files in segments(self.path).items():
            lo, hi = start.get(p, 0), end.get(p, 0)
            firsts = sorted({f for f, _ in files})
            for first, nxt in zip(firsts, [*firsts[1:], None]):
                a, b = max(lo, first), hi if nxt is None else min(hi, nxt)
                if a < b:
                    out.append(Segment(p, a, b, [f for s, f in files if s == first]))
        return out

    def read(self, part: Segment | None) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyarrow import parquet

        if part is None:  # nothing to read
            return
        store, _ = _open(self.path)
        names = [f.name for f in self.fields]
        for f in part.files:
            with store.open_input_file(f) as opened:
                have = [n for n in names if n not in (PARTITION, "dt")]
                for b in parquet.ParquetFile(opened).iter_batches(columns=[*dict.fromkeys([*have, OFFSET])]):
                    at = b.column(b.schema.get_field_index(OFFSET))
                    b = b.filter(pc.and_(pc.greater_equal(at, part.lo), pc.less(at, part.hi)))
                    day = re.search(r"dt=([^/]+)/", f)[1]
                    fixed = {PARTITION: pa.array([part.partition] * b.num_rows, pa.int32()), "dt": pa.array([day] * b.num_rows, pa.string())}
                    yield pa.RecordBatch.from_arrays([fixed[n] if n in fixed else b.column(b.schema.get_field_index(n)) for n in names], names=names)


class _Batch(_Reading, DataSourceReader):
    def partitions(self) -> list[Segment]:
        return self.planned(self.wanted("startingOffsets", "earliest"), self.available() | self.wanted("endingOffsets", "latest"))


class _Stream(_Reading, DataSourceStreamReader):
    told: dict[int, int] | None = None

    def initialOffset(self) -> dict:
        return {str(p): o for p, o in self.wanted("startingOffsets", "earliest").items()}

    def latestOffset(self) -> dict:
        """All there is, or as far as the limit allows beyond what was told
        last; partitions share the limit evenly."""
        end = self.available()
        limit = int(self.options.get("maxoffsetspertrigger", "0"))
        if limit and self.told is not None:
            each = max(1, limit // max(1, len(end)))
            end = {p: min(o, self.told.get(p, 0) + each) for p, o in end.items()}
        return {str(p): o for p, o in end.items()}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        whole = lambda x: {int(p): int(o) for p, o in x.items()}
        self.told = whole(end)
        return self.planned(whole(start), whole(end))

    def commit(self, end: dict) -> None:
        """Nothing to do: the checkpoint holds the offsets."""


class TopicSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        raise ValueError("give the schema of the messages")

    def reader(self, schema) -> DataSourceReader:
        return _Batch(dict(self.options), schema)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(dict(self.options), schema)


def read_topic(spark: SparkSession, path: str, schema, stream: bool = False, **options) -> DataFrame:
    """The messages of a topic kept as segments."""
    spark.dataSource.register(TopicSource)
    r = (spark.readStream if stream else spark.read).format(NAME).schema(schema).options(path=path, **options)
    return r.load()
