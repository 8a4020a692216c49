"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelsight.session import materialize

#: The characters that separate words: space and U+0009 to U+000D.
SPACE = "\\x20\\x09-\\x0D"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the path goes to Spark's reader as it is."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    return materialize(df, f"llm-{tag}")


def sorted_side(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is sorted and merged, never sent whole
    to all tasks.  For tables that grow with the corpus where Spark's estimate,
    which knows neither the rows that an explode makes nor how far a written
    file is compressed, could let the driver collect them."""
    return df.hint("merge")


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def n_words(text: Column) -> Column:
    """Number of words, without building them."""
    t = F.coalesce(text, F.lit(""))
    parts = F.size(F.split(t, f"[{SPACE}]+"))
    edge = (F.when(t.rlike(f"^[{SPACE}]"), 1).otherwise(0) + F.when(t.rlike(f"[{SPACE}]\\z"), 1).otherwise(0))
    blank = ~t.rlike(f"[^{SPACE}]")
    return F.when(blank, F.lit(0)).otherwise(parts - edge).cast("long")


def row_key(*cols: Column) -> Column:
    """128 bits of hash that name a row by its content; equal rows get equal
    keys, so no generated row id has to survive a recomputation."""
    parts = [F.coalesce(c.cast("string"), F.lit("\x00null")) for c in cols]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit("key"), *reversed(parts)).alias("b"))


def packed(docs: DataFrame, key: Column) -> DataFrame:
    """(row, ka, kb): all columns of ``docs`` in one struct, beside the row's
    :func:`row_key`, so that no name of a helper can meet one of theirs."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), key.alias("k"))
    return rows.select("row", F.col("k.a").alias("ka"), F.col("k.b").alias("kb"))


def unpacked(rows: DataFrame, docs: DataFrame, new: dict[str, Column] | None = None) -> DataFrame:
    """The columns of ``docs`` from ``row``, those of ``new`` replaced."""
    return rows.select(*[(new or {}).get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def counted_anew(docs: DataFrame, text: str, length: str, now: Column, changed: Column) -> dict[str, Column]:
    """The column ``length``, if ``docs`` has it, with the characters of the
    text ``now`` where it has changed."""
    if length not in docs.columns or length == text:
        return {}
    return {length: F.when(changed, F.length(now).cast(docs.schema[length].dataType)).otherwise(F.col("row")[length])}


def running(df: DataFrame, group: list[str], order: list[str], value: str | None, tag: str,
            out: str = "before") -> DataFrame:
    """Add ``out``: the sum of ``value`` (None: the number) of the rows before
    this one in its group, in ``order``.

    No group is gathered in one task: the rows are range-sorted on
    (group, order) and written once with the number of their partition; the
    sums of each (partition, group), at most partitions + groups rows, are
    added up separately, and only rows of one partition share a window.  Both
    readings come from the written files, so recomputed tasks cannot shift
    the partition borders between them.  Rows that tie in all of ``order``
    are ordered by a number given before the sort, so that a repeated row
    cannot fill one partition; which of them comes first is not fixed."""
    cols = df.columns
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v = F.lit(1).cast("long") if value is None else F.col(value)
    order = [*order, "_tie"]
    ranged = (df.withColumn("_tie", F.monotonically_increasing_id())
                .repartitionByRange(n, *[F.col(c).asc_nulls_last() for c in group + order]))
    t = staged(ranged.withColumn("_pid", F.spark_partition_id()), tag)
    # null-safe group keys for the small joins
    gk = F.struct(*[F.col(c) for c in group]) if group else F.struct(F.lit(0).alias("_all"))
    sums = t.groupBy(gk.alias("_g"), "_pid").agg(F.sum(v).alias("_s"))
    prior = F.sum("_s").over(Window.partitionBy("_g").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("_g", "_pid", F.coalesce(prior, F.lit(0)).alias("_off"))
    within = (Window.partitionBy("_pid", *group).orderBy(*[F.col(c).asc_nulls_last() for c in order])
              .rowsBetween(Window.unboundedPreceding, -1))
    inner = t.withColumn("_in", F.coalesce(F.sum(v).over(within), F.lit(0))).withColumn("_g", gk)
    o = offsets.select(F.col("_g").alias("_og"), F.col("_pid").alias("_op"), "_off")
    joined = inner.join(o, (F.col("_pid") == F.col("_op")) & F.col("_g").eqNullSafe(F.col("_og")))
    return joined.select(*cols, (F.col("_off") + F.col("_in")).alias(out))
