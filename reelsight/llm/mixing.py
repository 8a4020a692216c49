"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, up to ``repeats``
times over.  A document (each time it is queued) has a virtual finish time:
the cumulative words of its source up to its end, divided by the source's
target.  All queued documents are range-sorted by finish time and served until
the total budget is used up, so at any point every source has been served in
proportion to its target, to within one document.

Targets: the sources, by code point (null last), have weights 5, 2, 1,
repeating, and share ``share`` of all words; none gets more than ``repeats``
times its words, and what is above is shared again by weight.

Only DataFrame functions are used.  Running sums over all documents of a
source, however many, and over the whole queue are two-level (see
:func:`reelsight.llm.tables.running`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsight.llm.tables import n_words, packed, row_key, running, staged, unpacked


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    repeats: int = 2
    seed: str = "mix"


def targets(sources: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, source_size, idx, target) from (source, source_size).

    The level l with sum(min(cap, l * weight)) = budget is found by capping
    the sources above it and sharing the rest again until none is above; one
    small aggregation a round, and each round caps a source or is the last."""
    t = running(sources, [], ["source"], None, "mix-sources", out="idx")
    weight = F.lit(None).cast("long")
    for i, w in enumerate(mix.weights):
        weight = F.when(F.col("idx") % len(mix.weights) == i, F.lit(w)).otherwise(weight)
    t = staged(t.withColumn("weight", weight.cast("long"))
                .withColumn("cap", F.col("source_size") * mix.repeats), "mix-weights")
    total, level, capped = None, None, None
    while True:
        full = F.lit(False) if level is None else F.col("cap") <= F.lit(level) * F.col("weight")
        r = t.agg(F.sum("source_size").alias("total"), F.count(F.when(full, 1)).alias("n"),
                  F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)).alias("caps"),
                  F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("open")).first()
        total = r["total"] or 0
        if not r["open"] or r["n"] == capped:
            break
        level, capped = (total * mix.share - r["caps"]) / r["open"], r["n"]
    goal = F.col("cap").cast("double")
    if level is not None:
        goal = F.least(goal, F.lit(float(level)) * F.col("weight"))
    return t.select("source", "source_size", "idx", goal.alias("target"))


def plan(docs: DataFrame, mix: Mix = Mix(), text: str = "text", source: str = "source",
         key: Column | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target (the source's), copies and
    taken (copies times size) of every row; with the parts of ``key`` (ka,
    kb) if one is given.

    Null texts and texts without words have size 0 and are never taken;
    null sources are one source, the last; null ids are ordered like an id.
    Repeated rows are queued separately.  An empty table gives no rows."""
    with_key = key is not None
    order = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("|" + mix.seed)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
                       n_words(F.col(text)).alias("size"), order.alias("h"),
                       *([key["a"].alias("ka"), key["b"].alias("kb")] if with_key else []))
    rows = running(rows, ["source"], ["h", "doc_id", "size"], "size", "mix-rows").drop("h")
    goals = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), mix)
    g = goals.withColumnRenamed("source", "_s")
    rows = staged(rows.join(g, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "mix-queue")

    def place(k: int) -> Column:
        """Where the row stands the k-th time in the order of finish times."""
        cum = F.col("source_size") * k + F.col("before") + F.col("size")
        return F.struct((cum / F.col("target")).alias("finish"), F.col("idx").alias("idx"), cum.alias("cum"))

    queued = rows.where("size > 0 and target > 0").select(
        "size", F.explode(F.array(*[place(k) for k in range(mix.repeats)])).alias("p")).select("p.*", "size")
    budget = min(mix.share, mix.repeats) * (goals.agg(F.sum("source_size")).first()[0] or 0)
    served = running(queued, [], ["finish", "idx", "cum"], "size", "mix-served")
    last = served.where(F.col("before") + F.col("size") <= F.lit(float(budget))).agg(
        F.max(F.struct("finish", "idx", "cum")).alias("p")).first()["p"]
    copies = F.lit(0)
    if last is not None:
        cut = F.struct(F.lit(last["finish"]).alias("finish"), F.lit(last["idx"]).cast("long").alias("idx"),
                       F.lit(last["cum"]).cast("long").alias("cum"))
        copies = sum((F.when((F.col("size") > 0) & (F.col("target") > 0) & (place(k) <= cut), 1).otherwise(0)
                      for k in range(mix.repeats)), F.lit(0))
    out = rows.withColumn("copies", copies.cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"), *(["ka", "kb"] if with_key else []))


def apply(docs: DataFrame, mix: Mix = Mix(), text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` as the mix takes them: a row as often as it is taken."""
    key = row_key(*[docs[f"`{c}`"] for c in docs.columns])
    chosen = (plan(docs, mix, text, source, key).where("copies > 0")
              .groupBy("ka", "kb").agg(F.sum("copies").alias("copies")))
    # rows equal in every column have their copies added up
    kept = packed(docs, key).join(chosen, ["ka", "kb"]).dropDuplicates(["ka", "kb"])
    times = kept.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("i"))
    return unpacked(times, docs)
