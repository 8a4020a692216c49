"""Ranking quality metrics on long-format recommendations (EVAL1-EVAL7).

Recommendations are rows ``(user, rank, item)`` (rank 1 = best), truth is
``(user, item, copies)``.  Nothing is collected into per-user lists: hits
come from an equi join, running hit counts from a window bounded by the
list length k, and the per-user metrics from one ``groupBy(user, k)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsight.functions.exprs import ideal_dcg

METRICS = ("precision", "recall", "ndcg", "map")


def user_metrics(recs: DataFrame, truth: DataFrame, k_values: Sequence[int] = (5, 10, 20),
                 user: str = "uidx", item: str = "iidx", precision_denominator: str = "k",
                 truth_as_list: bool = True, users: DataFrame | None = None) -> DataFrame:
    """Per ``(user, k)``: precision, recall, ndcg and map.

    * precision: hits / k (``precision_denominator="k"``, offline) or hits /
      min(k, list length) (``"returned"``, service);
    * recall: hits / |truth| and ndcg ideal over min(|truth|, k), where
      |truth| counts copies when ``truth_as_list`` (offline) and distinct
      items otherwise (service / notebooks);
    * map: sum over hits of hits-so-far / rank, divided by
      min(|distinct truth|, k); k <= 0 gives 0.

    Users are those in ``users`` (default: users with truth); users without
    recommendations score 0.
    """
    ks = [int(k) for k in k_values]
    max_k = max(ks) if ks else 0
    tstats = truth.groupBy(user).agg(
        F.sum("copies").alias("truth_len") if truth_as_list else F.countDistinct(item).alias("truth_len"),
        F.countDistinct(item).alias("truth_distinct"))
    if users is None:
        users = tstats.select(user)
    tset = truth.select(user, item).distinct().withColumn("_hit", F.lit(1))
    r = (recs.where(F.col("rank") <= max_k).select(user, "rank", item)
             .join(tset, [user, item], "left")
             .withColumn("_hit", F.coalesce(F.col("_hit"), F.lit(0))))
    w = Window.partitionBy(user).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    r = r.withColumn("_cum", F.sum("_hit").over(w)).withColumn("_n", F.count(F.lit(1)).over(
        Window.partitionBy(user)))
    per = (r.select(user, "rank", "_hit", "_cum", "_n",
                    F.explode(F.filter(F.array(*[F.lit(k) for k in ks]), lambda k: k >= F.col("rank"))).alias("k"))
             .groupBy(user, "k")
             .agg(F.sum("_hit").alias("hits"),
                  F.sum(F.col("_hit") / F.log2(F.col("rank") + 1)).alias("dcg"),
                  F.sum(F.when(F.col("_hit") == 1, F.col("_cum") / F.col("rank")).otherwise(0.0)).alias("ap_num"),
                  F.max("_n").alias("n_recs")))
    grid = users.select(user).distinct().select(user, F.explode(F.array(*[F.lit(k) for k in ks])).alias("k"))
    g = (grid.join(per, [user, "k"], "left").join(tstats, user, "left")
             .fillna(0, ["hits", "dcg", "ap_num", "n_recs", "truth_len", "truth_distinct"]))
    k = F.col("k")
    if precision_denominator == "k":
        prec = F.when(k <= 0, 0.0).otherwise(F.col("hits") / k)
    else:
        den = F.least(k, F.col("n_recs"))
        prec = F.when((k <= 0) | (den == 0), 0.0).otherwise(F.col("hits") / den)
    recall = F.when(F.col("truth_len") == 0, 0.0).otherwise(F.col("hits") / F.col("truth_len"))
    ideal = ideal_dcg(F.least(F.col("truth_len"), k))
    ndcg = F.when(ideal == 0, 0.0).otherwise(F.col("dcg") / ideal)
    mden = F.least(F.col("truth_distinct"), k)
    mapk = F.when((F.col("truth_distinct") == 0) | (mden <= 0), 0.0).otherwise(F.col("ap_num") / mden)
    return g.select(user, "k", prec.cast("double").alias("precision"), recall.cast("double").alias("recall"),
                    ndcg.cast("double").alias("ndcg"), mapk.cast("double").alias("map"))


def overall(metrics: DataFrame, k_values: Sequence[int] = ()) -> DataFrame:
    """Mean of every metric per k over evaluated users (EVAL6); each of
    ``k_values`` has a row, with null means if no user was evaluated."""
    got = metrics.groupBy("k").agg(*[F.avg(m).alias(m) for m in METRICS],
                                   F.count(F.lit(1)).alias("users"))
    if not k_values:
        return got
    grid = metrics.sparkSession.createDataFrame([(int(k),) for k in k_values], "k int")
    return grid.join(got, "k", "left").withColumn("users", F.coalesce("users", F.lit(0)))


def by_bucket(metrics: DataFrame, buckets: DataFrame, user: str = "uidx",
              all_buckets: Sequence[str] = ()) -> DataFrame:
    """Means per (bucket, k) (EVAL7); buckets in ``all_buckets`` without
    evaluated users give null metrics (the reference's NaN)."""
    m = metrics.join(buckets.select(user, "bucket"), user, "inner")
    agg = m.groupBy("bucket", "k").agg(*[F.avg(x).alias(x) for x in METRICS],
                                      F.count(F.lit(1)).alias("users"))
    if not all_buckets:
        return agg
    ks = metrics.select("k").distinct()
    grid = (ks.select("k", F.explode(F.array(*[F.lit(b) for b in all_buckets])).alias("bucket")))
    return (grid.join(agg, ["bucket", "k"], "left")
                .withColumn("users", F.coalesce(F.col("users"), F.lit(0))))


def hit_rate(recs: DataFrame, targets: DataFrame, k: int = 20, user: str = "uidx",
             item: str = "iidx", target: str = "true_item") -> DataFrame:
    """HR@k and single-target NDCG@k over the holdout item, no rating
    filter (EVAL5).  ``targets`` is ``(user, target)``, one row per user."""
    hit = (recs.where(F.col("rank") <= k).select(user, F.col(item).alias(target), "rank")
               .groupBy(user, target).agg(F.min("rank").alias("hit_rank")))
    t = targets.select(user, target).join(hit, [user, target], "left")
    return t.agg(F.avg(F.when(F.col("hit_rank").isNotNull(), 1.0).otherwise(0.0)).alias(f"hr_at_{k}"),
                 F.avg(F.coalesce(1.0 / F.log2(F.col("hit_rank") + 1), F.lit(0.0))).alias(f"ndcg_at_{k}"),
                 F.count(F.lit(1)).alias("users"))
