"""Exposure, concentration and fairness (AGG9-AGG13, JON13, EVAL8-EVAL10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsight.functions.exprs import ideal_dcg
from reelsight.operators.common import global_rank
from reelsight.operators.features import COLD, WARM

TIERS = ("Head", "Mid", "Tail")
S1_LIMIT = 0.40          # fixed value: maximum tier share allowed
FAIR_RATIO_MIN = 0.70    # fixed value: cold / warm NDCG ratio required


def item_counts(events: DataFrame, item: str = "movie_id") -> DataFrame:
    return (events.where(F.col(item).isNotNull()).groupBy(item)
                  .agg(F.count(F.lit(1)).alias("watches")))


def top_share_exposure(events: DataFrame, item: str = "movie_id", share: float = 0.05) -> DataFrame:
    """Share of all events that fall on the top ``max(1, int(share *
    distinct))`` items (AGG9).  One row: total, distinct, n_top, top_events,
    exposure.  The top sum does not depend on how ties are broken."""
    counts = item_counts(events, item)
    ranked = global_rank(counts, [F.col("watches").desc(), F.col(item).asc()], "_r")
    stats = ranked.agg(F.sum("watches").alias("total_watches"), F.count(F.lit(1)).alias("distinct_items"))
    n = counts.select(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) * F.lit(share))).cast("bigint")).scalar()
    top = ranked.where(F.col("_r") <= n).select(F.sum("watches")).scalar()
    return stats.select("total_watches", "distinct_items", n.alias("n_top"), top.alias("top_watches"),
                        (top / F.col("total_watches")).alias("exposure"))


def top_share_exposure_daily(events: DataFrame, day: Column, item: str = "movie_id",
                             share: float = 0.05) -> DataFrame:
    """AGG9 per calendar day (AGG10); rows without a day are skipped."""
    per = (events.where(F.col(item).isNotNull()).withColumn("day", day).where(F.col("day").isNotNull())
                 .groupBy("day", item).agg(F.count(F.lit(1)).alias("watches")))
    return daily_top_share(per, item, share)


def daily_top_share(per: DataFrame, item: str = "movie_id", share: float = 0.05) -> DataFrame:
    """Top-share exposure from ``(day, item, watches)`` counts.

    Items are numbered over all days at once, in the order (day, watches
    descending, item); a day's items are a run of numbers, so its top ones
    need no window over the day."""
    ranked = global_rank(per, [F.col("day"), F.col("watches").desc(), F.col(item)], "_r")
    days = ranked.groupBy("day").agg(F.min("_r").alias("_first"), F.sum("watches").alias("total_watches"),
                                     F.count(F.lit(1)).alias("distinct_items"))
    n = F.greatest(F.lit(1), F.floor(F.col("distinct_items") * F.lit(share)))
    top = (ranked.join(days.select("day", (F.col("_first") + n).alias("_end")), "day").where(F.col("_r") < F.col("_end"))
                 .groupBy("day").agg(F.sum("watches").alias("top_watches")))
    return (days.drop("_first").join(top, "day")
                .select("day", "total_watches", "distinct_items", "top_watches",
                        (F.col("top_watches") / F.col("total_watches")).alias("exposure")))


def top_items(events: DataFrame, n: int = 10, item: str = "movie_id") -> DataFrame:
    """The ``n`` most watched items, ties by item id (AGG11) – a top-k
    report, planned as TakeOrderedAndProject."""
    return item_counts(events, item).orderBy(F.col("watches").desc(), F.col(item).asc()).limit(n)


def freq_topn(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    """Normalised frequency of the ``n`` most common values (AGG12); nulls
    neither count nor rank."""
    df = df.where(F.col(col).isNotNull())
    total = df.select(F.count(F.lit(1))).scalar()
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))
              .orderBy(F.col("cnt").desc(), F.col(col).asc()).limit(n)
              .select(F.col(col).cast("string").alias("value"), (F.col("cnt") / total).alias("freq")))


def freq_align(ref: DataFrame, cur: DataFrame, key: str = "value", val: str = "freq") -> DataFrame:
    """Two frequency tables on the union of their keys, missing -> 0 (JON13)."""
    a = ref.select(F.col(key), F.col(val).alias("ref"))
    b = cur.select(F.col(key), F.col(val).alias("cur"))
    return a.join(b, key, "full_outer").select(key, F.coalesce("ref", F.lit(0.0)).alias("ref"),
                                               F.coalesce("cur", F.lit(0.0)).alias("cur"))


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width density histogram between min and max (AGG13): the last
    bin is closed; ``density = count / (n * width)``.  A constant column is
    spread over [v - 0.5, v + 0.5], as numpy does; a column without values
    has null edges and density, and counts of 0."""
    x = F.col(col).cast("double")
    same = F.min(x) == F.max(x)
    st = df.select(F.struct((F.min(x) - F.when(same, 0.5).otherwise(0.0)).alias("lo"),
                            (F.max(x) + F.when(same, 0.5).otherwise(0.0)).alias("hi"), F.count(x).alias("n"))).scalar()
    lo, hi, n = st.getField("lo"), st.getField("hi"), st.getField("n")
    width = (hi - lo) / F.lit(bins)
    b = F.least(F.floor((x - lo) / width), F.lit(bins - 1)).cast("int")
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = counts.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
                .select("bin", (lo + F.col("bin") * width).alias("lo"), (lo + (F.col("bin") + 1) * width).alias("hi"),
                        F.coalesce(F.col("count"), F.lit(0)).alias("count"))
                .withColumn("density", F.try_divide(F.col("count").cast("double"), n * width)))


def exposure_by_tier(recs: DataFrame, tiers: DataFrame, item: str = "item_id") -> DataFrame:
    """Share of recommendation slots per popularity tier, all three tiers
    present (EVAL8); without any slot the shares are 0.  Slots are counted per
    item before the tiers are joined, so popular items meet as one row."""
    per = recs.groupBy(item).agg(F.count(F.lit(1)).alias("_c"))
    t = (per.join(tiers.select(item, "tier"), item, "left")
            .withColumn("tier", F.coalesce(F.col("tier"), F.lit("Tail"))))
    counts = t.groupBy("tier").agg(F.sum("_c").alias("slots"))
    total = F.coalesce(counts.select(F.sum("slots")).scalar(), F.lit(0))
    grid = recs.sparkSession.createDataFrame([(x,) for x in TIERS], "tier string")
    return (grid.join(counts, "tier", "left")
                .select("tier", F.coalesce(F.col("slots"), F.lit(0)).alias("slots"),
                        F.coalesce(F.try_divide(F.coalesce(F.col("slots"), F.lit(0)).cast("double"), total), F.lit(0.0))
                         .alias("share")))


def exposure_s1(shares: DataFrame, limit: float = S1_LIMIT) -> DataFrame:
    """Requirement S1: the largest tier share is at most ``limit`` (EVAL9)."""
    return shares.agg(F.max("share").alias("max_share")).withColumn("s1_met", F.col("max_share") <= limit)


def ndcg_set(recs: DataFrame, truth: DataFrame, k: int, user: str = "user_id",
             item: str = "item_id") -> DataFrame:
    """Per user with non-empty truth set: NDCG@k (set semantics)."""
    tset = truth.select(user, item).distinct()
    tlen = tset.groupBy(user).agg(F.count(F.lit(1)).alias("_tl"))
    hits = (recs.where(F.col("rank") <= k).join(tset.withColumn("_h", F.lit(1)), [user, item], "inner")
                .groupBy(user).agg(F.sum(1.0 / F.log2(F.col("rank") + 1)).alias("_dcg")))
    ideal = ideal_dcg(F.least(F.col("_tl"), F.lit(k)))
    return (tlen.join(hits, user, "left")
                .select(user, (F.coalesce(F.col("_dcg"), F.lit(0.0)) / ideal).alias("ndcg")))


def fair_ndcg_by_bucket(base: DataFrame, fair: DataFrame, truth: DataFrame, buckets: DataFrame,
                        k: int = 10, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Mean NDCG@k of two recommenders per user bucket (EVAL10), plus the
    cold/warm ratio of the second (null when warm is 0 or missing)."""
    nb = ndcg_set(base, truth, k, user, item).withColumnRenamed("ndcg", "ndcg_base")
    nf = ndcg_set(fair, truth, k, user, item).withColumnRenamed("ndcg", "ndcg_fair")
    per = (nb.join(nf, user).join(buckets.select(user, "bucket"), user, "left")
             .withColumn("bucket", F.coalesce(F.col("bucket"), F.lit("unknown"))))
    summary = per.groupBy("bucket").agg(F.avg("ndcg_base").alias("ndcg_base"),
                                        F.avg("ndcg_fair").alias("ndcg_fair"),
                                        F.count(F.lit(1)).alias("users"))
    cold = summary.where(F.col("bucket") == COLD).select(F.max("ndcg_fair")).scalar()
    warm = summary.where(F.col("bucket") == WARM).select(F.max("ndcg_fair")).scalar()
    ratio = F.when(warm > 0, cold / warm)
    return summary.withColumn("cold_warm_ratio", ratio).withColumn("m1_met", F.coalesce(ratio >= FAIR_RATIO_MIN,
                                                                                          F.lit(False)))
