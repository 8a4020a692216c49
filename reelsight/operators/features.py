"""Per-user / per-item aggregates and dataset summaries (AGG1-AGG5,
AGG14-AGG16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsight.operators.common import global_cumsum, global_rank

# Activity bucket labels and bounds (< 10, 10-49, 50+).
COLD, WARM, HOT, UNKNOWN = "cold(<10)", "warm(10-49)", "hot(50+)", "unknown"


def user_activity(df: DataFrame, user: str = "user_id") -> DataFrame:
    return df.groupBy(user).agg(F.count(F.lit(1)).alias("n_events"))


def item_activity(df: DataFrame, item: str = "item_id") -> DataFrame:
    return df.groupBy(item).agg(F.count(F.lit(1)).alias("n_events"))


def popularity(df: DataFrame, item: str = "item_id") -> DataFrame:
    """Mean rating per item when ratings exist, else event count (AGG2);
    ``rank`` orders by score desc, ties by item id."""
    if "rating" in df.columns:
        scores = df.groupBy(item).agg(F.avg("rating").alias("score"))
    else:
        scores = df.groupBy(item).agg(F.count(F.lit(1)).cast("double").alias("score"))
    return global_rank(scores, [F.col("score").desc(), F.col(item).asc()], "rank")


def popularity_positive(df: DataFrame, threshold: float = 3.5, item: str = "item_id",
                        user: str = "user_id") -> DataFrame:
    """Count of positive rows (rating >= threshold) per item, ranked (AGG3).

    Output ``(item, pop_count, pos)`` with ``pos`` 1..N."""
    counts = (df.where(F.col("rating") >= threshold).groupBy(item)
                .agg(F.count(user).alias("pop_count")))
    return global_rank(counts, [F.col("pop_count").desc(), F.col(item).asc()], "pos")


def bucket_label(n: Column) -> Column:
    return (F.when(n < 10, F.lit(COLD)).when(n < 50, F.lit(WARM)).otherwise(F.lit(HOT)))


def activity_buckets(train: DataFrame, user: str = "uidx") -> DataFrame:
    """Bucket by all train rows per user (AGG4)."""
    return (train.groupBy(user).agg(F.count(F.lit(1)).alias("n_train"))
                 .withColumn("bucket", bucket_label(F.col("n_train"))))


def positive_buckets(train: DataFrame, users: DataFrame, threshold: float = 3.5,
                     user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Bucket by distinct positive train items; users without any are
    ``unknown`` (AGG5)."""
    pos = (train.where(F.col("rating") >= threshold).groupBy(user)
                .agg(F.countDistinct(item).alias("train_positives")))
    return (users.select(user).distinct().join(pos, user, "left")
                 .select(user, F.coalesce(F.col("train_positives"), F.lit(0)).alias("train_positives"),
                         F.when(F.col("train_positives").isNull(), F.lit(UNKNOWN))
                          .otherwise(bucket_label(F.col("train_positives"))).alias("bucket")))


def train_summary(df: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """rows, distinct users, distinct items (AGG15)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(user).alias("n_users"),
                  F.countDistinct(item).alias("n_items"))


def snapshot_id(train: DataFrame, test: DataFrame, cutoff: Column, user: str = "user_id",
                item: str = "item_id") -> DataFrame:
    """Dataset stats and their sha1 over key-sorted JSON (AGG14).

    The JSON text is built by hand to match Python's ``json.dumps(...,
    sort_keys=True)`` spacing (``", "`` and ``": "``)."""
    n_test = test.select(F.count(F.lit(1))).scalar()
    stats = train.agg(F.count(F.lit(1)).alias("n_train"), F.countDistinct(user).alias("n_users"),
                      F.countDistinct(item).alias("n_items"),
                      cutoff.cast("bigint").alias("cutoff_ts"), n_test.alias("n_test"))
    text = F.concat(F.lit('{"cutoff_ts": '), F.col("cutoff_ts").cast("string"),
                    F.lit(', "n_items": '), F.col("n_items").cast("string"),
                    F.lit(', "n_test": '), F.col("n_test").cast("string"),
                    F.lit(', "n_train": '), F.col("n_train").cast("string"),
                    F.lit(', "n_users": '), F.col("n_users").cast("string"), F.lit("}"))
    return stats.select("cutoff_ts", "n_train", "n_test", "n_users", "n_items",
                        F.sha1(F.encode(text, "UTF-8")).alias("data_snapshot_id"))


def auc(scores: DataFrame, y_true: str = "y_true", y_score: str = "y_score") -> DataFrame:
    """Exact ROC AUC with tie-averaged ranks (AGG16).

    Per distinct score: positives, negatives; AUC = sum over scores of
    ``pos * (negatives below + negatives equal / 2)`` / (P * N)."""
    g = (scores.groupBy(y_score)
               .agg(F.sum(F.col(y_true).cast("bigint")).alias("pos"),
                    F.sum((1 - F.col(y_true)).cast("bigint")).alias("neg")))
    c = global_cumsum(g, [F.col(y_score).asc()], "neg", "neg_below")
    return c.agg(F.try_divide(F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") * 0.5)),
                              F.sum("pos").cast("double") * F.sum("neg")).alias("auc"),
                 F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
