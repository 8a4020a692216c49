"""Filters and splits of interaction data (JON1-JON9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsight.functions.exprs import hash_uniform
from reelsight.operators.common import dense_index, exact_quantiles, global_rank
from reelsight.session import materialize


def active_users(df: DataFrame, n: int, user: str = "user_id", *more: Column) -> DataFrame:
    """Users with at least ``n`` rows, with the aggregates ``more``."""
    return df.groupBy(user).agg(F.count(F.lit(1)).alias("_n"), *more).where(F.col("_n") >= n).drop("_n")


def min_interactions(df: DataFrame, n: int = 5, user: str = "user_id") -> DataFrame:
    """Rows of users with at least ``n`` rows (JON1).

    A count per user (partial aggregation) and a semi join keep the rows
    thin; no per-row window over a possibly hot user."""
    return df.join(active_users(df, n, user), user, "left_semi")


def id_maps(df: DataFrame, user: str = "user_id", item: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """Contiguous 0..N-1 ids over sorted distinct users and items (JON2)."""
    return dense_index(df, user, "uidx"), dense_index(df, item, "iidx")


def reindex(df: DataFrame, n: int = 5, user: str = "user_id", item: str = "item_id",
            ts: str | None = None, owners: DataFrame | None = None, by: str | None = None,
            last_only: Sequence[str] = ()) -> DataFrame:
    """JON1 then JON2: keep active users and add ``uidx`` / ``iidx`` (JON15).

    ``df``, often a join, is read for the users (a count each) and for the
    rows, which meet their user's id in one join and are written; items and
    the result come from those files.  With ``ts``, rows also have
    ``is_last``: no row of the user with an item has a later time (none at all
    is the latest), for :func:`mark_last_item`; the columns ``last_only`` are
    then kept for these rows and null in the others.

    If a row's user stands in another table (an order's customer),
    ``owners`` is that table with the columns ``by`` and ``user``, and ``df``
    has ``by`` in place of ``user``.  Then the rows are counted for each
    ``by`` before they meet the owners, and the users' ids are dealt over the
    owners, not over the rows: the rows move once, to their owner."""
    if ts is None:
        counts = []
    else:  # numbers rather than a struct, so that Spark counts in a hash table
        back, has = -F.col(ts).cast("double"), F.col(item).isNotNull()
        counts = [F.min(F.when(has, back)).alias("_back"), F.max(has & F.col(ts).isNull()).alias("_none")]
    if owners is None:
        users = active_users(df, n, user, *counts)
    else:
        owned = df.groupBy(by).agg(F.count(F.lit(1)).alias("_n"), *counts).join(owners.select(by, user), by)
        more = [F.min("_back").alias("_back"), F.max("_none").alias("_none")] if counts else []
        users = owned.groupBy(user).agg(F.sum("_n").alias("_n"), *more).where(F.col("_n") >= n).drop("_n")
    users = materialize(users.where(F.col(user).isNotNull()), "users")
    known = global_rank(users, [F.col(user).asc()], "_r").withColumn("uidx", F.col("_r") - 1).drop("_r")
    if owners is None:
        rows = df.join(known, user)
    else:
        rows = df.join(owners.select(by, user).join(known, user).drop(user), by)
    if ts is not None:
        last = F.when(F.col("_none"), F.col(ts).isNull()).otherwise(F.coalesce(back == F.col("_back"), F.lit(False)))
        rows = rows.withColumn("is_last", last).drop("_back", "_none")
        rows = rows.withColumns({c: F.when(F.col("is_last"), F.col(c)) for c in last_only})
    rows = materialize(rows, "reindex")
    return rows.join(dense_index(rows, item, "iidx"), item)


def cutoff(df: DataFrame, q: float = 0.8, col: str = "timestamp") -> Column:
    """Time cutoff at quantile ``q`` (numpy's linear interpolation), truncated
    to an integer, as a constant; null without times (JON3)."""
    v = exact_quantiles(df, [col], [q])[col]
    return F.lit(None if v is None else int(v[0])).cast("bigint")


def chrono_split(df: DataFrame, q: float = 0.8, col: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """train = ``t <= cutoff``, test = ``t > cutoff`` (JON3)."""
    c = cutoff(df, q, col)
    return df.where(F.col(col) <= c), df.where(F.col(col) > c)


def eligible_overlap(train: DataFrame, test: DataFrame, user: str = "user_id",
                     item: str = "item_id") -> DataFrame:
    """Test rows whose user and item both occur in train (JON4)."""
    return (test.join(train.select(user).distinct(), user, "left_semi")
                .join(train.select(item).distinct(), item, "left_semi"))


def notebook_eligibility(train: DataFrame, test: DataFrame, min_train: int = 5,
                         user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Test rows of users with >= ``min_train`` train rows whose item occurs
    in train (JON5)."""
    users = (train.groupBy(user).agg(F.count(F.lit(1)).alias("_n"))
                  .where(F.col("_n") >= min_train).select(user))
    return test.join(users, user, "left_semi").join(train.select(item).distinct(), item, "left_semi")


def mark_last_item(df: DataFrame, order_cols: Sequence[str], user: str = "uidx", item: str = "iidx",
                   ts: str = "timestamp") -> DataFrame:
    """``df`` with ``is_test``: the latest row of each user (JON6).

    Ties on the latest time go to the earliest row in input order
    (``order_cols`` ascending); rows equal to it in all of them are marked, too.
    The pick is an aggregate (``min_by``), so a hot user's rows collapse
    map-side instead of being sorted in one task, and every row meets its
    user's pick in one join.  If ``df`` has ``is_last`` (from :func:`reindex`),
    only the rows of the latest times are aggregated and joined."""
    key = F.struct((-F.col(ts).cast("double")).alias("_t"), *[F.col(c) for c in order_cols])
    rows = df.where("is_last") if "is_last" in df.columns else df
    kept = [c for c in df.columns if c != "is_last"]
    picked = rows.groupBy(F.col(user).alias("_u")).agg(F.min_by(F.struct(*[F.col(c).alias(f"_o_{c}") for c in order_cols]), key).alias("_p"))
    same = F.lit(True)
    for c in order_cols:  # null-safe: the test row of a user without times is one, too
        same = same & F.col(c).eqNullSafe(F.col(f"_p._o_{c}"))
    found = rows.join(picked, F.col(user).eqNullSafe(F.col("_u"))).select(*kept, same.alias("is_test"))
    return found if rows is df else found.unionByName(df.where("not is_last").select(*kept, F.lit(False).alias("is_test")))


def held_out(marked: DataFrame, user: str = "uidx", item: str = "iidx", ts: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` of marked rows; ``test`` has one row (user,
    true_item, ts) a user."""
    latest = F.struct((-F.col(ts).cast("double")).alias("_t"))
    test = marked.where("is_test").groupBy(user).agg(
        F.min_by(F.struct(F.col(item).alias("true_item"), F.col(ts).alias(ts)), latest).alias("_p"))
    return marked.where("not is_test").drop("is_test"), test.select(user, "_p.*")


def last_item_holdout(df: DataFrame, order_cols: Sequence[str], user: str = "uidx",
                      item: str = "iidx", ts: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """Latest row per user is the test row, the rest is train (JON6); see
    :func:`mark_last_item`."""
    return held_out(mark_last_item(df, order_cols, user, item, ts), user, item, ts)


def sample_users(users: DataFrame, n: int, seed: int = 42, col: str = "uidx") -> DataFrame:
    """At most ``n`` users without replacement, chosen by a seeded hash
    (JON7).  The same ids come out of any engine with md5."""
    return (users.select(col).distinct()
                 .withColumn("_u", hash_uniform(seed, col))
                 .orderBy("_u", col).limit(n).drop("_u"))


def truth_sets(test: DataFrame, ratings: DataFrame, threshold: float = 3.5, user: str = "uidx",
               item: str = "iidx") -> DataFrame:
    """Holdout item joined to all of the user's ratings of that item,
    rating >= threshold (JON8).

    Long form ``(user, item, copies)``: the reference's truth list repeats an
    item once per matching rating, ``copies`` keeps that multiplicity without
    collecting lists."""
    r = ratings.select(F.col(user), F.col(item).alias("true_item"), "rating")
    return (test.select(user, "true_item").join(r, [user, "true_item"])
                .where(F.col("rating") >= threshold)
                .groupBy(user, F.col("true_item").alias(item))
                .agg(F.count(F.lit(1)).alias("copies")))


def exclude_seen(candidates: DataFrame, seen: DataFrame, user: str = "user_id",
                 item: str = "item_id") -> DataFrame:
    """Drop candidate (user, item) pairs the user has seen (JON9)."""
    return candidates.join(seen.select(user, item), [user, item], "left_anti")
