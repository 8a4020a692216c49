"""Non-learned recommenders and re-ranking (REC5-REC7, REC9-REC11).

The popularity recommender returns, for each user, the first ``k`` items of
a global ranking the user has not seen.  A naive plan pairs every user with
the top ``k + max_seen`` items, which explodes when one user has seen a large
part of the catalogue.  Here the answer is computed exactly from the user's
own seen positions:

with the user's seen ranking positions sorted ``s_1 < s_2 < ...``, the
number of unseen positions before ``s_i`` is ``s_i - i``.  So the unseen
positions between ``s_i`` and ``s_(i+1)`` have the ranks ``pos - i``, and only
those up to ``k + i`` belong to the list (``s_0`` = 0).  Each seen position
with ``s_i - i < k`` gives the range that follows it; a user's ranges hold
``k`` positions in all, ranks included, whatever the user has seen.

A user with ``n`` seen rows can reach no position beyond ``k + n``; seen rows
further down are left out before users are grouped.  The index ``i`` is
computed in two bounded steps: a count per (user, block of positions) with a
running sum over the user's blocks (at most catalogue/B rows per user), and
a row number inside each (user, block) (at most B rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsight.operators.common import global_rank
from reelsight.session import materialize

BLOCK = 256
SPREAD = 32
#: Positions of the ranking that are sent to all tasks, list rows expanded in one task.
SMALL = 100_000
EXPAND = 500_000

# Cold-service fallback list and fair re-rank parameters.
FALLBACK_ITEMS = (50, 172, 1, 99, 87)
FAIR_CANDIDATE_MULT = 5
FAIR_BETA_POP = 0.7
FAIR_TAIL_BOOST = 0.3
HEAD_SHARE, MID_SHARE = 0.2, 0.5


def popularity_recs(users: DataFrame, seen: DataFrame, ranking: DataFrame, k: int,
                    user: str = "user_id", item: str = "item_id", pos: str = "pos",
                    carry: Sequence[str] = ()) -> DataFrame:
    """Top-``k`` unseen ranked items per user: ``(user, rank, item, pos)``
    (REC7) and the columns ``carry`` of ``ranking``.

    ``ranking`` is ``(item, pos)`` with positions 1..N; ``seen`` holds
    ``(user, item)`` pairs (duplicates allowed); ``users`` the users to serve.
    Users who have seen almost everything get fewer than ``k`` items.
    """
    k = int(k)
    rows = seen.groupBy(user).agg(F.count(F.lit(1)).alias("_n"))
    served = materialize(users.select(user).distinct().join(rows, user, "left")
                              .select(user, F.coalesce(F.col("_n"), F.lit(0)).alias("_n")), "served")
    many, most = served.agg(F.count(F.lit(1)), F.max("_n")).first()
    reach = k + (most or 0)
    few = reach <= SMALL  # then the positions that lists can reach are sent to the users
    send = F.broadcast if few else (lambda df: df)
    rk = ranking.select(item, pos, *carry)
    n_items = ranking.select(F.count(F.lit(1))).first()[0]
    rk = rk.where(F.col(pos) <= reach)
    sp = (seen.select(user, item).join(send(rk.select(item, pos)), item).join(served, user)
              .where(F.col(pos) <= k + F.col("_n")).select(user, pos).distinct()
              .withColumn("_blk", F.floor((F.col(pos) - 1) / BLOCK)))
    of_user = Window.partitionBy(user).orderBy("_blk")
    per_blk = (sp.groupBy(user, "_blk").agg(F.count(F.lit(1)).alias("_c"), F.min(pos).alias("_first"))
                 .withColumn("_before", F.coalesce(F.sum("_c").over(of_user.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                 .withColumn("_after", F.lead("_first").over(of_user)))
    in_blk = Window.partitionBy(user, "_blk").orderBy(pos)
    idx = (sp.withColumn("_in", F.row_number().over(in_blk)).withColumn("_next", F.lead(pos).over(in_blk))
             .join(per_blk.select(user, "_blk", "_before", "_after"), [user, "_blk"])
             .select(user, F.col(pos).cast("bigint").alias("_s"), (F.col("_before") + F.col("_in")).alias("_i"),
                     F.coalesce("_next", "_after").cast("bigint").alias("_next")))
    # a user's list starts before its first seen position (the row of index 0)
    first = sp.groupBy(user).agg(F.min(pos).cast("bigint").alias("_next"))
    starts = served.select(user).join(first, user, "left").select(
        user, F.lit(0).cast("bigint").alias("_s"), F.lit(0).cast("bigint").alias("_i"), "_next")
    ranges = (starts.unionByName(idx.where(F.col("_s") - F.col("_i") < k))
                    .select(user, "_i", (F.col("_s") + 1).alias("_lo"),
                            F.least(F.col("_next") - 1, F.col("_i") + k, F.lit(n_items).cast("bigint")).alias("_hi"))
                    .where(F.col("_lo") <= F.col("_hi")))
    # the small ranges are dealt before they are expanded, a user in one place for the windows that follow
    ranked = (ranges.repartition(1 + many * k // EXPAND, user)
                    .select(user, "_i", F.explode(F.sequence("_lo", "_hi")).alias(pos))
                    .select(user, (F.col(pos) - F.col("_i")).cast("int").alias("rank"), pos))
    if few:
        return ranked.join(F.broadcast(rk), pos).select(user, "rank", item, pos, *carry)
    # all users share about the first k positions: each position is entered SPREAD times, and
    # users are dealt over the entries
    top = rk.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    dealt = ranked.withColumn("_s", F.pmod(F.xxhash64(user), F.lit(SPREAD)).cast("int"))
    return dealt.join(top, [pos, "_s"]).select(user, "rank", item, pos, *carry)


def popularity_tiers(ranking: DataFrame, item: str = "item_id", pos: str = "pos") -> DataFrame:
    """Head = first int(0.2 n) positions, Mid up to int(0.5 n), Tail the
    rest (REC10).  Items missing from the ranking count as Tail."""
    n = ranking.select(F.count(F.lit(1))).scalar()
    head = F.floor(n * F.lit(HEAD_SHARE))
    mid = F.floor(n * F.lit(MID_SHARE))
    return ranking.select(item, pos, F.when(F.col(pos) <= head, "Head").when(F.col(pos) <= mid, "Mid")
                          .otherwise("Tail").alias("tier"))


def pop_norm(counts: DataFrame, count_col: str = "pop_count") -> Column:
    """``(c - min) / (max - min + 1e-9)`` as a column over ``counts`` (REC11)."""
    stats = counts.select(F.struct(F.min(count_col).alias("lo"), F.max(count_col).alias("hi"))).scalar()
    lo, hi = stats.getField("lo"), stats.getField("hi")
    return (F.col(count_col) - lo) / (hi - lo + F.lit(1e-9))


def fair_rerank(users: DataFrame, seen: DataFrame, ranking: DataFrame, k: int,
                user: str = "user_id", item: str = "item_id",
                candidate_mult: int = FAIR_CANDIDATE_MULT, beta_pop: float = FAIR_BETA_POP,
                tail_boost: float = FAIR_TAIL_BOOST, cands: DataFrame | None = None) -> DataFrame:
    """Popularity candidates (k * mult) re-scored as
    ``1/rank - beta * pop_norm + boost * [Tail]``, best k kept; ties keep
    the base order (REC9).  ``ranking`` needs ``(item, pos, pop_count)``;
    ``cands`` are the popularity candidates, if they exist already.  Else the
    items carry their popularity and tier into the lists."""
    norm = ranking.select(item, "pos", F.when(F.col(item).isNotNull(), pop_norm(ranking)).alias("_pn"))
    known = norm.join(popularity_tiers(ranking, item).select(item, "tier"), item, "left")
    if cands is None:
        cands = popularity_recs(users, seen, known, k * candidate_mult, user, item, carry=("_pn", "tier"))
    else:
        cands = cands.join(known.select(item, "_pn", "tier"), item, "left")
    scored = (cands.withColumn("_score", F.lit(1.0) / F.col("rank")
                              - F.lit(beta_pop) * F.coalesce(F.col("_pn"), F.lit(0.0))
                              + F.when(F.col("tier") == "Tail", F.lit(tail_boost)).otherwise(F.lit(0.0))))
    w = Window.partitionBy(user).orderBy(F.col("_score").desc(), F.col("rank").asc())
    return (scored.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
                  .select(user, F.col("_r").alias("rank"), item))


def factor_norm_rank(factors: DataFrame, id_col: str = "item", features: str = "features") -> DataFrame:
    """Cold-start ranking: items by L2 norm of their factor vector, largest
    first, ties by id (REC5)."""
    norm = F.sqrt(F.aggregate(F.col(features), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return global_rank(factors.select(id_col, norm.alias("norm")),
                       [F.col("norm").desc(), F.col(id_col).asc()], "rank")


def recommend_fallback(requests: DataFrame, scored: DataFrame | None, cold: DataFrame | None, k: int,
                       user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Fallback chain per request (REC6): the user's scored list when the
    model knows the user, else the cold-start ranking, else (no model) the
    fixed list.  ``scored`` is ``(user, rank, item)``, ``cold`` is
    ``(rank, item)``; k is clamped to [0, catalogue size].

    Output ``(user, source, items)`` where ``items`` is ordered by rank; the
    lists are at most k long, so the per-user collect is bounded by k.
    """
    k = max(int(k), 0)
    req = requests.select(user).distinct()
    fixed = F.slice(F.array(*[F.lit(x).cast("bigint") for x in FALLBACK_ITEMS]), 1, min(k, len(FALLBACK_ITEMS)))
    if scored is None or cold is None:
        return req.select(user, F.lit("fallback").alias("source"), fixed.alias("items"))
    s = (scored.where(F.col("rank") <= k).groupBy(user)
               .agg(F.sort_array(F.collect_list(F.struct("rank", F.col(item).cast("bigint").alias("i"))))
                    .alias("_s")))
    cold_items = (cold.where(F.col("rank") <= k)
                      .select(F.transform(F.sort_array(F.collect_list(
                          F.struct("rank", F.col(item).cast("bigint").alias("i")))), lambda x: x["i"]))
                      .scalar())
    j = req.join(s, user, "left")
    return j.select(user,
                    F.when(F.col("_s").isNotNull(), F.lit("model")).otherwise(F.lit("cold")).alias("source"),
                    F.when(F.col("_s").isNotNull(), F.transform("_s", lambda x: x["i"]))
                     .otherwise(cold_items).alias("items"))
