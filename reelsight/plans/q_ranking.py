"""Offline ranking evaluation, popularity / fair recommenders, exposure and
fairness plans (REC7, REC9-11, EVAL1-10, AGG9-13, JON13).

Offline flow (the reference's offline evaluation, with the deterministic
popularity recommender standing in for ALS so an SQL oracle exists):
ratings -> users with >= 5 rows + dense ids -> last-item holdout -> truth
(holdout item, rating >= 3.5) -> top-20 popular unseen items of every user
with truth -> precision / recall / NDCG / MAP at 5, 10, 20; hit rate over
every user with a holdout item.

Fairness flow (the notebook's fairness cells): 0.8-quantile time split,
popularity of positive train rows, base top-k vs. fair re-rank.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from reelsight.functions.exprs import event_day
from reelsight.operators import exposure, features, ranking, recommend, splits
from reelsight.plans.oracle_views import add_view, with_views
from reelsight.plans.q_prep import ORDER, ORDER_SQL, ratings
from reelsight.plans.registry import register, rounded
from reelsight.session import materialize
from reelsight.sources import testdata as td

KS = (5, 10, 20)

# ------------------------------------------------------------ oracle views --
add_view("off_keep", """
    SELECT * FROM ratings
    WHERE user_id IN (SELECT user_id FROM ratings GROUP BY user_id HAVING count(*) >= 5)""", ("ratings",))
add_view("off_d", """
    SELECT k.*, um.uidx, im.iidx FROM off_keep k
    JOIN (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS uidx
          FROM (SELECT DISTINCT user_id FROM off_keep)) um USING (user_id)
    JOIN (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS iidx
          FROM (SELECT DISTINCT item_id FROM off_keep)) im USING (item_id)""", ("off_keep",))
add_view("off_h", f"""
    SELECT *, row_number() OVER (PARTITION BY uidx ORDER BY "timestamp" DESC, {ORDER_SQL}) AS rn
    FROM off_d""", ("off_d",))
add_view("off_train", "SELECT * FROM off_h WHERE rn > 1", ("off_h",))
add_view("off_test", "SELECT uidx, iidx AS true_item FROM off_h WHERE rn = 1", ("off_h",))
add_view("off_truth", """
    SELECT t.uidx, t.true_item AS iidx, count(*) AS copies
    FROM off_test t JOIN off_d d ON d.uidx = t.uidx AND d.iidx = t.true_item
    WHERE d.rating >= 3.5 GROUP BY t.uidx, t.true_item""", ("off_test", "off_d"))
add_view("off_eu", "SELECT DISTINCT uidx FROM off_truth", ("off_truth",))
add_view("off_rank", """
    SELECT iidx, pop_count, row_number() OVER (ORDER BY pop_count DESC, iidx) AS pos
    FROM (SELECT iidx, count(*) AS pop_count FROM off_train WHERE rating >= 3.5 GROUP BY iidx)""",
         ("off_train",))
add_view("off_all_recs", """
    SELECT uidx, iidx, rank, pos FROM (
      SELECT e.uidx, r.iidx, r.pos, row_number() OVER (PARTITION BY e.uidx ORDER BY r.pos) AS rank
      FROM off_test e CROSS JOIN off_rank r
      WHERE NOT EXISTS (SELECT 1 FROM off_train t WHERE t.uidx = e.uidx AND t.iidx = r.iidx)) x
    WHERE rank <= 20""", ("off_test", "off_rank", "off_train"))
add_view("off_recs", "SELECT * FROM off_all_recs WHERE uidx IN (SELECT uidx FROM off_eu)", ("off_all_recs", "off_eu"))
add_view("ideal", """
    SELECT i AS n, sum(1.0 / log2(i + 1)) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) AS idcg
    FROM range(1, 101) t(i)""")


def metrics_view(name: str, recs: str, truth: str, users: str, user: str, item: str,
                 truth_len: str = "sum(copies)", denominator: str = "k") -> None:
    """Per (user, k) metrics view in DuckDB text, the definition of EVAL1-4."""
    prec = ("CASE WHEN k <= 0 THEN 0.0 ELSE hits / k END" if denominator == "k" else
            "CASE WHEN k <= 0 OR least(k, n_recs) = 0 THEN 0.0 ELSE hits / least(k, n_recs) END")
    add_view(name, f"""
    WITH tl AS (SELECT {user}, {truth_len} AS truth_len, count(DISTINCT {item}) AS truth_distinct
                FROM {truth} GROUP BY {user}),
    rh AS (SELECT r.{user}, r.rank, CASE WHEN t.{item} IS NULL THEN 0 ELSE 1 END AS hit,
                  count(*) OVER (PARTITION BY r.{user}) AS n_recs
           FROM (SELECT * FROM {recs} WHERE rank <= {max(KS)}) r
           LEFT JOIN (SELECT DISTINCT {user}, {item} FROM {truth}) t
             ON t.{user} = r.{user} AND t.{item} = r.{item}),
    rc AS (SELECT *, sum(hit) OVER (PARTITION BY {user} ORDER BY rank ROWS UNBOUNDED PRECEDING) AS cum FROM rh),
    ks AS (SELECT unnest({list(KS)}) AS k),
    per AS (SELECT u.{user}, ks.k, coalesce(sum(rc.hit), 0) AS hits,
                   coalesce(sum(rc.hit / log2(rc.rank + 1)), 0.0) AS dcg,
                   coalesce(sum(CASE WHEN rc.hit = 1 THEN rc.cum / rc.rank ELSE 0.0 END), 0.0) AS ap_num,
                   coalesce(max(rc.n_recs), 0) AS n_recs
            FROM (SELECT DISTINCT {user} FROM {users}) u CROSS JOIN ks
            LEFT JOIN rc ON rc.{user} = u.{user} AND rc.rank <= ks.k
            GROUP BY u.{user}, ks.k)
    SELECT per.{user}, per.k,
           {prec} AS precision,
           CASE WHEN coalesce(truth_len, 0) = 0 THEN 0.0 ELSE hits / truth_len END AS recall,
           CASE WHEN coalesce(i.idcg, 0) = 0 THEN 0.0 ELSE dcg / i.idcg END AS ndcg,
           CASE WHEN coalesce(truth_distinct, 0) = 0 THEN 0.0 ELSE ap_num / least(truth_distinct, k) END AS map
    FROM per LEFT JOIN tl ON tl.{user} = per.{user}
    LEFT JOIN ideal i ON i.n = least(coalesce(tl.truth_len, 0), per.k)""", (recs, truth, users, "ideal"))


metrics_view("off_metrics", "off_recs", "off_truth", "off_eu", "uidx", "iidx")
metrics_view("off_metrics_svc", "off_recs", "off_truth", "off_eu", "uidx", "iidx",
             truth_len="count(DISTINCT iidx)", denominator="returned")


# ----------------------------------------------------------- spark flows --

class Offline:
    """The offline flow, built as far as a query needs it.  The re-indexed
    ratings with their mark of train or test are written (all later steps read
    them); times and the columns that only order rows are kept where they
    decide the mark."""

    def __init__(self, spark, sf):
        rows = td.rated_lines(spark, sf).withColumnRenamed("ts", "timestamp")
        rows = splits.reindex(rows, 5, ts="timestamp", owners=td.order_users(spark, sf), by="l_orderkey",
                              last_only=[c for c in ORDER if c != "item_id"])
        marked = splits.mark_last_item(rows, ORDER)
        marked = materialize(marked.select("uidx", "iidx", "rating", "timestamp", "is_test"), "offline-d")
        self.d = marked.select("uidx", "iidx", "rating")
        train, self.test = splits.held_out(marked)
        self.train = train.drop("timestamp")

    @cached_property
    def truth(self):
        """Written: lists, truth lengths and hits start from it."""
        return materialize(splits.truth_sets(self.test, self.d, 3.5), "truth")

    @cached_property
    def users(self):
        """All users with truth."""
        return self.truth.select("uidx").distinct()

    @cached_property
    def ranking(self):
        return features.popularity_positive(self.train, 3.5, item="iidx", user="uidx")

    def popular(self, users):
        return recommend.popularity_recs(users, self.train, self.ranking, max(KS), user="uidx", item="iidx")

    @cached_property
    def recs(self):
        return self.popular(self.users)


def offline_metrics(spark, sf, service: bool = False):
    p = Offline(spark, sf)
    if service:
        return ranking.user_metrics(p.recs, p.truth, KS, precision_denominator="returned",
                                    truth_as_list=False, users=p.users)
    return ranking.user_metrics(p.recs, p.truth, KS, users=p.users)


@register("recommend_popularity", with_views("SELECT uidx, rank, iidx FROM off_recs", "off_recs"),
          ids=("REC7", "JON9"))
def q_recommend_popularity(spark, sf):
    return Offline(spark, sf).recs.select("uidx", F.col("rank").cast("bigint").alias("rank"), "iidx")


for _key, _metric, _svc, _ids in (("precision_at_k", "precision", False, ("EVAL1",)),
                                  ("precision_at_k_returned", "precision", True, ("EVAL1",)),
                                  ("recall_at_k", "recall", False, ("EVAL2",)),
                                  ("recall_at_k_set", "recall", True, ("EVAL2",)),
                                  ("ndcg_at_k", "ndcg", False, ("EVAL3",)),
                                  ("map_at_k", "map", False, ("EVAL4",))):
    def _make(metric=_metric, svc=_svc):
        def q(spark, sf):
            m = offline_metrics(spark, sf, svc)
            return rounded(m.select("uidx", F.col("k").cast("int").alias("k"), metric))
        return q
    register(_key, with_views(
        f"SELECT uidx, CAST(k AS INTEGER) AS k, round({_metric}, 6) AS {_metric} FROM "
        f"{'off_metrics_svc' if _svc else 'off_metrics'}", "off_metrics_svc" if _svc else "off_metrics"),
        ids=_ids)(_make())


@register("offline_overall", with_views("""
SELECT CAST(k AS INTEGER) AS k, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall,
       round(avg(ndcg), 6) AS ndcg, round(avg(map), 6) AS map, count(*) AS users
FROM off_metrics GROUP BY k""", "off_metrics"), ids=("EVAL6", "SNK3"))
def q_offline_overall(spark, sf):
    return rounded(ranking.overall(offline_metrics(spark, sf), KS).withColumn("k", F.col("k").cast("int")))


@register("offline_by_bucket", with_views("""
WITH b AS (SELECT uidx, CASE WHEN count(*) < 10 THEN 'cold(<10)' WHEN count(*) < 50 THEN 'warm(10-49)'
                             ELSE 'hot(50+)' END AS bucket FROM off_train GROUP BY uidx),
g AS (SELECT * FROM (SELECT unnest(['cold(<10)', 'warm(10-49)', 'hot(50+)']) AS bucket) x
      CROSS JOIN (SELECT unnest([5, 10, 20]) AS k) y),
a AS (SELECT b.bucket, m.k, avg(precision) AS precision, avg(recall) AS recall, avg(ndcg) AS ndcg,
             avg(map) AS map, count(*) AS users
      FROM off_metrics m JOIN b ON b.uidx = m.uidx GROUP BY b.bucket, m.k)
SELECT g.bucket, CAST(g.k AS INTEGER) AS k, round(a.precision, 6) AS precision, round(a.recall, 6) AS recall,
       round(a.ndcg, 6) AS ndcg, round(a.map, 6) AS map, coalesce(a.users, 0) AS users
FROM g LEFT JOIN a ON a.bucket = g.bucket AND a.k = g.k""", "off_metrics", "off_train"), ids=("EVAL7", "AGG4"))
def q_offline_by_bucket(spark, sf):
    p = Offline(spark, sf)
    m = ranking.user_metrics(p.recs, p.truth, KS, users=p.users)
    b = features.activity_buckets(p.train, "uidx")
    out = ranking.by_bucket(m, b, "uidx", (features.COLD, features.WARM, features.HOT))
    return rounded(out.withColumn("k", F.col("k").cast("int")))


@register("hr_at_k", with_views("""
WITH h AS (SELECT r.uidx, min(r.rank) AS hit_rank FROM off_all_recs r JOIN off_test t
             ON t.uidx = r.uidx AND t.true_item = r.iidx GROUP BY r.uidx)
SELECT round(avg(CASE WHEN h.hit_rank IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS hr_at_20,
       round(avg(coalesce(1.0 / log2(h.hit_rank + 1), 0.0)), 6) AS ndcg_at_20, count(*) AS users
FROM off_test t LEFT JOIN h ON h.uidx = t.uidx""",
    "off_all_recs", "off_test"), ids=("EVAL5",))
def q_hr_at_k(spark, sf):
    p = Offline(spark, sf)
    return rounded(ranking.hit_rate(p.popular(p.test.select("uidx")), p.test, 20))


# ---------------------------------------------------------- fairness flow --
add_view("fair_train", "SELECT * FROM split WHERE is_train", ("split",))
add_view("fair_test", "SELECT * FROM split WHERE NOT is_train", ("split",))
add_view("fair_users", "SELECT DISTINCT user_id FROM fair_test", ("fair_test",))
add_view("fair_rank", """
    SELECT item_id, pop_count, row_number() OVER (ORDER BY pop_count DESC, item_id) AS pos
    FROM (SELECT item_id, count(*) AS pop_count FROM fair_train WHERE rating >= 3.5 GROUP BY item_id)""",
         ("fair_train",))
add_view("fair_cand", """
    SELECT e.user_id, r.item_id, r.pos, r.pop_count,
           row_number() OVER (PARTITION BY e.user_id ORDER BY r.pos) AS rank
    FROM fair_users e CROSS JOIN fair_rank r
    WHERE NOT EXISTS (SELECT 1 FROM fair_train t WHERE t.user_id = e.user_id AND t.item_id = r.item_id)""",
         ("fair_users", "fair_rank", "fair_train"))
add_view("fair_tier", """
    SELECT item_id, CASE WHEN pos <= floor(0.2 * n) THEN 'Head' WHEN pos <= floor(0.5 * n) THEN 'Mid'
                         ELSE 'Tail' END AS tier,
           (pop_count - mn) / (mx - mn + 1e-9) AS pn
    FROM fair_rank, (SELECT count(*) AS n, min(pop_count) AS mn, max(pop_count) AS mx FROM fair_rank) s""",
         ("fair_rank",))
add_view("fair_base", "SELECT user_id, item_id, rank FROM fair_cand WHERE rank <= 20", ("fair_cand",))


def _fair_sql(k: int) -> str:
    return f"""
    SELECT user_id, item_id, rn AS rank FROM (
      SELECT c.user_id, c.item_id, row_number() OVER (
               PARTITION BY c.user_id
               ORDER BY 1.0 / c.rank - 0.7 * t.pn + CASE WHEN t.tier = 'Tail' THEN 0.3 ELSE 0.0 END DESC,
                        c.rank) AS rn
      FROM fair_cand c JOIN fair_tier t ON t.item_id = c.item_id
      WHERE c.rank <= {k * 5}) x
    WHERE rn <= {k}"""


add_view("fair_fair", _fair_sql(20), ("fair_cand", "fair_tier"))
add_view("fair_base10", "SELECT user_id, item_id, rank FROM fair_cand WHERE rank <= 10", ("fair_cand",))
add_view("fair_fair10", _fair_sql(10), ("fair_cand", "fair_tier"))


def fair_parts(spark, sf):
    """The fairness flow's split (written once) and ranking."""
    train, test = split_tables(spark, sf)
    users = test.select("user_id").distinct()
    rank = features.popularity_positive(train, 3.5)
    return dict(train=train, test=test, users=users, ranking=rank)


def split_tables(spark, sf):
    """0.8-quantile time split written once with a flag; train and test are
    filters on that table (pushed into the parquet scan)."""
    r = ratings(spark, sf).select("user_id", "item_id", "rating", "timestamp")
    flagged = materialize(r.withColumn("is_train", F.col("timestamp") <= splits.cutoff(r, 0.8)), "split")
    return (flagged.where(F.col("is_train")).drop("is_train"), flagged.where(~F.col("is_train")).drop("is_train"))


@register("popularity_tiers", with_views("""
SELECT item_id, tier, count(*) OVER (PARTITION BY tier) AS tier_size FROM fair_tier""", "fair_tier"),
    ids=("REC10", "REC11"))
def q_popularity_tiers(spark, sf):
    t = recommend.popularity_tiers(fair_parts(spark, sf)["ranking"])
    sizes = t.groupBy("tier").agg(F.count(F.lit(1)).alias("tier_size"))
    return t.select("item_id", "tier").join(sizes, "tier")


@register("recommend_fair", with_views("SELECT user_id, item_id, rank FROM fair_fair", "fair_fair"),
          ids=("REC9", "REC11"))
def q_recommend_fair(spark, sf):
    p = fair_parts(spark, sf)
    out = recommend.fair_rerank(p["users"], p["train"], p["ranking"], 20)
    return out.select("user_id", "item_id", F.col("rank").cast("bigint").alias("rank"))


_EXPOSURE_SQL = """
WITH t AS (SELECT coalesce(ft.tier, 'Tail') AS tier FROM {recs} r LEFT JOIN fair_tier ft ON ft.item_id = r.item_id),
g AS (SELECT unnest(['Head', 'Mid', 'Tail']) AS tier)
SELECT g.tier, count(t.tier) AS slots, round(count(t.tier) / (SELECT count(*) FROM {recs}), 6) AS share
FROM g LEFT JOIN t ON t.tier = g.tier GROUP BY g.tier"""


def _exposure(spark, sf, which: str, p=None):
    p = p or fair_parts(spark, sf)
    if which == "base":
        recs = recommend.popularity_recs(p["users"], p["train"], p["ranking"], 20)
    else:
        recs = recommend.fair_rerank(p["users"], p["train"], p["ranking"], 20)
    return exposure.exposure_by_tier(recs, recommend.popularity_tiers(p["ranking"]))


@register("exposure_by_tier", with_views(_EXPOSURE_SQL.format(recs="fair_base"), "fair_base", "fair_tier"),
          ids=("EVAL8",))
def q_exposure_by_tier(spark, sf):
    return rounded(_exposure(spark, sf, "base"))


@register("exposure_by_tier_fair", with_views(_EXPOSURE_SQL.format(recs="fair_fair"), "fair_fair", "fair_tier"),
          ids=("EVAL8", "REC9"))
def q_exposure_by_tier_fair(spark, sf):
    return rounded(_exposure(spark, sf, "fair"))


@register("exposure_s1", with_views("""
WITH b AS (SELECT coalesce(ft.tier, 'Tail') AS tier FROM fair_base r LEFT JOIN fair_tier ft USING (item_id)),
f AS (SELECT coalesce(ft.tier, 'Tail') AS tier FROM fair_fair r LEFT JOIN fair_tier ft USING (item_id)),
s AS (SELECT 'base' AS recommender, tier, count(*) / (SELECT count(*) FROM b) AS share FROM b GROUP BY tier
      UNION ALL
      SELECT 'fair', tier, count(*) / (SELECT count(*) FROM f) FROM f GROUP BY tier)
SELECT recommender, round(max(share), 6) AS max_share, max(share) <= 0.4 AS s1_met FROM s GROUP BY recommender""",
    "fair_base", "fair_fair", "fair_tier"), ids=("EVAL9",))
def q_exposure_s1(spark, sf):
    p = fair_parts(spark, sf)
    b = exposure.exposure_s1(_exposure(spark, sf, "base", p)).select(F.lit("base").alias("recommender"), "*")
    f = exposure.exposure_s1(_exposure(spark, sf, "fair", p)).select(F.lit("fair").alias("recommender"), "*")
    return rounded(b.unionByName(f))


add_view("fair_truth", "SELECT DISTINCT user_id, item_id, 1 AS copies FROM fair_test WHERE rating >= 3.5",
         ("fair_test",))


@register("fair_ndcg_by_bucket", with_views("""
WITH tl AS (SELECT user_id, count(*) AS n FROM fair_truth GROUP BY user_id),
nd AS (SELECT tl.user_id,
              coalesce((SELECT sum(1.0 / log2(r.rank + 1)) FROM fair_base10 r JOIN fair_truth t
                          ON t.user_id = r.user_id AND t.item_id = r.item_id WHERE r.user_id = tl.user_id), 0.0)
                / i.idcg AS ndcg_base,
              coalesce((SELECT sum(1.0 / log2(r.rank + 1)) FROM fair_fair10 r JOIN fair_truth t
                          ON t.user_id = r.user_id AND t.item_id = r.item_id WHERE r.user_id = tl.user_id), 0.0)
                / i.idcg AS ndcg_fair
       FROM tl JOIN ideal i ON i.n = least(tl.n, 10)),
pb AS (SELECT user_id, count(DISTINCT item_id) AS n FROM fair_train WHERE rating >= 3.5 GROUP BY user_id),
per AS (SELECT nd.*, CASE WHEN pb.n IS NULL THEN 'unknown' WHEN pb.n < 10 THEN 'cold(<10)'
                          WHEN pb.n < 50 THEN 'warm(10-49)' ELSE 'hot(50+)' END AS bucket
        FROM nd LEFT JOIN pb ON pb.user_id = nd.user_id),
s AS (SELECT bucket, avg(ndcg_base) AS ndcg_base, avg(ndcg_fair) AS ndcg_fair, count(*) AS users
      FROM per GROUP BY bucket),
r AS (SELECT CASE WHEN w.ndcg_fair > 0 THEN c.ndcg_fair / w.ndcg_fair END AS ratio
      FROM (SELECT max(ndcg_fair) AS ndcg_fair FROM s WHERE bucket = 'cold(<10)') c,
           (SELECT max(ndcg_fair) AS ndcg_fair FROM s WHERE bucket = 'warm(10-49)') w)
SELECT s.bucket, round(s.ndcg_base, 6) AS ndcg_base, round(s.ndcg_fair, 6) AS ndcg_fair, s.users,
       round(r.ratio, 6) AS cold_warm_ratio, coalesce(r.ratio >= 0.7, false) AS m1_met
FROM s, r""", "fair_base10", "fair_fair10", "fair_truth", "fair_train", "ideal"), ids=("EVAL10", "AGG5"))
def q_fair_ndcg_by_bucket(spark, sf):
    p = fair_parts(spark, sf)
    # the candidates of the fair list are the base list, carried on
    cands = materialize(recommend.popularity_recs(p["users"], p["train"], p["ranking"],
                                                  10 * recommend.FAIR_CANDIDATE_MULT), "fair-cands")
    base = cands.where(F.col("rank") <= 10)
    fair = recommend.fair_rerank(p["users"], p["train"], p["ranking"], 10, cands=cands)
    truth = p["test"].where(F.col("rating") >= 3.5).select("user_id", "item_id")
    buckets = features.positive_buckets(p["train"], p["users"])
    buckets = buckets.where(F.col("bucket") != features.UNKNOWN)
    return rounded(exposure.fair_ndcg_by_bucket(base, fair, truth, buckets, 10))


# ------------------------------------------------------ watch-log exposure --

@register("top5_exposure", with_views("""
WITH c AS (SELECT movie_id, count(*) AS watches FROM watches WHERE movie_id IS NOT NULL GROUP BY movie_id),
n AS (SELECT greatest(1, CAST(floor(count(*) * 0.05) AS BIGINT)) AS n_top FROM c),
r AS (SELECT *, row_number() OVER (ORDER BY watches DESC, movie_id) AS rk FROM c)
SELECT CAST((SELECT sum(watches) FROM c) AS BIGINT) AS total_watches, (SELECT count(*) FROM c) AS distinct_items,
       n.n_top, CAST(sum(r.watches) AS BIGINT) AS top_watches, round(sum(r.watches) / (SELECT sum(watches) FROM c), 6) AS exposure
FROM r, n WHERE r.rk <= n.n_top GROUP BY n.n_top""", "watches"), ids=("AGG9",))
def q_top5_exposure(spark, sf):
    return rounded(exposure.top_share_exposure(td.watches(spark, sf)))


@register("top5_exposure_daily", with_views("""
WITH c AS (SELECT CAST(to_timestamp(ts) AS DATE) AS day, movie_id, count(*) AS watches
           FROM watches WHERE movie_id IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY watches DESC, movie_id) AS rk,
             greatest(1, floor(count(*) OVER (PARTITION BY day) * 0.05)) AS n FROM c)
SELECT CAST(day AS VARCHAR) AS day, CAST(sum(watches) AS BIGINT) AS total_watches, count(*) AS distinct_items,
       CAST(sum(CASE WHEN rk <= n THEN watches ELSE 0 END) AS BIGINT) AS top_watches,
       round(sum(CASE WHEN rk <= n THEN watches ELSE 0 END) / sum(watches), 6) AS exposure
FROM r GROUP BY day""", "watches"), ids=("AGG10", "PRJ9"))
def q_top5_exposure_daily(spark, sf):
    w = td.watches(spark, sf)
    out = exposure.top_share_exposure_daily(w, event_day(F.col("ts") * 1000, "millis"))
    return rounded(out.withColumn("day", F.col("day").cast("string")))


@register("top_items", with_views("""
SELECT movie_id, count(*) AS watches FROM watches WHERE movie_id IS NOT NULL
GROUP BY movie_id ORDER BY watches DESC, movie_id LIMIT 10""", "watches"), ids=("AGG11",))
def q_top_items(spark, sf):
    return exposure.top_items(td.watches(spark, sf), 10)




@register("freq_topn", with_views("""
SELECT CAST(movie_id AS VARCHAR) AS value, round(cnt / (SELECT count(*) FROM drift_rows WHERE is_train), 6) AS freq
FROM (SELECT movie_id, count(*) AS cnt FROM drift_rows WHERE is_train GROUP BY movie_id
      ORDER BY cnt DESC, movie_id LIMIT 20) x""", "drift_rows"), ids=("AGG12",))
def q_freq_topn(spark, sf):
    train, _ = splits.chrono_split(ratings(spark, sf))
    return rounded(exposure.freq_topn(train, "item_id"))


@register("freq_align", with_views("""
WITH a AS (SELECT CAST(movie_id AS VARCHAR) AS value, cnt / (SELECT count(*) FROM drift_rows WHERE is_train) AS f
           FROM (SELECT movie_id, count(*) AS cnt FROM drift_rows WHERE is_train GROUP BY movie_id
                 ORDER BY cnt DESC, movie_id LIMIT 20) x),
b AS (SELECT CAST(movie_id AS VARCHAR) AS value, cnt / (SELECT count(*) FROM drift_rows WHERE NOT is_train) AS f
      FROM (SELECT movie_id, count(*) AS cnt FROM drift_rows WHERE NOT is_train GROUP BY movie_id
            ORDER BY cnt DESC, movie_id LIMIT 20) y)
SELECT coalesce(a.value, b.value) AS value, round(coalesce(a.f, 0.0), 6) AS ref, round(coalesce(b.f, 0.0), 6) AS cur
FROM a FULL OUTER JOIN b ON a.value = b.value""", "drift_rows"), ids=("JON13",))
def q_freq_align(spark, sf):
    train, test = splits.chrono_split(ratings(spark, sf))
    return rounded(exposure.freq_align(exposure.freq_topn(train, "item_id"), exposure.freq_topn(test, "item_id")))


@register("rating_hist", with_views("""
WITH s AS (SELECT min(rating) AS lo, max(rating) AS hi, count(rating) AS n FROM drift_rows),
c AS (SELECT CAST(least(floor((rating - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, count(*) AS cnt
      FROM drift_rows, s WHERE rating IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(i AS INTEGER) AS bin FROM range(0, 20) t(i))
SELECT g.bin, round(lo + g.bin * ((hi - lo) / 20), 6) AS lo, round(lo + (g.bin + 1) * ((hi - lo) / 20), 6) AS hi,
       coalesce(c.cnt, 0) AS count, round(coalesce(c.cnt, 0) / (n * ((hi - lo) / 20)), 6) AS density
FROM g LEFT JOIN c ON c.bin = g.bin, s""", "drift_rows"), ids=("AGG13",))
def q_rating_hist(spark, sf):
    return rounded(exposure.histogram(ratings(spark, sf), "rating", 20))
