"""ALS and serving plans (REC1-6, REC8, SNK3-4).

ALS results cannot be reproduced by SQL (the reference's own runs differ
between runs, unseeded), so those plans are rows-only and their quality is
checked in the tests against the popularity baseline.  The fallback chain
and the cold-start ranking are deterministic and have oracles.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from reelsight.functions.exprs import items_text
from reelsight.operators import als, features, ranking, recommend, topk
from reelsight.plans.oracle_views import add_view, with_views
from reelsight.plans.q_ranking import KS, Offline, fair_parts
from reelsight.plans.registry import register, rounded
from reelsight.session import materialize, scratch_path
from reelsight.sources import sinks, testdata as td

def offline_model(p):
    """ALS fitted on the train split of an offline flow."""
    return als.train_als(als.ui_matrix(p.train), seed=42)


def als_recs(spark, sf, k: int):
    """The flow, its model and the top-k unseen lists of its users."""
    p = Offline(spark, sf)
    model = offline_model(p)
    return p, model, als.recommend_unseen(model, p.users, p.train, k)


add_view("als_ui", "SELECT DISTINCT uidx, iidx FROM off_train WHERE rating > 3.5", ("off_train",))


@register("ui_matrix", with_views("""
SELECT uidx, iidx, sum(CASE WHEN rating > 3.5 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END) AS value
FROM off_train GROUP BY uidx, iidx""",
    "off_train"), ids=("REC1", "PRJ5"))
def q_ui_matrix(spark, sf):
    return als.ui_matrix(Offline(spark, sf).train)


@register("als_factors", with_views("""
SELECT 'user' AS kind, uidx AS id, 64 AS dims, true AS finite FROM (SELECT DISTINCT uidx FROM als_ui)
UNION ALL SELECT 'item', iidx, 64, true FROM (SELECT DISTINCT iidx FROM als_ui)""", "als_ui"), ids=("REC2",))
def q_als_factors(spark, sf):
    f = als.factor_table(offline_model(Offline(spark, sf))).withColumn("id", F.col("id").cast("bigint"))
    return f.select("kind", "id", F.size("features").alias("dims"), als.finite_features().alias("finite"))


@register("als_topk", None, ids=("REC3", "JON9"))
def q_als_topk(spark, sf):
    return als_recs(spark, sf, max(KS))[2]


# What SQL can say about lists whose factors no other engine reproduces: who
# gets one, how long it is, that ranks count from 1 and no seen item is in it.
_LISTS = """
SELECT u.uidx, least({k}, {n}) AS n_items, CAST(1 AS INTEGER) AS first_rank, CAST(least({k}, {n}) AS INTEGER) AS last_rank,
       CAST(0 AS BIGINT) AS n_seen
FROM (SELECT uidx FROM off_eu WHERE uidx IN (SELECT uidx FROM als_ui)) u,
     (SELECT count(DISTINCT iidx) AS items FROM als_ui) i
LEFT JOIN (SELECT uidx, count(*) AS seen FROM (SELECT DISTINCT uidx, iidx FROM off_train
           WHERE iidx IN (SELECT iidx FROM als_ui)) GROUP BY uidx) s ON s.uidx = u.uidx
WHERE {n} > 0"""


def _list_facts(recs, seen):
    s = seen.select("uidx", "iidx").distinct().withColumn("_seen", F.lit(1))
    return (recs.join(s, ["uidx", "iidx"], "left").groupBy("uidx")
                .agg(F.countDistinct("iidx").alias("n_items"), F.min("rank").cast("int").alias("first_rank"),
                     F.max("rank").cast("int").alias("last_rank"), F.count("_seen").alias("n_seen")))


@register("als_topk_facts", with_views(_LISTS.format(k=20, n="(i.items - coalesce(s.seen, 0))"), "off_eu", "als_ui", "off_train"),
          ids=("REC3", "JON9"))
def q_als_topk_facts(spark, sf):
    p, _, recs = als_recs(spark, sf, max(KS))
    return _list_facts(recs, p.train)


@register("als_topk_serving", None, ids=("REC4",))
def q_als_topk_serving(spark, sf):
    p = Offline(spark, sf)
    return als.recommend_serving(offline_model(p), p.users, max(KS))


@register("als_serving_facts", with_views("""
SELECT uidx, least(1000000, (SELECT count(DISTINCT iidx) FROM als_ui)) AS n_items, CAST(1 AS INTEGER) AS first_rank
FROM off_eu WHERE uidx IN (SELECT uidx FROM als_ui)""", "off_eu", "als_ui"), ids=("REC4",))
def q_als_serving_facts(spark, sf):
    """A k beyond the catalogue is clamped to it."""
    p = Offline(spark, sf)
    recs = als.recommend_serving(offline_model(p), p.users, 1_000_000, lists=True)
    # an item of a user is in one piece of the list only
    return recs.groupBy(F.col("uidx").cast("bigint").alias("uidx")).agg(
        F.sum(F.size(F.array_distinct("items"))).alias("n_items"), F.min("rank").cast("int").alias("first_rank"))


# items weighted by the square of how many watched them, so their lengths differ
add_view("wt_item", """
    SELECT e.vec_id AS item_id, list_transform(e.embedding::DOUBLE[], lambda x: x * (1 + coalesce(w.n, 0)) ** 2) AS v
    FROM embeddings e LEFT JOIN (SELECT movie_id, count(*) AS n FROM watches GROUP BY movie_id) w ON w.movie_id = e.vec_id""",
         ("watches",))
add_view("wt_lists", """
    SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM (
      SELECT u.vec_id AS user_id, i.item_id, round(list_dot_product(u.embedding::DOUBLE[], i.v), 6) AS score
      FROM embeddings u CROSS JOIN wt_item i) s""", ("wt_item",))


def _weighted(spark, sf):
    vectors = td.item_factors(spark, sf).select(F.col("item").alias("id"), F.col("features").cast("array<double>").alias("features"))
    n = td.watches(spark, sf).groupBy(F.col("movie_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    weight = F.pow(1 + F.coalesce("n", F.lit(0)), F.lit(2))
    items = vectors.join(n, "id", "left").select("id", F.transform("features", lambda x: x * weight).alias("features"))
    return vectors, items


@register("topk_products", with_views("""
SELECT user_id, CAST(rank AS INTEGER) AS rank, item_id, score FROM wt_lists WHERE rank <= 10""", "wt_lists"), ids=("REC4",))
def q_topk_products(spark, sf):
    """The ten items of every vector by product with weighted items."""
    vectors, items = _weighted(spark, sf)
    wide = topk.top_products(vectors, items, 20, None, "user_id", "item_id", bucket=64)[0]
    # a margin beyond k lets products that differ in the last digits be ordered by item id
    w = Window.partitionBy("user_id").orderBy(F.round("score", 6).desc(), "item_id")
    return wide.select("user_id", F.row_number().over(w).cast("int").alias("rank"), "item_id",
                       F.round("score", 6).alias("score")).where(F.col("rank") <= 10)


@register("topk_work", """
SELECT count(*) * count(*) AS all_pairs, true AS fewer FROM embeddings""", ids=("REC4",))
def q_topk_work(spark, sf):
    """The pairs scored by ``topk_products`` are less than half of all."""
    vectors, items = _weighted(spark, sf)
    pairs = topk.top_products(vectors, items, 10, None, "user_id", "item_id", bucket=64)[1]
    n = vectors.agg((F.count(F.lit(1)) * F.count(F.lit(1))).alias("all_pairs"))
    return n.select("all_pairs", (2 * pairs.scalar() < F.col("all_pairs")).alias("fewer"))


def _holdout(p, model):
    """Hit rate over every user with a holdout item (no rating filter)."""
    users = p.test.select("uidx")
    return rounded(ranking.hit_rate(als.recommend_unseen(model, users, p.train, 20), p.test, 20))


@register("als_hr_at_k", None, ids=("EVAL5", "REC2"))
def q_als_hr_at_k(spark, sf):
    p = Offline(spark, sf)
    return _holdout(p, offline_model(p))


@register("als_offline_overall", None, ids=("EVAL6", "REC3"))
def q_als_offline_overall(spark, sf):
    p, _, recs = als_recs(spark, sf, max(KS))
    return rounded(ranking.overall(ranking.user_metrics(recs, p.truth, KS, users=p.users), KS))


@register("recommend_hybrid", None, ids=("REC8",))
def q_recommend_hybrid(spark, sf):
    p, _, cf = als_recs(spark, sf, 20)
    return als.recommend_hybrid(cf.drop("score"), p.recs)


@register("hybrid_facts", with_views("""
SELECT uidx, CASE WHEN uidx IN (SELECT uidx FROM als_ui) THEN 'cf' ELSE 'popularity' END AS source FROM off_eu""",
    "off_eu", "als_ui"), ids=("REC8",))
def q_hybrid_facts(spark, sf):
    return q_recommend_hybrid(spark, sf).select("uidx", "source").distinct()


@register("factor_norm_rank", """
SELECT vec_id AS item, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6)
         AS norm,
       row_number() OVER (ORDER BY sqrt(list_sum(list_transform(embedding,
                         lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) DESC, vec_id) AS rank
FROM embeddings""", ids=("REC5",))
def q_factor_norm_rank(spark, sf):
    return rounded(recommend.factor_norm_rank(td.item_factors(spark, sf)))


@register("recommend_fallback", with_views("""
WITH cold AS (SELECT string_agg(CAST(vec_id AS VARCHAR), ',' ORDER BY n DESC, vec_id) AS items FROM (
                SELECT vec_id, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))
                       AS n FROM embeddings ORDER BY n DESC, vec_id LIMIT 5) x),
known AS (SELECT DISTINCT user_id FROM fair_train),
scored AS (SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) AS items
           FROM fair_cand WHERE rank <= 5 AND user_id IN (SELECT user_id FROM known) GROUP BY user_id)
SELECT u.user_id, CASE WHEN s.items IS NOT NULL THEN 'model' ELSE 'cold' END AS source,
       coalesce(s.items, (SELECT items FROM cold)) AS items
FROM fair_users u LEFT JOIN scored s ON s.user_id = u.user_id""", "fair_cand", "fair_train", "fair_users"),
    ids=("REC6", "PRJ11"))
def q_recommend_fallback(spark, sf):
    p = fair_parts(spark, sf)
    known = p["train"].select("user_id").distinct()
    scored = recommend.popularity_recs(p["users"].join(known, "user_id", "left_semi"), p["train"], p["ranking"], 5)
    cold = recommend.factor_norm_rank(td.item_factors(spark, sf)).select("rank", F.col("item").alias("item_id"))
    out = recommend.recommend_fallback(p["users"], scored, cold, 5)
    return out.select("user_id", "source", items_text("items").alias("items"))


@register("recommend_fallback_no_model", with_views("""
SELECT DISTINCT user_id, 'fallback' AS source, '50,172,1' AS items FROM fair_test""", "fair_test"), ids=("REC6",))
def q_recommend_fallback_no_model(spark, sf):
    p = fair_parts(spark, sf)
    out = recommend.recommend_fallback(p["users"], None, None, 3)
    return out.select("user_id", "source", items_text("items").alias("items"))


@register("offline_report", None, ids=("SNK3",))
def q_offline_report(spark, sf):
    p = Offline(spark, sf)
    m = materialize(ranking.user_metrics(p.recs, p.truth, KS, users=p.users), "report-metrics")
    b = ranking.by_bucket(m, features.activity_buckets(p.train, "uidx"), "uidx",
                          (features.COLD, features.WARM, features.HOT))
    return sinks.report_json(rounded(ranking.overall(m, KS)), rounded(b))


@register("offline_report_numbers", with_views("""
SELECT CAST(k AS INTEGER) AS k, round(avg(recall), 6) AS recall, round(avg(ndcg), 6) AS ndcg, count(*) AS users
FROM off_metrics GROUP BY k""", "off_metrics"), ids=("SNK3",))
def q_offline_report_numbers(spark, sf):
    """The numbers of the nested report, read back from its JSON."""
    r = q_offline_report(spark, sf).select(F.from_json(
        "report", "overall array<struct<k:int,recall:double,ndcg:double,users:bigint>>").alias("r"))
    return r.select(F.inline("r.overall"))


@register("registry_publish", None, ids=("SNK4",))
def q_registry_publish(spark, sf):
    row = _published(spark, sf)
    return row.select("version", "sha256", F.size(F.map_keys("metrics")).alias("n_metrics"))


def _published(spark, sf):
    reg_dir = scratch_path(spark, f"registry-{uuid.uuid4().hex[:12]}")
    p = Offline(spark, sf)
    model = offline_model(p)
    hr = _holdout(p, model).first()
    return als.publish(model, reg_dir, "v0.1",
                       {"hr@20": float(hr["hr_at_20"] or 0.0), "ndcg@20": float(hr["ndcg_at_20"] or 0.0)})


@register("registry_publish_facts", "SELECT 'v0.1' AS version, 2 AS n_metrics, 64 AS digest_length, true AS dated",
          ids=("SNK4",))
def q_registry_publish_facts(spark, sf):
    return _published(spark, sf).select(
        "version", F.size(F.map_keys("metrics")).alias("n_metrics"), F.length("sha256").alias("digest_length"),
        F.col("created_at").isNotNull().alias("dated"))
