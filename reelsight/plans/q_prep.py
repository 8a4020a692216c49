"""Cleaning, split and feature plans (PRJ1-6, JON1-9, AGG1-5, AGG14-16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelsight.functions.exprs import hash_uniform_sql
from reelsight.operators import clean, features, splits
from reelsight.plans.oracle_views import add_view, with_views
from reelsight.plans.registry import register, rounded
from reelsight.session import materialize
from reelsight.sources import testdata as td

ORDER = ["l_orderkey", "l_linenumber", "item_id", "l_suppkey", "timestamp"]
ORDER_SQL = "l_orderkey, l_linenumber, item_id, l_suppkey, \"timestamp\""

add_view("dirty", """
    SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id,
           CASE WHEN l_linenumber = 7 THEN 'bad' ELSE CAST(rating AS VARCHAR) END AS rating,
           CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE ts END AS "timestamp",
           l_orderkey, l_linenumber, l_suppkey, item_id AS item_key, ts AS ts_key
    FROM interactions""", ("interactions",))
add_view("ratings", """
    SELECT user_id, item_id, rating, ts AS "timestamp", l_orderkey, l_linenumber, l_suppkey
    FROM interactions""", ("interactions",))
add_view("split", """
    SELECT r.*, r."timestamp" <= (SELECT CAST(floor(quantile_cont("timestamp", 0.8)) AS BIGINT) FROM ratings) AS is_train
    FROM ratings r""", ("ratings",))
add_view("drift_rows", "SELECT user_id, item_id AS movie_id, rating, is_train FROM split", ("split",))


def ratings(spark, sf):
    """Interactions with the reference's column names."""
    return td.interactions(spark, sf).withColumnRenamed("ts", "timestamp")


DIRTY_ORDER = ["l_orderkey", "l_linenumber", "item_key", "l_suppkey", "ts_key"]
_CLEAN_SQL = """
WITH c AS (
  SELECT {u} AS u, {i} AS i,
         least(greatest(coalesce(TRY_CAST(rating AS DOUBLE), 0.0), 0.0), 5.0) AS rating,
         TRY_CAST("timestamp" AS DOUBLE) AS t, l_orderkey, l_linenumber, item_key, l_suppkey, ts_key
  FROM dirty)
SELECT CAST(trunc(u) AS BIGINT) AS user_id, CAST(trunc(i) AS BIGINT) AS item_id, round(rating, 6) AS rating,
       CAST(trunc(t) AS BIGINT) AS "timestamp"
FROM (SELECT *, row_number() OVER (PARTITION BY u, i, t ORDER BY l_orderkey DESC, l_linenumber DESC,
                                   item_key DESC, l_suppkey DESC, ts_key DESC) AS rn
      FROM c WHERE u IS NOT NULL AND i IS NOT NULL AND t IS NOT NULL) x
WHERE rn = 1"""


@register("basic_clean", with_views(_CLEAN_SQL.format(
    u="TRY_CAST(user_id AS DOUBLE)", i="TRY_CAST(item_id AS DOUBLE)"), "dirty"), ids=("PRJ1", "PRJ2"))
def q_basic_clean(spark, sf):
    d = td.dirty(spark, sf).withColumnRenamed("timestamp", "ts")  # PRJ2: ts -> timestamp
    out = clean.basic_clean(d, DIRTY_ORDER)
    return rounded(out.select("user_id", "item_id", "rating", "timestamp"))


_CLIP = "least(greatest(coalesce(TRY_CAST({c} AS DOUBLE), 0.0), 0.0), 5.0)"


@register("basic_clean_parity", with_views(_CLEAN_SQL.format(
    u=_CLIP.format(c="user_id"), i=_CLIP.format(c="item_id")), "dirty"), ids=("PRJ1",))
def q_basic_clean_parity(spark, sf):
    out = clean.basic_clean(td.dirty(spark, sf), DIRTY_ORDER, clip_ids=True)
    return rounded(out.select("user_id", "item_id", "rating", "timestamp"))


@register("normalize_cols", with_views("""
SELECT user_id, item_id AS movie_id, rating, ts AS "timestamp", l_orderkey, l_linenumber, l_suppkey
FROM interactions""", "interactions"), ids=("PRJ3",))
def q_normalize_cols(spark, sf):
    i = td.interactions(spark, sf)
    variant = i.withColumnsRenamed({"user_id": "userId", "item_id": "movieId", "ts": "Timestamp"})
    return clean.normalize_cols(variant)


@register("binarize", with_views("""
SELECT count(*) FILTER (WHERE rating > 3.5) AS n_gt, count(*) FILTER (WHERE rating >= 3.5) AS n_ge,
       count(*) AS n FROM interactions""", "interactions"), ids=("PRJ4", "PRJ5"))
def q_binarize(spark, sf):
    i = clean.default_rating(td.interactions(spark, sf))
    gt = clean.binarize(i, 3.5, ">", out="gt")
    both = clean.binarize(gt, 3.5, ">=", out="ge")
    return both.agg(F.count(F.when(F.col("gt"), 1)).alias("n_gt"), F.count(F.when(F.col("ge"), 1)).alias("n_ge"),
                    F.count(F.lit(1)).alias("n"))


@register("recency", with_views("""
SELECT l_orderkey, l_linenumber, l_suppkey,
       round(CASE WHEN max(ts) OVER () = min(ts) OVER () THEN 0.0
             ELSE (ts - min(ts) OVER ()) / (max(ts) OVER () - min(ts) OVER ()) END, 6) AS recency
FROM interactions""", "interactions"), ids=("PRJ6",))
def q_recency(spark, sf):
    r = clean.recency(ratings(spark, sf))
    return rounded(r.select("l_orderkey", "l_linenumber", "l_suppkey", "recency"))


@register("user_activity", "SELECT o_custkey AS user_id, count(*) AS n_events FROM lineitem JOIN orders "
          "ON l_orderkey = o_orderkey GROUP BY o_custkey", ids=("AGG1",))
def q_user_activity(spark, sf):
    return features.user_activity(td.interactions(spark, sf))


@register("item_activity", "SELECT l_partkey AS item_id, count(*) AS n_events FROM lineitem JOIN orders "
          "ON l_orderkey = o_orderkey GROUP BY l_partkey", ids=("AGG1",))
def q_item_activity(spark, sf):
    return features.item_activity(td.interactions(spark, sf))


@register("popularity_mean", with_views("""
SELECT item_id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, item_id) AS rank
FROM (SELECT item_id, avg(rating) AS score FROM interactions GROUP BY item_id)""", "interactions"),
    ids=("AGG2",))
def q_popularity_mean(spark, sf):
    return rounded(features.popularity(td.interactions(spark, sf)))


@register("popularity_count", with_views("""
SELECT item_id, CAST(score AS DOUBLE) AS score, row_number() OVER (ORDER BY score DESC, item_id) AS rank
FROM (SELECT item_id, count(*) AS score FROM interactions GROUP BY item_id)""", "interactions"),
    ids=("AGG2",))
def q_popularity_count(spark, sf):
    return features.popularity(td.interactions(spark, sf).drop("rating"))


@register("popularity_positive", with_views("""
SELECT item_id, pop_count, row_number() OVER (ORDER BY pop_count DESC, item_id) AS pos
FROM (SELECT item_id, count(*) AS pop_count FROM interactions WHERE rating >= 3.5 GROUP BY item_id)""",
    "interactions"), ids=("AGG3",))
def q_popularity_positive(spark, sf):
    return features.popularity_positive(td.interactions(spark, sf))


@register("min_interactions", with_views("""
SELECT user_id, item_id, ts, l_orderkey, l_linenumber FROM interactions
WHERE user_id IN (SELECT user_id FROM interactions GROUP BY user_id HAVING count(*) >= 50)""",
    "interactions"), ids=("JON1",))
def q_min_interactions(spark, sf):
    kept = splits.min_interactions(td.interactions(spark, sf), 50)
    return kept.select("user_id", "item_id", "ts", "l_orderkey", "l_linenumber")


@register("id_maps", with_views("""
SELECT 'user' AS kind, user_id AS id, row_number() OVER (ORDER BY user_id) - 1 AS idx
FROM (SELECT DISTINCT user_id FROM interactions)
UNION ALL
SELECT 'item' AS kind, item_id AS id, row_number() OVER (ORDER BY item_id) - 1 AS idx
FROM (SELECT DISTINCT item_id FROM interactions)""", "interactions"), ids=("JON2", "JON15"))
def q_id_maps(spark, sf):
    umap, imap = splits.id_maps(td.interactions(spark, sf))
    return (umap.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), F.col("uidx").alias("idx"))
                .unionByName(imap.select(F.lit("item").alias("kind"), F.col("item_id").alias("id"),
                                         F.col("iidx").alias("idx"))))


@register("chrono_split", with_views("""
SELECT (SELECT CAST(floor(quantile_cont("timestamp", 0.8)) AS BIGINT) FROM ratings) AS cutoff,
       count(*) FILTER (WHERE is_train) AS n_train, count(*) FILTER (WHERE NOT is_train) AS n_test
FROM split""", "split"), ids=("JON3",))
def q_chrono_split(spark, sf):
    r = ratings(spark, sf)
    c = splits.cutoff(r, 0.8)
    train, test = splits.chrono_split(r, 0.8)
    return r.agg(F.count(F.when(F.col("timestamp") <= c, 1)).alias("n_train"),
                 F.count(F.when(F.col("timestamp") > c, 1)).alias("n_test")).select(c.alias("cutoff"), "*")


_TEST_ROWS = "user_id, item_id, \"timestamp\", l_orderkey, l_linenumber"


@register("eligible_overlap", with_views(f"""
SELECT {_TEST_ROWS} FROM split t
WHERE NOT is_train
  AND user_id IN (SELECT user_id FROM split WHERE is_train)
  AND item_id IN (SELECT item_id FROM split WHERE is_train)""", "split"), ids=("JON4",))
def q_eligible_overlap(spark, sf):
    train, test = splits.chrono_split(ratings(spark, sf))
    return splits.eligible_overlap(train, test).select(*[c.strip(' "') for c in _TEST_ROWS.split(",")])


@register("notebook_eligibility", with_views(f"""
SELECT {_TEST_ROWS} FROM split t
WHERE NOT is_train
  AND user_id IN (SELECT user_id FROM split WHERE is_train GROUP BY user_id HAVING count(*) >= 5)
  AND item_id IN (SELECT item_id FROM split WHERE is_train)""", "split"), ids=("JON5",))
def q_notebook_eligibility(spark, sf):
    train, test = splits.chrono_split(ratings(spark, sf))
    return splits.notebook_eligibility(train, test).select(*[c.strip(' "') for c in _TEST_ROWS.split(",")])


add_view("holdout", f"""
    SELECT * FROM (SELECT r.*, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" DESC, {ORDER_SQL}) AS rn
                   FROM ratings r
                   WHERE user_id IN (SELECT user_id FROM ratings GROUP BY user_id HAVING count(*) >= 5)) x""",
         ("ratings",))


@register("last_item_holdout", with_views("""
SELECT user_id, item_id AS true_item, "timestamp", (SELECT count(*) FROM holdout WHERE rn > 1) AS n_train
FROM holdout WHERE rn = 1""", "holdout"), ids=("JON6", "REC12"))
def q_last_item_holdout(spark, sf):
    kept = splits.min_interactions(ratings(spark, sf), 5)
    train, test = splits.last_item_holdout(kept, ORDER, user="user_id", item="item_id")
    return test.select("user_id", "true_item", "timestamp", train.select(F.count(F.lit(1))).scalar().alias("n_train"))


@register("sample_users", with_views(f"""
SELECT user_id FROM (SELECT DISTINCT user_id FROM interactions)
ORDER BY {hash_uniform_sql(42, 'user_id')}, user_id LIMIT 500""", "interactions"), ids=("JON7",))
def q_sample_users(spark, sf):
    return splits.sample_users(td.interactions(spark, sf), 500, 42, "user_id")


@register("truth_sets", with_views("""
SELECT h.user_id, h.item_id, count(*) AS copies
FROM holdout h JOIN ratings r ON r.user_id = h.user_id AND r.item_id = h.item_id
WHERE h.rn = 1 AND r.rating >= 3.5
GROUP BY h.user_id, h.item_id""", "holdout"), ids=("JON8",))
def q_truth_sets(spark, sf):
    r = ratings(spark, sf)
    kept = splits.min_interactions(r, 5)
    _, test = splits.last_item_holdout(kept, ORDER, user="user_id", item="item_id")
    return splits.truth_sets(test, r, 3.5, user="user_id", item="item_id")


@register("exclude_seen", with_views(f"""
SELECT {_TEST_ROWS} FROM split t
WHERE NOT is_train AND NOT EXISTS (
  SELECT 1 FROM split s WHERE s.is_train AND s.user_id = t.user_id AND s.item_id = t.item_id)""", "split"),
    ids=("JON9",))
def q_exclude_seen(spark, sf):
    train, test = splits.chrono_split(ratings(spark, sf))
    return splits.exclude_seen(test, train).select(*[c.strip(' "') for c in _TEST_ROWS.split(",")])


@register("activity_buckets", with_views("""
SELECT bucket, count(*) AS users, CAST(sum(n_train) AS BIGINT) AS n_train FROM (
  SELECT user_id, count(*) AS n_train,
         CASE WHEN count(*) < 10 THEN 'cold(<10)' WHEN count(*) < 50 THEN 'warm(10-49)' ELSE 'hot(50+)' END AS bucket
  FROM holdout WHERE rn > 1 GROUP BY user_id) x
GROUP BY bucket""", "holdout"), ids=("AGG4",))
def q_activity_buckets(spark, sf):
    kept = splits.min_interactions(ratings(spark, sf), 5)
    train, _ = splits.last_item_holdout(kept, ORDER, user="user_id", item="item_id")
    b = features.activity_buckets(train, "user_id")
    return b.groupBy("bucket").agg(F.count(F.lit(1)).alias("users"), F.sum("n_train").alias("n_train"))


@register("positive_buckets", with_views("""
WITH pos AS (SELECT user_id, count(DISTINCT item_id) AS n FROM split WHERE is_train AND rating >= 3.5
             GROUP BY user_id)
SELECT u.user_id, coalesce(p.n, 0) AS train_positives,
       CASE WHEN p.n IS NULL THEN 'unknown' WHEN p.n < 10 THEN 'cold(<10)' WHEN p.n < 50 THEN 'warm(10-49)'
            ELSE 'hot(50+)' END AS bucket
FROM (SELECT DISTINCT user_id FROM split WHERE NOT is_train) u LEFT JOIN pos p ON p.user_id = u.user_id""",
    "split"), ids=("AGG5",))
def q_positive_buckets(spark, sf):
    train, test = splits.chrono_split(ratings(spark, sf))
    return features.positive_buckets(train, test)


@register("train_summary", with_views("""
SELECT count(*) AS "rows", count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items
FROM split WHERE is_train""", "split"), ids=("AGG15",))
def q_train_summary(spark, sf):
    train, _ = splits.chrono_split(ratings(spark, sf))
    return features.train_summary(train)


@register("snapshot_id", with_views("""
WITH s AS (
  SELECT (SELECT CAST(floor(quantile_cont("timestamp", 0.8)) AS BIGINT) FROM ratings) AS cutoff_ts,
         count(*) FILTER (WHERE is_train) AS n_train, count(*) FILTER (WHERE NOT is_train) AS n_test,
         count(DISTINCT user_id) FILTER (WHERE is_train) AS n_users,
         count(DISTINCT item_id) FILTER (WHERE is_train) AS n_items
  FROM split)
SELECT *, sha1('{"cutoff_ts": ' || cutoff_ts || ', "n_items": ' || n_items || ', "n_test": ' || n_test ||
               ', "n_train": ' || n_train || ', "n_users": ' || n_users || '}') AS data_snapshot_id
FROM s""", "split"), ids=("AGG14",))
def q_snapshot_id(spark, sf):
    return snapshot(materialize(ratings(spark, sf).select("user_id", "item_id", "timestamp"), "snapshot"))


def snapshot(r):
    """Dataset stats and id of ratings that are read several times."""
    train, test = splits.chrono_split(r)
    return features.snapshot_id(train, test, splits.cutoff(r))


@register("auc", """
WITH s AS (SELECT CAST(d.n_chars AS DOUBLE) AS y_score, l.quality AS y_true
           FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
g AS (SELECT y_score, sum(y_true) AS pos, sum(1 - y_true) AS neg FROM s GROUP BY y_score),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY y_score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                AS neg_below FROM g)
SELECT round(sum(pos * (neg_below + neg * 0.5)) / (sum(pos) * sum(neg)), 6) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c""", ids=("AGG16",))
def q_auc(spark, sf):
    return rounded(features.auc(td.scores(spark, sf)))


@register("auc_price", """
WITH g AS (SELECT CAST(l_extendedprice AS DOUBLE) AS s, count(*) FILTER (WHERE l_returnflag = 'R') AS pos,
                  count(*) FILTER (WHERE l_returnflag <> 'R') AS neg FROM lineitem GROUP BY 1),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT round(sum(pos * (below + neg * 0.5::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE), 6) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM c""", ids=("AGG16",))
def q_auc_price(spark, sf):
    """Nearly as many scores as rows: the running sum spans partitions."""
    li = td.table(spark, sf, "lineitem")
    return rounded(features.auc(li.select((F.col("l_returnflag") == "R").cast("int").alias("y_true"),
                                          F.col("l_extendedprice").cast("double").alias("y_score"))))
