"""A/B experiment plans (EXP1-EXP8) over the response log: arm by user
parity, success = a listed item watched within 7 days (60 minutes for the
provenance trace)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from reelsight.functions.exprs import hash_uniform_sql, items_text, normal_cdf_sql
from reelsight.operators import als, experiment, features, online, recommend, splits
from reelsight.plans.oracle_views import add_view, with_views
from reelsight.plans.q_online import _HIT_SQL, WEEK
from reelsight.plans.q_prep import ratings, snapshot
from reelsight.plans.registry import PLANS, register, rounded
from reelsight.session import materialize
from reelsight.sources import testdata as td

B_REPS = 2000

add_view("arms", """
    SELECT *, CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS arm FROM responses""", ("responses",))
add_view("ab_labelled", f"""
    WITH {_HIT_SQL.format(h=WEEK).strip()}
    SELECT a.*, CASE WHEN h.first_hit IS NOT NULL THEN 1 ELSE 0 END AS success
    FROM arms a LEFT JOIN hit h ON h.request_id = a.request_id""", ("arms", "resp_items", "watches"))
add_view("ab_counts", """
    SELECT sum(CASE WHEN arm = 'A' THEN success ELSE 0 END) AS succ_a, count(*) FILTER (WHERE arm = 'A') AS n_a,
           sum(CASE WHEN arm = 'B' THEN success ELSE 0 END) AS succ_b, count(*) FILTER (WHERE arm = 'B') AS n_b
    FROM ab_labelled""", ("ab_labelled",))


def _z_sql() -> str:
    pool = "((succ_a + succ_b) / (n_a + n_b))"
    se = f"sqrt({pool} * (1 - {pool}) * (1.0 / n_a + 1.0 / n_b))"
    z = f"((succ_a / n_a - succ_b / n_b) / {se})"
    zero = f"({se} = 0 OR {se} IS NULL)"
    return f"""
    SELECT CAST(succ_a AS BIGINT) AS succ_a, n_a, CAST(succ_b AS BIGINT) AS succ_b, n_b,
           CASE WHEN {zero} THEN 0.0 ELSE {z} END AS z,
           CASE WHEN {zero} THEN 1.0 ELSE 2 * (1 - {normal_cdf_sql(f'abs({z})')}) END AS p_two_sided,
           CASE WHEN {zero} THEN 1.0 ELSE 1 - {normal_cdf_sql(z)} END AS p_greater,
           CASE WHEN {zero} THEN 1.0 ELSE {normal_cdf_sql(z)} END AS p_less,
           succ_a / n_a - succ_b / n_b AS delta
    FROM ab_counts"""


add_view("ab_z", _z_sql(), ("ab_counts",))


def _table_sql(arm: str) -> str:
    """(k, cdf) of the arm's binomial, from log-gamma probabilities."""
    return f"""
    SELECT k, sum(w) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) / sum(w) OVER () AS cdf FROM (
      SELECT k, exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(s / n) + (n - k) * ln(1 - s / n)) AS w
      FROM (SELECT succ_{arm}::DOUBLE AS s, n_{arm}::DOUBLE AS n, unnest(range(1, n_{arm}::BIGINT)) AS k FROM ab_counts) x
      WHERE s > 0 AND s < n) y"""


def _draw_sql(arm: str) -> str:
    return f"""
    SELECT r.rep, t.k FROM (SELECT rep, 1.0 - {hash_uniform_sql(42, repr(arm), 'rep')} AS u
                            FROM (SELECT unnest(range(1, {B_REPS + 1})) AS rep) g) r
    ASOF JOIN ab_table_{arm} t ON r.u <= t.cdf"""


for _arm in "ab":
    add_view(f"ab_table_{_arm}", _table_sql(_arm), ("ab_counts",))
    add_view(f"ab_draw_{_arm}", _draw_sql(_arm), (f"ab_table_{_arm}",))
add_view("ab_boot", """
    WITH d AS (SELECT a.k / c.n_a - b.k / c.n_b AS delta
               FROM ab_draw_a a JOIN ab_draw_b b USING (rep), ab_counts c)
    SELECT quantile_cont(delta, 0.025) AS ci_lo, quantile_cont(delta, 0.975) AS ci_hi, count(*) AS replicates
    FROM d""", ("ab_counts", "ab_draw_a", "ab_draw_b"))


def labelled(spark, sf, horizon=WEEK):
    arms = experiment.assign_arm(td.responses(spark, sf))
    return online.response_success(arms, td.watches(spark, sf), horizon)


@register("assign_arm", with_views("SELECT request_id, user_id, arm FROM arms", "arms"), ids=("EXP1",))
def q_assign_arm(spark, sf):
    return experiment.assign_arm(td.responses(spark, sf)).select("request_id", "user_id", "arm")


@register("ab_rates", with_views("""
SELECT arm, CAST(sum(success) AS BIGINT) AS successes, count(*) AS responses, round(avg(success), 6) AS rate
FROM ab_labelled GROUP BY arm""", "ab_labelled"), ids=("EXP3", "EXP8"))
def q_ab_rates(spark, sf):
    return rounded(experiment.arm_rates(labelled(spark, sf)))


@register("ab_ztest", with_views("""
SELECT succ_a, n_a, succ_b, n_b, round(z, 6) AS z, round(p_two_sided, 6) AS p_two_sided,
       round(p_greater, 6) AS p_greater, round(p_less, 6) AS p_less, round(delta, 6) AS delta FROM ab_z""",
    "ab_z"), ids=("EXP4",))
def q_ab_ztest(spark, sf):
    z = experiment.z_test(experiment.arm_rates(labelled(spark, sf)))
    return rounded(z.withColumn("succ_a", F.col("succ_a").cast("bigint"))
                    .withColumn("succ_b", F.col("succ_b").cast("bigint")))


@register("ab_bootstrap", with_views("""
SELECT round(ci_lo, 6) AS ci_lo, round(ci_hi, 6) AS ci_hi, replicates FROM ab_boot""", "ab_boot"),
    ids=("EXP5",))
def q_ab_bootstrap(spark, sf):
    return rounded(experiment.bootstrap_ci(experiment.arm_rates(labelled(spark, sf)), B_REPS))


@register("ab_decision", with_views("""
SELECT round(z.p_two_sided, 6) AS p_two_sided, round(b.ci_lo, 6) AS ci_lo, round(b.ci_hi, 6) AS ci_hi,
       CASE WHEN z.p_two_sided < 0.05 AND b.ci_lo > 0 THEN 'ship A'
            WHEN z.p_two_sided < 0.05 AND b.ci_hi < 0 THEN 'ship B' ELSE 'inconclusive' END AS decision
FROM ab_z z, ab_boot b""", "ab_z", "ab_boot"), ids=("EXP6",))
def q_ab_decision(spark, sf):
    rates = materialize(experiment.arm_rates(labelled(spark, sf)), "ab-rates")
    p = experiment.z_test(rates).select("p_two_sided").scalar()
    ci = experiment.bootstrap_ci(rates, B_REPS)
    out = ci.select(p.alias("p_two_sided"), "ci_lo", "ci_hi")
    return rounded(out.withColumn("decision", experiment.decision(F.col("p_two_sided"), F.col("ci_lo"),
                                                                  F.col("ci_hi"))))


# Model names of the arms, list length, build provenance.
VERSIONS = {"A": "als_v1", "B": "pop_v1"}
K_RESP = 20
BUILD = {"pipeline_git_sha": "git_sha_example_abcdef", "container_image_digest": "sha256:container_digest_example_123456"}


def provenance(spark, sf, rated=None):
    """The snapshot id of the training data (of ``rated``, if they are
    written already), and the build columns."""
    snap = (PLANS["snapshot_id"].fn(spark, sf) if rated is None else snapshot(rated)).first()["data_snapshot_id"]
    return {"data_snapshot_id": snap, **BUILD}


add_view("ab_snapshot", f"SELECT data_snapshot_id FROM ({PLANS['snapshot_id'].oracle}) z", ())
_PROV_SQL = ", ".join(f"'{v}' AS {k}" for k, v in BUILD.items())


@register("provenance_trace", with_views(f"""
WITH {_HIT_SQL.format(h=3600).strip()}
SELECT a.request_id, a.user_id, a.arm, CASE a.arm WHEN 'A' THEN 'als_v1' ELSE 'pop_v1' END AS model_version,
       s.data_snapshot_id, {_PROV_SQL}, a.ts, CAST({K_RESP} AS INTEGER) AS k,
       array_to_string(a.movie_ids, ',') AS movie_ids, CASE WHEN h.first_hit IS NOT NULL THEN 1 ELSE 0 END AS success
FROM arms a LEFT JOIN hit h ON h.request_id = a.request_id, ab_snapshot s
ORDER BY {hash_uniform_sql(42, 'a.request_id')}, a.request_id LIMIT 3""", "arms", "resp_items", "watches", "ab_snapshot"),
    ids=("EXP7", "EXP8"))
def q_provenance_trace(spark, sf):
    lab = labelled(spark, sf, 3600)
    mv = F.create_map(*[F.lit(x) for kv in VERSIONS.items() for x in kv])
    cols = lab.select("request_id", "user_id", "arm", mv[F.col("arm")].alias("model_version"),
                      *[F.lit(v).alias(k) for k, v in provenance(spark, sf).items()], "ts", F.lit(K_RESP).alias("k"),
                      items_text("movie_ids").alias("movie_ids"), "success")
    return experiment.provenance_trace(cols, 3)


add_view("ab_users", "SELECT DISTINCT user_id FROM responses", ("responses",))
# arm A: implicit ALS with fixed item factors; a user's factors solve the normal
# equations of the distinct items they liked (here by conjugate gradients)
add_view("ab_item", "SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings")
add_view("ab_gram", """
    SELECT list(g ORDER BY i) AS gram FROM (
      SELECT i, list(x ORDER BY j) AS g FROM (
        SELECT a.d AS i, b.d AS j, sum(a.x * b.x) AS x
        FROM (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM ab_item) a
        JOIN (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM ab_item) b USING (vec_id)
        GROUP BY a.d, b.d) c GROUP BY i) r""", ("ab_item",))
add_view("ab_liked", """
    SELECT DISTINCT user_id, item_id FROM fair_train
    WHERE rating >= 3.5 AND user_id IN (SELECT user_id FROM ab_users) AND item_id IN (SELECT vec_id FROM ab_item)""",
         ("fair_train", "ab_users", "ab_item"))
add_view("ab_equations", f"""
    SELECT user_id, n, cols, list_transform(cols, lambda c: 2.0 * list_sum(c)) AS b FROM (
      SELECT user_id, max(n) AS n, list(c ORDER BY d) AS cols FROM (
        SELECT l.user_id, e.d, count(*) AS n, list(e.x ORDER BY l.item_id) AS c FROM ab_liked l
        JOIN (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM ab_item) e ON e.vec_id = l.item_id
        GROUP BY l.user_id, e.d) k GROUP BY user_id) q""", ("ab_liked", "ab_item"))
add_view("ab_matrix", f"""
    SELECT user_id, b, list_transform(range(1, len(cols) + 1), lambda i: list_transform(range(1, len(cols) + 1), lambda j:
             gram[i][j] + list_dot_product(cols[i], cols[j]) + CASE WHEN i = j THEN {als.REG!r} * n ELSE 0.0 END)) AS a
    FROM ab_equations, ab_gram""", ("ab_equations", "ab_gram"))
add_view("ab_step", """
    SELECT 0 AS step, user_id, list_transform(b, lambda t: 0.0::DOUBLE) AS x, b AS r, b AS p, list_dot_product(b, b) AS rr FROM ab_matrix
    UNION ALL
    SELECT step + 1, user_id, x2, r2, list_transform(range(1, len(p) + 1), lambda i: r2[i] + rr2 / rr * p[i]), rr2 FROM (
      SELECT *, list_dot_product(r2, r2) AS rr2 FROM (
        SELECT *, list_transform(range(1, len(p) + 1), lambda i: x[i] + s * p[i]) AS x2,
               list_transform(range(1, len(p) + 1), lambda i: r[i] - s * ap[i]) AS r2 FROM (
          SELECT *, rr / list_dot_product(p, ap) AS s FROM (
            SELECT c.*, list_transform(m.a, lambda g: list_dot_product(g, c.p)) AS ap
            FROM ab_step c JOIN ab_matrix m USING (user_id) WHERE c.rr > 1e-24 AND c.step < 80) k1) k2) k3) k4""", ("ab_matrix",))
add_view("ab_profile", "SELECT user_id, arg_max(x, step) AS f FROM ab_step GROUP BY user_id", ("ab_step",))
# arm A falls back to arm B's list for users without a liked item
add_view("ab_lists", """
    WITH own AS (SELECT 'A' AS arm, user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) AS movie_ids FROM (
      SELECT u.user_id, e.vec_id AS item_id, row_number() OVER (PARTITION BY u.user_id ORDER BY
               round(list_dot_product(u.f, e.v), 9) DESC, e.vec_id) AS rank
      FROM ab_profile u CROSS JOIN ab_item e
      WHERE NOT EXISTS (SELECT 1 FROM fair_train t WHERE t.user_id = u.user_id AND t.item_id = e.vec_id)) x
    WHERE rank <= 20 GROUP BY user_id),
    popular AS (SELECT 'B' AS arm, user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) AS movie_ids FROM (
      SELECT e.user_id, r.item_id, row_number() OVER (PARTITION BY e.user_id ORDER BY r.pos) AS rank
      FROM ab_users e CROSS JOIN fair_rank r
      WHERE NOT EXISTS (SELECT 1 FROM fair_train t WHERE t.user_id = e.user_id AND t.item_id = r.item_id)) y
    WHERE rank <= 20 GROUP BY user_id)
    SELECT * FROM own UNION ALL SELECT * FROM popular
    UNION ALL SELECT 'A', user_id, movie_ids FROM popular WHERE user_id NOT IN (SELECT user_id FROM own)""",
         ("ab_users", "ab_profile", "ab_item", "fair_rank", "fair_train"))


def arm_factors(train, items, users):
    """User factors of arm A: implicit ALS folds the distinct items rated
    3.5 or more in, against the published item factors."""
    liked = (train.where(F.col("rating") >= 3.5).join(users, "user_id", "left_semi")
                  .select("user_id", "item_id").distinct().withColumn("value", F.lit(1.0)))
    return als.fold_in(liked, items, user="user_id", item="item_id")


@register("ab_responses", with_views(f"""
SELECT a.request_id, a.ts + 1 AS ts, a.user_id, a.arm, l.movie_ids, CAST({K_RESP} AS INTEGER) AS k,
       CASE WHEN a.arm = 'A' THEN 'als_v1' ELSE 'pop_v1' END AS model_version, s.data_snapshot_id, {_PROV_SQL},
       CAST(a.latency_ms AS DOUBLE) AS latency_ms, 200 AS status
FROM arms a LEFT JOIN ab_lists l ON l.user_id = a.user_id AND l.arm = a.arm, ab_snapshot s""",
    "arms", "ab_lists", "ab_snapshot"), ids=("EXP2",))
def q_ab_responses(spark, sf):
    """Arm A: unseen items by ALS, with the popular ones for users it cannot
    score; arm B: popular unseen items."""
    # every step reads the joined ratings from files
    rated = materialize(ratings(spark, sf).select("user_id", "item_id", "rating", "timestamp"), "ab-ratings")
    train, _ = splits.chrono_split(rated)
    rank = features.popularity_positive(train)
    req = experiment.assign_arm(td.responses(spark, sf)).select("request_id", "ts", "user_id", "arm", "latency_ms")
    users = req.select("user_id").distinct()
    items = td.item_factors(spark, sf).select(F.col("item").alias("id"), "features")
    # a margin beyond k lets products that differ in the last digits be ordered by item id
    wide = als.top_unseen(arm_factors(train, items, users), items, train, K_RESP + 10, "user_id", "item_id")
    w = Window.partitionBy("user_id").orderBy(F.round("score", 9).desc(), "item_id")
    scored = wide.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= K_RESP)
    recs_b = materialize(recommend.popularity_recs(users, train, rank, K_RESP), "ab-popular")
    recs_a = als.recommend_hybrid(scored.select("user_id", "rank", "item_id"), recs_b.select("user_id", "rank", "item_id"), "user_id")
    out = experiment.ab_responses(req, {"A": recs_a, "B": recs_b}, provenance(spark, sf, rated), VERSIONS)
    return out.select("request_id", (F.col("ts") + 1).alias("ts"), "user_id", "arm", items_text("movie_ids").alias("movie_ids"),
                      F.lit(K_RESP).alias("k"), "model_version", "data_snapshot_id", *BUILD,
                      F.col("latency_ms").cast("double").alias("latency_ms"), F.lit(200).alias("status"))
