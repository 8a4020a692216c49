"""Drift plans (DRF1-DRF5): interactions before vs. after the 0.8 time
quantile, columns user_id, movie_id, rating."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelsight.operators import drift
from reelsight.plans.oracle_views import add_view, with_views
from reelsight.plans.q_ranking import split_tables
from reelsight.plans.registry import register, rounded

COLS = ("user_id", "movie_id", "rating")


def _levels_sql(bins: int) -> str:
    return "[" + ", ".join(f"CAST({q!r} AS DOUBLE)" for q in drift.quantile_levels(bins)) + "]"


def _side(cond: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM drift_rows WHERE {cond} "
                              f"AND {c} IS NOT NULL" for c in COLS)


def _edge(name: str) -> str:
    return (f"CASE WHEN len({name}) < 2 THEN [coalesce({name}[1], 0.0) - 0.5, coalesce({name}[1], 0.0) + 0.5] "
            f"ELSE {name} END")


add_view("drift_ref", _side("is_train"), ("drift_rows",))
add_view("drift_cur", _side("NOT is_train"), ("drift_rows",))
add_view("drift_edges", f"""
    SELECT col, {_edge('e10')} AS e10, {_edge('e20')} AS e20 FROM (
      SELECT col, list_sort(list_distinct(quantile_cont(v, {_levels_sql(10)}))) AS e10,
                  list_sort(list_distinct(quantile_cont(v, {_levels_sql(20)}))) AS e20
      FROM drift_ref GROUP BY col) x""", ("drift_ref",))
add_view("drift_kinds", """
    SELECT col, 'psi' AS kind, e10 AS edges FROM drift_edges UNION ALL SELECT col, 'kl', e20 FROM drift_edges""",
         ("drift_edges",))
add_view("drift_shares", """
    WITH s AS (SELECT 'ref' AS side, * FROM drift_ref UNION ALL SELECT 'cur', * FROM drift_cur),
    b AS (SELECT s.side, s.col, k.kind, len(k.edges) - 1 AS m,
                 CASE WHEN s.v = k.edges[len(k.edges)] THEN len(k.edges) - 2
                      ELSE len(list_filter(k.edges, lambda x: x <= s.v)) - 1 END AS bin
          FROM s JOIN drift_kinds k ON k.col = s.col),
    c AS (SELECT col, kind, bin, count(*) FILTER (WHERE side = 'ref') AS ref_n,
                 count(*) FILTER (WHERE side = 'cur') AS cur_n
          FROM b WHERE bin >= 0 AND bin < m GROUP BY col, kind, bin),
    g AS (SELECT col, kind, unnest(range(0, len(edges) - 1)) AS bin FROM drift_kinds),
    f AS (SELECT g.col, g.kind, g.bin, coalesce(c.ref_n, 0) AS ref_n, coalesce(c.cur_n, 0) AS cur_n
          FROM g LEFT JOIN c ON c.col = g.col AND c.kind = g.kind AND c.bin = g.bin),
    t AS (SELECT col, kind, sum(ref_n) AS rt, sum(cur_n) AS ct FROM f GROUP BY col, kind)
    SELECT f.col, f.kind, f.bin,
           CASE WHEN ref_n = 0 THEN 1e-6 ELSE ref_n / greatest(rt, 1) END AS r,
           CASE WHEN cur_n = 0 THEN 1e-6 ELSE cur_n / greatest(ct, 1) END AS c
    FROM f JOIN t ON t.col = f.col AND t.kind = f.kind""", ("drift_ref", "drift_cur", "drift_kinds"))
add_view("drift_metrics", """
    SELECT col, sum(CASE WHEN kind = 'psi' THEN (c - r) * ln(c / r) END) AS psi,
                sum(CASE WHEN kind = 'kl' THEN r * ln(r / c) END) AS kl
    FROM drift_shares GROUP BY col""", ("drift_shares",))


def _frames(spark, sf):
    train, test = split_tables(spark, sf)
    pick = lambda d: d.select("user_id", F.col("item_id").alias("movie_id"), "rating")
    return pick(train), pick(test)


@register("bin_edges", with_views("""
SELECT col AS "column", kind, CAST(i AS INTEGER) AS idx, round(edge, 6) AS edge FROM (
  SELECT col, kind, unnest(edges) AS edge, unnest(range(0, len(edges))) AS i FROM drift_kinds) x""",
    "drift_kinds"), ids=("DRF1",))
def q_bin_edges(spark, sf):
    ref, _ = _frames(spark, sf)
    e = drift.bin_edges(ref, COLS)
    long = e.select("column", F.explode(F.array(
        F.struct(F.lit("psi").alias("kind"), F.col("edges_psi").alias("edges")),
        F.struct(F.lit("kl").alias("kind"), F.col("edges_kl").alias("edges")))).alias("k"))
    return rounded(long.select("column", "k.kind", F.posexplode("k.edges").alias("idx", "edge"))
                       .withColumn("idx", F.col("idx").cast("int")))


@register("psi", with_views('SELECT col AS "column", round(psi, 6) AS psi FROM drift_metrics', "drift_metrics"),
          ids=("DRF2",))
def q_psi(spark, sf):
    ref, cur = _frames(spark, sf)
    return rounded(drift.drift_metrics(ref, cur, COLS).select("column", "psi"))


@register("kl", with_views('SELECT col AS "column", round(kl, 6) AS kl FROM drift_metrics', "drift_metrics"),
          ids=("DRF3",))
def q_kl(spark, sf):
    ref, cur = _frames(spark, sf)
    return rounded(drift.drift_metrics(ref, cur, COLS).select("column", "kl"))


@register("drift_flag", with_views("""
SELECT col AS "column", round(psi, 6) AS psi, round(kl, 6) AS kl, psi > 0.2 OR kl > 0.5 AS flag,
       bool_or(psi > 0.2 OR kl > 0.5) OVER () AS drift
FROM drift_metrics""", "drift_metrics"), ids=("DRF4",))
def q_drift_flag(spark, sf):
    ref, cur = _frames(spark, sf)
    return rounded(drift.detect_drift(ref, cur, COLS))


@register("drift_table", with_views("""
SELECT w.col AS "column", round(m.psi, 6) AS psi, round(m.kl, 6) AS kl, 0.2::DOUBLE AS psi_threshold,
       0.5::DOUBLE AS kl_threshold, m.psi > 0.2 OR m.kl > 0.5 AS flag
FROM (SELECT unnest(['user_id', 'movie_id', 'rating', 'genre']) AS col) w
LEFT JOIN drift_metrics m ON m.col = w.col""", "drift_metrics"), ids=("DRF5",))
def q_drift_table(spark, sf):
    ref, cur = _frames(spark, sf)
    return drift.drift_table(ref, cur, ("user_id", "movie_id", "rating", "genre"))
