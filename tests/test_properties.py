"""Distributed rewrites of the operators against direct Python definitions
on random data (including one user holding a third of all rows)."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelsight.operators import common, features, online, recommend, registry, splits


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_popularity_recs_exact_with_hot_user(spark):
    rnd = random.Random(7)
    n_items, k = 600, 20
    ranking = [(i, p) for p, i in enumerate(rnd.sample(range(1000, 1000 + n_items), n_items), start=1)]
    seen = []
    for u in range(30):
        take = rnd.randint(0, 40)
        seen += [(u, i) for i, _ in rnd.sample(ranking, take)]
    # user 99 has seen most of the top of the ranking and much more: > 1/3 of all rows
    seen += [(99, i) for i, p in ranking if p <= 500 and p % 7 != 0]
    seen += seen[:50]  # duplicates allowed
    users = [(u,) for u in list(range(30)) + [99, 123]]
    rk = spark.createDataFrame(ranking, "item_id int, pos int")
    sn = spark.createDataFrame(seen, "user_id int, item_id int")
    us = spark.createDataFrame(users, "user_id int")
    got = _rows(recommend.popularity_recs(us, sn, rk, k), "user_id", "rank", "item_id")
    by_pos = sorted(ranking, key=lambda x: x[1])
    want = []
    for (u,) in users:
        s = {i for uu, i in seen if uu == u}
        items = [i for i, _ in by_pos if i not in s][:k]
        want += [(u, r, i) for r, i in enumerate(items, start=1)]
    assert got == sorted(want)


def test_global_rank_is_contiguous(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("v"), "id").repartition(13)
    r = common.global_rank(df, [F.col("v").desc(), F.col("id").asc()], "rk").collect()
    ranks = sorted(x["rk"] for x in r)
    assert ranks == list(range(1, 5001))
    ordered = sorted(r, key=lambda x: x["rk"])
    assert all((a["v"], -a["id"]) >= (b["v"], -b["id"]) for a, b in zip(ordered, ordered[1:]))


def test_interval_join_matches_definition(spark):
    rnd = random.Random(3)
    resp, wat = [], []
    for rid in range(300):
        u = 0 if rid % 3 == 0 else rnd.randint(1, 20)  # user 0 is hot
        t = rnd.randint(0, 5000)
        resp.append((rid, u, t, [rnd.randint(0, 30) for _ in range(rnd.randint(0, 6))]))
    for _ in range(900):
        wat.append((0 if rnd.random() < 0.4 else rnd.randint(1, 20), rnd.randint(0, 5500), rnd.randint(0, 30)))
    for h in (0, 1, 250, 1000):
        r = spark.createDataFrame(resp, "request_id int, user_id int, ts long, movie_ids array<bigint>")
        w = spark.createDataFrame(wat, "user_id int, ts long, movie_id bigint")
        got = {x["request_id"]: (x["success"], x["first_hit"])
               for x in online.response_success(r, w, h).collect()}
        for rid, u, t, items in resp:
            hits = [p for p, m in enumerate(items, start=1)
                    if any(wu == u and wm == m and t <= wt <= t + h for wu, wt, wm in wat)]
            assert got[rid] == ((1, min(hits)) if hits else (0, None)), (h, rid)
        parts = online.proxy_kpi_parts(r, w, h).first()
        active = sum(1 for rid, u, t, items in resp
                     if items and any(wu == u and t <= wt <= t + h for wu, wt, _ in wat))
        hit = sum(1 for rid, u, t, items in resp
                  if any(wu == u and wm in items and t <= wt <= t + h for wu, wt, wm in wat))
        assert (parts["requests_with_watch"], parts["requests_with_hit"]) == (active, hit)


def test_asof_matches_definition(spark):
    rnd = random.Random(11)
    acts = [(f"v{i}", rnd.randint(0, 400000)) for i in range(12)]
    reqs = [(i, rnd.randint(-50000, 500000)) for i in range(400)]
    a = spark.createDataFrame(acts, "version string, activated_at long")
    q = spark.createDataFrame(reqs, "request_id int, ts long")
    got = dict(_rows(registry.active_version_asof(q, a), "request_id", "version"))
    for rid, t in reqs:
        before = [(at, v) for v, at in acts if at <= t]
        assert got[rid] == (max(before)[1] if before else None), rid
    assert len(got) == len(reqs)


def test_holdout_partitions_input(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 9), rnd.randint(0, 50), rnd.randint(0, 20), i) for i in range(400)]
    df = spark.createDataFrame(rows, "uidx int, iidx int, timestamp int, row int")
    train, test = splits.last_item_holdout(df, ["row"])
    assert train.count() + test.count() == len(rows)
    for u, item, t in _rows(test, "uidx", "true_item", "timestamp"):
        mine = [r for r in rows if r[0] == u]
        best = max(x[2] for x in mine)
        first = min((x for x in mine if x[2] == best), key=lambda x: x[3])
        assert (item, t) == (first[1], first[2])


def test_dense_index(spark):
    df = spark.createDataFrame([(x,) for x in (5, 3, 5, 9, 1, 3)], "u int")
    assert _rows(common.dense_index(df, "u", "idx"), "u", "idx") == [(1, 0), (3, 1), (5, 2), (9, 3)]


def test_exact_quantiles_equal_percentile(spark):
    rnd = random.Random(9)
    vals = [(float(rnd.choice([rnd.randint(0, 30), rnd.randint(0, 10 ** 6)])), rnd.choice([None, float("nan"), 1.5, 2.5]), None)
            for _ in range(3000)]
    df = spark.createDataFrame(vals, "v double, w double, n double")
    qs = [0.0, 0.2, 0.5, 0.8, 0.999, 1.0]
    got = common.exact_quantiles(df, ["v", "w", "n"], qs)
    for c in ("v", "w"):
        ok = df.where(F.col(c).isNotNull() & ~F.isnan(c))
        assert got[c] == list(ok.agg(F.percentile(c, F.array(*[F.lit(q) for q in qs]))).first()[0])
    assert got["n"] is None and common.exact_quantiles(df, [], qs) == {}


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_running_sum_and_rank_over_many_partitions(spark, reuse):
    """Offsets belong to the partitions of the rows, with a column that only
    one branch reads and with and without exchange reuse."""
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        rng = np.random.default_rng(8)
        n = 400_000
        score, label = rng.permutation(n * 3)[:n] / 7.0, rng.integers(0, 2, n)
        df = spark.createDataFrame(pd.DataFrame({"y_score": score, "y_true": label, "extra": score.astype(str)}))
        got = features.auc(df).first()
        ranks = np.empty(n)
        ranks[np.argsort(score)] = np.arange(1, n + 1)
        pos = int(label.sum())
        want = (ranks[label == 1].sum() - pos * (pos + 1) / 2) / (pos * (n - pos))
        assert abs(got["auc"] - want) < 1e-12
        r = common.global_rank(df, [F.col("y_score").desc()], "r").agg(F.countDistinct("r"), F.min("r"), F.max("r")).first()
        assert tuple(r) == (n, 1, n)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_unseen_lists_match_definition(spark):
    from reelsight.operators import als

    rng = np.random.default_rng(3)
    users, items = rng.normal(size=(40, 6)), rng.normal(size=(90, 6))
    items[7] = items[3]  # a tie
    seen = [(u, int(i)) for u in range(40) for i in rng.choice(90, size=u * 2, replace=False)] + [(99, 1), (1, 999)]
    table = lambda m: spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "id int, features array<float>")
    got = als.top_unseen(table(users), table(items), spark.createDataFrame(seen, "uidx int, iidx int"), 20).collect()
    known = {}
    for u, i in seen:
        known.setdefault(u, set()).add(i)
    score = users.astype("float32").astype(float) @ items.astype("float32").astype(float).T
    for u in range(40):
        mine = [(r["rank"], r["iidx"]) for r in got if r["uidx"] == u]
        left = sorted((i for i in range(90) if i not in known.get(u, ())), key=lambda i: (-score[u, i], i))[:20]
        assert sorted(mine) == list(enumerate(left, 1))


def test_alerts_do_not_depend_on_batch_order(spark, tmp_path):
    """Twelve flagged minutes in a row fire once, in order or swapped, for
    each service, and a gap keeps another from firing."""
    from reelsight.streaming import pipelines as sp

    rows = {"a": [60 * i for i in range(100, 112)], "b": [60 * i for i in range(100, 112) if i != 105]}
    chunks = [[(s, t) for s, v in rows.items() for t in v if t // 60 % 3 == k] for k in (2, 0, 1)] + [[("end", 10 ** 6)]]
    path = str(tmp_path / "in")
    for c in chunks:
        spark.createDataFrame(c, "service string, window_start bigint").coalesce(1).write.mode("append").parquet(path)
    s = sp.read_stream(spark, path, "service string, window_start bigint", max_files_per_trigger=1)
    sp.run_available(sp.alert_stream(s, delay="1 hour").writeStream.format("parquet").option("path", str(tmp_path / "out"))
                     .option("checkpointLocation", str(tmp_path / "ckpt")))
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert got == [("a", 6000, 6600)]


def test_replay_after_midnight_replaces_itself(spark, tmp_path):
    """The same batch written twice lands in the folder of its event date."""
    from reelsight.sources import sinks

    df = spark.createDataFrame([("t", 1, 0, "2024-05-01")], "topic string, x int, batch_id long, day string")
    for _ in range(2):
        sinks.write_batch(df.drop("day"), str(tmp_path), "t", ("parquet",), date=F.to_date(F.lit("2024-05-01")),
                          mode="overwrite", extra_partitions=("batch_id",))
    assert spark.read.parquet(f"{tmp_path}/parquet").count() == 1


def test_invalid_record_fails_also_after_select(spark):
    from reelsight.operators import quality
    from reelsight.sources.schemas import WATCH_EVENT

    good = '{"event": "watch", "user_id": 1, "movie_id": 2, "timestamp": "2024-01-01T00:00:00Z", "platform": null}'
    df = spark.createDataFrame([(1, good), (2, '{"event": "watch", "user_id": "x"}')], "id int, j string")
    v = quality.validate_json(df, "j", WATCH_EVENT)
    with pytest.raises(Exception, match="invalid record"):
        quality.assert_valid(v).select("id").collect()
    assert quality.assert_valid(v.where("id = 1")).select("id").count() == 1
    # a record is parsed once, however often the check names its fields
    plan = quality.assert_valid(v).select("id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") + plan.lower().count("parse_json") == 1


def test_edge_cases_of_reports(spark):
    from reelsight.operators import drift, exposure, ranking, registry

    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (None, None)], "g int, x double")
    assert [tuple(r) for r in exposure.freq_topn(df, "g").collect()] == [("1", 1.0)]
    h = exposure.histogram(df, "x", 4).orderBy("bin").collect()
    assert [(r["lo"], r["count"], r["density"]) for r in h] == [(1.5, 0, 0.0), (1.75, 0, 0.0), (2.0, 2, 4.0), (2.25, 0, 0.0)]
    tiers = spark.createDataFrame([(1, "Head")], "item_id int, tier string")
    none = exposure.exposure_by_tier(spark.createDataFrame([], "item_id int"), tiers).collect()
    assert sorted((r["tier"], r["slots"], r["share"]) for r in none) == [("Head", 0, 0.0), ("Mid", 0, 0.0), ("Tail", 0, 0.0)]
    empty = spark.createDataFrame([], "uidx int, k int, precision double, recall double, ndcg double, map double")
    assert sorted((r["k"], r["map"], r["users"]) for r in ranking.overall(empty, (5, 10)).collect()) == [(5, None, 0), (10, None, 0)]
    req = spark.createDataFrame([(1, 5), (2, None), (3, 20)], "request_id int, ts long")
    act = spark.createDataFrame([("v0.1", 10), ("v0.2", None)], "version string, activated_at long")
    assert sorted((r["request_id"], r["version"]) for r in registry.active_version_asof(req, act).collect()) == [
        (1, None), (2, None), (3, "v0.1")]
    t = drift.drift_table(df, df, ("x", "zz")).collect()
    assert sorted((r["column"], r["psi"], r["psi_threshold"], r["kl_threshold"], r["flag"]) for r in t) == [
        ("x", 0.0, 0.2, 0.5, False), ("zz", None, 0.2, 0.5, None)]


def test_binomial_table_is_the_binomial(spark):
    from math import comb

    from reelsight.operators import experiment

    c = spark.createDataFrame([(2, 6), (0, 4), (4, 4), (300, 1000)], "s long, n long")
    for s, n in ((2, 6), (300, 1000)):
        got = {r["k"]: r["cdf"] for r in experiment.binomial_table(c.where(f"s = {s} and n = {n}"), "s", "n").collect()}
        p, acc = s / n, 0.0
        for k in range(n + 1):
            acc += comb(n, k) * p ** k * (1 - p) ** (n - k)
            if k in got:
                assert abs(got[k] - acc) < 1e-9
    for s in (0, 4):
        assert [tuple(r) for r in experiment.binomial_table(c.where(f"s = {s} and n = 4"), "s", "n").collect()] == [(s, 1.0)]
    draws = experiment.binomial_draws(experiment.binomial_table(c.where("s = 300"), "s", "n"), 2000, 1, "x").agg(
        F.avg("k"), F.stddev("k"), F.count("k")).first()
    assert abs(draws[0] - 300) < 1.5 and abs(draws[1] - 14.49) < 1 and draws[2] == 2000


def test_shared_folder_is_required_off_local(monkeypatch, spark):
    from reelsight import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def _counted(spark, rows, schema):
    """The rows, and how often they were read in all."""
    acc = spark.sparkContext.accumulator(0)
    rdd = spark.sparkContext.parallelize(rows, 4).map(lambda r: (acc.add(1), r)[1])
    return spark.createDataFrame(rdd, schema), acc


def _rated(n=400):
    rnd = random.Random(11)
    rows = [(rnd.choice([None, 1, 2, 3, 50, 60, 70]), rnd.choice([None, 5, 6, 7, 8]), rnd.randint(1, 50) / 10,
             rnd.choice([None, 10, 20, 30]), i // 3, i % 3) for i in range(n)]
    rows += [(80, 5, 4.0, None, n, 0), (80, None, 4.0, 40, n, 1), (81, 6, 4.0, None, n, 2), (81, 7, 1.0, 9, n, 3)]
    return rows + rows[:20]


def test_reindex_and_mark_read_their_input_twice(spark):
    rows = _rated()
    order = ["o", "l", "item_id", "timestamp"]
    schema = "user_id int, item_id int, rating double, timestamp long, o int, l int"
    df, acc = _counted(spark, rows, schema)
    users = {u: sum(r[0] == u for r in rows) for u in {r[0] for r in rows} - {None}}
    kept = [r for r in rows if users.get(r[0], 0) >= 2 and r[1] is not None]
    uidx = {u: i for i, u in enumerate(sorted(u for u, n in users.items() if n >= 2))}
    iidx = {x: i for i, x in enumerate(sorted({r[1] for r in kept}))}
    plain = _rows(splits.reindex(df, 2), "uidx", "iidx", "o", "l")
    assert plain == sorted((uidx[r[0]], iidx[r[1]], r[4], r[5]) for r in kept)
    assert acc.value <= 2 * len(rows)

    def place(r):  # no time is the latest, then the input order
        return (0 if r[3] is None else 1, -(r[3] or 0), r[4], r[5], r[1])

    best = {u: min((r for r in kept if r[0] == u), key=place) for u in {r[0] for r in kept}}
    read = acc.value
    marked = splits.mark_last_item(splits.reindex(df, 2, ts="timestamp"), order)
    assert "is_last" not in marked.columns
    got = _rows(marked, "uidx", "iidx", "o", "l", "is_test")
    assert got == sorted((uidx[r[0]], iidx[r[1]], r[4], r[5], r == best[r[0]]) for r in kept)
    assert acc.value - read <= 2 * len(rows)
    assert got == _rows(splits.mark_last_item(splits.reindex(df, 2), order), "uidx", "iidx", "o", "l", "is_test")


def test_reindex_with_owners_is_reindex_of_the_join(spark):
    rnd = random.Random(12)
    owners = spark.createDataFrame([(o, rnd.choice([None, 1, 2, 3, 50])) for o in [*range(60), *range(12), None, None]],
                                   "o int, user_id int")
    lines = spark.createDataFrame([(rnd.choice([None, *range(70)]), rnd.choice([None, 5, 6, 7]), rnd.choice([None, 10, 20, 30]), i)
                                   for i in range(150)] * 2, "o int, item_id int, timestamp long, l int")
    joined = lines.join(owners, "o")
    for n in (2, 80):
        assert (_rows(splits.reindex(lines, n, owners=owners, by="o"), "uidx", "iidx", "o", "l")
                == _rows(splits.reindex(joined, n), "uidx", "iidx", "o", "l"))
        got = splits.reindex(lines, n, ts="timestamp", owners=owners, by="o", last_only=["o", "l", "timestamp"])
        last = got.where("is_last")
        want = splits.reindex(joined, n, ts="timestamp")
        assert (sorted(map(repr, last.select("uidx", "iidx", "o", "l", "timestamp").collect()))
                == sorted(map(repr, want.where("is_last").select("uidx", "iidx", "o", "l", "timestamp").collect())))
        assert _rows(got, "uidx", "iidx", "is_last") == _rows(want, "uidx", "iidx", "is_last")
        assert got.where("not is_last").agg(F.count("o"), F.count("l"), F.count("timestamp")).first() == (0, 0, 0)


def test_offline_rows_move_once_to_their_order(spark, tmp_path, monkeypatch):
    from reelsight.plans import q_ranking

    rnd = random.Random(4)
    spark.createDataFrame([(o, rnd.randint(1, 9)) for o in range(80)], "o_orderkey long, o_custkey long").write.parquet(
        str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(rnd.randint(0, 85), rnd.randint(1, 12), rnd.randint(1, 3), i % 7, float(rnd.randint(1, 50)), 86400 * rnd.randint(1, 90))
                           for i in range(300)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, s long"
                          ).withColumn("l_shipdate", F.timestamp_seconds("s")).drop("s").write.parquet(str(tmp_path / "lineitem.parquet"))
    plans = {}

    def kept(df, tag, write=splits.materialize):
        plans[tag] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, tag)

    monkeypatch.setattr(splits, "materialize", kept)
    monkeypatch.setattr(q_ranking, "materialize", kept)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = q_ranking.offline_metrics(spark, str(tmp_path))
        joins = [x for x in plans["reindex"].splitlines() if "SortMergeJoin" in x]
        assert "SortMergeJoin [l_orderkey" in joins[0]  # the users' ids come with the orders
        assert "truth" in plans  # one join for lists, truth lengths and hits
        users = q_ranking.Offline(spark, str(tmp_path)).users.count()
        assert users and out.count() == 3 * users
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("small", [0, 100_000])
def test_popularity_recs_null_keys_and_short_rankings(spark, small, monkeypatch):
    monkeypatch.setattr(recommend, "SMALL", small)
    monkeypatch.setattr(recommend, "BLOCK", 4)
    monkeypatch.setattr(recommend, "EXPAND", 7)
    rnd = random.Random(5)
    ranking = [(None if p == 3 else 100 + p, p, p * 0.5) for p in range(1, 31)]
    seen = [(u, rnd.choice([None, 7, *range(101, 101 + 3 * u)])) for u in range(1, 11) for _ in range(4 * u)]
    seen += [(11, 100 + p) for p in range(1, 31)] + [(None, 101), (77, 101)]
    users = [*range(1, 13), None]
    us, sn = spark.createDataFrame([(u,) for u in users + users], "user_id int"), spark.createDataFrame(seen, "user_id int, item_id int")
    rk = spark.createDataFrame(ranking, "item_id int, pos int, x double")
    for k in (0, 1, 6, 40):
        got = recommend.popularity_recs(us, sn, rk, k, carry=["x"])
        want = []
        for u in users:
            s = {i for uu, i in seen if uu == u and u is not None and i is not None}
            want += [(u, n, *r) for n, r in enumerate([r for r in ranking if r[0] not in s][:k], start=1)]
        assert sorted(map(repr, map(tuple, got.select("user_id", "rank", "item_id", "pos", "x").collect()))) == sorted(map(repr, want))


def test_fair_rerank_does_not_deal_expanded_lists(spark):
    rk = spark.createDataFrame([(i, i, 1000 - i) for i in range(1, 901)], "item_id int, pos int, pop_count int")
    sn = spark.createDataFrame([(u, 1 + u % 9) for u in range(40)], "user_id int, item_id int")
    out = recommend.fair_rerank(sn.select("user_id"), sn, rk, 5)
    above = out._jdf.queryExecution().sparkPlan().toString().split("Generate")[0]
    assert "Window" in above and "Join" in above and "SortMergeJoin" not in above
    lists = out._jdf.queryExecution().executedPlan().toString().split("Generate")[0]
    assert "Exchange hashpartitioning" not in lists
    assert out.count() == 40 * 5


def test_ab_responses_reads_the_ratings_once(spark, tmp_path, monkeypatch):
    from reelsight.plans import q_experiment

    rnd = random.Random(3)
    rows = [(rnd.randint(0, 9), rnd.randint(0, 15), rnd.randint(1, 50) / 10, i) for i in range(200)]
    df, acc = _counted(spark, rows, "user_id long, item_id long, rating double, timestamp long")
    monkeypatch.setattr(q_experiment, "ratings", lambda spark, sf: df)
    spark.createDataFrame([(i, i % 12, "view" if i % 3 else "click", 1.5, '{"k": 4}') for i in range(60)],
                          "event_id long, user_id long, event_type string, value double, props string").withColumn(
        "ts", F.timestamp_seconds(F.col("event_id"))).write.parquet(str(tmp_path / "events.parquet"))
    spark.createDataFrame([(i, [rnd.random() for _ in range(4)]) for i in range(16)],
                          "vec_id long, embedding array<double>").write.parquet(str(tmp_path / "embeddings.parquet"))
    monkeypatch.setitem(q_experiment.PLANS, "snapshot_id", None)  # the id comes from the written ratings, too
    out = q_experiment.q_ab_responses(spark, str(tmp_path)).collect()
    assert len(out) == 40 and len({r["data_snapshot_id"] for r in out}) == 1
    assert acc.value == len(rows)
