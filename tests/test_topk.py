"""Pruned top-k by inner product and ALS fold-in against brute force."""

import numpy as np
import pytest

from conftest import SF001
from reelsight.operators import als, topk


def factors(spark, m, ids):
    return spark.createDataFrame([(int(i), [float(x) for x in r]) for i, r in zip(ids, m)], "id long, features array<double>")


def brute(u, v, uids, vids, k, seen):
    out = {}
    s = u @ v.T
    for a, row in zip(uids, s):
        best = sorted((-x, i) for x, i in zip(row, vids) if (a, i) not in seen)[:k]
        out[a] = [i for _, i in best]
    return out


@pytest.mark.parametrize("tail,share", [(1.0, 0.35), (0.0, 1.01)])
def test_same_lists_as_brute_force(spark, tail, share):
    """Lengths that fall off (log-normal) and lengths that are all equal."""
    rng = np.random.default_rng(3)
    u, v = rng.normal(size=(150, 8)), rng.normal(size=(900, 8))
    v = v / np.linalg.norm(v, axis=1)[:, None] * np.exp(tail * rng.normal(size=900))[:, None]
    v[40:60] = v[40]  # ties
    uids, vids = [int(i) * 3 - 10 for i in range(150)], [int(i) for i in rng.permutation(2000)[:900]]
    seen = {(uids[a], vids[b]) for a, b in zip(rng.integers(0, 150, 4000), rng.integers(0, 900, 4000))}
    seen |= {(uids[0], i) for i in vids[:895]}  # five are left
    pairs = spark.createDataFrame([*seen, (10 ** 6, 1), (uids[1], 10 ** 6)], "uidx long, iidx long")
    lists, work = topk.top_products(factors(spark, u, uids), factors(spark, v, vids), 7, pairs, bucket=32, block=40)
    got = {}
    for r in sorted(lists.collect(), key=lambda r: r.rank):
        got.setdefault(r.uidx, []).append(r.iidx)
    assert got == brute(u, v, uids, vids, 7, seen)
    assert 0 < work.first()["pairs"] <= share * 150 * 900


def test_edges(spark):
    u, v = factors(spark, np.eye(2), [1, 2]), factors(spark, np.array([[1.0, 0.0], [0.0, 0.0]]), [5, 6])
    got = [tuple(r) for r in topk.top_products(u, v, 10)[0].orderBy("uidx", "rank").collect()]
    assert got == [(1, 1, 5, 1.0), (1, 2, 6, 0.0), (2, 1, 5, 0.0), (2, 2, 6, 0.0)]  # k beyond the catalogue
    for k, a, b in ((0, u, v), (-1, u, v), (3, u.limit(0), v), (3, u, v.limit(0))):
        lists, work = topk.top_products(a, b, k)
        assert lists.collect() == [] and work.first()["pairs"] == 0


def test_cells_copy_few_vectors():
    """Vectors copied to cells: before, one for each bucket and each 2,048 users."""
    for users, items in ((280_000, 1_200_000), (1_700_000, 7_200_000)):
        blocks, run = topk.cells(users, items, 20, topk.BUCKET)
        runs = -(-items // (run * topk.BUCKET))
        assert run * topk.BUCKET <= topk.CELL and users / blocks <= topk.CELL and blocks * runs >= topk.CELLS
        assert 30 * (users * runs + items * blocks) < users * items / topk.BUCKET + items * users / 2048
    blocks, run = topk.cells(280_000, 1_200_000, 1_000_000, topk.BUCKET)
    assert 280_000 / blocks * run * topk.BUCKET <= topk.LISTS  # long lists: the lists of a cell are bounded
    assert topk.cells(1, 1, 5, 64) == (1, 1)


def test_several_runs_and_users_of_many_seen_items(spark, monkeypatch):
    """Cells of several buckets, tiles of several users, k above a cell's items."""
    monkeypatch.setattr(topk, "CELL", 64)
    rng = np.random.default_rng(5)
    u, v = rng.normal(size=(540, 4)), np.round(rng.normal(size=(200, 4)), 1)  # ties
    uids, vids = list(range(540)), list(range(200))
    seen = {(int(a), int(b)) for a, b in zip(rng.integers(0, 540, 9000), rng.integers(0, 200, 9000))}
    pairs = spark.createDataFrame(list(seen), "uidx long, iidx long")
    for k in (9, 1000):
        got = {}
        for r in topk.top_products(factors(spark, np.round(u, 1), uids), factors(spark, v, vids), k, pairs, bucket=16)[0].orderBy("uidx", "rank").collect():
            got.setdefault(r.uidx, []).append((round(r.score, 6), r.iidx))
        for a, row in zip(uids, np.round(u, 1) @ v.T):
            want = sorted((-round(x, 6), i) for x, i in zip(row, vids) if (a, i) not in seen)[:k]
            assert [x for x, _ in got[a]] == [-x for x, _ in want] and len({i for _, i in got[a]}) == len(want)
            assert not {(a, i) for _, i in got[a]} & seen


def test_fold_in_gives_the_factors_of_training(spark):
    from reelsight.plans.q_als import offline_model
    from reelsight.plans.q_ranking import Offline

    p = Offline(spark, SF001)
    model = offline_model(p)
    want = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    ui = als.ui_matrix(p.train).where("value > 0")
    for chunk in (4096, 7):  # users whole, and in several chunks
        got = {r.id: np.array(r.features) for r in als.fold_in(ui, model.itemFactors, chunk=chunk).collect()}
        assert set(got) == set(want)
        assert max(np.abs(got[i] - want[i]).max() for i in want) < 1e-4


def test_fold_in_of_odd_users(spark):
    items = factors(spark, np.array([[1.0, 0.5], [0.2, 1.0]]), [1, 2])
    ui = spark.createDataFrame([(1, 1, 2.0), (1, 9, 1.0), (2, 9, 1.0), (3, 1, 0.0), (4, None, 1.0), (None, 1, 1.0), (5, 1, 1.0), (5, 2, -1.0)],
                               "uidx long, iidx long, value double")
    got = {r.id: np.array(r.features) for r in als.fold_in(ui, items, reg=0.1, alpha=2.0).collect()}
    y = np.array([[1.0, 0.5], [0.2, 1.0]])
    assert set(got) == {1, 5}  # unknown items, no positive value, null ids: no row
    one = np.linalg.solve(y.T @ y + 4 * np.outer(y[0], y[0]) + 0.1 * np.eye(2), 5 * y[0])
    five = np.linalg.solve(y.T @ y + 2 * np.outer(y[0], y[0]) + 2 * np.outer(y[1], y[1]) + 0.1 * np.eye(2), 3 * y[0])
    assert np.allclose(got[1], one) and np.allclose(got[5], five)
    assert als.fold_in(ui, items.limit(0)).collect() == [] and als.fold_in(ui.limit(0), items).collect() == []


def test_training_keeps_no_files_of_past_iterations(spark):
    """Of about two shuffles an iteration only those that the last factors hang on stay."""
    import time

    rng = np.random.default_rng(2)
    ui = spark.createDataFrame([(int(a), int(b), 1.0) for a, b in {*zip(rng.integers(0, 60, 400), rng.integers(0, 40, 400))}],
                               "uidx int, iidx int, value double")
    kept = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    before = kept.size()
    model = als.train_als(ui, rank=4)
    for _ in range(40):  # the files are removed in the background
        if kept.size() < before + 20:
            break
        time.sleep(0.25)
    assert kept.size() < before + 20
    assert model.userFactors.count() == ui.select("uidx").distinct().count()


def test_blocks_bound_what_a_task_gathers():
    """Before: 10 blocks of any table; at 65 million ratings a task then gathered 4 million factors."""
    for n, others in ((10_800_000, 900_000), (10_800_000, 1_200_000), (65_000_000, 7_200_000), (10 ** 10, 10 ** 9), (10 ** 10, 10 ** 6)):
        blocks = als.blocks_for(n, others)
        got = others * -np.expm1(-n / (blocks * others))
        assert got <= 1.01 * als.RECEIVED and blocks >= als.BLOCKS
    assert als.blocks_for(10 ** 6, 10 ** 5) == als.blocks_for(0, 0) == 10


def test_lists_of_the_whole_catalogue(spark, monkeypatch):
    """One row a user, ties by id; the same entries in pieces where a task cannot hold the catalogue."""
    rng = np.random.default_rng(7)
    u, v = np.round(rng.normal(size=(90, 4)), 1), np.round(rng.normal(size=(300, 4)), 1)
    v[10:20] = v[10]  # ties
    uids, vids = list(range(5, 95)), [int(i) for i in rng.permutation(900)[:300]]
    monkeypatch.setattr(topk, "ENTRIES", 700)
    monkeypatch.setattr(topk, "PIECE", 64)
    x, y = factors(spark, u, uids), factors(spark, v, vids)
    want = brute(u, v, uids, vids, 300, set())
    rows = topk.top_lists(x, y, 1000).collect()
    assert len(rows) == 90 and {r.uidx: len(r["items"]) for r in rows} == {i: 300 for i in uids}
    by_id = {i: f for i, f in zip(vids, v)}
    for r in rows:
        assert r["rank"] == 1 and sorted(r["items"]) == sorted(vids)
        assert np.allclose(r.scores, [u[r.uidx - 5] @ by_id[i] for i in r["items"]])
        assert all(s > t or i < j for s, t, i, j in zip(r.scores, r.scores[1:], r["items"], r["items"][1:]))
        assert np.allclose(r.scores, [u[r.uidx - 5] @ by_id[i] for i in want[r.uidx]])
    monkeypatch.setattr(topk, "CELL", 256)
    for k, n in ((1000, 300), (70, 70)):
        got = {}
        for r in topk.top_lists(x, y, k).collect():
            got.setdefault(r.uidx, []).append(r)
        assert len(got) == 90 and len(got[5]) > 1
        for i, pieces in got.items():
            assert min(p["rank"] for p in pieces) == 1
            assert len({j for p in pieces for j in p["items"]}) == sum(len(p["items"]) for p in pieces) == n
    for k, a, b in ((0, x, y), (5, x.limit(0), y), (500, x.limit(0), y), (500, x, y.limit(0))):
        assert topk.top_lists(a, b, k).collect() == []


def test_serving_facts_read_lists_not_entries(spark, monkeypatch):
    """Before, every entry of every list was a row."""
    from reelsight.plans import q_als

    monkeypatch.setattr(topk, "top_products", lambda *a, **b: pytest.fail("a row for every pair"))
    monkeypatch.setattr(als, "top_products", lambda *a, **b: pytest.fail("a row for every pair"))
    rows = q_als.q_als_serving_facts(spark, SF001).collect()
    assert rows and {r.n_items for r in rows} == {max(r.n_items for r in rows)} and {r.first_rank for r in rows} == {1}
