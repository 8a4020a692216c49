"""Recall of the production forest against brute force, where it approximates."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from llm_setup import few_partitions  # noqa: F401
from reelsight.llm import prefix_forest


def recall(spark, folder, x, k=20):
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x))}), f"{folder}/v.parquet")
    df = spark.read.parquet(f"{folder}/v.parquet")
    got = prefix_forest.search(df, df.where("vec_id % 200 = 0"), k=k).collect()
    hit, asked = 0, range(0, len(x), 200)
    for q in asked:
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(set(np.argsort(-s)[:k].tolist()) & {r.vec_id for r in got if r.query_id == q})
    return hit / k / len(asked)


def directions(n, d=64, seed=8):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1)[:, None], rng


@pytest.mark.parametrize("lengths", ["few long", "lognormal"])
def test_recall_of_unequal_lengths(spark, tmp_path, lengths):
    x, rng = directions(8_000)
    size = np.where(np.arange(len(x)) % 100 == 1, 10.0, 1.0) if lengths == "few long" else np.exp(2 * rng.normal(size=len(x)))
    assert recall(spark, tmp_path, x * size[:, None]) >= 0.95


def test_recall_of_the_production_forest(spark, tmp_path):
    x, _ = directions(20_000)  # two chunks
    assert len(x) > prefix_forest.Forest().chunk
    found = recall(spark, tmp_path, x)
    print("recall", found)
    assert found >= 0.95


def test_every_length_and_every_row(spark):
    """Vectors of two numbers of components, and rows that share an id."""
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(300)] + [(1000 + i, rng.normal(size=3).tolist()) for i in range(30)]
    rows += [(7, rng.normal(size=16).tolist()), (8, rows[8][1]), (20, rng.normal(size=16).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = prefix_forest.Forest(share=1.0, chunk=64)
    got = {}
    for r in prefix_forest.search(df, df.where("vec_id % 20 = 0 and vec_id <> 20"), k=40, forest=whole).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 9)))
    assert set(got) == {i for i in range(0, 300, 20) if i != 20} | {1000, 1020}
    for q, mine in got.items():
        v = next(x for i, x in rows if i == q)
        s = sorted((-round(float(np.dot(v, x)), 9), i) for i, x in rows if i != q and len(x) == len(v))[:40]
        assert sorted(mine) == [(n, i, -x) for n, (x, i) in enumerate(s, 1)]


@pytest.mark.parametrize("n", [25, 200, 2_000])
def test_recall_of_small_tables(spark, tmp_path, n):
    x, _ = directions(n)
    assert recall(spark, tmp_path, x) >= (1.0 if n <= 200 else 0.95)
