"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash

from llm_setup import few_partitions  # noqa: F401
from reelsight.llm import simhash
from reelsight.llm.components import components

SCHEMA = "doc_id long, text string, source string, fp string, component_id int"


def slow_fingerprint(text, k):
    w = [x for x in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").replace("\n", " ").split(" ") if x]
    if not w:
        return 0
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(fps, bits):
    """Smallest id reachable for a list of (id, fp)."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(fps))]


def texts():
    rng = random.Random(4)
    words = [f"w{i}É" if i % 7 == 0 else f"Word{i}" for i in range(300)]
    out = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 120)))) for i in range(40)]
    for i in range(40, 80):  # near copies: a few words changed
        w = out[i % 10 * 4][1].split()
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append((i, " ".join(w)))
    out += [(90, None), (91, ""), (92, " \t\n"), (93, out[3][1]), (93, out[3][1]), (None, out[5][1]), (94, "one two"),
            (None, "no id at all " * 9), (95, "long " * 70_000 + "end")]
    return out


def test_fingerprint_matches_definition():
    for _, t in texts():
        got = simhash.fingerprint((t or "").encode(), 4) & (2 ** 64 - 1)
        if t is None or len(t) < 50_000:
            assert got == slow_fingerprint(t, 4)


def test_components_match_brute_force(spark):
    rows = texts()
    df = spark.createDataFrame([(d, t, "s", "clash", 1) for d, t in rows], SCHEMA)
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    fps = [(d, simhash.fingerprint((t or "").encode(), 4) & (2 ** 64 - 1)) for d, t in rows]
    want = sorted(((d, f, c) for (d, f), c in zip(fps, slow_components(fps, 4))), key=str)
    assert sorted(((r.doc_id, r.fp & (2 ** 64 - 1), r.component_id) for r in got), key=str) == want


@pytest.mark.parametrize("heavy,block", [(10_000, 512), (4, 3)])
def test_dense_groups(spark, heavy, block):
    """Many fingerprints around few centres, through blocks and without."""
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(3)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(60)}
    signed = [(f - 2 ** 64 if f >= 2 ** 63 else f,) for f in sorted(fps)]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), 4, heavy, block)
    got = {r.node: r.root for r in components(edges).collect()}
    ids = [f for f, in signed]
    want = slow_components([(f, f & (2 ** 64 - 1)) for f in ids], 4)
    assert [got.get(f, f) for f in ids] == want


@pytest.mark.parametrize("n", [10, 100_000, 10 ** 9])
@pytest.mark.parametrize("bits", [0, 1, 3, 4, 6])
def test_layout_loses_no_pair(n, bits):
    seg = simhash.layout(n, bits)
    assert sum(w for _, w, _ in seg) == 64 or bits == 0
    assert bits == 0 or sum(r + 1 for _, _, r in seg) == bits + 1


def test_one_of_each(spark):
    rows = texts()
    df = spark.createDataFrame([(d, t, "s", "clash", 1) for d, t in rows], SCHEMA)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    fps = [(d, simhash.fingerprint((t or "").encode(), 4) & (2 ** 64 - 1)) for d, t in rows]
    comp = slow_components(fps, 4)
    named = sorted({c for c in comp if c is not None})
    got = [r.doc_id for r in kept.collect()]
    assert sorted(d for d in got if d is not None) == named
    assert got.count(None) == sum(1 for c in comp if c is None)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.one_of_each(df).collect() == []


def test_components_of_a_long_chain(spark):
    n = 300
    order = np.random.default_rng(0).permutation(n).tolist()
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n)}, 500: 500, 501: 500}


@pytest.fixture()
def plans(monkeypatch):
    """Spark's first plan of each written table."""
    got = {}

    def staged(df, tag):
        got[tag] = df._jdf.queryExecution().sparkPlan().toString()
        return before(df, tag)

    before = simhash.staged
    monkeypatch.setattr(simhash, "staged", staged)
    return got


def test_exploded_tables_are_not_sent_to_all_tasks(spark, plans):
    """Spark's estimate leaves out the rows that an explode makes, so these
    joins are sorted and merged whatever it says."""
    links = simhash.links(spark.createDataFrame([(1,), (3,), (2 ** 62,)], "fp long"), 4)
    assert "Broadcast" not in plans["simhash-found"] and "SortMergeJoin" in plans["simhash-found"]
    lines = links._jdf.queryExecution().sparkPlan().toString().split("\n")
    # what is left are the few entries of heavy groups, met by both sides
    assert sum("BroadcastHashJoin" in x for x in lines) <= 2 and sum("SortMergeJoin" in x for x in lines) >= 2


def test_nor_in_the_pipeline(spark, plans):
    import corpus_pipeline

    df = spark.createDataFrame([(d, t, "s", "x", 1) for d, t in texts()[:20]], SCHEMA)
    kept = corpus_pipeline.near_duplicates(spark, df, "")
    assert "Broadcast" not in plans["simhash-found"] and 0 < kept.count() <= 20
