"""Jaccard join of shingle sets against brute force."""

import random

import pytest

from llm_setup import few_partitions  # noqa: F401
from reelsight.llm import shingle_join
from reelsight.llm.shingle_join import Near

SCHEMA = "doc_id long, text string, n long, comp int, key string, rec string"


def slow_set(text, k=3):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for s in "\t\n\v\f\r":
        t = t.replace(s, " ")
    w = [x for x in t.split(" ") if x]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def slow(rows):
    sets = [slow_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def edited(rng, words, pool, n):
    w = list(words)
    for _ in range(n):
        i = rng.randrange(len(w))
        w[i:i + rng.randint(0, 1)] = [rng.choice(pool)] * rng.randint(0, 1)
    return w


def texts(seed):
    """Groups around texts of many lengths, with edits about the limit."""
    rng = random.Random(seed)
    pool = [f"W{i}é" if i % 5 == 0 else f"w{i}" for i in range(400)]
    rows, i = [], 0
    for size in (3, 5, 8, 10, 11, 12, 14, 20, 25, 40, 60, 100, 150, 300):
        for _ in range(3):
            base = [rng.choice(pool) for _ in range(size)]
            for _ in range(6):
                rows.append((i, " ".join(edited(rng, base, pool, rng.randint(0, max(1, size // 25))))))
                i += 1
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "one  two"), (7, rows[7][1]),
             (7, rows[7][1]), (None, rows[60][1]), (None, "no id at all but words"), (907, "same " * 50), (908, "same " * 9),
             (909, " ".join(f"v{k}" for k in range(30_000))), (910, " ".join(f"v{k}" for k in range(29_000))),
             (911, " ".join(f"v{k}" for k in range(26_000)))]
    return rows


@pytest.mark.parametrize("near", [Near(), Near(spare=2, row_cost=-1e9, stars=1, heavy=4, block=3)])
def test_matches_brute_force(spark, near):
    rows = texts(3)
    df = spark.createDataFrame([(i, t, 1, 2, "k", "r") for i, t in rows], SCHEMA)
    got = shingle_join.near_duplicates(df, near).collect()
    want = slow(rows)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert len({c for _, _, c in want}) < 200  # there are links
    assert shingle_join.near_duplicates(df.limit(0), near).collect() == []


def test_exchanges_happen_and_keep_units(spark):
    near = Near(spare=2, row_cost=-1e9)
    df = spark.createDataFrame(texts(4), "doc_id long, text string")
    classes = shingle_join.sets(df, near).withColumn("rec", shingle_join.F.monotonically_increasing_id())
    swaps = shingle_join.allocation(classes, near)
    assert swaps and len({(g, i) for g, i, _ in swaps}) == len({(g, j) for g, _, j in swaps}) == len(swaps)
    assert not {(g, i) for g, i, _ in swaps} & {(g, j) for g, _, j in swaps}
    assert shingle_join.allocation(classes, Near(spare=2, row_cost=1e9)) == []


def test_stars_leave_nothing_apart(spark):
    """A chain of texts, each similar to its neighbours only, in entries
    with many strangers that share a passage."""
    rng = random.Random(6)
    pool = [f"w{i}" for i in range(3000)]
    base = [rng.choice(pool) for _ in range(120)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(base)))
        for _ in range(2):
            base[rng.randrange(len(base))] = rng.choice(pool)
    shared = [rng.choice(pool) for _ in range(60)]
    rows += [(100 + i, " ".join(shared + [rng.choice(pool) for _ in range(30)])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for near in (Near(stars=0), Near(stars=1, heavy=9, block=4)):
        got = sorted((tuple(r) for r in shingle_join.near_duplicates(df, near).collect()), key=str)
        assert got == slow(rows)
