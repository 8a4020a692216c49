"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from llm_setup import few_partitions  # noqa: F401
from reelsight.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, id string, form string"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow(rows):
    count = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 7 and c >= 2}
    out = {}
    for w in n:
        near = [v for v in n if one_edit(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        out[w] = (best if best is not None and n[best] >= 10 * n[w] else None, len(near))
    full = {}
    for w in n:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        form = out[w][0]
        full[w] = (w, form, root, n[w], out[w][1], None if form is None else n[form])
    return full


def texts():
    rng = random.Random(5)
    letters = "abcdeéÀß÷"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 10))) for _ in range(25)]
    pool = list(base) + ["abcdefgh" * 5, "aaaaaaaa", "aaaaaaa", "aaaaaaaaa", "z" * 70, "z" * 71, "q" * 63 + "x", "q" * 64 + "x",
                         "q" * 65, "long" * 900, "long" * 900 + "e"]
    for w in base:
        for _ in range(4):
            i = rng.randrange(len(w))
            pool.append(rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]]))
    rows = []
    for i in range(80):
        ws = [rng.choice(pool) for _ in range(30)]
        ws += ["commonword"] * 40 + (["commonwordd"] * (i % 3 == 0)) + (["commonworddy"] if i in (3, 4) else [])
        rows.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in ws)))
    return rows + [(100, None), (101, ""), (102, "12 ?? \n"), (None, "without an identity identity"), (7, rows[7][1]), (7, rows[7][1])]


def test_matches_brute_force(spark):
    rows = texts()
    df = spark.createDataFrame([(i, t, "w", 1, "x", "f") for i, t in rows], SCHEMA)
    got = spelling.variants(df).collect()
    want = slow(rows)
    assert {r.word: tuple(r) for r in got} == want and len(got) == len(want)
    assert any(v[1] and v[2] != v[1] for v in want.values())  # a way of two forms
    assert spelling.variants(df.limit(0)).collect() == []


def test_parts_of_a_text_add_up(spark, monkeypatch):
    rows = texts()[:20]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(r.word, r.n) for r in spelling.vocabulary(df).collect()}
    monkeypatch.setattr(spelling, "CHUNK", 7)
    monkeypatch.setattr(spelling, "HELD", 5)
    assert {(r.word, r.n) for r in spelling.vocabulary(df).collect()} == want


WORDS = st.text(alphabet="abcé", min_size=1, max_size=7)


@settings(max_examples=300, deadline=None)
@given(st.lists(WORDS, min_size=2, max_size=25, unique=True), st.integers(2, 4))
def test_every_pair_is_met_once(words, size):
    """Whatever the alphabets, each near pair is met from one end."""
    reduced = spelling.Reduced({"a": 9, "b": 5, "c": 4, "é": 1}, {n: 2 + (n * size) % 3 for n in range(9)}, 8)
    key = {w: int(reduced.own([w])[0]) for w in words}
    met = Counter()
    for w in words:
        at, keys, own = reduced.once([w])
        assert len(set(keys.tolist())) == len(keys)
        for k, o in zip(keys.tolist(), own.tolist()):
            for v in words:
                if key[v] == k and v != w and (not o or w < v):
                    met[frozenset((v, w))] += 1
    for i, a in enumerate(words):
        for b in words[:i]:
            if one_edit(a, b):
                assert met[frozenset((a, b))] == 1, (a, b)
