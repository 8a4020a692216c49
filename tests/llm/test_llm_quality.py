"""Shared lines of documents that are mostly boilerplate, and of near copies."""

import random

from llm_setup import few_partitions  # noqa: F401
from reelsight.llm import line_quality

SCHEMA = "doc_id long, text string, source string, n_chars int"


def words(rng, n):
    return " ".join("".join(rng.choice("abdefgiklmnoprstu") for _ in range(7)) for _ in range(n))


def kept(spark, rows):
    df = spark.createDataFrame([(i, t, "h", len(t)) for i, t in rows], SCHEMA)
    judged = {r.doc_id for r in line_quality.judge(df).collect() if r.kept}
    out = {r.doc_id: r.text for r in line_quality.clean(df).collect()}
    assert set(out) == judged
    return out


def test_one_long_shared_line_depletes(spark):
    rng = random.Random(1)
    shared = words(rng, 80)
    assert kept(spark, [(i, f"{shared}\n{words(rng, 12)}") for i in range(300)]) == {}
    rest = {i: words(rng, 70) for i in range(300)}
    assert kept(spark, [(i, f"{shared}\n{rest[i]}") for i in range(300)]) == rest


def test_template_pages_lose_their_lines(spark):
    rng = random.Random(2)
    template = [words(rng, 40 - 5 * i) for i in range(4)]
    out = kept(spark, [(i, "\n".join([*template, words(rng, 12)])) for i in range(300)])
    assert len(out) == 1  # indistinguishable from near copies: one of them is left


def test_near_copies_leave_one(spark):
    rng = random.Random(3)
    lines = [words(rng, 15) for _ in range(12)]
    rows = []
    for i in range(1000):
        mine = list(lines)
        at = rng.randrange(12)
        mine[at] = mine[at][:-7] + words(rng, 1)
        rows.append((i, "\n".join(mine)))
    other = [words(rng, 14) for _ in range(10)]  # another text, with lines of the first
    for i in range(1000, 1400):
        mine = lines[:2] + list(other)
        mine[rng.randrange(2, 12)] += " " + words(rng, 1)
        rows.append((i, "\n".join(mine)))
    out = kept(spark, rows)
    texts = dict(rows)
    assert 1 <= sum(i < 1000 for i in out) <= 12 and 1 <= sum(i >= 1000 for i in out) <= 12
    assert all(out[i] == texts[i] for i in out)


def test_lines_of_figures_stay(spark):
    rng = random.Random(4)
    rows = [(i, f"{words(rng, 60)}\n{1000 + i} | {i * 7} | {i}\nPrice: {i},499\n}}\n\u00a0\nTotal 5") for i in range(40)]
    out = {r.doc_id: r.text for r in line_quality.clean(spark.createDataFrame([(i, t, "h", len(t)) for i, t in rows], SCHEMA)).collect()}
    # only what all forty hold in the same characters goes
    assert out == {i: t.replace("\n}\n", "\n").replace("\nTotal 5", "") for i, t in rows}
