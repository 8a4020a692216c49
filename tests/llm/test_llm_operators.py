"""The other operators against brute force, their promises, and held-out
accuracy."""

import base64
import hashlib
import math
import random
import re

import numpy as np
import pytest

from llm_setup import few_partitions  # noqa: F401
from reelsight.llm import line_quality, mixing, prefix_forest, secret_scan, sharding, toxicity, url_reputation
from reelsight.llm.tables import running

# -- running sums -------------------------------------------------------------


def test_running_sums(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.randint(0, 20), rng.randint(0, 9)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, o int, v long")
    got = running(df, ["g"], ["o"], "v", "t").collect()
    for g in ("a", "b", None):
        mine = sorted((r.before, r.o, r.v) for r in got if r.g == g)
        at, last = 0, -1
        for before, o, v in sorted(mine, key=lambda x: (x[0], x[2] > 0, x[1])):
            assert before == at and o >= last
            at, last = at + v, o
        assert at == sum(v for x, _, v in rows if x == g)
    assert sorted(r.n for r in running(df, [], ["o", "v"], None, "t", out="n").collect()) == list(range(3000))

# -- mixing -------------------------------------------------------------------


def mix_rows(seed=1):
    rng = random.Random(seed)
    out = []
    for s, n in (("a", 400), ("b", 40), ("c", 40), ("d", 5), (None, 60)):
        out += [(len(out) + i, " ".join(["w"] * rng.randint(0, 30)), s, "clash") for i in range(n)]
    return out


def test_targets_fill_by_weight(spark):
    sizes = [("a", 1000), ("b", 10), ("c", 500), ("d", 0), (None, 90)]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    lo, hi = 0.0, 1e9
    for _ in range(200):  # the level, by bisection
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(2 * n, mid * weights[s]) for s, n in sizes) < 2400 else (lo, mid)
    for s, n in sizes:
        assert math.isclose(got[s], min(2 * n, lo * weights[s]), rel_tol=1e-9, abs_tol=1e-6)


def test_mix_keeps_its_promises(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies string")
    got = mixing.plan(df).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    for s in ("a", "b", "c", "d", None):
        mine = [r for r in got if r.source == s]
        assert all(r.taken in (0, r.size, 2 * r.size) for r in mine)
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 2 * max(r.size for r in mine)
    assert sum(r.taken for r in got) <= 1.5 * sum(r.size for r in got)
    again = mixing.plan(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    out = mixing.apply(df)
    assert out.columns == df.columns
    times = {}
    for r in out.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert times == {r.doc_id: r.copies for r in got if r.copies}

# -- sharding -----------------------------------------------------------------


def slow_assign(keys, ring):
    """Shard of each key: home rows first, in ring order, then the others
    clockwise."""
    arcs = ring.arcs()
    n, caps = len(arcs), ring.capacities(len(keys))
    at = []
    for i, k in enumerate(keys):
        p = ring.place("key " + ("null" if k is None else str(k)))
        arc = next((j for j, (x, _) in enumerate(arcs) if p <= x), n)
        at.append((arc % n, arc < n, p, i))
    used, out, over = [0] * ring.shards, {}, []
    for arc, _, _, i in sorted(at):
        s = arcs[arc][1]
        if used[s] < caps[s]:
            used[s] += 1
            out[i] = s
        else:
            over.append((arc, i))
    for arc, i in over:
        j = arc
        while True:
            j = (j + 1) % n
            s = arcs[j][1]
            if used[s] < caps[s]:
                used[s] += 1
                out[i] = s
                break
    return [out[i] for i in range(len(keys))]


@pytest.mark.parametrize("slack", [0.0, 0.2])
def test_sharding_matches_brute_force(spark, slack):
    ring = sharding.Ring(shards=5, vnodes=8, slack=slack)
    keys = list(range(200))
    df = spark.createDataFrame([(k, "x") for k in keys], "doc_id long, shard string")
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.assign(df.drop("shard"), ring).collect()}
    assert [got[k][0] for k in keys] == slow_assign(keys, ring)
    for s in range(5):
        slots = sorted(x for t, x in got.values() if t == s)
        assert slots == list(range(len(slots)))
        assert slack or len(slots) == 40


def test_hot_key_spreads(spark):
    ring = sharding.Ring(shards=4, vnodes=8)
    df = spark.createDataFrame([(1,)] * 90 + [(None,)] * 30 + [(k,) for k in range(50)], "doc_id long")
    got = sharding.assign(df, ring).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in got) == [42, 42, 43, 43]


def test_growing_moves_few(spark):
    df = spark.range(2000).withColumnRenamed("id", "doc_id")
    a = {r.doc_id: r.shard for r in sharding.assign(df, sharding.Ring(shards=10, slack=0.2)).collect()}
    b = {r.doc_id: r.shard for r in sharding.assign(df, sharding.Ring(shards=11, slack=0.2)).collect()}
    assert sum(a[k] != b[k] for k in a) < 0.3 * len(a)

# -- nearest neighbours -------------------------------------------------------


def vectors(n=1500, d=16, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, d))
    x = centres[rng.integers(0, 20, n)] + 0.7 * rng.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_recall_and_scores(spark):
    x = vectors()
    rows = [(i, [float(v) for v in row], "clash") for i, row in enumerate(x)]
    rows += [(5000 + i, rows[3][1], "tie") for i in range(40)] + [rows[0], rows[0]]
    rows += [(9000, None, ""), (9001, [0.0] * 16, ""), (9002, [float("nan")] * 16, ""), (9003, [float("inf")] + [0.0] * 15, ""),
             (9004, [1.0, None] + [0.0] * 14, ""), (9005, [1.0, 2.0], ""), (None, rows[5][1], "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    f = prefix_forest.Forest(trees=16, share=0.35, least=50, chunk=400, block=64)
    got = prefix_forest.search(df, df.where("vec_id % 20 = 0"), k=10, forest=f).collect()
    use = {r[0]: np.array(r[1]) for r in rows[:1540]}
    ids = np.array(sorted(use))
    mat = np.stack([use[i] for i in ids])
    hit, n = 0, 0
    for q in [i for i in ids if i % 20 == 0]:
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert [m[1:] for m in mine] == sorted((m[1:] for m in mine), key=lambda m: (-m[1], m[0]))
        s = (mat * use[q]).sum(axis=1)
        assert all(math.isclose(sc, float(use[q] @ use[v]), abs_tol=1e-12) and v != q for _, v, sc in mine)
        want = [v for v in ids[np.lexsort((ids, -s))] if v != q][:10]
        hit, n = hit + len(set(want) & {m[1] for m in mine}), n + 10
    assert hit / n >= 0.9
    assert {r.query_id for r in got} == {int(i) for i in ids if i % 20 == 0}


def test_fewer_candidates_than_k(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (40, [0.0, 1.0]), (41, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = prefix_forest.search(df, df.where("vec_id % 20 = 0"), k=20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(20, 1, 41, 1.0), (20, 2, 40, 0.0), (40, 1, 41, 1.0), (40, 2, 20, 0.0)]


def test_ascent_meets_longest_prefixes():
    """Candidates are exactly the rows whose prefix agrees, in some tree, up to
    the level where enough are met."""
    x = vectors(300)
    f = prefix_forest.Forest(trees=3, bits=16, share=0.1, least=1)
    t = prefix_forest.Trees(x, f)
    codes = [t.hash(x, p) for p in t.planes]
    for q, found in t.candidates(x[:20]).items():
        for level in range(16, -1, -1):
            met = np.flatnonzero(np.any([(c >> np.uint64(16 - level)) == (c[q] >> np.uint64(16 - level)) for c in codes], axis=0))
            if len(met) >= 30:
                break
        assert sorted(found) == sorted(met)

# -- toxicity -----------------------------------------------------------------


def toxic_docs(n=1200, seed=6):
    rng = random.Random(seed)
    base = ["".join(rng.choice("aeioustrnml") for _ in range(rng.randint(3, 9))) for _ in range(800)]
    bad = ["vexglor", "drazzik", "mobblen"]
    out = []
    for i in range(n):
        w = [rng.choice(base) for _ in range(rng.randint(20, 120))]
        grade = rng.choice([0, 0, 0, 1, 2])
        for _ in range({0: 0, 1: 2, 2: 6}[grade]):
            w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", "en", "s", "ung"]))
        out.append((i, " ".join(w), grade, "clash"))
    return out


def test_held_out_grades(spark):
    rows = toxic_docs()
    df = spark.createDataFrame(rows, "doc_id long, text string, truth int, severity string")
    labels = df.where("doc_id < 700").select("doc_id", df.truth.alias("grade"))
    labels = labels.union(spark.createDataFrame([(None, 2), (3, None), (5000, 1), (4, 9)], "doc_id long, grade int"))
    m = toxicity.model(df, labels, 3)
    got = {r.doc_id: r for r in toxicity.score(df, m).collect()}
    held = [r for r in rows if r[0] >= 700]
    assert np.mean([got[i].toxic == (g > 0) for i, _, g, _ in held]) > 0.98
    means = [np.mean([got[i].severity for i, _, g, _ in held if g == k]) for k in range(3)]
    assert means[0] < 0.1 < means[1] < means[2]
    th = [r.weight for r in m.where("column < 0").orderBy("column", ascending=False).collect()]
    assert th == sorted(th) and len(th) == 2
    two = toxicity.model(df, df.where("doc_id < 700").selectExpr("doc_id", "cast(truth > 0 as int) grade"))
    again = {r.doc_id: r for r in toxicity.score(df, two).collect()}
    assert np.mean([again[i].toxic == (g > 0) for i, _, g, _ in held]) > 0.98
    assert max(r.grade for r in again.values()) == 2


def test_no_labels_and_odd_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, "x y"), (2, "")], "doc_id long, text string")
    m = toxicity.model(df, spark.createDataFrame([], "doc_id long, grade int"))
    got = toxicity.score(df, m).collect()
    assert len(got) == 4 and not any(r.toxic for r in got)

# -- secrets ------------------------------------------------------------------


@pytest.fixture(scope="module")
def forest(spark):
    rows = secret_scan.labelled_findings(spark, 6000)
    return secret_scan.train(rows.limit(4000)), rows


def test_forest_on_held_out_findings(spark, forest):
    from pyspark.sql import functions as F

    f, rows = forest
    feats = secret_scan.features(*[F.col(c) for c in ("before", "name", "value", "after")])
    seen = secret_scan.labelled_findings(spark, 7500).exceptAll(rows).select(
        "label", F.struct(*[c.cast("double").alias(k) for k, c in feats.items()]).alias("f"))
    got = seen.select("label", F.expr(f).alias("s")).collect()
    assert len(got) > 1000 and np.mean([(r.s > 0.5) == (r.label == 1) for r in got]) > 0.95


def test_findings_and_redaction(spark, forest):
    f, _ = forest
    key = hashlib.sha1(b"1").hexdigest()
    texts = [(1, f'It is token = "{key}" é and\ntoken = "{key}"### api_key: {key[:32]};', 5), (2, None, None), (3, "", 0),
             (4, f"commit {key} fixes it", 3), (5, "plain words only", 2), (None, f'secret="{key}"', 1), (5, "plain words only", 2),
             (6, ("many words here " * 9000) + f'password = "{key[:20]}"', 1), (7, "see https://www.example.com/user/profile/page_12.html now", 1)]
    df = spark.createDataFrame(texts, "doc_id long, text string, n_chars long")
    got = secret_scan.findings(df, f).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for d, t, _ in texts:
        want = [m.span() for m in re.finditer(r"(?<=[\"' ])[0-9a-f]{20,40}(?![0-9a-f])", t or "")]
        if d != 7:
            assert [(r.start, r.end) for r in sorted(by.get(d, []), key=lambda r: r.start)] == want
    assert all(r.secret for d in (1, None, 6) for r in by[d]) and not any(r.secret for r in by[4])
    assert all(r.value_sha256 == hashlib.sha256(key.encode()).hexdigest() for r in by[4])
    out = secret_scan.redact(df, f)
    assert out.columns == df.columns
    red = sorted(((str(r.doc_id), r.text, r.n_chars) for r in out.collect()), key=str)
    assert len(red) == len(texts)
    text = {d: (t, n) for d, t, n in red}
    assert text["1"][0] == 'It is token = "[SECRET]" é and\ntoken = "[SECRET]"### api_key: [SECRET];' and text["1"][1] == len(text["1"][0])
    assert text["4"] == (texts[3][1], 3) and text["2"] == (None, None) and text["3"] == ("", 0)


def test_urls_dashed_names_and_key_blocks(spark, forest):
    f, _ = forest
    lines = [base64.b64encode(hashlib.sha384(b"%d" % i).digest()).decode() for i in range(20)]
    key = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\n\n" + "\n".join(lines) + "==\n-----END RSA PRIVATE KEY-----"
    texts = [(1, "see postgres://admin:hunter2pwX9@db.example.org/x now"), (2, 'secret-key: "q8Zk3LmP0x7Rt2"'), (3, f"head\n{key}\ntail"),
             (4, "open http://localhost:8080/a@b or http://h:80/ there"), (5, "the private key of a person, and secret things: none")]
    df = spark.createDataFrame([(i, t, len(t)) for i, t in texts], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r.text for r in secret_scan.redact(df, f).collect()}
    assert got[1] == "see postgres://admin:[SECRET]@db.example.org/x now"
    assert got[2] == 'secret-key: "[SECRET]"'
    assert got[3] == "head\n[SECRET]\ntail"
    assert got[4] == texts[3][1] and got[5] == texts[4][1]


def test_secret_training_does_not_compute_its_findings_in_each_pass(spark):
    """The fit makes several passes over the written features; the findings are computed twice at most."""
    from pyspark.sql import functions as F

    rows = secret_scan.labelled_findings(spark, 400)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        seen.add(1)
        return value

    forest = secret_scan.train(rows.withColumn("value", counted.asNondeterministic()("value")))
    assert seen.value <= 2 * 400 and forest == secret_scan.train(rows)


def test_secret_findings_have_a_small_plan(spark, monkeypatch):
    from pyspark.sql import functions as F

    made, lit = [], F.lit
    monkeypatch.setattr(F, "lit", lambda x: made.append(x) or lit(x))
    assert secret_scan.labelled_findings(spark, 20).count() == 20
    assert len(made) < 500


def test_one_class_gives_a_constant(spark):
    rows = secret_scan.labelled_findings(spark, 200)
    assert secret_scan.train(rows.where("label = 1")) == "1.0" and secret_scan.train(rows.limit(0)) == "0.0"

# -- quality and urls ---------------------------------------------------------


def test_clean_removes_lines(spark):
    word = lambda n: "".join("bcdfghjklm"[int(c)] + "a" for c in str(n))
    body = lambda i: "\n".join(" ".join(word(10_000 * i + 100 * j + k) for k in range(30)) for j in range(3))
    rows = [(i, f"Share this page!\n{body(i)}", "h", 1) for i in range(30)] + [(100 + i, body(99), "h", 1) for i in range(50)]
    rows += [(200, f"Share this page!\n{body(7)}", "other", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    out = {r.doc_id: r for r in line_quality.clean(df).collect()}
    letters = lambda t: re.sub("[^a-z]+", " ", t.lower())
    assert set(out) == {r[0] for r in rows}  # copies of one text are left to the near-duplicate stage
    assert "share" not in letters(out[3].text) and out[3].n_chars == len(out[3].text)
    assert out[200].text == rows[-1][1] and out[200].n_chars == 1


@pytest.mark.parametrize("url,host,path", [
    ("http://A.b/C?d", "a.b", "/C"), ("x://h#f/", "h", ""), ("//h/p", "", ""), (None, "", ""), ("a://É.X/q#", "É.x", "/q"), ("://", "", "")])
def test_host_and_path(spark, url, host, path):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(url,)], "u string")
    r = df.select(url_reputation.host(F.col("u")).alias("h"), url_reputation.path(F.col("u")).alias("p")).first()
    assert (r.h, r.p) == (host, path)


def test_reputation_shrinks(spark):
    rows = [("bad.a.com", True)] * 60 + [("one.b.com", True)] + [(f"x{i}.b.com", False) for i in range(60)] + [("new.a.com", None)]
    got = {r.host: r for r in url_reputation.reputations(spark.createDataFrame(rows, "host string, bad boolean")).collect()}
    assert got["bad.a.com"].bound > 0.5 and got["one.b.com"].bound < 0.5
    assert got["x1.b.com"].mean < got["one.b.com"].mean < got["bad.a.com"].mean
    assert got["new.a.com"].n == 0 and 0 < got["new.a.com"].mean < 1
