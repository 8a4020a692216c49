"""Registered queries against their SQL on the given tables, and on tables
with nulls, blanks, ties, repeated rows, extra columns, and no rows."""

import duckdb
import pytest

from llm_setup import few_partitions  # noqa: F401
from reelsight.llm.queries import QUERIES, SQL
from tools.oracle_check import canon

SF001 = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, h string, before long, rule string"
BOILER = "Subscribe to our newsletter, 100 readers!"


def word(n):
    return "".join("bcdfghjklm"[int(c)] + "a" for c in str(n))


def odd_docs():
    rows = []
    for i in range(60):
        body = " ".join(word(1000 * i + j) for j in range(60))
        rows.append((i, f"Title {i}\n{body}\n{BOILER}\n{BOILER.upper()}", "en", "a" if i % 3 else "b"))
    # lines that do go: a long shared line, near copies, lines of figures
    shared = " ".join(word(77_000 + j) for j in range(80))
    rows += [(1000 + i, f"{shared}\n" + " ".join(word(90_000 + 10 * i + j) for j in range(9)), "en", "long") for i in range(30)]
    lines = [" ".join(word(80_000 + 20 * k + j) for j in range(15)) for k in range(9)]
    rows += [(2000 + i, "\n".join(x + (f" {word(95_000 + i)}" if k == i % 9 else "") for k, x in enumerate(lines)), "en", None) for i in range(50)]
    rows += [(3000 + i, " ".join(word(120_000 + 70 * i + j) for j in range(60)) + f"\nPrice {i},499\nPrice 5\n| 7 | 8 |\n\u00a0\nE", "en", "f") for i in range(30)]
    rows += [(100, None, None, None), (101, "", "en", "a"), (102, " \t\n ", "en", None), (103, "x y z " * 40, "en", "c"),
             (104, "a b c d e f g", "en", "a"), (105, "### $$$ <p> | " * 30, "en", ""), (None, "no id " + "q r s t u " * 30, "de", "é"),
             (7, rows[7][1], "en", "a"), (7, rows[7][1], "en", "a"), (106, "long " + " ".join(f"v{k}" for k in range(30_000)), "en", "a"),
             (107, f"{BOILER}\nsmall rest of a document that is " + "mostly boilerplate " * 3, "en", "a"),
             (108, "\n".join([BOILER] * 30), "en", "a"), (109, "ÀÉ ß\n" * 60, "fr", "a")]
    return [(*r, len(r[1] or ""), 1, "h", 2, "r") for r in rows]


URLS = ["http://www.example.com/en/1", "https://a.example.com/en/2", "http://example.com/fr/3?x=http://b.net/es/", None, "", "no scheme",
        "HTTP://WWW.Example.COM/en/5#f", "http://x.example.net/es/6", "http://net/fr/7", "http://notnet/fr/8", "http://com", "http://com/",
        "http://wexample.com/en/9", "x://?q", "ftp://h.org", "http://spam.org/1", "http://spam.org/2", "http://É.org:80/en/12"]


def write(spark, folder, rows, schema, name):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    f = str(tmp_path_factory.mktemp("odd"))
    write(spark, f, odd_docs(), DOCS, "documents")
    pages = [(i, u, "<p>x", "rule") for i, u in enumerate(URLS)] + [(0, URLS[0], None, None), (None, "http://spam.org/3", "", "")]
    pages += [(1000 + i, f"http://bad.org/en/{i}", "", "") for i in range(40)]
    pages += [(3000 + i, f"http://g{i % 20}.org/en/{500 + i}", "", "") for i in range(200)]
    # hosts that share a registered domain, a suffix of two labels, or are addresses
    odd_hosts = ["a.gov.uk", "b.gov.uk", "x.co.at", "me.github.io", "you.github.io", "10.0.0.1", "10.2.0.1:81", "[::1]:80", "co.uk", "u@h.com.au"]
    pages += [(5000 + 20 * k + i, f"http://{h}/en/{(i if k % 2 else 500 + i)}", "", "") for k, h in enumerate(odd_hosts) for i in range(15)]
    write(spark, f, pages, "page_id long, url string, html string, verdict string", "pages")
    labels = [(i, 0, None) for i in range(30)] + [(500 + i, 1, 0) for i in range(200)] + [(1, 1, 0), (None, 0, 1), (40, None, None)]
    write(spark, f, labels, "doc_id long, quality int, toxic int", "labels")
    return f


@pytest.fixture(scope="module")
def none(spark, odd, tmp_path_factory):
    f = str(tmp_path_factory.mktemp("none"))
    for t in ("documents", "pages", "labels"):
        spark.read.parquet(f"{odd}/{t}.parquet").limit(0).coalesce(1).write.parquet(f"{f}/{t}.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{f}/embeddings.parquet")
    return f


def compare(spark, name, folder):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        try:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'' if folder == SF001 else '/*.parquet'}')")
        except duckdb.IOException:
            continue
    cur = con.execute(SQL[name])
    df = QUERIES[name](spark, folder)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    want = canon([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


@pytest.mark.parametrize("name", sorted(SQL))
def test_given_tables(spark, name):
    compare(spark, name, SF001)


@pytest.mark.parametrize("name", sorted(SQL))
def test_odd_tables(spark, odd, name):
    compare(spark, name, odd)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, none, name):
    assert QUERIES[name](spark, none).collect() == []


@pytest.mark.parametrize("name", ["op1_simhash", "op3_secrets", "op6_bpe", "op8_toxicity", "op10_sharding"])
def test_odd_rows_come_back(spark, odd, name):
    got = QUERIES[name](spark, odd).collect()
    if name != "op3_secrets":
        assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in odd_docs())


def test_boilerplate_and_bad_hosts(spark, odd):
    kept = {r.doc_id: r for r in QUERIES["op4_quality"](spark, odd).collect()}
    assert kept[0].kept and kept[1].kept  # they lose only the shared line
    assert kept[1].n_cut_chars > 0 and kept[0].n_cut_chars == 0  # few documents of host b
    assert kept[100].n_words == 0 and not kept[100].kept
    assert not any(kept[1000 + i].kept for i in range(30))
    assert 1 <= sum(kept[2000 + i].kept for i in range(50)) <= 9
    assert {kept[3000 + i].n_cut_chars for i in range(30)} == {17} and all(kept[3000 + i].kept for i in range(30))
    from reelsight.llm import url_reputation
    hosts = spark.createDataFrame([(h,) for h in ("a.gov.uk", "x.me.github.io", "10.0.0.1", "[::1]:80", "u@w.h.org:8")], "host string")
    parts = url_reputation._registered(hosts.host, url_reputation.Reputation())
    assert [tuple(r) for r in hosts.select(*parts).collect()] == [
        ("a.gov.uk", "gov.uk"), ("me.github.io", "github.io"), ("10.0.0.1", "[address]"), ("[::1]", "[address]"), ("h.org", "org")]
    said = {r.host: r.verdict for r in QUERIES["op9_urls"](spark, odd).collect() if r.rule is None}
    assert said["bad.org"] == "block" and said["h.org"] == "allow" and said["spam.org"] == "allow"
