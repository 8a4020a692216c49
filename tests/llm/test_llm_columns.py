"""Tables whose other columns have the names of helpers, and repeated rows
that differ in another column only."""

import pytest

import corpus_pipeline
from llm_setup import few_partitions  # noqa: F401
from reelsight.llm import mixing
from reelsight.llm.queries import QUERIES

#: Names that the operators give to columns of their own.
NAMES = ("_a _b _k _ka _kb _cut _i _pieces _found _raw _seen _id _t _w _l _s _at _host _th _lines _fp _off _pid _g _tie _n _1 _2 _r _p "
         "a b k t h i p n id key row rec hub comp grade rank score fp root node seg val size before before_ word form cut times copies "
         "taken target idx ka kb cols band home whole output finish x c now hits label f").split()
ROWS = 70


def rows():
    base = [(i, f"Text {i} " + " ".join(f"w{'abcdefghij'[(i + j) % 10]}{'klmnopq'[j % 7]}{'rstuvwxyz'[i % 9]}{'bcd' * (i // 9 % 8)}" for j in range(70))
             + f' token = "0123456789abcdef0123456789abcdef0123{i:04d}"', "en", "ab"[i % 2], 10) for i in range(ROWS)]
    return base + [(40, base[40][1], "de", "b", 10), (40, base[40][1], "de", "b", 10)]


@pytest.fixture(scope="module")
def clashing(spark, tmp_path_factory):
    f = str(tmp_path_factory.mktemp("clash"))
    more = [f"m_{n}" for n in NAMES]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
    docs = spark.createDataFrame([(*r, *[m for m in more]) for r in rows()], schema)
    docs.write.parquet(f"{f}/documents.parquet")
    labels = [(i, 1, i % 2, "g", "i") for i in range(ROWS)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, grade string, _id string").write.parquet(f"{f}/labels.parquet")
    return f


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n not in ("op2_html", "op5_neighbours", "op9_urls")])
def test_queries(spark, clashing, name):
    got = QUERIES[name](spark, clashing).collect()
    if name not in ("op3_secrets", "op11_spelling"):
        assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows())
    assert got


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, clashing, stage):
    docs = spark.read.parquet(f"{clashing}/documents.parquet")
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, clashing)
    if stage != "tokens":
        assert out.columns == docs.columns
    got = out.collect()
    assert got
    for r in got:
        assert all(r[n] == f"m_{n}" for n in NAMES if n in out.columns)


def test_repeated_rows_keep_their_other_columns(spark):
    docs = spark.createDataFrame([(1, "some words here", "en", "a"), (1, "some words here", "de", "a"), (1, "some words here", "de", "a")],
                                 "doc_id long, text string, lang string, source string")
    whole = mixing.apply(docs, mixing.Mix(share=1.0, repeats=1))
    assert sorted(r.lang for r in whole.collect()) == ["de", "de", "en"]
    twice = mixing.apply(docs, mixing.Mix(share=2.0, repeats=2))
    assert sorted(r.lang for r in twice.collect()) == ["de"] * 4 + ["en"] * 2
